"""Intermediate tables in the folder all executors share.

A staged table cuts lineage (a lost executor re-reads files instead of re-running
the job) and has a known file size, so later joins choose broadcast or shuffle
from facts.
"""

import math
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.util import inheritable_thread_target


FOLDER_KEY = "auditloom.shared.folder"   # may be set at run time, unlike spark.checkpoint.dir
SCOPE_KEY = "auditloom.shared.scope"     # the folder of the open scope of a session
NARROW_ROWS = 250_000                    # rows of a few numbers or digests that a task reads


def set_shared_folder(spark, folder):
    """Name the folder for intermediate tables where spark.checkpoint.dir is unset."""
    spark.conf.set(FOLDER_KEY, folder)


def shared_folder(spark):
    """The folder all executors share: spark.checkpoint.dir, or the one of ``set_shared_folder``.

    Where neither is set, a local master gets a scratch folder; a cluster has no folder that
    could be guessed, so it gets an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(
                "No shared folder: set spark.checkpoint.dir, or call set_shared_folder with a path "
                "that the driver and all executors reach")
        folder = tempfile.mkdtemp(prefix="auditloom-")
        set_shared_folder(spark, folder)
    return f"{folder.rstrip('/')}/auditloom/{spark.sparkContext.applicationId}"


def new_path(spark, name):
    folder = spark.conf.get(SCOPE_KEY, None) or shared_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scope(spark, name):
    """Inside the block, the session's intermediate tables go to one folder, whose path it gives.

    Its owner may ``remove`` the folder once all results that read it are written.
    """
    outer = spark.conf.get(SCOPE_KEY, None)
    path = new_path(spark, name)
    spark.conf.set(SCOPE_KEY, path)
    try:
        yield path
    finally:
        if outer:
            spark.conf.set(SCOPE_KEY, outer)
        else:
            spark.conf.unset(SCOPE_KEY)


def remove(spark, path):
    """Delete a folder of intermediate tables that no result needs any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_staged(df, path):
    """Write ``df`` as an intermediate table, in a codec that suits text, and read it back."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df, name="stage"):
    """Write ``df`` as parquet into the shared folder and return the table read back."""
    return write_staged(df, new_path(df.sparkSession, name))


def few_tasks(df, rows):
    """``df`` in a task per ``NARROW_ROWS`` of the ``rows`` its last stage reads, or per core if that is more.

    For tables of narrow rows that are about to be staged. Where there are many more shuffle partitions,
    each would write a file that costs more than its rows; more partitions than there are, are never made.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / NARROW_ROWS)))


def spread_small(df, key="row_id"):
    """Give a scan of fewer splits than cores to all cores; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, key)


def concurrently(spark, *jobs):
    """Run independent jobs side by side, so small ones do not wait for each other."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]
