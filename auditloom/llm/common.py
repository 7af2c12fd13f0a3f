"""Small helpers that the training-data operators share."""

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20   # text a Python task works on at once


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_workers_import(spark):
    """Put the folder of this package on the workers' path (a cluster needs it installed there)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_arrow(df, function, schema):
    """``mapInArrow`` with a function of one record batch that yields record batches."""
    let_workers_import(df.sparkSession)

    def batches(stream):
        for batch in stream:
            yield from function(batch)

    return df.mapInArrow(batches, schema)


def small_batches(batch, column, limit=SLICE_BYTES):
    """Cut a record batch so that a slice holds about ``limit`` bytes of ``column``, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def utf8(column):
    """The bytes of a text column as a list; missing texts are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column):
    """The strings of a text column; missing ones are empty, broken UTF-8 is replaced."""
    return [x.decode("utf-8", "replace") for x in utf8(column)]


def ascii_lower(column):
    """Lower-case A-Z only, unlike ``lower``, which also maps other letters."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
