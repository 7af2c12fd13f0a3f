"""Exact deduplication as a stateful stream.

Rows arrive as files of a staged table that names each row (``row``: the content locator). A
streaming aggregation keyed by the digest of the normalised text keeps, on disk (RocksDB) and
without expiry, the stable identifier and locator of the row that stays and the number of equal
rows. Tasks combine the rows of a digest before the shuffle, so a text that makes up a third of
all rows reaches its state partition as one row per task. Rows that hit a known digest are
compared with the retained content, byte by byte; if a digest was shared by different texts, those
rows are grouped again by the texts themselves.
"""

from pyspark.sql import functions as F

from auditloom.llm.common import ascii_lower
from auditloom.storage import few_tasks, new_path, staged, write_staged

MAX_BATCH_BYTES = 256 << 30   # of the files a micro-batch reads
STORE_MEMORY_MB = 256      # native memory of the state stores of an executor
FILTER_SLOTS = 1 << 28     # bits of the largest filter broadcast before texts are shuffled: 32 MB

_STORE = "spark.sql.streaming.stateStore."
_FILES = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def sha256(text):
    return F.sha2(text.cast("binary"), 256)


def _stream_session(spark):
    """A session with its own settings for the state store."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and not key.startswith("spark.sql.warehouse"):
            try:
                session.conf.set(key, value)
            except Exception:   # a static setting, which sessions share
                continue
    session.conf.set(
        _STORE + "providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set(_STORE + "rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set(_STORE + "rocksdb.allowFAllocate", "false")   # else each store reserves megabytes of disk
    # the checkpoint is read by its own run only; a file of checksums for each of its files would take four threads a store,
    # and on a local folder each rename of the default manager starts four processes
    session.conf.set("spark.sql.streaming.checkpoint.fileChecksum.enabled", "false")
    session.conf.set("spark.sql.streaming.checkpointFileManagerClass", _FILES)
    session.conf.set(_STORE + "rocksdb.boundedMemoryUsage", "true")
    session.conf.set(_STORE + "rocksdb.maxMemoryUsageMB", STORE_MEMORY_MB)
    return session


def _keyed_state(spark, arrivals_path, arrivals_schema, max_batch_bytes):
    """The state after all arrivals: digest, keep (doc_id, row) and copies.

    Each micro-batch writes the groups it changed into a folder of its own, which a repeated
    batch overwrites; the last version of a group is the one with the most copies.
    """
    session = _stream_session(spark)
    out = new_path(spark, "state")
    changed = (
        session.readStream.schema(arrivals_schema).option("maxBytesPerTrigger", max_batch_bytes)
        .parquet(arrivals_path).groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("copies"))
    )

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        changed.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", new_path(spark, "stream")).trigger(availableNow=True).start())
    query.awaitTermination()
    schema = "digest string, keep struct<doc_id: bigint, row: bigint>, copies bigint"
    versions = spark.read.schema(f"{schema}, batch int").parquet(out)
    batches = versions.agg(F.max("batch")).first()[0]
    if not batches:
        return versions.drop("batch")
    last = versions.groupBy("digest").agg(F.max(F.struct("copies", "keep")).alias("last"))
    return last.select("digest", "last.keep", "last.copies")


def _marked(rows, hits, column, slots=None):
    """``rows`` with ``_may``: true where ``column`` is among that of ``hits``, and for few other rows.

    One bit per slot of a hash of the column, in bitmaps of 4 KB, is broadcast. The number of slots
    follows the hits up to a fixed bound; beyond it the filter marks more rows.
    """
    slots = slots or min(FILTER_SLOTS, 1 << max(15, (16 * hits.count()).bit_length()))
    slot = F.pmod(F.xxhash64(column), F.lit(slots)) + 1
    maps = hits.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    power = F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), (place % 8 + 1).cast("int"))
    found = rows.withColumn("_bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(maps), "_bucket", "left")
    return found.select(*rows.columns, F.coalesce(byte.bitwiseAND(power) != 0, F.lit(False)).alias("_may"))


def _may_hit(rows, hits, column, slots=None):
    """The rows whose ``column`` may be among that of ``hits``: all that are, and few others."""
    return _marked(rows, hits, column, slots).where("_may").drop("_may")


def _decide(rows, groups, key):
    """keep, copies and group of each row; groups of one row take the same way."""
    return rows.join(groups, key).select(
        "row", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"),
        F.col("copies").alias("group_size"))


def _decisions(docs, digest, max_batch_bytes):
    """The staged rows of ``docs``, and for each ``row`` its keep_id, keep_row and group_size."""
    spark = docs.sparkSession
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        digest(text).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    path = new_path(spark, "arrivals")
    arrivals = write_staged(rows, path)
    n = arrivals.count()
    if not n:
        return arrivals, arrivals.select(
            "row", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("row").alias("group_size"))
    keys = arrivals.select("row", "doc_id", "digest")
    state = staged(few_tasks(_keyed_state(spark, path, keys.schema, max_batch_bytes), n), "groups")

    hits = staged(state.where("copies > 1").select("digest", F.col("keep.row").alias("row")), "hits")
    body = ascii_lower(F.coalesce(F.col("doc.text"), F.lit(""))).cast("binary")
    bodies = arrivals.select("row", "digest", body.alias("body"))
    # only texts that may be compared are shuffled; the unequal are written, as a distinct on
    # the join's own key would keep Spark from splitting a hot digest
    retained = _may_hit(bodies, hits, "row").join(hits, ["digest", "row"]).select("digest", F.col("body").alias("retained"))
    unequal = staged(
        _may_hit(bodies, hits, "digest").join(retained, "digest").where("body != retained").select("digest"), "unequal")
    differ = unequal.distinct()
    if differ.isEmpty():
        groups, exact = state, None
    else:
        groups = state.join(differ, "digest", "left_anti")
        mixed = arrivals.select("row", "doc_id", "digest", body.alias("body")).join(differ, "digest", "left_semi")
        by_text = mixed.groupBy("digest", "body").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("copies"))
        exact = _decide(mixed, by_text, ["digest", "body"])
    decided = _decide(keys, groups, "digest")
    if exact is not None:
        decided = decided.unionByName(exact)
    return arrivals, staged(few_tasks(decided, 2 * n) if exact is None else decided, "decided")


def deduplicate(docs, digest=sha256, max_batch_bytes=MAX_BATCH_BYTES):
    """Stage ``docs`` and decide for every row which of the rows with an equal text stays.

    ``docs`` has doc_id, text and any other columns. Texts are equal if identical after
    lower-casing A-Z; a missing text is an empty one. Of equal texts the row with the largest
    doc_id stays; rows without an id rank below all others, and of rows with one id exactly one
    stays. Returns the input row as the struct ``doc``, its ``digest``, ``keep_id``, ``group_size`` and
    ``kept``. An empty table gives no rows.
    """
    arrivals, decided = _decisions(docs, digest, max_batch_bytes)
    return arrivals.select("row", "digest", "doc").join(decided, "row").select(
        "doc", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def survivors(docs, digest=sha256, max_batch_bytes=MAX_BATCH_BYTES):
    """The rows of ``docs`` that ``deduplicate`` keeps, with all their columns.

    Rows that a filter of the dropped ones does not mark stay where they are; only the marked
    ones, the dropped and a few others, are shuffled to be told apart.
    """
    arrivals, decided = _decisions(docs, digest, max_batch_bytes)
    dropped = staged(decided.where("row != keep_row").select("row"), "dropped")
    marked = _marked(arrivals.select("row", "doc"), dropped, "row")
    told = marked.where("_may").join(dropped, "row", "left_anti")
    return marked.where("NOT _may").unionByName(told).select("doc.*")
