"""Stratified sample: all frauds, and a bounded number of other transactions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.operators.ordering import number_rows, running_start
from auditloom.storage import staged

CHUNK_ROWS = 250_000
CHUNKS = 25
CELL_IDS = 65_536   # consecutive ids counted together
_HEX = 4   # 65,536 buckets of the order hash


def _lowest(rows, n):
    """The ``n`` rows with the lowest ``_order`` hash, without sorting them all.

    Counting the hash by its first digits finds the bucket in which the n-th row lies; rows
    below it are kept as they are, and only the rows of that bucket are sorted.
    """
    bucket = F.substring("_order", 1, _HEX)
    counts = rows.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_before", F.coalesce(before, F.lit(0)))
    last = counts.where(F.col("_before") < n).orderBy(F.desc("_bucket")).first()
    if last is None:
        return rows.limit(0)
    kept = rows.where(bucket < last["_bucket"])
    edge = rows.where(bucket == last["_bucket"]).orderBy("_order", "row_id").limit(n - last["_before"])
    return kept.unionByName(edge)


def number_by_id(rows):
    """Add ``_number``, the rows with smaller row_ids, to rows of (row_id, any others); ids are unique.

    Counting the ids by their leading bits gives the rows before each cell of ``CELL_IDS`` ids, one
    row per cell. Where a cell has no gaps, as the ids of a scan or of a database have none, an id's place in
    it is a difference; only rows of other cells are shuffled, by cell, to rank at most that many.
    """
    cell = F.floor(F.col("row_id") / CELL_IDS).cast("bigint")
    cells = rows.groupBy(cell.alias("_cell")).agg(
        F.count("*").alias("_n"), F.min("row_id").alias("_low"), F.max("row_id").alias("_high"))
    whole = F.col("_n") == F.col("_high") - F.col("_low") + 1
    cells = running_start(
        staged(cells.withColumn("_whole", whole), "cells"), [F.asc("_cell")], "_n", "_before")
    placed = rows.withColumn("_cell", cell).join(cells.select("_cell", "_whole", "_low", "_before"), "_cell")
    even = placed.where("_whole").withColumn("_number", F.col("_before") + F.col("row_id") - F.col("_low"))
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy("row_id"))
    other = placed.where("NOT _whole").withColumn("_number", F.col("_before") + rank - 1)
    columns = [*rows.columns, "_number"]
    return even.select(columns).unionByName(other.select(columns))


def stratified_sample(df, n_normal=150_000, seed=42, chunk_rows=CHUNK_ROWS):
    """All rows with isFraud = 1, and up to ``n_normal`` with isFraud = 0.

    Every chunk of ``chunk_rows`` consecutive rows gives at most n_normal / 25 of them. Rows are
    numbered without gaps in order of row_id first, and the choice is by a hash of that number
    and the seed, so it is the same in every run and for every split of the input. Only ids and labels
    take part in the choice; the at most ``n_normal`` chosen ids then fetch their rows.
    """
    rows = number_by_id(df.select("row_id", "isFraud"))
    order = F.md5(F.concat_ws("-", F.col("_number").cast("string"), F.lit(str(seed))))
    place = Window.partitionBy("_chunk").orderBy("_order", "row_id")
    normal = staged(
        rows.where("isFraud = 0").withColumn("_order", order)
        .withColumn("_chunk", F.floor(F.col("_number") / chunk_rows))
        .withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") <= n_normal // CHUNKS).select("row_id", "_order"), "normal")
    chosen = staged(_lowest(normal, n_normal).select("row_id"), "chosen")
    return df.where("isFraud = 1").unionByName(df.join(chosen, "row_id", "left_semi").select(df.columns))


def shuffled(sample, seed=42):
    """Add ``position``, from 0, in an order by a seeded hash of row_id; it is the same for every split.

    The order is written in ranges, so a reader of the files in turn meets the rows in it.
    """
    key = F.md5(F.concat_ws("-", F.lit("shuffle"), F.col("row_id").cast("string"), F.lit(str(seed))))
    numbered = number_rows(sample.withColumn("_key", key), ["_key", "row_id"], "position")
    return numbered.withColumn("position", F.col("position") - 1).drop("_key")


def sample_summary(sample):
    return sample.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_records"),
        F.count_if(F.col("isFraud") == 0).alias("normal_records"))
