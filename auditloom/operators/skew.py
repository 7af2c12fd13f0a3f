"""Joins and splits that keep working when one key holds a large share of the rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditloom.storage import staged

HEAVY_ROWS = 500_000           # a key with fewer rows fits one task
TASK_ROWS = 250_000            # rows a task of a row shuffle should get; all rules together need 2.5 KB a row
MAX_TASKS = 100_000            # more tasks would make too many shuffle blocks
BROADCAST_VALUES = 1_000_000   # values of the largest lookup table sent to every executor
TEXT_BYTES = 16                # of a text that count as one value
SPREAD = 4_096


def heaviest(counts, weight, heavy_rows=None):
    """The rows of ``counts`` whose weight exceeds ``heavy_rows``.

    Weights add up to the rows there are, so a trillion rows have at most two million of them.
    """
    return counts.where(F.col(weight) > (HEAVY_ROWS if heavy_rows is None else heavy_rows))


def task_count(spark, total, task_rows=TASK_ROWS):
    """Tasks for a shuffle of ``total`` rows, or None where the session's setting gives them few enough.

    Adaptive execution merges the session's partitions until about one a core is left, whatever they
    hold, so rows that need more tasks than there are cores get a number that it leaves alone.
    """
    tasks = min(-(-(total or 0) // task_rows), MAX_TASKS)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, default) if tasks > min(default, spark.sparkContext.defaultParallelism) else None


def shuffle_by(rows, total, *keys, task_rows=TASK_ROWS):
    """Hash partition ``total`` rows, into more tasks than the session's default if they need them."""
    tasks = task_count(rows.sparkSession, total, task_rows)
    return rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)


def count_keys(rows, key):
    """A staged table with the number of rows ``_n`` of every key, a missing one included."""
    return staged(rows.groupBy(key).agg(F.count("*").alias("_n")), "counts")


def split_heavy(rows, key, counts, heavy_rows=None):
    """Split rows into (rows of light keys, rows of heavy keys or None if there are none).

    ``counts`` is the table of ``count_keys`` or one with the same columns.
    """
    heavy = heaviest(counts.select(F.col(key).alias("_heavy"), "_n"), "_n", heavy_rows).select("_heavy")
    if heavy.isEmpty():
        return rows, None
    heavy = staged(heavy, "heavy_keys")
    same = F.col(key).eqNullSafe(F.col("_heavy"))
    return (
        rows.join(F.broadcast(heavy), same, "left_anti"),
        rows.join(F.broadcast(heavy), same, "left_semi"),
    )


def _values_of(column, kind):
    """Number of values a column holds: struct fields, array elements, texts by length."""
    if isinstance(kind, T.StructType):
        return sum((_values_of(column[f.name], f.dataType) for f in kind), F.lit(0))
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        each = F.aggregate(column, F.lit(1).cast("bigint"), lambda s, x: s + _values_of(x, element).cast("bigint"))
        return F.coalesce(each, F.lit(1))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 1 + F.coalesce(F.floor(F.octet_length(column) / TEXT_BYTES), F.lit(0))
    return F.lit(1)


def _values(table):
    """Number of values a row of the table holds."""
    return sum((_values_of(F.col(f.name), f.dataType) for f in table.schema), F.lit(0))


def lookup(rows, table, on, weight, broadcast_values=None, heavy_rows=None, spread_by="row_id"):
    """Left join ``rows`` with the staged ``table``, which has one row per key ``on``.

    ``weight`` is the column of ``table`` with the number of rows of each key; it is not
    returned. A small table is broadcast after its values were counted. For a larger one the
    payload of the heavy keys is broadcast, and the rows of those keys (and of missing
    keys, which match nothing) are spread by a hash of ``spread_by`` over all tasks of the
    shuffle join.
    """
    limit = BROADCAST_VALUES if broadcast_values is None else broadcast_values
    payload = [c for c in table.columns if c not in on and c != weight]
    size, total = table.agg(F.coalesce(F.sum(_values(table)), F.lit(0)), F.sum(weight)).first()
    if size <= limit:
        return rows.join(F.broadcast(table.drop(weight)), on, "left")

    keys = [f"_k{i}" for i in range(len(on))]
    heavy = heaviest(table, weight, heavy_rows).select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)], F.struct(*payload).alias("_heavy"))
    match = F.lit(True)
    missing = F.lit(False)
    for c, k in zip(on, keys):
        match = match & (F.col(c) == F.col(k))
        missing = missing | F.col(c).isNull()
    rows = rows.join(F.broadcast(heavy), match, "left").drop(*keys)
    spread = F.when(
        missing | F.col("_heavy").isNotNull(),
        1 + F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)),
    ).otherwise(F.lit(0).cast("bigint"))
    # zero, but no literal: the optimizer would move a literal into the join condition, and the
    # rows would be shuffled again by the keys alone
    none = (F.col(weight) * 0).cast("bigint")
    light = table.where(F.col(weight).isNotNull()).select(*on, none.alias("_spread"), F.struct(*payload).alias("_light"))
    rows = shuffle_by(rows.withColumn("_spread", spread), total, *on, "_spread")
    rows = rows.join(light, [*on, "_spread"], "left")
    rows = rows.withColumns({c: F.coalesce(F.col(f"_heavy.{c}"), F.col(f"_light.{c}")) for c in payload})
    return rows.drop("_heavy", "_light", "_spread")
