"""Global row numbers and running totals without a single-task sort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.operators.skew import task_count
from auditloom.storage import staged

ONE_TASK_ROWS = 1_000_000

# monotonically_increasing_id: task number above bit 33, position in the task below
_TASK_BITS = 33


def stage_in_order(df, order, name="ordered", total=None):
    """Write ``df``, of ``total`` rows, range partitioned and sorted by the total ``order``.

    The table gets ``_task`` and ``_place``: the range a row lies in, and its place there.
    Both are written with the rows, so every later reader sees the same ranges.
    """
    tasks = task_count(df.sparkSession, df.count() if total is None else total)
    ranges = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    ranged = (
        ranges.sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_id", _TASK_BITS))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)))
        .drop("_id")
    )
    return staged(ranged, name)


def _rows_before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _with_start(ordered, size):
    """Add ``_before``, the total of ``size`` over the earlier ranges.

    There is one such total per task, so its window and broadcast stay small.
    """
    sizes = ordered.groupBy("_task").agg(F.sum(size).alias("_size"))
    starts = sizes.select("_task", F.coalesce(
        F.sum("_size").over(_rows_before(Window.orderBy("_task"))), F.lit(0)).alias("_before"))
    return ordered.join(F.broadcast(starts), "_task")


def number_rows(df, order, name):
    """Add the row number from 1 in the total ``order``."""
    ordered = stage_in_order(df, order)
    return (
        _with_start(ordered, F.lit(1))
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_task", "_place", "_before")
    )


def running_start(table, order, size, name, one_task_rows=ONE_TASK_ROWS):
    """Add the total of ``size`` over all rows earlier in ``order`` to a staged table."""
    total = table.count()
    if total <= one_task_rows:
        before = F.sum(size).over(_rows_before(Window.orderBy(*order)))
        return table.withColumn(name, F.coalesce(before, F.lit(0)))
    ordered = _with_start(stage_in_order(table, order, total=total), F.col(size))
    before = F.sum(size).over(_rows_before(Window.partitionBy("_task").orderBy("_place")))
    return (
        ordered.withColumn(name, F.col("_before") + F.coalesce(before, F.lit(0)))
        .drop("_task", "_place", "_before")
    )
