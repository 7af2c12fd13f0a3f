"""Data-quality report of raw transactions."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from auditloom.functions.columns import half_even
from auditloom.operators.skew import task_count
from auditloom.storage import staged

TASK_VALUES = 2_000_000    # values of all columns that a task of the profile should get
CHUNKS = 64                # hashed into each task, so that tasks are alike in size


def _distinct_values(df, columns, tasks):
    """Number of distinct present values ``n_unique`` of each column, given by its position ``_i``.

    Equal values are reduced in ``tasks`` chunks of the rows, then in as many ranges of their hash, so a
    task holds its share of the values however the rows are stored. A value met everywhere comes in
    once a chunk. Without ``tasks`` the values are few enough for the session's own shuffle.
    """
    types = dict(df.dtypes)
    kinds = list(dict.fromkeys(types[c] for c in columns))
    slots = [f"_v{j}" for j in range(len(kinds))]

    def cell(i, c):
        return F.struct(F.lit(i).alias("_i"), *[
            (F.col(f"`{c}`") if types[c] == k else F.lit(None).cast(k)).alias(s) for k, s in zip(kinds, slots)])

    every = [F.col(f"`{c}`") for c in df.columns]
    place = F.xxhash64(F.coalesce("row_id", F.xxhash64(*every)) if "row_id" in df.columns else F.xxhash64(*every))
    chunk = F.pmod(place, F.lit(CHUNKS * (tasks or 1))).alias("_chunk")
    rows = df.select(chunk, *[F.col(f"`{c}`") for c in columns])
    rows = rows.repartition(tasks, "_chunk") if tasks else rows
    cells = rows.select("_chunk", F.explode(F.array(*[cell(i, c) for i, c in enumerate(columns)])).alias("_c"))
    cells = cells.select("_chunk", "_c.*").where(reduce(or_, [F.col(s).isNotNull() for s in slots]))
    if tasks:
        cells = cells.groupBy("_chunk", "_i", *slots).agg(F.lit(1)).withColumn("_hash", F.xxhash64("_i", *slots))
        cells = cells.repartition(tasks, "_hash").groupBy("_hash", "_i", *slots).agg(F.lit(1))
    else:
        cells = cells.groupBy("_i", *slots).agg(F.lit(1))
    return cells.groupBy("_i").agg(F.count("*").alias("n_unique"))


def column_profile(df, columns=None, approximate=False, task_values=TASK_VALUES):
    """One row per column: type, missing values, their percentage, distinct values.

    All columns come from one scan. The approximate form merges one sketch per column and shuffles a row
    per task. The exact form counts the rows first, then expands each row once per column and reduces
    equal values of all columns together, in tasks of about ``task_values`` values.
    """
    columns = columns or [c for c in df.columns if c != "row_id"]
    types = dict(df.dtypes)
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"present_{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"unique_{i}") for i, c in enumerate(columns) if approximate])
    counts = counts if approximate else staged(counts, "counts")
    lines = F.array(*[
        F.struct(F.lit(i).alias("_i"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 (F.col("rows") - F.col(f"present_{i}")).alias("n_missing"),
                 *([F.col(f"unique_{i}").alias("n_unique")] if approximate else []))
        for i, c in enumerate(columns)])
    lines = counts.select("rows", F.inline(lines))
    if not approximate:
        tasks = task_count(df.sparkSession, counts.first()["rows"] * len(columns), task_values)
        found = _distinct_values(df, columns, tasks)   # a row per column
        lines = lines.join(F.broadcast(found), "_i", "left").withColumn(
            "n_unique", F.coalesce("n_unique", F.lit(0).cast("bigint")))
    pct = half_even(100.0 * F.try_divide(F.col("n_missing"), F.col("rows")), 3)
    return lines.select("column", "dtype", "n_missing", pct.alias("pct_missing"), "n_unique")


def dq_checks(df):
    """Counts of negative and zero amounts and of balances that do not add up."""
    gap = F.abs(F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig"))
    return df.agg(
        F.count_if(F.col("amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("amount") == 0).alias("zero_amounts"),
        F.count_if(gap > 1.0).alias("balance_mismatches"),
    )


def audit_summary(profile, flagged):
    """The stored profile if there is one, else one row that says how much was evaluated."""
    if profile is not None:
        return profile
    return flagged.agg(F.count("*").alias("records_evaluated")).select(
        F.lit("Completed").alias("status"), "records_evaluated")
