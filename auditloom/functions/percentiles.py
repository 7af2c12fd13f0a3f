"""Exact, linearly interpolated percentiles without holding a group in one task.

The values are counted once, with map-side combine, into a table of distinct values. If that
table is small the built-in ``percentile`` reads it. It keeps all distinct values of a group
in one buffer, so a larger table is narrowed first: the values are counted again in buckets,
whose number is bounded, and only buckets that hold a wanted rank are kept and cut into finer
ones, until few enough values are left to walk through one by one.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.storage import staged

MAX_VALUES = 1_000_000    # distinct values a task may hold
BUCKETS_PER_E = 256       # log buckets per factor e: under 400,000 over all doubles
SLICES = 65_536           # even slices a bucket is cut into


def _log_bucket(value):
    return F.signum(value) * F.floor(F.log1p(F.abs(value)) * BUCKETS_PER_E)


def _slice(value):
    width = F.col("_hi") - F.col("_lo")
    return F.when(width > 0, F.floor((value - F.col("_lo")) / width * SLICES)).otherwise(F.lit(0))


def _rank_array(fractions, total):
    """Both neighbouring ranks of every fraction, and the share of the upper one."""
    ranks = []
    for i, fraction in enumerate(fractions):
        place = F.lit(float(fraction)) * (total - 1)
        for kind, rank in (("lower", F.floor(place)), ("upper", F.ceil(place))):
            ranks.append(F.struct(
                F.lit(i).alias("point"), F.lit(kind).alias("kind"),
                rank.cast("bigint").alias("rank"), (place - F.floor(place)).alias("share")))
    return F.array(*ranks)


def _inside(ranks, before, size):
    return F.filter(ranks, lambda r: (r["rank"] >= before) & (r["rank"] < before + size))


def _before(size, window):
    return F.coalesce(F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _narrow(cells, keys, ranks):
    """Keep the cells of the buckets (column ``_bucket``) that hold a wanted rank.

    ``ranks`` is the array of wanted ranks of the group ``keys``, in terms of its ``_total``
    rows. The kept cells carry ``_ranks``, counted from the start of their bucket, its
    bounds ``_lo`` and ``_hi``, and its number of values ``_values``.
    """
    buckets = cells.groupBy(*keys, "_bucket").agg(
        F.sum("_n").alias("_size"), F.count("*").alias("_values"),
        F.min("_value").alias("_lo"), F.max("_value").alias("_hi"),
        *([F.first("_ranks").alias("_ranks")] if "_ranks" in cells.columns else []))
    group = Window.partitionBy(*keys)
    first = F.col("_first")
    buckets = (
        buckets.withColumn("_first", _before("_size", group.orderBy("_bucket")))
        .withColumn("_total", F.sum("_size").over(group))
        .withColumn("_ranks", _inside(ranks, first, F.col("_size")))
        .where(F.size("_ranks") > 0)
        .withColumn("_ranks", F.transform("_ranks", lambda r: r.withField("rank", r["rank"] - first)))
        .select(*keys, "_bucket", "_lo", "_hi", "_values", "_ranks")
    )
    cells = cells.select(*keys, "_bucket", "_value", "_n")
    return staged(cells.join(staged(buckets, "buckets"), [*keys, "_bucket"]), "cells")


def _from_buckets(cells, by, points, max_values):
    """The percentiles by narrowing; exact for any number of values."""
    kept = _narrow(
        cells.withColumn("_bucket", _log_bucket(F.col("_value"))), by,
        _rank_array(points.values(), F.col("_total")))
    # Slices of a bucket shrink 65,536-fold each time, so this ends after few rounds.
    while kept.agg(F.max("_values")).first()[0] > max_values:
        group = [*by, "_low"]
        kept = kept.withColumn("_low", F.col("_lo")).withColumn("_bucket", _slice(F.col("_value")))
        kept = _narrow(kept, group, F.col("_ranks"))
    bucket = Window.partitionBy(*by, "_lo").orderBy("_value")
    hits = kept.withColumn("_first", _before("_n", bucket)).select(
        *by, "_value", F.explode(_inside("_ranks", F.col("_first"), F.col("_n"))).alias("_hit"))

    def pick(i, kind, what):
        return F.max(F.when((F.col("_hit.point") == i) & (F.col("_hit.kind") == kind), what))

    out = []
    for i, name in enumerate(points):
        lower, upper = pick(i, "lower", F.col("_value")), pick(i, "upper", F.col("_value"))
        # as the built-in percentile interpolates, to the last bit
        share = pick(i, "lower", F.col("_hit.share"))
        out.append(F.when(lower == upper, lower).otherwise((1 - share) * lower + share * upper).alias(name))
    return hits.groupBy(*by).agg(*out)


def exact_percentiles(df, value, points, by, max_values=None, missing_keys=False):
    """One row per group with a column for each entry of ``points`` (name -> fraction).

    Missing values are left out, and groups with a missing key unless ``missing_keys`` is set.
    """
    limit = MAX_VALUES if max_values is None else max_values
    if missing_keys:
        # a struct is never missing itself, and its missing fields are equal to each other
        rows = df.select(F.struct(*by).alias("_group"), F.col(value).alias("_of"))
        found = exact_percentiles(rows, "_of", points, ["_group"], limit)
        return found.select(*[F.col(f"_group.{k}").alias(k) for k in by], *points)
    present = F.col(value).isNotNull()
    for key in by:
        present = present & F.col(key).isNotNull()
    return counted_percentiles(
        df.where(present).groupBy(*by, F.col(value).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n")), points, by, limit)


def counted_percentiles(cells, points, by, max_values=None):
    """The same from values counted before: rows of (``by``, ``_value``, ``_n``), none of them missing or twice."""
    limit = MAX_VALUES if max_values is None else max_values
    cells = staged(cells, "values")
    if cells.count() > limit:
        return _from_buckets(cells, by, points, limit)
    found = F.percentile(F.col("_value"), F.array(*[F.lit(float(p)) for p in points.values()]), F.col("_n"))
    return cells.groupBy(*by).agg(found.alias("_p")).select(
        *by, *[F.col("_p")[i].alias(name) for i, name in enumerate(points)])


def value_at_place(df, column, place, bits=16):
    """The value at ``place`` (from 0, smallest first) of a column of whole numbers, without sorting or shuffling them.

    Counting the values without their last ``bits`` bits brackets the place; only values inside the
    bracket, 2^bits different ones at most, are counted one by one. Both counts are combined in the tasks.
    """
    def step(rows, key, left):
        cells = rows.groupBy(key.alias("key")).agg(F.count("*").alias("n")).orderBy("key").collect()
        for r in cells:
            if left < r.n:
                return r.key, left
            left -= r.n
        raise IndexError(f"place {place} is beyond the rows")

    value = F.col(column).cast("bigint")
    bracket, left = step(df.where(value.isNotNull()), F.shiftright(value, bits), place)
    return step(df.where(F.shiftright(value, bits) == bracket), value, left)[0]


def column_percentiles(df, columns, points, max_values=None):
    """Percentiles of several columns in one pass, as one row of ``<column>_<point>``."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("_c")).select("_c.column", "_c.value")
    found = exact_percentiles(long, "value", points, ["column"], max_values)
    return found.agg(*[
        F.max(F.when(F.col("column") == c, F.col(p))).alias(f"{c}_{p}") for c in columns for p in points
    ])
