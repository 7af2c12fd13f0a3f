"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) fitted and applied on the executors.

The trees are trained one per group on small samples; their nodes (at most 511 per tree) are
the only thing that passes the driver, which broadcasts them for scoring. Choices come from a hash
in whole numbers that any SQL engine can state, and path lengths are whole millionths, so sums do not
depend on their order and the same rows are outliers wherever the definition is evaluated.
"""

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from auditloom.functions.percentiles import column_percentiles, value_at_place
from auditloom.storage import staged

# The executors get the functions below with the task, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = ["amount", "hour_of_day", "step", "balance_delta_orig"]
PRIME = 2_147_483_647      # hashes are below it
UNIT = 1_000_000           # parts of a unit of path length
SAMPLE = -1                # stands in a tree's place where rows of the sample are chosen


def mixed(number, other, seed):
    """A hash below ``PRIME`` of two whole numbers, for columns as for plain numbers; ``number`` is below it, too."""
    x = (number * 48_271 + other * 69_621 + seed * 40_692 + 1) % PRIME
    for add in (12_345, 54_321):
        square = x * x % PRIME
        x = (square * square % PRIME * x % PRIME * 16_807 + add) % PRIME
    return x


def path_length(n):
    """Average depth of an unsuccessful search among n points, in millionths."""
    if n <= 1:
        return 0
    if n == 2:
        return UNIT
    return round((2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n) * UNIT)


def _grow(points, depth, tree, seed):
    """One tree as a full binary heap: feature, threshold and path length of every slot.

    Below a leaf all slots repeat its path length, so scoring may always walk to the bottom.
    """
    slots = 2 ** (depth + 1) - 1
    feature = np.zeros(slots, dtype=np.int32)
    threshold = np.full(slots, np.inf)
    length = np.zeros(slots, dtype=np.int64)
    todo = [(0, 0, points)]
    while todo:
        slot, level, rows = todo.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (0.0, 0.0)
        usable = np.flatnonzero(np.asarray(high) > np.asarray(low))
        if level == depth or len(rows) <= 1 or len(usable) == 0:
            first, width = slot, 1
            while first < slots:
                length[first:first + width] = level * UNIT + path_length(len(rows))
                first, width = 2 * first + 1, 2 * width
            continue
        f = int(usable[mixed(slot, 2 * tree, seed) * len(usable) // PRIME])
        cut = low[f] + mixed(slot, 2 * tree + 1, seed) / PRIME * (high[f] - low[f])
        feature[slot], threshold[slot] = f, cut
        right = rows[:, f] >= cut
        todo.append((2 * slot + 1, level + 1, rows[~right]))
        todo.append((2 * slot + 2, level + 1, rows[right]))
    return feature, threshold, length


def _total_length(points, trees, depth):
    n = len(points)
    columns = np.ascontiguousarray(points.T).ravel()
    row = np.arange(n, dtype=np.int32)
    place, value, cut = np.empty(n, dtype=np.int32), np.empty(n), np.empty(n)
    total = np.zeros(n, dtype=np.int64)
    for feature, threshold, length in trees:
        start = (feature * n).astype(np.int32)
        slot = np.zeros(n, dtype=np.int32)
        for _ in range(depth):
            np.take(start, slot, out=place, mode="clip")
            place += row
            np.take(columns, place, out=value, mode="clip")
            np.take(threshold, slot, out=cut, mode="clip")
            slot = 2 * slot + 1 + (value >= cut)
        total += length[slot]
    return total


def with_balance_delta(df):
    if {"oldbalanceOrg", "newbalanceOrig"} <= set(df.columns):
        df = df.withColumn("balance_delta_orig", F.col("oldbalanceOrg") - F.col("newbalanceOrig"))
    return df


def robust_scale(df, columns=FEATURES):
    """(x - median) / (q75 - q25) per column, missing values as 0, a zero spread as 1."""
    df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    points = column_percentiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}).first()
    return df.withColumns({
        f"{c}_scaled": (F.col(c) - points[f"{c}_q50"]) / ((points[f"{c}_q75"] - points[f"{c}_q25"]) or 1.0)
        for c in columns})


class IsolationForest:
    """Scaling each feature would not change the trees, so the features are taken as they are."""

    def __init__(self, trees=100, tree_rows=256, contamination=0.015, fit_rows=200_000, seed=42):
        self.trees = trees
        self.tree_rows = tree_rows
        self.contamination = contamination
        self.fit_rows = fit_rows
        self.seed = seed

    def _features(self, df):
        return [c for c in FEATURES if c in df.columns]

    def _place(self, tree):
        return mixed(F.pmod("row_id", F.lit(PRIME)).cast("bigint"), tree, self.seed)

    def _sample(self, df, features):
        """About ``fit_rows`` rows, chosen by a hash of row_id."""
        columns = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
        rows = df.select("row_id", *columns)
        share = F.lit(float(self.fit_rows)) / rows.agg(F.count("*").cast("double")).scalar()
        return staged(rows.where(self._place(SAMPLE) / PRIME < share), "forest_sample")

    def grow(self, df):
        """The trees, without a threshold."""
        df = with_balance_delta(df)
        features = self._features(df)
        sample = self._sample(df, features)
        size = sample.count()
        per_tree = min(self.tree_rows, size)
        depth = max(1, math.ceil(math.log2(max(per_tree, 2))))
        seed = self.seed

        # Twice the rows a tree needs are drawn for it; it keeps those with the lowest hashes.
        reach = int(min(1.0, 2.0 * self.tree_rows / max(size, 1)) * PRIME)
        numbers = F.sequence(F.lit(0), F.lit(self.trees - 1))
        drawn = (
            sample.withColumn("tree", F.explode(F.filter(numbers, lambda t: self._place(t) < reach)))
            .withColumn("place", self._place(F.col("tree")))
        )

        def grow(key, pdf):
            pdf = pdf.sort_values(["place", "row_id"]).head(per_tree)
            tree = _grow(pdf[features].to_numpy(dtype=float), depth, int(key[0]), seed)
            names = ("feature", "threshold", "length")
            return pd.DataFrame({"tree": [int(key[0])], **{n: [a] for n, a in zip(names, tree)}})

        # an explicit number, or the few rows would be put into one task
        tasks = min(self.trees, df.sparkSession.sparkContext.defaultParallelism)
        grown = drawn.repartition(tasks, "tree").groupBy("tree").applyInPandas(
            grow, "tree int, feature array<int>, threshold array<double>, length array<bigint>")
        nodes = [
            (np.array(r.feature), np.array(r.threshold), np.array(r.length))
            for r in sorted(grown.collect(), key=lambda r: r.tree)]
        return ForestModel(df.sparkSession, features, nodes, depth, path_length(per_tree), self.contamination)

    def fit(self, df):
        """Trees, and the threshold of the outliers among all rows of ``df``."""
        model = self.grow(df)
        return model.choose(staged(model.totals(with_balance_delta(df), "_total").select("_total"), "totals"), "_total")


class ForestModel:
    def __init__(self, spark, features, nodes, depth, normal, contamination):
        self.features = features
        self.depth = depth
        self.trees = len(nodes)
        self.normal = max(normal, 1) * max(len(nodes), 1)
        self.contamination = contamination
        self.nodes = spark.sparkContext.broadcast(nodes)
        self.threshold = None    # rows whose total is less are outliers

    def totals(self, df, name):
        """Add the sum of path lengths over all trees, in millionths; outliers have short paths."""
        nodes, depth = self.nodes, self.depth

        @F.pandas_udf("bigint")
        def total(*columns: pd.Series) -> pd.Series:
            points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series(_total_length(points, nodes.value, depth))

        filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features]
        return df.withColumn(name, total(*filled))

    def score(self, df, name):
        """Add the anomaly score in (0, 1]; short paths score high."""
        return self.totals(df, name).withColumn(name, F.pow(F.lit(2.0), -F.col(name) / F.lit(float(self.normal))))

    def choose(self, scored, name):
        """Set the threshold so that rows scoring above the quantile 1 - contamination are the outliers.

        The score falls as the total rises, so the row at that quantile is found by its place among the
        totals from the largest down; rows of a smaller total are above it.
        """
        n = scored.count()
        if n:
            place = math.floor((1.0 - self.contamination) * (n - 1))
            self.threshold = value_at_place(scored, name, n - 1 - place)
        return self

    def flag(self, df, name):
        """Turn the totals of ``totals`` into flag_multivariate_outlier."""
        return df.withColumn("flag_multivariate_outlier", F.col(name) < F.lit(self.threshold)).drop(name)

    def transform(self, df):
        return self.flag(self.totals(with_balance_delta(df), "_total"), "_total")


def detect_multivariate_outliers(df, sample_size=200_000, random_state=42):
    """Each row is scored once: its total is staged with it, and the threshold comes from that column."""
    model = IsolationForest(fit_rows=sample_size, seed=random_state).grow(df)
    return flag_outliers(model, df)


def flag_outliers(model, df):
    """Score ``df`` into a staged table, take the threshold from it, and flag its rows."""
    scored = staged(model.totals(with_balance_delta(df), "_total"), "scored")
    return model.choose(scored, "_total").flag(scored, "_total")
