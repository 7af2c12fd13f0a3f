import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.functions.percentiles import value_at_place
from auditloom.operators.forest import (
    PRIME, UNIT, IsolationForest, _grow, _total_length, detect_multivariate_outliers, mixed, path_length,
    with_balance_delta)
from tests.frames import as_dict


def test_path_length():
    assert path_length(1) == 0 and path_length(2) == UNIT
    assert abs(path_length(256) / UNIT - 10.24) < 0.01


def test_tree_isolates_an_outlier():
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(size=(255, 2)), [[50.0, 50.0]]])
    trees = [_grow(points, 8, i, 42) for i in range(50)]
    lengths = _total_length(points, trees, 8)
    assert lengths.argmin() == 255


def test_constant_points_end_in_a_leaf():
    tree = _grow(np.ones((16, 2)), 4, 0, 42)
    assert _total_length(np.zeros((3, 2)), [tree], 4).tolist() == [path_length(16)] * 3


def test_hashes_are_even_and_equal_in_spark_and_python(spark):
    found = [r[0] for r in spark.range(20_000).select(mixed(F.col("id"), F.lit(3), 42)).collect()]
    assert found == [mixed(i, 3, 42) for i in range(20_000)]
    counts = np.bincount([x * 20 // PRIME for x in found], minlength=20)
    assert counts.min() > 880 and counts.max() < 1120
    shared = len(set(np.argsort(found)[:256]) & set(np.argsort([mixed(i, 4, 42) for i in range(20_000)])[:256]))
    assert shared < 15


def test_share_repeatability_and_extremes(spark):
    df = spark.range(3000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") < 20, 1e6 + F.col("id")).otherwise(F.col("id") % 97).alias("amount"),
        (F.col("id") % 24).alias("hour_of_day"), (F.col("id") % 700).alias("step"))
    first = as_dict(IsolationForest(trees=60).fit(df).transform(df), "flag_multivariate_outlier")
    again = as_dict(IsolationForest(trees=60).fit(df.repartition(5)).transform(df), "flag_multivariate_outlier")
    assert first == again
    assert 0.010 <= sum(first.values()) / 3000 <= 0.016
    assert sum(first[i] for i in range(20)) >= 18


def test_cutoff_comes_from_all_rows(spark):
    rows = spark.range(4000).selectExpr(
        "id AS row_id", "abs(sin(id * 12.9898)) * 1000 + IF(id % 100 = 0, id * 50, 0) AS amount", "id % 97 AS oldbalanceOrg")
    forest = IsolationForest(trees=20, fit_rows=300)
    model = forest.fit(rows)
    scores = [r.s for r in model.score(with_balance_delta(rows), "s").select("s").collect()]
    totals = [r.t for r in model.totals(with_balance_delta(rows), "t").select("t").collect()]
    cutoff = np.percentile(scores, 100 * (1 - forest.contamination))
    assert [t < model.threshold for t in totals] == [s > cutoff for s in scores]
    assert 0 < sum(s > cutoff for s in scores) <= 60


def test_value_at_place(spark):
    values = [(i * 7919 % 1000) ** 2 * (-1) ** i for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint").repartition(4)
    for place in (0, 1, 1500, 2998, 2999):
        assert value_at_place(df, "v", place, bits=6) == sorted(values)[place]
    with pytest.raises(IndexError):
        value_at_place(df, "v", 3000)


def test_missing_features(spark):
    df = spark.range(300).select(F.col("id").alias("row_id"), F.when(F.col("id") > 3, F.col("id") * 1.0).alias("amount"))
    assert detect_multivariate_outliers(df).where("flag_multivariate_outlier IS NULL").isEmpty()
