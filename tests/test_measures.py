"""Measures of several groupings at once, label-free evaluation, and histograms, on small and awkward inputs."""

import pytest
from pyspark.sql import functions as F

from auditloom.plans import evaluation
from auditloom.plans.measures import READ, measures, measures_of_groupings
from tests.test_plans import plan

TYPES = (
    "category string, amount double, anomaly_score int, risk_level string, is_flagged boolean, "
    "is_fraud_ground_truth int, " + ", ".join(f"{c} boolean" for c in READ if c.startswith("flag_")))
GROUPINGS = {"all": [], "category": ["category"], "level": ["risk_level"], "both": ["category", "risk_level"]}


def fact(spark, n):
    """Rows with ties, missing values, and one category and one amount that hold a third each."""
    rows = []
    for i in range(n):
        flags = [(i >> b) % 3 == 0 for b in range(9)]
        rows.append((
            "hot" if i % 3 == 0 else None if i % 11 == 1 else f"c{i % 4}", 5.0 if i % 3 == 1 else None if i % 7 == 0
            else (i * 37 % 1000) / 100 - 2, i * 13 % 101, ["LOW", "HIGH", "CRITICAL", "MEDIUM"][i % 4], i % 5 == 0,
            None if i % 13 == 0 else i % 2, *flags))
    return spark.createDataFrame(rows, TYPES)


def by_group(df, keys):
    return {tuple(r[k] for k in keys): {k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()
                                        if k not in ("grouping", "category", "risk_level")} for r in df.collect()}


@pytest.mark.parametrize("max_values", [None, 20])
def test_one_pass_equals_each_grouping(spark, max_values):
    rows = fact(spark, 600)
    found = measures_of_groupings(rows, GROUPINGS, max_values)
    for name, keys in GROUPINGS.items():
        mine = found.where(F.col("grouping") == name)
        assert by_group(mine, keys) == by_group(measures(rows, keys), keys)
    assert found.where("grouping = 'category' AND category IS NULL").count() == 1
    assert found.where("grouping = 'all'").select("category", "risk_level").first() == (None, None)


def test_one_pass_without_rows_or_amounts(spark):
    assert measures_of_groupings(fact(spark, 0), GROUPINGS).isEmpty()
    blank = fact(spark, 8).withColumn("amount", F.lit(None).cast("double"))
    card = measures_of_groupings(blank, {"all": []}).first()
    assert (card.total_transactions, card.total_value, card.median_transaction_value) == (8, 0.0, None)
    assert card.avg_transaction_value is None and card.flagged_value_ratio == 0.0


def test_one_pass_reads_the_fact_once_and_no_other_column(spark, tmp_path):
    fact(spark, 100).withColumn("other", F.lit("x" * 20)).write.parquet(str(tmp_path / "fact"))
    source = spark.read.parquet(str(tmp_path / "fact"))
    text = plan(measures_of_groupings(source, GROUPINGS))
    assert str(tmp_path / "fact") not in text          # only the counted rows are read from here on
    counted = plan(source.groupBy("category", *READ).agg(F.count("*")))
    assert "other#" not in counted


def test_scores_without_the_label(spark, ws):
    blind = evaluation.without_label(ws.flagged())
    assert blind.where("flag_reasons LIKE '%Ground Truth%'").isEmpty()
    assert blind.count() == ws.flagged().count()
    assert evaluation.roc_auc(blind).first().roc_auc < evaluation.roc_auc(ws.fact()).first().roc_auc
    flipped = evaluation.without_label(ws.flagged().withColumn("isFraud", 1 - F.col("isFraud")))
    assert evaluation.score_histogram(flipped).exceptAll(evaluation.score_histogram(blind)).isEmpty()


def test_histogram_counts_each_value_once(spark):
    rows = spark.createDataFrame([(v, k) for k in "ab" for v in (0.0, 1.0, 1.0, 9.99, 10.0, None)], "v double, k string")
    found = {(r.k, r.bin): (r.transactions, r.bin_start) for r in evaluation.histogram(rows, "v", 10, ["k"]).collect()}
    assert found == {(k, b): (n, float(b)) for k in "ab" for b, n in ((0, 1), (1, 2), (9, 2))}
    one = evaluation.histogram(rows.where("v = 1"), "v", 4).first()
    assert (one.bin, one.transactions) == (0, 4)
    assert evaluation.histogram(rows.where("v > 99"), "v", 4).isEmpty()
