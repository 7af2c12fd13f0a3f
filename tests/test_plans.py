"""The physical plans have the shuffles and scans they should have, and no others."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from auditloom.operators.skew import lookup
from auditloom.plans import views
from auditloom.plans.pipeline import flag_raw
from auditloom.plans.views import slice_fact
from auditloom.plans.warehouse import save_tables, saved_tables
from auditloom.storage import staged


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_signals_shuffle_the_rows_once(ws):
    text = plan(flag_raw(ws.transactions(), multivariate=False))
    assert len(re.findall(r"Exchange hashpartitioning\(nameOrig", text)) == 1
    assert len(re.findall(r"(?<!Broadcast)Exchange (?!SinglePartition)", text)) == 1
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "rangepartitioning"):
        assert bad not in text


def test_reports_reduce_before_the_join_and_read_few_columns(ws):
    text = plan(views.report(ws.tables(), views.DAILY_AUDIT))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    fact = next(s for s in schemas if "is_flagged" in s)
    assert sorted(c.split(":")[0] for c in fact.split(",")) == ["amount", "is_flagged", "row_number", "timestamp"]
    assert "partial_sum" in text and text.index("BroadcastHashJoin") < text.index("partial_sum")


def test_filters_reach_the_scan(ws):
    text = plan(views.slice_fact(ws.tables(), risk_levels=["HIGH"]).select("amount"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(risk_level,HIGH\)", text)
    assert "ReadSchema: struct<amount:double,risk_level:string>" in text


def test_large_lookup_shuffles_once_by_key_and_spread(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("row_id"),
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN concat('k', id % 1000) END").alias("k"))
    table = staged(rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("row_id").alias("top")))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = lookup(rows, table, ["k"], "n", broadcast_values=0, heavy_rows=100)
        text = plan(found)
        sizes = [r["count"] for r in found.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert re.search(r"SortMergeJoin \[k#\d+, _spread#\d+L\], \[k#\d+, _spread#\d+L\], LeftOuter", text)
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", text)) == 2   # the rows once, and the table
    assert max(sizes) < 3 * 20_000 / 64


def test_slicers_prune_the_days_of_a_saved_fact(spark, ws, tmp_path):
    save_tables(ws.tables(), "slices", str(tmp_path / "slices"))
    tables = saved_tables(spark, "slices")
    by_range = plan(slice_fact(tables, dates=("2024-01-08", "2024-01-09")))
    assert re.search(r"PartitionFilters: \[[^\]]*date_key#\d+ >= 20240108", by_range)
    by_weekend = slice_fact(tables, weekend=True)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(by_weekend))
    assert by_weekend.count() == slice_fact(ws.tables(), weekend=True).count()
    spark.sql("DROP DATABASE slices CASCADE")
