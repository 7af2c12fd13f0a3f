"""Every query against its DuckDB text, and facts that hold for any input."""

import pytest
from pyspark.sql import functions as F

from auditloom.plans.catalogue import QUERIES
from checks.compare import connect, difference
from checks.duckdb_sql import ORACLE
from tests.conftest import FOLDER

UNCHECKED = {"synth_transactions", "synth_injections"}    # a simulator; see the README


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - UNCHECKED))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(UNCHECKED))
def test_unchecked_query_runs(spark, name):
    assert not QUERIES[name](spark, FOLDER).isEmpty()


def test_entry_points():
    import __spark_entry__ as driver
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) - set(driver.oracle_sql()) == UNCHECKED


def test_counts_of_the_fixture(ws):
    """The counts that FIXTURES.md lists for this scale."""
    row = ws.flagged().agg(
        F.count("*").alias("clean"), F.count_if("flag_exact_duplicate").alias("exact"),
        F.count_if("flag_near_duplicate").alias("near"), F.count_if("flag_large_transaction").alias("large"),
        F.count_if("flag_unusual_timing").alias("timing"), F.count_if("flag_vendor_spike").alias("spike"),
        F.count_if("flag_velocity").alias("velocity"), F.count_if("flag_concentration").alias("concentration"),
        F.sum("isFraud").alias("fraud"), F.count_if("is_flagged").alias("flagged"),
        *[F.count_if(F.col("risk_level") == c).alias(c) for c in ("CRITICAL", "HIGH", "MEDIUM")]).first()
    assert ws.transactions().count() == 1052
    assert tuple(row) == (1047, 4, 8, 55, 282, 41, 284, 131, 35, 74, 31, 26, 119)


def test_no_row_is_lost_or_doubled(ws):
    assert ws.flagged().select("row_id").distinct().count() == ws.clean().count() == ws.flagged().count()


def test_score_reasons_and_tiers_agree(ws):
    df = ws.flagged_with_forest()
    assert df.where("anomaly_score < 0 OR anomaly_score > 100").isEmpty()
    assert df.where("(flag_reasons = '') <> (anomaly_score = 0)").isEmpty()
    bounds = {r.risk_level: (r.lo, r.hi) for r in df.groupBy("risk_level").agg(
        F.min("anomaly_score").alias("lo"), F.max("anomaly_score").alias("hi")).collect()}
    assert bounds["LOW"][1] < 20 <= bounds["MEDIUM"][0] and bounds["MEDIUM"][1] < 45 <= bounds["HIGH"][0]


def test_totals_of_dimension_and_fact_agree(ws):
    tables = ws.tables()
    vendors = tables["dim_vendor"].agg(F.sum("total_transactions"), F.sum("flagged_count")).first()
    fact = tables["fact_transactions"].agg(F.count("amount"), F.count_if("is_flagged")).first()
    assert tuple(vendors) == tuple(fact)


def test_planted_copies_are_caught(ws):
    billion = 1_000_000_000
    planted = ws.flagged().where(F.col("row_id").between(billion, 3 * billion - 1))
    assert planted.count() > 0
    # the copy or its source, whichever comes later, is marked
    copies = planted.where(F.col("row_id") < 2 * billion)
    assert copies.where("NOT flag_duplicate").isEmpty()
    assert planted.where(F.col("row_id") >= 2 * billion).where("NOT flag_near_duplicate").isEmpty()


def test_fact_columns(ws):
    fact = ws.fact()
    assert len(fact.columns) == 40
    assert fact.columns[0] == "transaction_id" and fact.columns[-1] == "date_key"
