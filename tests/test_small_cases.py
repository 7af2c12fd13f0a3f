"""The small cases of FIXTURES.md, part A, and the gaps it lists."""

import datetime

import pytest
from pyspark.sql import functions as F

from auditloom.operators import signals
from auditloom.operators.clean import clean, temporal_features
from auditloom.operators.quality import column_profile, dq_checks
from auditloom.operators.scoring import score
from auditloom.plans.warehouse import dim_category, dim_date, dim_vendor
from tests.frames import as_dict, five_rows, numbered


def test_profile(spark):
    rows = {r["column"]: r for r in column_profile(five_rows(spark)).collect()}
    assert len(rows) == 11
    assert rows["amount"]["n_missing"] == 1 and rows["amount"]["pct_missing"] == 20.0
    assert rows["amount"]["n_unique"] == 3
    assert dq_checks(five_rows(spark)).first().negative_amounts == 0


def test_profile_in_many_tasks_of_few_values(spark):
    rows = [(None if i % 5 == 0 else i, float("nan") if i % 3 else -0.0 if i % 2 else 0.0, f"t{i % 7}", None, "same")
            for i in range(600)] + [(None, None, None, None, None)] * 300 + [(1, 1.0, "t1", None, "same")] * 300
    df = spark.createDataFrame(rows, "row_id bigint, a double, b string, c bigint, `d.e` string")
    expected = df.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in df.columns]).first().asDict()
    for task_values in (100, 10 ** 6):
        for columns in (None, ["a", "b", "c", "d.e", "row_id"]):
            got = column_profile(df, columns, task_values=task_values).collect()
            assert {r["column"]: r.n_unique for r in got} == {
                c: n for c, n in expected.items() if columns or c != "row_id"}
            assert {r["column"]: r.n_missing for r in got}["c"] == 1200


def test_approximate_profile(spark):
    rows = {r["column"]: r for r in column_profile(five_rows(spark), approximate=True).collect()}
    assert rows["nameOrig"]["n_unique"] == 4


def test_clean(spark):
    df = clean(five_rows(spark))
    assert df.count() == 4
    assert {"timestamp", "hour_of_day", "is_weekend", "is_night", "is_merchant_dest"} <= set(df.columns)
    assert as_dict(df, "is_exact_duplicate") == {0: False, 1: False, 2: True, 4: False}
    assert as_dict(df, "is_near_duplicate") == {0: False, 1: False, 2: True, 4: False}
    assert as_dict(df, "timestamp")[4] == datetime.datetime(2024, 1, 2, 1)


def test_clean_keeps_negatives_trims_all_space_and_rounds_to_even(spark):
    rows = [
        (0, "\t transfer\n", -0.125, "C1", None, 0.0, "M1", 4.0, 0.0, 0, 0),
        (5, "Payment", 0.375, "C1", 2.0, 0.0, "m1", 4.0, 0.0, 0, 0),
        (5, "Payment", 0.375, "C1", 5.0, 0.0, "C1", None, 0.0, 0, 0),
    ]
    from tests.frames import RAW_TYPES
    df = clean(numbered(spark, rows, RAW_TYPES))
    assert as_dict(df, "type") == {0: "TRANSFER", 1: "PAYMENT", 2: "PAYMENT"}
    assert as_dict(df, "amount") == {0: -0.12, 1: 0.38, 2: 0.38}
    assert as_dict(df, "oldbalanceOrg")[0] == 3.5
    assert as_dict(df, "oldbalanceDest")[2] == 4.0
    assert as_dict(df, "is_merchant_dest") == {0: True, 1: False, 2: False}
    assert as_dict(df, "is_missing_orig_balance")[0]


def test_duplicates(spark):
    rows = [(1, "PAYMENT", 100.0, "C1", "M1"), (1, "PAYMENT", 100.0, "C1", "M1"), (2, "PAYMENT", 100.0, "C1", "M1")]
    df = signals.detect_duplicates(numbered(
        spark, rows, "step bigint, type string, amount double, nameOrig string, nameDest string"))
    assert as_dict(df, "flag_exact_duplicate") == {0: False, 1: True, 2: False}
    assert as_dict(df, "flag_near_duplicate") == {0: False, 1: True, 2: True}


def test_missing_keys_are_exact_but_never_near_duplicates(spark):
    rows = [(1, "PAYMENT", 1.0, None, "M1"), (1, "PAYMENT", 1.0, None, "M1")]
    df = signals.detect_duplicates(numbered(
        spark, rows, "step bigint, type string, amount double, nameOrig string, nameDest string"))
    assert as_dict(df, "flag_exact_duplicate") == {0: False, 1: True}
    assert as_dict(df, "flag_near_duplicate") == {0: False, 1: False}


def test_velocity(spark):
    rows = [(10, "C99", 100.0), (11, "C99", 200.0), (11, "C99", 300.0), (12, "C99", 400.0), (50, "C99", 500.0),
            (1, None, 1.0), (1, None, 1.0)]
    df = signals.detect_user_velocity(numbered(spark, rows, "step bigint, nameOrig string, amount double"))
    assert as_dict(df, "flag_velocity") == {0: True, 1: True, 2: True, 3: True, 4: False, 5: False, 6: False}


def test_dimensions(spark):
    cats = spark.createDataFrame(
        [("PAYMENT",), ("TRANSFER",), ("CASH_OUT",), ("FOO_BAR-2x",), ("PAYMENT",)], "category string")
    rows = {r.category_id: r for r in dim_category(cats).collect()}
    assert len(rows) == 4
    assert rows["TRANSFER"].category_risk_profile == "High"
    assert rows["FOO_BAR-2x"].category_name == "Foo_Bar-2X"
    assert rows["FOO_BAR-2x"].description == "General FOO_BAR-2x transaction"
    assert rows["FOO_BAR-2x"].category_risk_profile == "Medium"
    days = spark.createDataFrame(
        [(datetime.datetime(2024, 1, d, 3),) for d in (1, 5)], "timestamp timestamp_ntz")
    dates = dim_date(days).orderBy("full_date").collect()
    assert [r.date_key for r in dates] == [20240101, 20240102, 20240103, 20240104, 20240105]
    assert dates[0].day_name == "Monday" and dates[0].quarter == "Q1" and dates[0].day_of_week == 0


def amounts(spark, *groups):
    rows = [(c, a) for c, values in groups for a in values]
    return numbered(spark, rows, "category string, amount double")


def test_large_by_quartiles_and_by_deviation(spark):
    even = [float(i) for i in range(1, 10)] + [100.0]
    flat = [5.0] * 30 + [6.0]
    df = signals.detect_large_transactions(amounts(spark, ("A", even), ("B", flat), ("C", [9.0]), (None, [1.0, 1e9])))
    large = [r.amount for r in df.where("flag_large_transaction").collect()]
    assert sorted(large) == [6.0, 100.0]


def test_single_category(spark):
    df = signals.detect_large_transactions(amounts(spark, ("A", [1.0, 2.0, 3.0, 50.0])))
    assert df.count() == 4


@pytest.mark.parametrize("n, flagged", [(9, 0), (10, 1)])
def test_timing_needs_ten_rows(spark, n, flagged):
    rows = [("M1", 12)] * (n - 1) + [("M1", 20), (None, 3), (None, 13)]
    df = signals.detect_unusual_timing(numbered(spark, rows, "vendor_id string, hour_of_day int"))
    assert df.where("flag_unusual_timing AND vendor_id IS NOT NULL").count() == flagged
    assert df.where("flag_unusual_timing AND vendor_id IS NULL").count() == 1


@pytest.mark.parametrize("days, last, flagged", [(2, 5, 0), (2, 6, 6), (1, 60, 0), (9, 6, 6)])
def test_spike(spark, days, last, flagged):
    rows = [("M1", 24 * d, 1.0) for d in range(days)] + [("M1", 24 * days + i % 24, 1.0) for i in range(last)]
    df = signals.detect_vendor_spikes(numbered(spark, rows, "vendor_id string, step bigint, amount double"))
    assert df.where("flag_vendor_spike").count() == flagged


def test_concentration(spark):
    rows = [("C1", "M1", 10.0)] * 3 + [("C2", "M1", 10.0)] * 2 + [("C3", "M1", 5.0), ("C3", "M2", 5.0), ("C3", "M2", 0.0)]
    rows += [("C4", "M1", 2.0), ("C4", "M2", -2.0), ("C4", "M2", 0.0), (None, "M1", 1.0)]
    df = signals.detect_concentration_hhi(numbered(spark, rows, "nameOrig string, vendor_id string, amount double"))
    got = {r.nameOrig: (r.user_hhi, r.flag_concentration) for r in df.collect()}
    assert got == {
        "C1": (1.0, True), "C2": (1.0, False), "C3": (0.5, False), "C4": (8.0, True), None: (0.0, False)}


def scored(spark, **flags):
    row = {c: False for c in (
        "flag_duplicate", "flag_large_transaction", "flag_vendor_spike", "flag_velocity",
        "flag_multivariate_outlier", "flag_unusual_timing", "flag_concentration")} | {"isFraud": 0} | flags
    types = ", ".join(f"{c} {'int' if c == 'isFraud' else 'boolean'}" for c in row)
    return score(spark.createDataFrame([tuple(row.values())], types)).first()


def test_score_tiers(spark):
    low = scored(spark, flag_unusual_timing=True)
    assert (low.anomaly_score, low.risk_level, low.is_flagged) == (10, "LOW", False)
    medium = scored(spark, flag_large_transaction=True)
    assert (medium.anomaly_score, medium.risk_level, medium.is_flagged) == (20, "MEDIUM", False)
    edge = scored(spark, flag_large_transaction=True, flag_velocity=True)
    assert (edge.anomaly_score, edge.is_flagged, edge.risk_level) == (35, True, "MEDIUM")
    high = scored(spark, flag_duplicate=True, flag_large_transaction=True)
    assert (high.anomaly_score, high.risk_level) == (45, "HIGH")
    critical = scored(spark, flag_duplicate=True, isFraud=1)
    assert (critical.anomaly_score, critical.risk_level) == (75, "CRITICAL")
    assert critical.flag_reasons == "Duplicate Transaction; Reported Fraud Ground Truth"
    everything = scored(
        spark, flag_duplicate=True, flag_large_transaction=True, flag_vendor_spike=True, flag_velocity=True,
        flag_multivariate_outlier=True, flag_unusual_timing=True, flag_concentration=True, isFraud=1)
    assert everything.anomaly_score == 100 and everything.flag_reasons.count(";") == 7
    clear = scored(spark, isFraud=None)
    assert (clear.anomaly_score, clear.flag_reasons, clear.is_flagged) == (0, "", False)


def test_score_without_label_column_or_by_choice(spark):
    df = spark.createDataFrame([(False, 1)], "flag_duplicate boolean, isFraud int")
    assert not score(df.drop("isFraud")).first().is_flagged
    assert not score(df, use_label=False).first().is_flagged
    assert score(df).first().anomaly_score == 50


def test_dim_vendor(spark):
    rows = [("M12345678", 10.0, i < 2) for i in range(13)] + [("C1", 2.5, False)] * 20
    df = spark.createDataFrame(rows, "vendor_id string, amount double, is_flagged boolean")
    got = {r.vendor_id: r for r in dim_vendor(df).collect()}
    merchant, person = got["M12345678"], got["C1"]
    assert (merchant.flagged_rate_pct, merchant.vendor_risk_tier) == (15.38, "HIGH_RISK")
    assert merchant.vendor_name.endswith(" (M12345)") and merchant.is_merchant
    assert person.vendor_name == "Private Account C1" and person.vendor_risk_tier == "STANDARD"
    assert (person.total_volume, person.avg_transaction_amount) == (50.0, 2.5)


def test_long_ids_keep_their_digits(spark):
    from auditloom.functions.columns import zero_padded
    row = spark.range(1).select(
        zero_padded(F.lit(7)).alias("a"), zero_padded(F.lit(1234567890)).alias("b")).first()
    assert (row.a, row.b) == ("00000007", "1234567890")


def test_weekday_and_night(spark):
    df = temporal_features(numbered(spark, [(0,), (5,), (6,), (24 * 5 + 1,)], "step bigint"))
    assert as_dict(df, "is_night") == {0: False, 1: True, 2: False, 3: True}
    assert as_dict(df, "is_weekend") == {0: False, 1: False, 2: False, 3: True}


def test_long_row_numbers_keep_their_digits(spark):
    from auditloom.functions.columns import zero_padded

    rows = spark.range(123_456_790, 123_457_837).select(zero_padded(F.col("id")).alias("t"))
    assert rows.distinct().count() == 1_047 and rows.first().t == "123456790"
