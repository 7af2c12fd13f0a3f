"""The ways for heavy keys and large tables give the same results as the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.functions.percentiles import column_percentiles, exact_percentiles
from auditloom.operators.clean import clean, clean_view
from auditloom.operators.neighbours import AnyRepeat, Burst, Rank, Recent, Repeat, apply_rules
from auditloom.operators.ordering import number_rows, running_start
from auditloom.operators.skew import lookup, shuffle_by
from auditloom.plans.pipeline import flag_raw
from auditloom.plans.warehouse import star_join
from auditloom.storage import staged
from tests.frames import random_raw, random_rows

FORCED = {"heavy_rows": 3, "broadcast_values": 0}
RULES = [
    Repeat(("step", "type", "amount", "nameOrig", "nameDest"), "copy"),
    AnyRepeat(("step", "type", "amount", "nameOrig", "nameDest"), "any_copy"),
    Recent(("nameOrig", "nameDest", "amount"), 2, "near"),
    Recent(("nameOrig", "nameDest", "amount"), 1, "near_sql", missing_equal=True),
    Burst("nameOrig", "burst"),
    Rank("nameOrig", "rank"),
]
NAMES = [getattr(r, "flag", None) or r.name for r in RULES]


def brute_force(rows):
    """The rules row by row, over lists."""
    rows = [dict(zip(("step", "type", "amount", "user", "_o", "_n", "dest"), r), id=i) for i, r in enumerate(rows)]
    out = {r["id"]: {} for r in rows}
    last = lambda v: (v is None, v or "")

    def groups(*keys):
        found = {}
        for r in rows:
            found.setdefault(tuple(r[k] for k in keys), []).append(r)
        return found.items()

    for _, group in groups("step", "type", "amount", "user", "dest"):
        for i, r in enumerate(sorted(group, key=lambda r: r["id"])):
            out[r["id"]].update(copy=i > 0, any_copy=len(group) > 1)
    for key, group in groups("user", "dest", "amount"):
        group.sort(key=lambda r: (r["step"], r["id"]))
        for i, r in enumerate(group):
            back = r["step"] - group[i - 1]["step"] if i else 99
            out[r["id"]].update(near=None not in key and back <= 2, near_sql=back <= 1)
    for (user,), group in groups("user"):
        group.sort(key=lambda r: (r["step"], last(r["dest"]), r["amount"], r["id"]))
        for i, r in enumerate(group):
            two = i > 1 and r["step"] - group[i - 2]["step"] <= 2
            one = i + 1 < len(group) and group[i + 1]["step"] - r["step"] <= 2
            out[r["id"]].update(burst=user is not None and (two or one), rank=i + 1)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("skew", [{}, FORCED, {"heavy_rows": 60, "broadcast_values": 9}])
def test_rules_match_brute_force(spark, seed, skew):
    expected = brute_force(random_rows(seed, 300))
    df = apply_rules(random_raw(spark, seed, 300), "nameOrig", RULES, **skew)
    assert {r.row_id: {n: r[n] for n in NAMES} for r in df.collect()} == expected


def test_clean_and_view(spark):
    raw = random_raw(spark, 5, 300)
    for job in (clean, clean_view):
        assert sorted(map(str, job(raw).collect())) == sorted(map(str, (
            job(raw, **FORCED).select(*job(raw).columns).collect())))


def test_whole_pipeline(spark):
    raw = random_raw(spark, 6, 400)
    plain = flag_raw(raw, multivariate=False)
    forced = flag_raw(raw, multivariate=False, **FORCED).select(*plain.columns)
    rows = plain.collect()
    assert sorted(map(str, rows)) == sorted(map(str, forced.collect()))
    assert sorted(r.row_number for r in rows) == list(range(1, len(rows) + 1))
    key = lambda r: [(v is None, v) if v is not None else (True, 0) for v in (
        r.nameOrig, r.step, r.nameDest, r.amount, r.row_id)]
    assert [r.row_number for r in sorted(rows, key=key)] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("skew", [{}, FORCED, {"heavy_rows": 10**9, "broadcast_values": 0}])
def test_lookup(spark, skew):
    rows = spark.range(500).select(
        F.col("id").alias("row_id"),
        F.expr("CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 11) END").alias("k"))
    table = staged(rows.where("k IS NOT NULL AND k <> 'k5'").groupBy("k").agg(
        F.count("*").alias("n"), F.max("row_id").alias("top")))
    tops = {r.k: r.top for r in table.collect()}
    got = lookup(rows, table, ["k"], "n", **skew).collect()
    assert len(got) == 500
    assert all(r.top == tops.get(r.k) for r in got)


@pytest.mark.parametrize("limit", [1, 50, None])
def test_percentiles(spark, limit):
    rng = random.Random(3)
    values = {
        "a": [round(rng.lognormvariate(5, 3), 2) for _ in range(700)],
        "b": [-round(rng.expovariate(0.01), 2) for _ in range(501)] + [0.0] * 600,
        "c": [7.25],
        "d": [rng.uniform(1.0, 1.0001) for _ in range(400)],
    }
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("a", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    points = {"p05": 0.05, "q25": 0.25, "q50": 0.5, "p985": 0.985, "top": 1.0}
    got = {r.k: r for r in exact_percentiles(df, "v", points, ["k"], limit).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        for name, p in points.items():
            assert got[k][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12)


def test_both_ways_to_percentiles_agree_to_the_last_bit(spark):
    rng = random.Random(4)
    rows = [(i % 400 or None, round(rng.uniform(0, 1000), 4)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k int, v double")
    points = {"q25": 0.25, "q50": 0.5, "p985": 0.985}
    ways = [
        sorted(map(str, exact_percentiles(df, "v", points, ["k"], limit, missing_keys=True).collect())) for limit in (None, 1)]
    assert ways[0] == ways[1] and len(ways[0]) == 400


def test_column_percentiles(spark):
    df = spark.range(101).select(F.col("id").alias("x"), (F.col("id") * -2.5).alias("y"))
    row = column_percentiles(df, ["x", "y"], {"q25": 0.25, "q50": 0.5}, 1).first()
    assert (row.x_q25, row.x_q50, row.y_q25, row.y_q50) == (25.0, 50.0, -187.5, -125.0)


def test_number_rows_and_running_start(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("v"), F.lit(2).alias("n")).repartition(7)
    got = number_rows(df, ["v"], "i").orderBy("v").collect()
    assert [r.i for r in got] == list(range(1, 1001))
    for limit in (10**6, 10):
        starts = running_start(staged(df), ["v"], "n", "start", limit).orderBy("v").collect()
        assert [r.start for r in starts] == list(range(0, 2000, 2))


def test_shuffle_by_takes_more_tasks_for_more_rows(spark):
    df = spark.range(1000)
    assert shuffle_by(df, 1000, "id", task_rows=50).rdd.getNumPartitions() == 20
    assert shuffle_by(df, 1000, "id").rdd.getNumPartitions() <= 8


def test_tasks_of_a_row_shuffle_stay_small_below_the_default_number_of_partitions(spark):
    """Adaptive execution would merge 200 partitions to one a core."""
    df = spark.range(1000)
    set_before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert shuffle_by(df, 36_000_000, "id").rdd.getNumPartitions() == 200
        assert shuffle_by(df, 1000, "id", task_rows=50).rdd.getNumPartitions() == 200
        assert shuffle_by(df, 100_000_000, "id").rdd.getNumPartitions() == 400
        assert shuffle_by(df, 1000, "id").rdd.getNumPartitions() <= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", set_before)


def test_star_join_with_large_vendor_table(ws):
    plain = star_join(ws.tables())
    forced = star_join(ws.tables(), **FORCED).select(*plain.columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, forced.collect()))


def test_empty_input(spark):
    empty = random_raw(spark, 1, 5).where("row_id < 0")
    assert flag_raw(empty).count() == 0
