"""Synthetic transactions with planted anomalies.

Every value is a hash of the row id and the seed, so a lost task gives the same rows again.
"""

import random

from pyspark.sql import functions as F

from auditloom.functions.columns import half_even
from auditloom.schema import RAW_COLUMNS

_FRACTION = float(1 << 53)

# Cumulative share of each type, and the amounts of each type
# (exponential: scale and floor; lognormal: mu and sigma).
TYPE_SHARES = [(0.35, "PAYMENT"), (0.55, "TRANSFER"), (0.80, "CASH_OUT"), (0.85, "DEBIT"), (1.00, "CASH_IN")]
EXPONENTIAL = {"PAYMENT": (35.0, 2.0), "DEBIT": (60.0, 5.0)}
LOGNORMAL = {"TRANSFER": (7.5, 1.2), "CASH_OUT": (7.0, 1.1), "CASH_IN": (6.8, 1.0)}
STEPS = 743

# How many anomalies of each kind are planted.
MISSING_AMOUNTS, MISSING_BALANCES = 50, 30
EXACT_COPIES, NEAR_COPIES, OUTLIERS = 30, 35, 25
BURST_USERS, BURST_ROWS = 10, 4
SPIKE_ROWS, SPIKE_STEP = 40, 250


def _uniform(seed, salt, id_="row_id"):
    """Uniform in (0, 1], independent for every salt."""
    bits = F.shiftrightunsigned(F.xxhash64(F.col(id_), F.lit(f"{seed}/{salt}")), 11)
    return (bits.cast("double") + 1.0) / _FRACTION


def _whole(seed, salt, n, id_="row_id"):
    """Uniform integer in 0..n-1."""
    return F.pmod(F.xxhash64(F.col(id_), F.lit(f"{seed}/{salt}")), F.lit(n))


def _normal(seed, salt):
    radius = F.sqrt(-2.0 * F.ln(_uniform(seed, salt)))
    return radius * F.cos(F.lit(6.283185307179586) * _uniform(seed, f"{salt} angle"))


def _name(prefix, number, seed, pool):
    """The account with this number in a pool: a letter and eight digits."""
    digits = 10_000_000 + F.pmod(F.xxhash64(number, F.lit(f"{seed}/{pool}")), F.lit(89_999_999))
    return F.concat(F.lit(prefix), digits.cast("string"))


def _pools(n):
    users = max(500, n // 15)
    return users, max(50, n // 50), users // 2


def _amount(seed):
    kind = F.col("type")
    amount = F.lit(None).cast("double")
    for name, (scale, floor) in EXPONENTIAL.items():
        amount = F.when(kind == name, -scale * F.ln(_uniform(seed, "amount")) + floor).otherwise(amount)
    for name, (mu, sigma) in LOGNORMAL.items():
        amount = F.when(kind == name, F.exp(mu + sigma * _normal(seed, "amount"))).otherwise(amount)
    return half_even(amount, 2)


def synthetic_transactions(ids, n, seed=42):
    """One plain transaction per row of ``ids``, a table of ``n`` values of ``row_id``."""
    users, merchants, people = _pools(n)
    draw = F.col("_draw")
    kind = F.lit(TYPE_SHARES[-1][1])
    for share, name in reversed(TYPE_SHARES[:-1]):
        kind = F.when(draw <= share, name).otherwise(kind)
    dest = F.col("_dest")
    return (
        ids.select("row_id")
        .withColumns({"_draw": _uniform(seed, "type"), "_dest": _whole(seed, "dest", merchants + people)})
        .withColumns({
            "step": 1 + _whole(seed, "step", STEPS),
            "type": kind,
            "nameOrig": _name("C", _whole(seed, "user", users), seed, "users"),
            "nameDest": F.when(dest < merchants, _name("M", dest, seed, "merchants")).otherwise(
                _name("C", dest, seed, "people")),
            "oldbalanceOrg": half_even(100 + 49_900 * _uniform(seed, "old orig"), 2),
            "oldbalanceDest": half_even(100_000 * _uniform(seed, "old dest"), 2),
        })
        .withColumn("amount", _amount(seed))
        .withColumns({
            "newbalanceOrig": half_even(F.greatest(F.lit(0.0), F.col("oldbalanceOrg") - F.col("amount")), 2),
            "newbalanceDest": half_even(F.col("oldbalanceDest") + F.col("amount"), 2),
            "isFraud": F.lit(0),
            "isFlaggedFraud": F.lit(0),
        })
        .select("row_id", *RAW_COLUMNS)
    )


def plant_anomalies(plain, n, seed=42):
    """Change and add rows of a table with row_id 0..n-1, in the order of the kinds below."""
    spark = plain.sparkSession
    rng = random.Random(seed)

    def pick(k):
        return rng.sample(range(n), min(k, n))

    def missing(c, ids):
        return F.when(~F.col("row_id").isin(ids), F.col(c))

    base = plain.withColumn("amount", missing("amount", pick(MISSING_AMOUNTS))).withColumn(
        "oldbalanceOrg", missing("oldbalanceOrg", pick(MISSING_BALANCES)))
    copied, near, extreme = pick(EXACT_COPIES), pick(NEAR_COPIES), pick(OUTLIERS)
    side = F.when(_uniform(seed, "side") < 0.5, -1).otherwise(1)
    copies = base.where(F.col("row_id").isin(copied)).withColumn("row_id", F.col("row_id") + n)
    nears = (
        base.where(F.col("row_id").isin(near))
        .withColumn("step", F.greatest(F.lit(1), F.col("step") + side))
        .withColumn("row_id", F.col("row_id") + 2 * n)
    )
    amount = half_even(150_000 + 600_000 * _uniform(seed, "extreme"), 2)
    changed = base.withColumn(
        "isFraud", F.when(F.col("row_id").isin(near + extreme), 1).otherwise(F.col("isFraud"))
    ).withColumn("amount", F.when(F.col("row_id").isin(extreme), amount).otherwise(F.col("amount")))
    out = changed.unionByName(copies).unionByName(nears)
    return out.unionByName(_bursts(spark, n, seed)).unionByName(_spike(spark, n, seed))


def _row_frame(rows, **columns):
    return rows.select(
        "row_id", *[(v if hasattr(v, "alias") else F.lit(v)).alias(c) for c, v in columns.items()]
    ).select("row_id", *RAW_COLUMNS)


def _bursts(spark, n, seed):
    users, merchants, _ = _pools(n)
    rows = spark.range(0, BURST_USERS * BURST_ROWS, 1, 1).select(
        (F.col("id") + 3 * n).alias("row_id"), F.expr(f"id div {BURST_ROWS}").alias("burst"))
    return _row_frame(
        rows, step=10 + _whole(seed, "burst step", 690, "burst"), type="TRANSFER",
        amount=half_even(8_000 + 7_000 * _uniform(seed, "burst amount"), 2),
        nameOrig=_name("C", _whole(seed, "burst user", users, "burst"), seed, "users"),
        oldbalanceOrg=50_000.0, newbalanceOrig=35_000.0,
        nameDest=_name("M", _whole(seed, "burst dest", merchants, "burst"), seed, "merchants"),
        oldbalanceDest=10_000.0, newbalanceDest=22_000.0, isFraud=1, isFlaggedFraud=1)


def _spike(spark, n, seed):
    users, _, _ = _pools(n)
    rows = spark.range(0, SPIKE_ROWS, 1, 1).select((F.col("id") + 4 * n).alias("row_id"), "id")
    return _row_frame(
        rows, step=F.lit(SPIKE_STEP).cast("bigint"), type="PAYMENT",
        amount=half_even(500 + 1_500 * _uniform(seed, "spike amount"), 2),
        nameOrig=_name("C", F.col("id") % users, seed, "users"),
        oldbalanceOrg=10_000.0, newbalanceOrig=8_500.0,
        nameDest=_name("M", F.lit(0).cast("bigint"), seed, "merchants"),
        oldbalanceDest=50_000.0, newbalanceDest=51_500.0,
        isFraud=F.when(F.col("id") % 2 == 0, 1).otherwise(0), isFlaggedFraud=0)


def generate_transactions(spark, n=50_000, seed=42):
    """A synthetic table of ``n`` transactions and the planted anomalies."""
    ids = spark.range(n).withColumnRenamed("id", "row_id")
    return plant_anomalies(synthetic_transactions(ids, n, seed), n, seed)
