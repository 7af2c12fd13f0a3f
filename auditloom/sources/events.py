"""Transactions derived from the ``events`` table, with planted anomalies.

All amounts are computed in whole cents. Every event gives one transaction; some events
give planted copies as well (exact copies, copies an hour later, bursts), and one merchant
gets a spike. The rules are those of FIXTURES.md, part B.
"""

from pyspark.sql import functions as F

from auditloom.schema import RAW_COLUMNS

# Event type -> transaction type.
EVENT_TYPES = {
    "purchase": "PAYMENT", "view": "TRANSFER", "click": "CASH_OUT",
    "error": "DEBIT", "signup": "CASH_IN",
}
BILLION = 1_000_000_000
BURST = 4
SPIKE_ROWS = 40


def _divides(n, remainder=0):
    return F.col("event_id") % n == remainder


def transactions(events):
    spark = events.sparkSession
    id_ = F.col("event_id")
    cents = F.round(F.col("value") * 100).cast("bigint")
    key = F.get_json_object("props", "$.k").cast("bigint")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint")

    kind = F.col("type")
    name = F.coalesce(*[
        F.when(F.col("event_type") == event, type_) for event, type_ in EVENT_TYPES.items()])
    messy = F.concat(F.lit("  "), F.lower(kind), F.lit(" "))
    old = 10_000 + (id_ * 7_919) % 4_990_000
    dest = (id_ * 104_729) % 10_000_000
    paid = (
        F.when(_divides(211), F.lit(None))
        .when(_divides(401, 1), F.col("cents") * 1_000)
        .when(_divides(499, 5), -F.col("cents"))
        .otherwise(F.col("cents"))
    )
    base = (
        events.select("event_id", "ts", "user_id", "event_type",
                      cents.alias("cents"), key.alias("key"), name.alias("type"))
        .withColumns({
            "row_id": id_,
            "step": day * 24 + F.hour("ts"),
            "type": F.when(_divides(50), messy).otherwise(kind),
            "amount": paid / 100.0,
            "nameOrig": F.concat(F.lit("C"), (20_000_000 + F.col("user_id")).cast("string")),
            "oldbalanceOrg": F.when(~_divides(307), old / 100.0),
            "newbalanceOrig": F.greatest(F.lit(0), old - F.col("cents")) / 100.0,
            "nameDest": F.concat(
                F.when(F.col("key") < 80, "M").otherwise("C"),
                (10_000_000 + F.col("key") * 123_457).cast("string")),
            "oldbalanceDest": dest / 100.0,
            "newbalanceDest": (dest + F.col("cents")) / 100.0,
            "isFraud": F.when(_divides(401, 1) | _divides(287, 3), 1).otherwise(0),
            "isFlaggedFraud": F.lit(0),
        })
    )
    columns = ["row_id", *RAW_COLUMNS]
    return _plant(base).select(*columns).unionByName(_spike(spark))


def _plant(base):
    """One scan: each event is repeated once per copy it plants (0 is the event itself)."""
    none = F.array().cast("array<int>")
    copies = F.concat(
        F.array(F.lit(0)),
        F.when(_divides(331, 2), F.array(F.lit(1))).otherwise(none),
        F.when(_divides(287, 3), F.array(F.lit(2))).otherwise(none),
        F.when(_divides(997, 4), F.array(*[F.lit(3 + j) for j in range(BURST)])).otherwise(none),
    )
    copy = F.col("copy").cast("bigint")
    burst = copy >= 3
    burst_cents = 800_000 + (F.col("event_id") * 13 + (copy - 3) * 97_700) % 700_000
    changed = {
        "row_id": F.col("row_id") + copy * F.lit(BILLION),
        "step": F.col("step") + F.when(copy == 2, 1).otherwise(0),
        "type": F.when(burst, "TRANSFER").otherwise(F.col("type")),
        "amount": F.when(burst, burst_cents / 100.0).otherwise(F.col("amount")),
        "isFraud": F.when(burst, 1).otherwise(F.col("isFraud")),
        "isFlaggedFraud": F.when(burst, 1).otherwise(F.col("isFlaggedFraud")),
    }
    balances = {
        "oldbalanceOrg": 50_000.0, "newbalanceOrig": 35_000.0,
        "oldbalanceDest": 10_000.0, "newbalanceDest": 22_000.0,
    }
    for c, v in balances.items():
        changed[c] = F.when(burst, v).otherwise(F.col(c))
    return base.withColumn("copy", F.explode(copies)).withColumns(changed)


def _spike(spark):
    j = F.col("id")
    return spark.range(0, SPIKE_ROWS, 1, 1).select(
        (j + 9 * BILLION).alias("row_id"),
        F.lit(250).cast("bigint").alias("step"),
        F.lit("PAYMENT").alias("type"),
        ((50_000 + j * 3_700) / 100.0).alias("amount"),
        F.concat(F.lit("C"), (20_000_000 + j % 15).cast("string")).alias("nameOrig"),
        F.lit(10_000.0).alias("oldbalanceOrg"),
        F.lit(8_500.0).alias("newbalanceOrig"),
        F.lit("M10000000").alias("nameDest"),
        F.lit(50_000.0).alias("oldbalanceDest"),
        F.lit(51_500.0).alias("newbalanceDest"),
        F.when(j % 2 == 0, 1).otherwise(0).alias("isFraud"),
        F.lit(0).alias("isFlaggedFraud"),
    )


def load_transactions(spark, folder):
    return transactions(spark.read.parquet(f"{folder}/events.parquet"))
