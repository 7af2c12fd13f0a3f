"""The measure catalogue: named aggregates over the fact table under any filter or grouping."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from auditloom.functions.columns import money, ratio
from auditloom.functions.percentiles import counted_percentiles, exact_percentiles
from auditloom.operators.skew import lookup
from auditloom.storage import staged


TIMES = "_times"    # how many rows a counted row stands for

# The columns of the fact that the measures read.
READ = [
    "amount", "anomaly_score", "risk_level", "is_flagged", "is_fraud_ground_truth", "flag_duplicate",
    "flag_exact_duplicate", "flag_near_duplicate", "flag_large_transaction", "flag_vendor_spike", "flag_velocity",
    "flag_unusual_timing", "flag_multivariate_outlier", "flag_concentration",
]


def _value(condition=None):
    amount = money(F.col("amount"))
    if condition is not None:
        amount = F.when(condition, amount).otherwise(F.lit(0))
    return F.coalesce(F.sum(amount).cast("double"), F.lit(0.0))


def _count(condition):
    return F.count_if(condition)


def base_measures():
    flagged = F.col("is_flagged")
    fraud = F.coalesce(F.col("is_fraud_ground_truth") == 1, F.lit(False))
    clean = F.coalesce(F.col("is_fraud_ground_truth") == 0, F.lit(False))
    level = F.col("risk_level")
    return {
        "total_transactions": F.count("*"),
        "total_value": _value(),
        "avg_transaction_value": F.try_divide(
            F.sum(money(F.col("amount"))).cast("double"), F.count("amount").cast("double")),
        "max_transaction_value": F.max("amount"),
        "flagged_transactions": _count(flagged),
        "flagged_value": _value(flagged),
        "avg_anomaly_score": F.avg("anomaly_score"),
        "high_critical_txns": _count(level.isin("HIGH", "CRITICAL")),
        "critical_risk_value": _value(level == "CRITICAL"),
        "duplicates_count": _count(F.col("flag_duplicate")),
        "exact_duplicates_count": _count(F.col("flag_exact_duplicate")),
        "near_duplicates_count": _count(F.col("flag_near_duplicate")),
        "large_transaction_count": _count(F.col("flag_large_transaction")),
        "vendor_spike_count": _count(F.col("flag_vendor_spike")),
        "velocity_burst_count": _count(F.col("flag_velocity")),
        "unusual_timing_count": _count(F.col("flag_unusual_timing")),
        "multivariate_outlier_count": _count(F.col("flag_multivariate_outlier")),
        "high_concentration_count": _count(F.col("flag_concentration")),
        "ground_truth_fraud_count": _count(fraud),
        "true_positives": _count(fraud & flagged),
        "false_negatives": _count(fraud & ~flagged),
        "false_positives": _count(clean & flagged),
    }


# Ratios of the measures above, 0 where the lower one is 0.
RATIOS = {
    "anomaly_ratio": ("flagged_transactions", "total_transactions"),
    "flagged_value_ratio": ("flagged_value", "total_value"),
    "recall": ("true_positives", "ground_truth_fraud_count"),
    "precision": ("true_positives", "flagged_transactions"),
}


def measures(fact, by=()):
    """All measures, one row per group of ``by`` or a single row."""
    by = list(by)
    # a constant key lets the single row use the grouped path
    rows, keys = (fact, by) if by else (fact.withColumn("_all", F.lit(1)), ["_all"])
    totals = rows.groupBy(*keys).agg(*[m.alias(n) for n, m in base_measures().items()])
    median = exact_percentiles(rows, "amount", {"median_transaction_value": 0.5}, keys, missing_keys=True)
    median = median.withColumnsRenamed({k: f"_{i}" for i, k in enumerate(keys)})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])
    out = totals.join(median, same, "left").drop(*[f"_{i}" for i in range(len(keys))]).withColumns(
        {n: ratio(F.col(a), F.col(b)) for n, (a, b) in RATIOS.items()})
    return out if by else out.drop("_all")


def _counted_measures():
    """``base_measures`` over counted rows: counts and sums weigh each row by ``TIMES``."""
    times = F.col(TIMES)
    value = money(F.col("amount")) * times
    flagged = F.col("is_flagged")
    fraud = F.coalesce(F.col("is_fraud_ground_truth") == 1, F.lit(False))
    clean = F.coalesce(F.col("is_fraud_ground_truth") == 0, F.lit(False))

    def count(condition):
        return F.coalesce(F.sum(F.when(condition, times)), F.lit(0).cast("bigint"))

    def total(condition=F.lit(True)):
        return F.coalesce(F.sum(F.when(condition, value)).cast("double"), F.lit(0.0))

    counts = {
        "total_transactions": F.lit(True),
        "flagged_transactions": flagged,
        "high_critical_txns": F.col("risk_level").isin("HIGH", "CRITICAL"),
        "duplicates_count": F.col("flag_duplicate"),
        "exact_duplicates_count": F.col("flag_exact_duplicate"),
        "near_duplicates_count": F.col("flag_near_duplicate"),
        "large_transaction_count": F.col("flag_large_transaction"),
        "vendor_spike_count": F.col("flag_vendor_spike"),
        "velocity_burst_count": F.col("flag_velocity"),
        "unusual_timing_count": F.col("flag_unusual_timing"),
        "multivariate_outlier_count": F.col("flag_multivariate_outlier"),
        "high_concentration_count": F.col("flag_concentration"),
        "ground_truth_fraud_count": fraud,
        "true_positives": fraud & flagged,
        "false_negatives": fraud & ~flagged,
        "false_positives": clean & flagged,
    }
    return {name: count(c) for name, c in counts.items()} | {
        "total_value": total(),
        "avg_transaction_value": F.try_divide(total(), count(F.col("amount").isNotNull()).cast("double")),
        "max_transaction_value": F.max("amount"),
        "flagged_value": total(flagged),
        "avg_anomaly_score": F.try_divide(
            F.sum(F.col("anomaly_score") * times).cast("double"), count(F.col("anomaly_score").isNotNull()).cast("double")),
        "critical_risk_value": total(F.col("risk_level") == "CRITICAL"),
    }


def measures_of_groupings(fact, groupings, max_values=None):
    """All measures for several groupings (name -> key columns) from one scan of the fact.

    Equal rows of the columns that matter are counted once, with map-side combine, into a staged
    table. Every grouping, the median included, is merged from these counts, so no further
    grouping costs another scan. One row per grouping and group; keys a grouping does
    not have are missing, and a missing key value is a group of its own. A grouping without keys
    gives one row, and none of an empty fact.
    """
    keys = list(dict.fromkeys(k for by in groupings.values() for k in by))
    kept = list(dict.fromkeys([*keys, *READ]))
    cells = staged(fact.groupBy(*kept).agg(F.count("*").alias(TIMES)), "cells")
    kinds = {k: cells.schema[k].dataType for k in keys}

    def group(name, by):
        return F.struct(F.lit(name).alias("grouping"), *[
            (F.col(k) if k in by else F.lit(None).cast(kinds[k])).alias(k) for k in keys])

    long = cells.select(F.explode(F.array(*[group(n, by) for n, by in groupings.items()])).alias("_group"), *[
        F.col(c) for c in [*READ, TIMES]])
    totals = long.groupBy("_group").agg(*[m.alias(n) for n, m in _counted_measures().items()])
    values = long.where(F.col("amount").isNotNull()).groupBy(
        "_group", F.col("amount").cast("double").alias("_value")).agg(F.sum(TIMES).alias("_n"))
    median = counted_percentiles(values, {"median_transaction_value": 0.5}, ["_group"], max_values)
    return totals.join(median, "_group", "left").select("_group.*", *[c for c in totals.columns if c != "_group"],
                                                        "median_transaction_value").withColumns(
        {n: ratio(F.col(a), F.col(b)) for n, (a, b) in RATIOS.items()})


def with_vendor_tier(tables):
    """Fact rows with the risk tier of their vendor."""
    vendors = tables["dim_vendor"].select("vendor_id", "total_transactions", "vendor_risk_tier")
    return lookup(
        tables["fact_transactions"], vendors, ["vendor_id"], "total_transactions", spread_by="transaction_id")
