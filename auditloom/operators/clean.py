"""Cleaning of raw transactions."""

from pyspark.sql import functions as F

from auditloom.functions.columns import half_even, step_timestamp, strip
from auditloom.functions.percentiles import column_percentiles
from auditloom.operators.neighbours import AnyRepeat, Recent, Repeat, apply_rules
from auditloom.schema import RAW_COLUMNS
from auditloom.storage import staged

IMPUTED = ["oldbalanceOrg", "oldbalanceDest"]

RAW_RULES = [
    Repeat(tuple(RAW_COLUMNS), "is_exact_duplicate"),
    Recent(("nameOrig", "amount"), 1, "is_near_duplicate"),
]

VIEW_RULES = [
    AnyRepeat(("step", "category", "amount", "user_orig_id", "vendor_id"), "copied"),
    Recent(("user_orig_id", "vendor_id", "amount"), 1, "near", missing_equal=True),
]


def missing_flags(df):
    return df.withColumns({
        "is_missing_amount": F.col("amount").isNull(),
        "is_missing_orig_balance": F.col("oldbalanceOrg").isNull(),
    })


def drop_missing_amount(df):
    return df.na.drop(subset=["amount"])


def balance_medians(df, columns=IMPUTED):
    """Median of each column, as one row on the driver."""
    return column_percentiles(df, columns, {"median": 0.5}).first()


def fill_balances(df, medians, columns=IMPUTED):
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(medians[f"{c}_median"])) for c in columns})


def impute_median(df, columns=IMPUTED):
    """Fill missing balances with the median of the column, which is computed at once."""
    return fill_balances(df, balance_medians(df, columns), columns)


def normalize_category(df):
    return df.withColumn("type", F.upper(strip(F.col("type"))))


def temporal_features(df):
    return (
        df.withColumn("timestamp", step_timestamp(F.col("step")))
        .withColumns({
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": F.weekday("timestamp"),
        })
        .withColumns({
            "is_weekend": F.col("day_of_week").isin(5, 6),
            "is_night": F.col("hour_of_day").between(1, 5),
        })
    )


def vendor_features(df):
    return df.withColumns({
        "vendor_id": F.col("nameDest"),
        "category": F.col("type"),
        "is_merchant_dest": F.col("nameDest").startswith("M"),
    })


def prepare(df):
    """All cleaning steps that look at one row at a time."""
    df = normalize_category(drop_missing_amount(missing_flags(df)))
    df = df.withColumn("amount", half_even(F.col("amount"), 2))
    return vendor_features(temporal_features(df))


def clean(df, **skew):
    prepared = staged(prepare(df), "prepared")
    return apply_rules(impute_median(prepared), "nameOrig", RAW_RULES, **skew)


def balance_inconsistent(old="old_balance_orig", amount="amount", new="new_balance_orig"):
    """1 where the payer's balances and the amount disagree by more than 1, else 0."""
    gap = F.abs(F.col(old) - F.col(amount) - F.col(new))
    return F.when(gap > 1, 1).otherwise(0)


def clean_view(staging, **skew):
    """The SQL cleaning view: keeps amounts from 0 up, fills nothing, and has its own duplicate rules."""
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    base = staging.where(F.col("amount").isNotNull() & (F.col("amount") >= 0)).select(
        "row_id", "step",
        F.upper(F.trim("type")).alias("category"),
        F.round("amount", 2).alias("amount"),
        F.col("nameOrig").alias("user_orig_id"),
        F.col("oldbalanceOrg").alias("old_balance_orig"),
        F.col("newbalanceOrig").alias("new_balance_orig"),
        F.col("nameDest").alias("vendor_id"),
        F.col("oldbalanceDest").alias("old_balance_dest"),
        F.col("newbalanceDest").alias("new_balance_dest"),
        F.col("isFraud").alias("is_fraud_ground_truth"),
        F.col("isFlaggedFraud").alias("is_flagged_fraud_system"),
    )
    rows = apply_rules(base, "user_orig_id", VIEW_RULES, **skew)
    hour = F.col("step") % 24
    day = F.expr("step div 24 % 7")
    return rows.select(
        "row_id", "step",
        step_timestamp(F.col("step")).alias("transaction_timestamp"),
        hour.alias("hour_of_day"), day.alias("day_of_week_num"),
        flag(hour.between(1, 5)).alias("is_night"),
        flag(day.isin(5, 6)).alias("is_weekend"),
        "category", "amount", "user_orig_id", "old_balance_orig", "new_balance_orig",
        balance_inconsistent().alias("is_balance_inconsistent"),
        "vendor_id", flag(F.col("vendor_id").ilike("M%")).alias("is_merchant_dest"),
        "old_balance_dest", "new_balance_dest", "is_fraud_ground_truth", "is_flagged_fraud_system",
        flag(F.col("copied")).alias("flag_exact_duplicate"),
        flag(F.col("near")).alias("flag_near_duplicate"),
    )
