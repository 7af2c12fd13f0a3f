"""The rule signals: duplicates, large amounts, timing, vendor spikes, velocity, concentration.

``*_profile`` functions reduce the transactions to a table with one row per category, vendor or
user; ``detect_*`` functions compare every transaction with its profile or its neighbours.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.functions.columns import day_bucket, half_even, money_sum
from auditloom.functions.percentiles import exact_percentiles
from auditloom.operators.neighbours import Burst, Recent, Repeat, apply_rules
from auditloom.operators.skew import lookup
from auditloom.sources.transactions import with_row_id
from auditloom.storage import staged

DUPLICATE_KEYS = ("step", "type", "amount", "nameOrig", "nameDest")
IQR_FACTOR = 2.5
STD_FACTOR = 3
ACTIVE_VENDOR_ROWS = 10
SPIKE_FLOOR = 5
SPIKE_STD = 2.5
BASELINE_DAYS = 7
HHI_FLOOR = 0.85
HHI_ROWS = 3


def duplicate_rules(columns, time="step"):
    keys = tuple(c for c in DUPLICATE_KEYS if c in columns)
    return [
        Repeat(keys, "flag_exact_duplicate"),
        Recent(("nameOrig", "nameDest", "amount"), 2, "flag_near_duplicate", time),
    ]


def velocity_rule(columns, user="nameOrig", time="step"):
    return Burst(user, "flag_velocity", time, tuple(c for c in ("nameDest", "amount") if c in columns))


def with_duplicate_flag(df):
    return df.withColumn("flag_duplicate", F.col("flag_exact_duplicate") | F.col("flag_near_duplicate"))


def detect_duplicates(df, time_col="step", **skew):
    df = with_row_id(df)
    return with_duplicate_flag(apply_rules(df, "nameOrig", duplicate_rules(df.columns, time_col), **skew))


def detect_user_velocity(df, user_col="nameOrig", step_col="step", **skew):
    df = with_row_id(df)
    return apply_rules(df, user_col, [velocity_rule(df.columns, user_col, step_col)], **skew)


def category_cutoffs(df, category_col="category", amount_col="amount"):
    """One row per category: quartiles and the amount above which a transaction is large."""
    quartiles = exact_percentiles(df, amount_col, {"q25": 0.25, "q75": 0.75}, [category_col])
    spread = df.where(F.col(category_col).isNotNull()).groupBy(category_col).agg(
        F.count("*").alias("n"), F.avg(amount_col).alias("mean"), F.stddev_samp(amount_col).alias("std"))
    iqr = F.col("q75") - F.col("q25")
    cutoff = F.when(iqr > 0, F.col("q75") + IQR_FACTOR * iqr).otherwise(
        F.col("mean") + STD_FACTOR * F.col("std"))
    return spread.join(quartiles, category_col, "left").withColumn("cutoff", cutoff)


def detect_large_transactions(df, category_col="category", amount_col="amount", cutoffs=None, **skew):
    df = with_row_id(df)
    if cutoffs is None:
        cutoffs = staged(category_cutoffs(df, category_col, amount_col), "cutoffs")
    df = lookup(df, cutoffs.select(category_col, "n", "cutoff"), [category_col], "n", **skew)
    large = F.coalesce(F.col(amount_col) > F.col("cutoff"), F.lit(False))
    return df.withColumn("flag_large_transaction", large).drop("cutoff")


def vendor_hour_profile(df, vendor_col="vendor_id", hour_col="hour_of_day"):
    """5th and 95th percentile hour of each vendor with enough transactions."""
    hours = df.where(F.col(vendor_col).isNotNull()).groupBy(vendor_col, hour_col).agg(F.count("*").alias("_n"))
    # at most 24 values per vendor, so the built-in percentile is safe here
    p = F.percentile(hour_col, F.array(F.lit(0.05), F.lit(0.95)), F.col("_n"))
    return (
        hours.groupBy(vendor_col).agg(F.sum("_n").alias("n"), p.alias("_p"))
        .where(F.col("n") >= ACTIVE_VENDOR_ROWS)
        .select(vendor_col, "n", F.col("_p")[0].alias("p05"), F.col("_p")[1].alias("p95"))
    )


def active_vendor_rows(df, vendor_col="vendor_id", **skew):
    """The transactions of vendors with enough transactions."""
    df = with_row_id(df)
    active = (
        df.where(F.col(vendor_col).isNotNull()).groupBy(vendor_col).agg(F.count("*").alias("n"))
        .where(F.col("n") >= ACTIVE_VENDOR_ROWS).withColumn("_active", F.lit(True))
    )
    return lookup(df, staged(active, "active"), [vendor_col], "n", **skew).where("_active").drop("_active")


def vendor_daily(df, vendor_col="vendor_id", step_col="step"):
    return (
        df.where(F.col(vendor_col).isNotNull())
        .groupBy(vendor_col, day_bucket(F.col(step_col)).alias("day_bucket"))
        .agg(F.count("amount").alias("daily_count"), money_sum(F.col("amount")).alias("daily_volume"),
             F.count("*").alias("rows"))
    )


def vendor_rolling_baseline(daily, vendor_col="vendor_id"):
    """Mean and deviation of the counts of the previous active days, and the spike mark.

    The window runs over vendor-days, so a vendor has at most as many rows as there are days.
    """
    past = Window.partitionBy(vendor_col).orderBy("day_bucket").rowsBetween(-BASELINE_DAYS, -1)
    enough = F.count("daily_count").over(past) >= 2
    mean, std = F.avg("daily_count").over(past), F.stddev_samp("daily_count").over(past)
    spike = (F.col("daily_count") > SPIKE_FLOOR) & (
        F.col("daily_count") > F.col("rolling_count_mean")
        + SPIKE_STD * F.coalesce(F.col("rolling_count_std"), F.lit(0.0)))
    return (
        daily.withColumn("rolling_count_mean", F.when(enough, mean))
        .withColumn("rolling_count_std", F.when(enough, std))
        .withColumn("is_vendor_spike_day", F.coalesce(spike, F.lit(False)))
    )


def vendor_profile(df, vendor_col="vendor_id", step_col="step", hour_col="hour_of_day"):
    """One row per vendor: usual hours and the list of its spike days."""
    days = vendor_rolling_baseline(vendor_daily(df, vendor_col, step_col), vendor_col)
    spikes = days.groupBy(vendor_col).agg(
        F.sum("rows").alias("n"),
        F.collect_set(F.when(F.col("is_vendor_spike_day"), F.col("day_bucket"))).alias("spike_days"))
    return spikes.join(vendor_hour_profile(df, vendor_col, hour_col).drop("n"), vendor_col, "left")


def _timing_flag(hour_col):
    hour = F.col(hour_col)
    unusual = (hour < F.col("p05")) | (hour > F.col("p95"))
    return F.coalesce(hour.between(1, 5), F.lit(False)) | F.coalesce(unusual, F.lit(False))


def _spike_flag(step_col):
    return F.coalesce(F.array_contains("spike_days", day_bucket(F.col(step_col))), F.lit(False))


def detect_unusual_timing(df, hour_col="hour_of_day", vendor_col="vendor_id", **skew):
    df = with_row_id(df)
    if hour_col not in df.columns and "timestamp" in df.columns:
        df = df.withColumn(hour_col, F.hour("timestamp"))
    hours = staged(vendor_hour_profile(df, vendor_col, hour_col), "hours")
    df = lookup(df, hours, [vendor_col], "n", **skew)
    return df.withColumn("flag_unusual_timing", _timing_flag(hour_col)).drop("p05", "p95")


def detect_vendor_spikes(df, vendor_col="vendor_id", step_col="step", **skew):
    df = with_row_id(df)
    days = vendor_rolling_baseline(vendor_daily(df, vendor_col, step_col), vendor_col)
    # all vendors with all their rows, so that one without a spike is known as heavy, too
    spikes = days.groupBy(vendor_col).agg(
        F.sum("rows").alias("n"),
        F.collect_set(F.when(F.col("is_vendor_spike_day"), F.col("day_bucket"))).alias("spike_days"))
    df = lookup(df, staged(spikes, "spikes"), [vendor_col], "n", **skew)
    return df.withColumn("flag_vendor_spike", _spike_flag(step_col)).drop("spike_days")


def detect_vendor_signals(df, profile=None, **skew):
    """Unusual timing and vendor spikes from one join with the vendor profile."""
    if profile is None:
        profile = staged(vendor_profile(df), "vendors")
    df = lookup(df, profile, ["vendor_id"], "n", **skew)
    return (
        df.withColumn("flag_unusual_timing", _timing_flag("hour_of_day"))
        .withColumn("flag_vendor_spike", _spike_flag("step"))
        .drop("p05", "p95", "spike_days")
    )


def user_vendor_spend(df, user_col="nameOrig", vendor_col="vendor_id"):
    return df.groupBy(user_col, vendor_col).agg(
        money_sum(F.col("amount")).alias("vendor_amount"), F.count("*").alias("vendor_rows"))


def _all_user_hhi(df, user_col, vendor_col):
    """Rows, spend, and concentration of the spend over vendors, also for a missing user.

    The squared shares are summed as squared spends over the squared total, so the total
    needs no second pass or join.
    """
    spend = user_vendor_spend(df, user_col, vendor_col)
    total = F.col("total_user_amount")
    base = F.when(total == 0, F.lit(1.0)).otherwise(total)
    squares = F.sum(F.when(F.col(vendor_col).isNotNull(), F.col("vendor_amount") * F.col("vendor_amount")))
    return (
        spend.groupBy(user_col).agg(
            F.sum("vendor_rows").alias("txn_count"),
            F.sum(F.col("vendor_amount").cast("decimal(28,2)")).cast("double").alias("total_user_amount"),
            squares.alias("_squares"))
        .withColumn("hhi", F.col("_squares") / (base * base))
        .withColumn("concentrated", F.coalesce(
            (F.col("txn_count") >= HHI_ROWS) & (F.col("hhi") >= HHI_FLOOR), F.lit(False)))
        .drop("_squares")
    )


def user_hhi(df, user_col="nameOrig", vendor_col="vendor_id"):
    """One row per user: rows, spend, and concentration of the spend over vendors."""
    return _all_user_hhi(df, user_col, vendor_col).where(F.col(user_col).isNotNull())


def user_attributes(df, user_col="nameOrig", vendor_col="vendor_id"):
    """The user profile as a table to join; a missing user has a row that joins nothing."""
    users = _all_user_hhi(df, user_col, vendor_col)
    return users.select(user_col, F.col("txn_count").alias("_n"), "hhi", "concentrated")


def with_concentration(df):
    return (
        df.withColumn("user_hhi", half_even(F.coalesce(F.col("hhi"), F.lit(0.0)), 4))
        .withColumn("flag_concentration", F.coalesce(F.col("concentrated"), F.lit(False)))
        .drop("hhi", "concentrated")
    )


def detect_concentration_hhi(df, user_col="nameOrig", vendor_col="vendor_id", **skew):
    df = with_row_id(df)
    users = staged(user_attributes(df, user_col, vendor_col), "users")
    return with_concentration(lookup(df, users, [user_col], "_n", **skew))


def user_vendor_share(df, user_col="nameOrig", vendor_col="vendor_id"):
    """Share of each vendor in the spend of each user."""
    spend = user_vendor_spend(df, user_col, vendor_col).where(
        F.col(user_col).isNotNull() & F.col(vendor_col).isNotNull())
    totals = user_hhi(df, user_col, vendor_col).select(user_col, "total_user_amount")
    total = F.col("total_user_amount")
    share = F.col("vendor_amount") / F.when(total == 0, F.lit(1.0)).otherwise(total)
    return (
        spend.drop("vendor_rows").join(totals, user_col)
        .withColumn("share", share).withColumn("share_sq", F.col("share") * F.col("share"))
    )
