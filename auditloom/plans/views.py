"""Report queries over the star schema, as Spark SQL.

The fact table is joined after it was reduced where the report allows it: totals per day,
category or vendor are built first (map-side combine), and only they meet the dimension.
"""

from pyspark.sql import functions as F

from auditloom.schema import OTHER_COLOR, RISK_COLORS, SUSPICIOUS_COLUMNS, VENDOR_REPORT

SUSPICIOUS = f"""
    SELECT {", ".join(SUSPICIOUS_COLUMNS)}
    FROM (SELECT * FROM {{fact_transactions}} WHERE is_flagged)
    LEFT JOIN (SELECT vendor_id, vendor_name FROM {{dim_vendor}}) USING (vendor_id)
    ORDER BY anomaly_score DESC, transaction_id
"""

VENDOR_RISK = f"""
    SELECT {", ".join(f"{of} AS {name}" for name, of in VENDOR_REPORT.items())}
    FROM {{dim_vendor}}
    ORDER BY flagged_transaction_count DESC, total_volume DESC, vendor_id
"""

# Totals of the fact per one key; sums are exact decimals.
TOTALS = """
    SELECT <key>, COUNT(transaction_id) AS txns,
           SUM(CAST(amount AS DECIMAL(18,2))) AS value,
           MAX(amount) AS largest,
           COUNT_IF(is_flagged) AS flagged,
           SUM(CASE WHEN is_flagged THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS flagged_value
    FROM {fact_transactions} GROUP BY <key>
"""


def _totals(key):
    return TOTALS.replace("<key>", key)


DAILY_AUDIT = f"""
    SELECT d.date_key, d.full_date, d.day_name, d.is_weekend, f.txns AS total_txns,
           CAST(f.value AS DOUBLE) AS total_value, f.flagged AS flagged_txns,
           CAST(f.flagged_value AS DOUBLE) AS flagged_value,
           ROUND(100.0D * f.flagged / f.txns, 2) AS anomaly_pct
    FROM {{dim_date}} d JOIN ({_totals("date_key")}) f
      ON d.date_key = f.date_key
    ORDER BY d.date_key
"""

CATEGORY_RISK = f"""
    SELECT c.category_id, c.category_name, c.category_risk_profile, f.txns AS txn_count,
           CAST(f.value AS DOUBLE) AS total_amount,
           ROUND(CAST(f.value AS DOUBLE) / f.txns, 2) AS avg_amount,
           f.largest AS max_amount, f.flagged AS flagged_count,
           ROUND(100.0D * f.flagged / f.txns, 2) AS flagged_rate_pct
    FROM {{dim_category}} c JOIN ({_totals("category")}) f ON c.category_id = f.category
    ORDER BY total_amount DESC, c.category_id
"""

TOP_VENDORS = f"""
    SELECT v.vendor_name, v.vendor_risk_tier, SUM(f.txns) AS total_txns,
           ROUND(CAST(SUM(f.value) AS DOUBLE), 2) AS total_volume,
           SUM(f.flagged) AS flagged_count,
           ROUND(100.0D * SUM(f.flagged) / SUM(f.txns), 2) AS flagged_pct
    FROM {{dim_vendor}} v JOIN ({_totals("vendor_id")}) f ON v.vendor_id = f.vendor_id
    GROUP BY v.vendor_name, v.vendor_risk_tier
    HAVING SUM(f.txns) >= 10
    ORDER BY flagged_count DESC, flagged_pct DESC, v.vendor_name, v.vendor_risk_tier
    LIMIT 10
"""

DAILY_TREND = f"""
    SELECT d.full_date, f.txns AS total_txns, f.flagged AS flagged_txns,
           ROUND(CAST(f.flagged_value AS DOUBLE), 2) AS flagged_volume
    FROM {{dim_date}} d JOIN ({_totals("date_key")}) f ON d.date_key = f.date_key
    ORDER BY d.full_date
"""

SUSPICIOUS_TOP5 = f"""
    SELECT transaction_id, vendor_name, amount, anomaly_score, risk_level, flag_reasons
    FROM ({SUSPICIOUS}) ORDER BY anomaly_score DESC, transaction_id LIMIT 5
"""

VENDORS_TOP5 = f"""
    SELECT vendor_name, total_transactions, total_volume, flagged_transaction_count, flagged_ratio_pct
    FROM ({VENDOR_RISK})
    ORDER BY flagged_transaction_count DESC, total_volume DESC, vendor_id LIMIT 5
"""

CATEGORIES = f"""
    SELECT category_name, txn_count, total_amount, flagged_count, flagged_rate_pct
    FROM ({CATEGORY_RISK}) ORDER BY total_amount DESC, category_name
"""

DRILL_THROUGH = f"""
    SELECT transaction_id, timestamp, vendor_name, category, amount, anomaly_score, risk_level, flag_reasons
    FROM ({SUSPICIOUS})
"""

TOP15_VENDORS = f"""
    SELECT v.vendor_id, v.vendor_name, CAST(f.flagged_value AS DOUBLE) AS flagged_value,
           CAST(f.flagged AS DOUBLE) / f.txns AS anomaly_ratio
    FROM {{dim_vendor}} v JOIN ({_totals("vendor_id")}) f ON v.vendor_id = f.vendor_id
    ORDER BY flagged_value DESC, v.vendor_id
    LIMIT 15
"""

DUPLICATE_DETAIL = """
    SELECT user_orig_id, vendor_id, amount, timestamp, flag_exact_duplicate, flag_near_duplicate
    FROM {fact_transactions} WHERE flag_duplicate
"""

OUTLIER_SCATTER = """
    SELECT timestamp, amount, is_flagged, anomaly_score FROM {fact_transactions}
"""

VENDOR_SCATTER = """
    SELECT vendor_id, total_transactions, flagged_rate_pct, total_volume, vendor_risk_tier
    FROM {dim_vendor}
"""

HOURLY = """
    SELECT hour_of_day, COUNT(*) AS total_transactions, COUNT_IF(is_flagged) AS flagged_transactions,
           hour_of_day BETWEEN 1 AND 5 AS off_hours
    FROM {fact_transactions} GROUP BY hour_of_day
"""

RISK_DISTRIBUTION = """
    SELECT risk_level, COUNT(*) AS transactions,
           CAST(SUM(CASE WHEN is_flagged THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS flagged_value
    FROM {fact_transactions} GROUP BY risk_level
"""

DAILY_OVERLAY = """
    SELECT d.full_date, f.total_transactions,
           CAST(f.flagged AS DOUBLE) / f.total_transactions AS anomaly_ratio,
           f.flagged_value, f.critical_risk_value
    FROM {dim_date} d JOIN (
        SELECT date_key, COUNT(*) AS total_transactions, COUNT_IF(is_flagged) AS flagged,
               CAST(SUM(CASE WHEN is_flagged THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS flagged_value,
               CAST(SUM(CASE WHEN risk_level = 'CRITICAL' THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
                   AS critical_risk_value
        FROM {fact_transactions} GROUP BY date_key) f ON d.date_key = f.date_key
    ORDER BY d.full_date
"""

CATEGORY_TREEMAP = f"""
    SELECT c.category_name, c.category_risk_profile, CAST(f.value AS DOUBLE) AS total_amount, f.txns AS txn_count
    FROM {{dim_category}} c JOIN ({_totals("category")}) f ON c.category_id = f.category
"""

# Report views a user can query by name after ``register_views``.
VIEWS = {
    "v_suspicious_transactions": SUSPICIOUS,
    "v_vendor_risk_summary": VENDOR_RISK,
    "v_daily_audit_trend": DAILY_AUDIT,
    "v_category_risk_breakdown": CATEGORY_RISK,
}


def report(tables, text):
    """Run one of the texts above on a set of star-schema tables."""
    spark = tables["fact_transactions"].sparkSession
    used = {name: table for name, table in tables.items() if "{" + name + "}" in text}
    return spark.sql(text, **used)


def register_views(tables, clean_view=None):
    """Make the tables and the report views available to plain SQL in this session."""
    spark = tables["fact_transactions"].sparkSession
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    if clean_view is not None:
        clean_view.createOrReplaceTempView("clean_transactions")
    for name, text in VIEWS.items():
        report(tables, text).createOrReplaceTempView(name)
    return spark


def risk_color(column="risk_level"):
    color = F.lit(OTHER_COLOR)
    for level, code in RISK_COLORS.items():
        color = F.when(F.col(column) == level, code).otherwise(color)
    return color


def vendor_risk_status(vendors):
    """The tier text of the selected vendors, or that there are several tiers."""
    one = F.count_distinct("vendor_risk_tier") == 1
    tier = F.when(one, F.max("vendor_risk_tier")).otherwise("Multiple Vendors")
    return vendors.agg(F.concat(F.lit("Vendor Risk Profile: "), tier).alias("vendor_risk_status"))


def slice_fact(tables, dates=None, categories=None, risk_levels=None, vendor_tiers=None,
               vendor_search=None, hours=None, weekend=None):
    """The fact rows left by the dashboard slicers; a slicer that is None selects all.

    Date keys ascend with the days, so a range of dates is a range of keys, which a saved fact's
    partitions are chosen by before the job; what is left of the days after the weekend slicer, a row per
    calendar day, is broadcast and prunes partitions as it runs.
    """
    fact = tables["fact_transactions"]
    if dates is not None:
        first, last = [int(str(d)[:10].replace("-", "")) for d in dates]
        fact = fact.where(F.col("date_key").between(first, last))
    if risk_levels is not None:
        fact = fact.where(F.col("risk_level").isin(*risk_levels))
    if hours is not None:
        fact = fact.where(F.col("hour_of_day").between(*hours))
    if dates is not None or weekend is not None:
        days = tables["dim_date"]
        if dates is not None:
            days = days.where(F.col("full_date").between(*[F.lit(d).cast("date") for d in dates]))
        if weekend is not None:
            # a comparison, as only such filters make Spark prune partitions; Saturday and Sunday are 5 and 6
            days = days.where(F.col("day_of_week") >= 5 if weekend else F.col("day_of_week") < 5)
        fact = fact.join(F.broadcast(days.select("date_key")), "date_key", "left_semi")
    if categories is not None:
        names = tables["dim_category"].where(F.col("category_name").isin(*categories))
        fact = fact.join(names.select(F.col("category_id").alias("category")), "category", "left_semi")
    if vendor_tiers is not None or vendor_search is not None:
        vendors = tables["dim_vendor"]
        if vendor_tiers is not None:
            vendors = vendors.where(F.col("vendor_risk_tier").isin(*vendor_tiers))
        if vendor_search is not None:
            vendors = vendors.where(F.lower("vendor_name").contains(vendor_search.lower()))
        fact = fact.join(vendors.select("vendor_id"), "vendor_id", "left_semi")
    return fact
