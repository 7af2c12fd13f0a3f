"""Star schema: one fact table, three dimensions, one audit table."""

import uuid

from pyspark.sql import functions as F

from auditloom.functions.columns import half_even, money_sum, tiered, title, zero_padded
from auditloom.operators.quality import audit_summary
from auditloom.operators.skew import lookup
from auditloom.schema import (
    CATEGORY_INFO, FACT_RENAMES, FLAGGED_COLUMNS, MERCHANT_BRANDS, SIGNALS, VENDOR_TIERS)
from auditloom.storage import concurrently, remove, staged


def date_key(time):
    return F.date_format(time, "yyyyMMdd").cast("int")


def dim_category(df, category_col="category"):
    """One row per category that occurs; unknown ones get a general text."""
    info = F.create_map(*[
        x for id_, name, text, risk in CATEGORY_INFO
        for x in (F.lit(id_), F.struct(
            F.lit(name).alias("name"), F.lit(text).alias("text"), F.lit(risk).alias("risk")))])
    id_ = F.col("category_id")
    known = F.try_element_at(info, id_)
    return (
        df.where(F.col(category_col).isNotNull())
        .select(F.col(category_col).alias("category_id")).distinct()
        .select(
            "category_id",
            F.coalesce(known["name"], title(id_)).alias("category_name"),
            F.coalesce(known["text"], F.concat(F.lit("General "), id_, F.lit(" transaction"))).alias("description"),
            F.coalesce(known["risk"], F.lit("Medium")).alias("category_risk_profile"))
        .orderBy("category_id")
    )


def vendor_name(vendor):
    """Brand and id prefix for merchants, a private account otherwise; the same in every run."""
    pick = F.conv(F.substring(F.md5(vendor), 1, 8), 16, 10).cast("bigint") % len(MERCHANT_BRANDS)
    brand = F.element_at(F.array(*[F.lit(b) for b in MERCHANT_BRANDS]), (pick + 1).cast("int"))
    merchant = F.concat(brand, F.lit(" ("), F.substring(vendor, 1, 6), F.lit(")"))
    return F.when(vendor.startswith("M"), merchant).otherwise(F.concat(F.lit("Private Account "), vendor))


def dim_vendor(df):
    """One row per vendor with its totals, flagged share, name and risk tier."""
    amount = F.col("amount")
    flagged = F.count_if("is_flagged") if "is_flagged" in df.columns else F.lit(0).cast("bigint")
    share = half_even(
        F.col("flagged_count") / F.greatest(F.col("total_transactions"), F.lit(1)) * 100, 2)
    return (
        df.where(F.col("vendor_id").isNotNull()).groupBy("vendor_id").agg(
            F.count(amount).alias("total_transactions"),
            money_sum(amount).alias("total_volume"),
            flagged.alias("flagged_count"))
        .select(
            "vendor_id", "total_transactions", "total_volume",
            F.try_divide("total_volume", "total_transactions").alias("avg_transaction_amount"),
            "flagged_count",
            F.col("vendor_id").startswith("M").alias("is_merchant"),
            share.alias("flagged_rate_pct"),
            vendor_name(F.col("vendor_id")).alias("vendor_name"))
        .withColumn("vendor_risk_tier", tiered(F.col("flagged_rate_pct"), VENDOR_TIERS, "STANDARD"))
    )


def dim_date(df, time_col="timestamp"):
    """Every day between the first and the last transaction."""
    day = F.col("full_date")
    bounds = df.agg(F.min(F.to_date(time_col)).alias("first"), F.max(F.to_date(time_col)).alias("last"))
    return (
        bounds.where("first IS NOT NULL")
        .select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
        .select(
            "full_date", date_key(day).alias("date_key"), F.year(day).alias("year"),
            F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
            F.month(day).alias("month"), F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"), F.weekday(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.weekday(day).isin(5, 6).alias("is_weekend"))
    )


def fact_transactions(flagged):
    """The fact table from a flagged table with its final ``row_number``."""
    flags = [
        "is_weekend", "is_night", "flag_exact_duplicate", "flag_near_duplicate", *SIGNALS, "is_flagged"]
    return (
        flagged.select(
            F.concat(F.lit("TXN_"), zero_padded(F.col("row_number"))).alias("transaction_id"),
            *FLAGGED_COLUMNS, date_key(F.col("timestamp")).alias("date_key"))
        .withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})
        .withColumn("flag_reasons", F.nullif(F.col("flag_reasons"), F.lit("")))
        .withColumnsRenamed(FACT_RENAMES)
    )


def build_tables(flagged, profile=None):
    """All five tables; the dimensions are staged, so joins know their sizes."""
    vendors, categories, dates = concurrently(
        flagged.sparkSession,
        lambda: staged(dim_vendor(flagged), "dim_vendor"),
        lambda: staged(dim_category(flagged), "dim_category"),
        lambda: staged(dim_date(flagged), "dim_date"))
    return {
        "fact_transactions": fact_transactions(flagged),
        "dim_vendor": vendors,
        "dim_category": categories,
        "dim_date": dates,
        "data_quality_summary": audit_summary(profile, flagged),
    }


def _location(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _rename(spark, old, new):
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def save_tables(tables, database, location):
    """Replace the warehouse tables together; the fact is split by day into evenly sized files.

    All tables are written beside the old ones first, under names and folders of a new version; then names
    are exchanged, which moves no data. If a write or an exchange fails, the old tables are as they
    were and the new version is removed. The old version's files go last.
    """
    spark = tables["fact_transactions"].sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    version = uuid.uuid4().hex[:8]
    name_of = lambda name, suffix="": f"`{database}`.`{name}{suffix}`"
    folder = f"{location}/versions/{version}"
    exchanged = []
    try:
        for name, table in tables.items():
            writer = table.hint("rebalance", "date_key") if name == "fact_transactions" else table
            writer = writer.write.format("parquet").option("path", f"{folder}/{name}")
            if name == "fact_transactions":
                writer = writer.partitionBy("date_key")
            writer.saveAsTable(name_of(name, f"__new_{version}"))
        for name in tables:
            held = spark.catalog.tableExists(name_of(name))
            if held:
                _rename(spark, name_of(name), name_of(name, f"__old_{version}"))
            exchanged.append((name, held))
            _rename(spark, name_of(name, f"__new_{version}"), name_of(name))
    except Exception:
        for name, held in reversed(exchanged):
            if held:
                if spark.catalog.tableExists(name_of(name)):
                    _rename(spark, name_of(name), name_of(name, f"__new_{version}"))
                _rename(spark, name_of(name, f"__old_{version}"), name_of(name))
            else:
                spark.sql(f"DROP TABLE IF EXISTS {name_of(name)}")
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name_of(name, f'__new_{version}')}")
        remove(spark, folder)
        raise
    for name, held in exchanged:
        if held:
            retired = name_of(name, f"__old_{version}")
            path = _location(spark, retired)
            spark.sql(f"DROP TABLE {retired}")
            if path and "/versions/" in path:
                remove(spark, path)


def saved_tables(spark, database):
    """The saved warehouse's tables by name, as ``save_tables`` takes and the reports read them."""
    names = ["fact_transactions", "dim_vendor", "dim_category", "dim_date", "data_quality_summary"]
    return {name: spark.table(f"`{database}`.`{name}`") for name in names}


def star_join(tables, **skew):
    """Fact rows with the attributes of all three dimensions."""
    fact = tables["fact_transactions"]
    dates = tables["dim_date"].select("date_key", "full_date", "day_name")
    categories = tables["dim_category"].select(
        F.col("category_id").alias("category"), "category_name", "category_risk_profile")
    vendors = tables["dim_vendor"].select(
        "vendor_id", "total_transactions", "vendor_name", "vendor_risk_tier")
    rows = fact.join(dates, "date_key", "left").join(categories, "category", "left")
    return lookup(rows, vendors, ["vendor_id"], "total_transactions", spread_by="transaction_id", **skew)
