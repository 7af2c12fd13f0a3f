"""From raw transactions to the flagged table, and the complete job with its outputs."""

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from auditloom.operators.clean import RAW_RULES, impute_median, prepare
from auditloom.operators.forest import IsolationForest, flag_outliers, with_balance_delta
from auditloom.operators.neighbours import Rank, apply_rules
from auditloom.operators.ordering import running_start
from auditloom.operators.quality import column_profile
from auditloom.operators.scoring import score
from auditloom.operators.signals import (
    category_cutoffs, detect_large_transactions, detect_vendor_signals, duplicate_rules,
    user_attributes, velocity_rule, vendor_profile, with_concentration, with_duplicate_flag)
from auditloom.plans.warehouse import build_tables, save_tables
from auditloom.schema import CLEAN_COLUMNS, FLAGGED_COLUMNS
from auditloom.sources.sinks import write_table
from auditloom.sources.transactions import check_rejects, load_all, with_row_id
from auditloom.storage import concurrently, staged


def user_table(prepared):
    """User profile with the number of rows of all earlier users in the final order."""
    users = staged(user_attributes(prepared), "users")
    return staged(running_start(users, [F.asc_nulls_last("nameOrig")], "_n", "_rows_before"), "users")


def detect(prepared, rules, fill=False, multivariate=True, use_label=True, **skew):
    """Add all signals, the score and the final row number to staged transactions.

    The profiles come from narrow scans that run side by side. The rows themselves are
    shuffled once, by user, for all neighbour rules, and again by vendor only if the vendor
    profile is too large to broadcast. The final order (user, step, destination, amount,
    row_id) starts with the user, so a row's number is its rank in the user plus the rows
    of earlier users: no further sort. ``multivariate`` is a forest, True for the default
    one, or False for none; with one, the result is a staged table and columns made from it row by row.
    ``fill`` asks to fill missing balances first.
    """
    forest = IsolationForest() if multivariate is True else multivariate
    spark = prepared.sparkSession
    users, cutoffs, vendors, rows = concurrently(
        spark,
        lambda: user_table(prepared),
        lambda: staged(category_cutoffs(prepared), "cutoffs"),
        lambda: staged(vendor_profile(prepared), "vendors"),
        lambda: impute_median(prepared) if fill else prepared)

    def signalled():
        columns = prepared.columns
        every = [*rules, *duplicate_rules(columns), velocity_rule(columns), Rank("nameOrig", "_rank")]
        out = apply_rules(rows, "nameOrig", every, attributes=users, **skew)
        known = users.where("nameOrig IS NOT NULL").agg(F.sum("_n")).scalar()
        before = F.coalesce(F.col("_rows_before"), known, F.lit(0))
        out = out.withColumn("row_number", before + F.col("_rank")).drop("_rows_before", "_rank")
        out = with_concentration(with_duplicate_flag(out))
        out = detect_large_transactions(out, cutoffs=cutoffs, **skew)
        return detect_vendor_signals(out, vendors, **skew)

    out, model = concurrently(spark, signalled, lambda: forest.grow(rows) if forest else None)
    if model:
        out = flag_outliers(model, out)
    else:
        out = with_balance_delta(out).withColumn("flag_multivariate_outlier", F.lit(False))
    return score(out, use_label)


def flag_raw(raw, multivariate=True, use_label=True, **skew):
    """Raw transactions to the flagged columns; cleaning and signals share one shuffle."""
    prepared = staged(prepare(raw), "prepared")
    rows = detect(prepared, RAW_RULES, True, multivariate, use_label, **skew)
    return rows.select("row_id", "row_number", *FLAGGED_COLUMNS)


def run_anomaly_pipeline(clean, multivariate=True, use_label=True, **skew):
    """All signals and the score for transactions that are already clean."""
    prepared = staged(with_row_id(clean), "clean")
    return detect(prepared, [], False, multivariate, use_label, **skew).drop("row_number")


def pipeline_summary(flagged):
    flags = F.count_if("is_flagged")
    return flagged.agg(
        F.count("*").alias("total_transactions"),
        flags.alias("flagged_transactions"),
        (100.0 * F.try_divide(flags, F.count("*"))).alias("flagged_pct"),
        F.count_if(F.col("risk_level").isin("HIGH", "CRITICAL")).alias("high_critical_transactions"),
    )


def run_full_pipeline(
        raw, outdir, multivariate=True, formats=("parquet", "csv"), database=None, max_rejects=0, **skew):
    """Profile, clean, flag, model and write everything; returns (tables, summary, seconds).

    ``raw`` is a DataFrame with a row_id, or a path; ``database`` also saves the star schema
    as tables there. Rows of a file with unreadable values are written as ``rejected_rows``; if there
    are more than ``max_rejects``, the job ends with an error after that. Independent writes run side
    by side.
    """
    started = time.time()
    if isinstance(raw, str):
        raw, rejects = load_all(SparkSession.active(), raw)
        write_table(rejects, outdir, "rejected_rows", ("parquet",))
        check_rejects(rejects, max_rejects)
    spark = raw.sparkSession
    profile, flagged = concurrently(
        spark,
        lambda: staged(column_profile(raw), "profile"),
        lambda: flag_raw(raw, multivariate, **skew) if multivariate else staged(flag_raw(raw, False, **skew), "flagged"))
    tables = build_tables(flagged, profile)
    outputs = {
        "clean_transactions": flagged.select(*CLEAN_COLUMNS),
        "flagged_transactions": flagged.select(*FLAGGED_COLUMNS),
        **tables,
    }
    jobs = [lambda n=n, t=t: write_table(t, outdir, n, formats) for n, t in outputs.items()]
    jobs.append(lambda: write_table(profile, outdir, "data_quality_report", ("csv",)))
    if database:
        jobs.append(lambda: save_tables(tables, database, f"{outdir}/{database}"))
    *_, summary = concurrently(spark, *jobs, lambda: pipeline_summary(flagged).first())
    return tables, summary, time.time() - started
