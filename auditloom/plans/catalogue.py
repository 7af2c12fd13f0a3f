"""Every query by name: a function of (spark, folder) that returns a DataFrame."""

from pyspark.sql import functions as F

from auditloom.functions.columns import zero_padded
from auditloom.operators import clean as cleaning
from auditloom.operators import quality, signals
from auditloom.operators.forest import FEATURES, robust_scale, with_balance_delta
from auditloom.operators.skew import lookup
from auditloom.plans import evaluation, measures, views
from auditloom.plans.pipeline import pipeline_summary
from auditloom.plans.warehouse import save_tables, saved_tables, star_join
from auditloom.plans.workspace import workspace
from auditloom.schema import CLEAN_COLUMNS, FLAGGED_COLUMNS, RAW_COLUMNS
from auditloom.sources import sampling, synthetic
from auditloom.sources.sinks import common_rows, read_table, write_table
from auditloom.sources.transactions import load, load_all, scan
from auditloom.storage import concurrently, new_path, staged

QUERIES = {}


def query(function):
    """Register a function of a workspace under its own name, less a closing underscore."""
    QUERIES[function.__name__.rstrip("_")] = lambda spark, folder: function(workspace(spark, folder))
    return function


# --- sources and sinks

@query
def scan_transactions(ws):
    path = new_path(ws.spark, "csv")
    write_table(ws.transactions(), path, "raw", ("csv",))
    return load(ws.spark, f"{path}/raw.csv").select("row_id", *RAW_COLUMNS)


@query
def scan_by_suffix(ws):
    path = new_path(ws.spark, "scan")
    write_table(ws.transactions(), path, "raw")
    counts = [
        scan(ws.spark, f"{path}/raw.{kind}").groupBy(F.lit(kind).alias("format")).agg(
            F.count("*").alias("rows"), F.sum(F.col("row_id").cast("bigint")).alias("id_sum"))
        for kind in ("parquet", "csv")]
    return counts[0].unionByName(counts[1])


def _spoilt(ws):
    """(rows, rejects) of the raw transactions after a spreadsheet has written some values its own way."""
    id_ = F.col("row_id")
    amount = F.when(F.col("amount").isNotNull(), F.format_string("%.2f", F.col("amount")))
    rows = ws.transactions().withColumns({
        "amount": F.when(id_ % 37 == 0, F.concat(F.lit("$"), amount)).when(id_ % 41 == 0, F.format_number("amount", 2))
        .when(id_ % 43 == 0, "N/A").otherwise(amount),
        "step": F.when(id_ % 5 == 0, F.concat(F.col("step").cast("string"), F.lit(".0")))
        .when(id_ % 53 == 0, F.concat(F.col("step").cast("string"), F.lit(".5"))).otherwise(F.col("step").cast("string")),
        "isFraud": F.when(id_ % 3 == 0, F.initcap((F.col("isFraud") == 1).cast("string")))
        .when(id_ % 59 == 0, "yes").otherwise(F.col("isFraud").cast("string"))})
    path = new_path(ws.spark, "csv")
    write_table(rows, path, "raw", ("csv",))
    return load_all(ws.spark, f"{path}/raw.csv")


@query
def rejected_rows(ws):
    """Rows of a CSV file with values that have no reading in their columns' types."""
    _, rejects = _spoilt(ws)
    return rejects.select(
        "row_id", F.array_join("unreadable", ",").alias("unreadable"), F.get_json_object("content", "$.amount").alias("amount_text"),
        F.get_json_object("content", "$.step").alias("step_text"), F.get_json_object("content", "$.isFraud").alias("label_text"))


@query
def load_audit(ws):
    """Where the rows of that file went: read, rejected, dropped without an amount, kept by cleaning."""
    rows, rejects = _spoilt(ws)
    kept = rows.agg(
        F.count("*").alias("rows_read"), F.count_if(F.col("amount").isNull()).alias("rows_without_amount"),
        F.sum("step").alias("step_sum"), F.count_if(F.col("isFraud") == 1).alias("fraud_rows"),
        F.round(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double"), 2).alias("amount_sum"))
    return kept.crossJoin(rejects.agg(F.count("*").alias("rows_rejected")))   # a row each


@query
def write_roundtrip(ws):
    path = new_path(ws.spark, "clean")
    rows = ws.clean().select("row_id", *CLEAN_COLUMNS)
    kinds = ("parquet", "csv")
    concurrently(ws.spark, *[lambda k=k: write_table(rows, path, "clean_transactions", (k,)) for k in kinds])
    back = [read_table(ws.spark, path, "clean_transactions", rows.schema, k) for k in kinds]
    return common_rows(*back).select(
        "row_id", "step", "category", "amount", "vendor_id", "timestamp", "is_night", "is_near_duplicate")


@query
def warehouse_load(ws):
    database = "auditloom_check"
    save_tables(ws.tables(), database, new_path(ws.spark, "warehouse"))
    counts = [
        ws.spark.table(f"{database}.{name}").agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        for name in ws.tables()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query
def dq_summary_table(ws):
    return ws.tables()["data_quality_summary"]


@query
def staging_cast(ws):
    return ws.staging()


@query
def synth_transactions(ws):
    """One synthetic transaction per event."""
    ids = ws.spark.read.parquet(f"{ws.folder}/events.parquet").select(F.col("event_id").alias("row_id"))
    return synthetic.synthetic_transactions(ids, ids.count())


@query
def synth_injections(ws):
    ids = ws.spark.read.parquet(f"{ws.folder}/events.parquet").select(F.col("event_id").alias("row_id"))
    n = ids.count()
    return synthetic.plant_anomalies(synthetic.synthetic_transactions(ids, n), n)


@query
def raw_transactions(ws):
    """The adapter's output, with all planted anomalies."""
    return ws.transactions().select("row_id", *RAW_COLUMNS)


SAMPLE_NORMAL, SAMPLE_CHUNK = 20_000, 5_000


@query
def stratified_sample(ws):
    rows = sampling.stratified_sample(ws.transactions(), SAMPLE_NORMAL, chunk_rows=SAMPLE_CHUNK)
    return rows.select("row_id", "isFraud", "amount", "nameOrig")


@query
def sample_shuffled(ws):
    rows = sampling.stratified_sample(ws.transactions(), SAMPLE_NORMAL, chunk_rows=SAMPLE_CHUNK)
    return sampling.shuffled(rows.select("row_id", "isFraud", "amount"))


@query
def sample_summary(ws):
    return sampling.sample_summary(
        sampling.stratified_sample(ws.transactions(), SAMPLE_NORMAL, chunk_rows=SAMPLE_CHUNK))


# --- quality and cleaning

@query
def column_profile(ws):
    return quality.column_profile(ws.transactions())


@query
def dq_checks(ws):
    return quality.dq_checks(ws.transactions())


@query
def drop_missing_amount(ws):
    return cleaning.drop_missing_amount(ws.transactions()).select("row_id", "amount")


@query
def missing_flags(ws):
    return cleaning.missing_flags(ws.transactions()).select(
        "row_id", "is_missing_amount", "is_missing_orig_balance")


@query
def impute_median(ws):
    rows = cleaning.impute_median(cleaning.drop_missing_amount(ws.transactions()))
    return rows.select("row_id", "oldbalanceOrg", "oldbalanceDest", "newbalanceOrig")


@query
def normalize_category(ws):
    return cleaning.normalize_category(ws.transactions()).select("row_id", "type")


@query
def step_to_timestamp(ws):
    return cleaning.temporal_features(ws.transactions()).select("row_id", "step", "timestamp")


@query
def temporal_features(ws):
    return cleaning.temporal_features(ws.transactions()).select(
        "row_id", "hour_of_day", "day_of_week", "is_weekend", "is_night")


@query
def merchant_predicate(ws):
    return cleaning.vendor_features(ws.transactions()).select("row_id", "vendor_id", "is_merchant_dest")


@query
def balance_inconsistency(ws):
    flag = cleaning.balance_inconsistent("oldbalanceOrg", "amount", "newbalanceOrig")
    return ws.transactions().select("row_id", flag.alias("is_balance_inconsistent"))


@query
def exact_duplicates_raw(ws):
    return cleaning.clean(ws.transactions()).select("row_id", "is_exact_duplicate")


@query
def near_duplicates_clean(ws):
    return cleaning.clean(ws.transactions()).select("row_id", "is_near_duplicate")


@query
def clean_transactions(ws):
    return ws.clean().select("row_id", *CLEAN_COLUMNS)


@query
def clean_transactions_view(ws):
    return cleaning.clean_view(ws.transactions())


@query
def exact_dupe_all_copies(ws):
    return cleaning.clean_view(ws.transactions()).select("row_id", "flag_exact_duplicate")


# --- signals

@query
def exact_duplicates(ws):
    return signals.detect_duplicates(ws.clean()).select("row_id", "flag_exact_duplicate")


@query
def near_duplicates(ws):
    return signals.detect_duplicates(ws.clean()).select("row_id", "flag_near_duplicate")


@query
def flag_duplicate(ws):
    return signals.detect_duplicates(ws.clean()).select(
        "row_id", "flag_exact_duplicate", "flag_near_duplicate", "flag_duplicate")


@query
def category_cutoffs(ws):
    return signals.category_cutoffs(ws.clean()).select(
        "category", "n", F.round("q25", 6).alias("q25"), F.round("q75", 6).alias("q75"),
        F.round("cutoff", 6).alias("cutoff"))


@query
def flag_large_transaction(ws):
    return signals.detect_large_transactions(ws.clean()).select("row_id", "flag_large_transaction")


@query
def active_vendors_semi(ws):
    return signals.active_vendor_rows(ws.clean()).select("row_id", "vendor_id")


@query
def vendor_hour_profile(ws):
    return signals.vendor_hour_profile(ws.clean()).select(
        "vendor_id", "n", F.round("p05", 4).alias("p05"), F.round("p95", 4).alias("p95"))


@query
def vendor_hours_join(ws):
    profile = staged(signals.vendor_hour_profile(ws.clean()), "hours")
    return lookup(ws.clean(), profile, ["vendor_id"], "n").select(
        "row_id", "hour_of_day", F.round("p05", 4).alias("p05"), F.round("p95", 4).alias("p95"))


@query
def flag_unusual_timing(ws):
    return signals.detect_unusual_timing(ws.clean()).select("row_id", "flag_unusual_timing")


@query
def vendor_daily(ws):
    return signals.vendor_daily(ws.clean()).select("vendor_id", "day_bucket", "daily_count", "daily_volume")


@query
def vendor_rolling_baseline(ws):
    return signals.vendor_rolling_baseline(signals.vendor_daily(ws.clean())).select(
        "vendor_id", "day_bucket", "daily_count",
        F.round("rolling_count_mean", 6).alias("rolling_count_mean"),
        F.round("rolling_count_std", 6).alias("rolling_count_std"), "is_vendor_spike_day")


@query
def vendor_spike(ws):
    """The flagged vendor-days."""
    days = signals.vendor_rolling_baseline(signals.vendor_daily(ws.clean()))
    return days.where("is_vendor_spike_day").select("vendor_id", "day_bucket", "daily_count")


@query
def flag_vendor_spike(ws):
    return signals.detect_vendor_spikes(ws.clean()).select("row_id", "flag_vendor_spike")


@query
def velocity(ws):
    return signals.detect_user_velocity(ws.clean()).where("flag_velocity").select("row_id", "nameOrig", "step")


@query
def flag_velocity(ws):
    return signals.detect_user_velocity(ws.clean()).select("row_id", "flag_velocity")


@query
def user_vendor_share(ws):
    return signals.user_vendor_share(ws.clean()).select(
        "nameOrig", "vendor_id", "vendor_amount", F.round("share", 6).alias("share"))


@query
def user_hhi(ws):
    return signals.user_hhi(ws.clean()).select(
        "nameOrig", "txn_count", "total_user_amount", F.round("hhi", 6).alias("hhi"), "concentrated")


@query
def concentration(ws):
    return signals.detect_concentration_hhi(ws.clean()).where("flag_concentration").select(
        "row_id", "nameOrig", F.col("user_hhi"))


@query
def flag_concentration(ws):
    return signals.detect_concentration_hhi(ws.clean()).select("row_id", "user_hhi", "flag_concentration")


@query
def robust_scale_(ws):
    scaled = robust_scale(with_balance_delta(ws.clean()))
    return scaled.select("row_id", *[F.round(f"{c}_scaled", 4).alias(f"{c}_scaled") for c in FEATURES])


@query
def flag_multivariate_outlier(ws):
    return ws.flagged_with_forest().select("row_id", "flag_multivariate_outlier")


@query
def anomaly_score(ws):
    return ws.flagged().select("row_id", "anomaly_score")


@query
def flag_reasons(ws):
    return ws.flagged().select("row_id", "flag_reasons")


@query
def is_flagged(ws):
    return ws.flagged().select("row_id", "is_flagged")


@query
def risk_level(ws):
    return ws.flagged().select("row_id", "risk_level")


@query
def anomaly_pipeline_rules(ws):
    return ws.flagged().select("row_id", *FLAGGED_COLUMNS)


@query
def anomaly_pipeline(ws):
    return ws.flagged_with_forest().select("row_id", *FLAGGED_COLUMNS)


@query
def pipeline_summary_(ws):
    return pipeline_summary(ws.flagged())


@query
def pipeline_summary_with_forest(ws):
    return pipeline_summary(ws.flagged_with_forest())


# --- star schema

@query
def dim_category(ws):
    return ws.tables()["dim_category"]


@query
def dim_vendor(ws):
    return ws.tables()["dim_vendor"].withColumn(
        "avg_transaction_amount", F.round("avg_transaction_amount", 6))


@query
def vendor_names(ws):
    return ws.tables()["dim_vendor"].select("vendor_id", "vendor_name")


@query
def dim_date(ws):
    return ws.tables()["dim_date"]


@query
def fact_transactions(ws):
    return ws.fact()


@query
def transaction_ids(ws):
    return ws.flagged().select("row_id", F.col("row_number"), F.concat(
        F.lit("TXN_"), zero_padded(F.col("row_number"))).alias("transaction_id"))


@query
def star_join_(ws):
    return star_join(ws.tables()).select(
        "transaction_id", "amount", "full_date", "day_name", "category_name", "category_risk_profile",
        "vendor_name", "vendor_risk_tier")


# --- reports

for _name, _text in {
    "suspicious_transactions": views.SUSPICIOUS,
    "vendor_risk_summary": views.VENDOR_RISK,
    "daily_audit_trend": views.DAILY_AUDIT,
    "category_risk_breakdown": views.CATEGORY_RISK,
    "top_suspicious_vendors": views.TOP_VENDORS,
    "daily_trend": views.DAILY_TREND,
    "suspicious_top5": views.SUSPICIOUS_TOP5,
    "vendors_top5": views.VENDORS_TOP5,
    "categories_smoke": views.CATEGORIES,
    "drill_through": views.DRILL_THROUGH,
    "top15_vendors_flagged_value": views.TOP15_VENDORS,
    "duplicate_detail": views.DUPLICATE_DETAIL,
    "outlier_scatter": views.OUTLIER_SCATTER,
    "vendor_scatter": views.VENDOR_SCATTER,
    "hourly_profile": views.HOURLY,
    "risk_distribution": views.RISK_DISTRIBUTION,
    "daily_overlay": views.DAILY_OVERLAY,
    "category_treemap": views.CATEGORY_TREEMAP,
}.items():
    QUERIES[_name] = lambda spark, folder, text=_text: views.report(workspace(spark, folder).tables(), text)


@query
def slicer_filters(ws):
    rows = views.slice_fact(
        ws.tables(), dates=("2024-01-05", "2024-01-25"),
        categories=["Wire & P2P Transfer", "Cash Withdrawal"], risk_levels=["HIGH", "CRITICAL", "MEDIUM"],
        vendor_tiers=["MEDIUM_RISK", "HIGH_RISK", "STANDARD"], vendor_search="a", hours=(0, 20), weekend=False)
    return rows.select("transaction_id", "amount", "category", "risk_level", "hour_of_day")


@query
def saved_weekend_days(ws):
    """Weekend rows of two weeks, from the saved warehouse, whose other days' files are not read."""
    database = "auditloom_slices"
    save_tables(ws.tables(), database, new_path(ws.spark, "warehouse"))
    rows = views.slice_fact(saved_tables(ws.spark, database), dates=("2024-01-08", "2024-01-21"), weekend=True)
    return rows.groupBy("date_key").agg(
        F.count("*").alias("transactions"), F.count_if("is_flagged").alias("flagged"))


@query
def risk_color(ws):
    return ws.fact().select("transaction_id", views.risk_color().alias("risk_color"))


@query
def vendor_risk_status(ws):
    return views.vendor_risk_status(ws.tables()["dim_vendor"])


@query
def kpi_cards(ws):
    return _rounded(measures.measures(ws.fact()))


@query
def measures_by_category(ws):
    return _rounded(measures.measures(ws.fact(), ["category"]))


@query
def measures_by_risk_level(ws):
    return _rounded(measures.measures(ws.fact(), ["risk_level"]))


@query
def measures_by_risk_tier(ws):
    return _rounded(measures.measures(measures.with_vendor_tier(ws.tables()), ["vendor_risk_tier"]))


@query
def measures_in_one_pass(ws):
    """The cards and all three groupings, from one scan of the fact."""
    return _rounded(measures.measures_of_groupings(measures.with_vendor_tier(ws.tables()), {
        "all": [], "category": ["category"], "risk_level": ["risk_level"],
        "vendor_risk_tier": ["vendor_risk_tier"], "category and risk_level": ["category", "risk_level"]}))


# --- the same with the forest's signal

@query
def suspicious_transactions_with_forest(ws):
    return views.report(ws.all_tables(), views.SUSPICIOUS)


@query
def kpi_cards_with_forest(ws):
    return _rounded(measures.measures(ws.all_tables()["fact_transactions"]))


@query
def signal_breakdown_with_forest(ws):
    return evaluation.signal_breakdown(ws.all_tables()["fact_transactions"])


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


# --- evaluation

@query
def signal_breakdown(ws):
    return evaluation.signal_breakdown(ws.fact())


@query
def score_histogram(ws):
    return _rounded(evaluation.score_histogram(ws.fact()))


@query
def hhi_histogram(ws):
    return _rounded(evaluation.hhi_histogram(signals.user_hhi(ws.clean())))


@query
def confusion_matrix(ws):
    return evaluation.confusion_matrix(ws.fact())


@query
def classification_report(ws):
    return _rounded(evaluation.classification_report(ws.fact()))


@query
def honest_confusion_matrix(ws):
    """The confusion matrix of a score that does not see the label."""
    return evaluation.confusion_matrix(evaluation.without_label(ws.flagged()))


@query
def honest_threshold_sweep(ws):
    return evaluation.threshold_sweep(evaluation.without_label(ws.flagged()))


@query
def honest_precision_recall_curve(ws):
    return _rounded(evaluation.precision_recall_curve(evaluation.without_label(ws.flagged())))


@query
def honest_roc_auc(ws):
    return _rounded(evaluation.roc_auc(evaluation.without_label(ws.flagged())))


@query
def honest_score_histogram(ws):
    return _rounded(evaluation.score_histogram(evaluation.without_label(ws.flagged())))


@query
def total_cost(ws):
    return evaluation.total_cost(ws.fact())


@query
def threshold_sweep(ws):
    return evaluation.threshold_sweep(ws.fact())


@query
def precision_recall_curve(ws):
    return _rounded(evaluation.precision_recall_curve(ws.fact()))


@query
def action_tier(ws):
    return evaluation.action_tier(ws.fact())


@query
def roc_auc(ws):
    return _rounded(evaluation.roc_auc(ws.fact()))


@query
def log_zscore(ws):
    return evaluation.log_zscore(ws.clean()).select(
        "row_id", F.round("log_z", 6).alias("log_z"), "flag_log_outlier")
