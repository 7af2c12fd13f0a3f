"""Evaluation against the fraud label, and score distributions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.functions.columns import money_sum, ratio, tiered
from auditloom.operators.ordering import running_start
from auditloom.operators.scoring import score
from auditloom.operators.skew import lookup
from auditloom.schema import ACTION_TIERS, SIGNALS
from auditloom.storage import staged

LABEL = "is_fraud_ground_truth"


def signal_breakdown(fact):
    """Number of incidents per signal."""
    counts = fact.agg(*[F.count_if(c).alias(c) for c in SIGNALS])
    rows = F.array(*[
        F.struct(F.lit(c).alias("signal"), F.col(c).alias("incidents")) for c in SIGNALS])
    return counts.select(F.inline(rows)).orderBy(F.desc("incidents"), "signal")


def histogram(df, value, bins, by=()):
    """Equal-width bins between the smallest and the largest value, per group of ``by``.

    The values are counted once, with map-side combine; bounds and bins are both found from these
    counts, so ``df`` is computed once.
    """
    counts = staged(df.where(F.col(value).isNotNull()).groupBy(value, *by).agg(F.count("*").alias("_n")), "counts")
    bounds = counts.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).first()
    low, high = bounds["lo"], bounds["hi"]
    if low is None:
        low = high = 0.0
    if high == low:
        high = low + 1.0
    width = (high - low) / bins
    place = F.floor((F.col(value).cast("double") - F.lit(low)) / F.lit(width)).cast("bigint")
    return (
        counts.groupBy(F.least(place, F.lit(bins - 1).cast("bigint")).alias("bin"), *by)
        .agg(F.sum("_n").alias("transactions"))
        .withColumn("bin_start", F.lit(low) + F.col("bin") * F.lit(width))
    )


def score_histogram(fact):
    return histogram(fact, "anomaly_score", 30, ["risk_level"])


def hhi_histogram(users, bins=20):
    return histogram(users, "hhi", bins).withColumnRenamed("transactions", "users")


def without_label(flagged):
    """Flagged rows scored anew without the fraud label, for an evaluation that does not measure the label itself.

    They have the columns of the fact that the evaluations read.
    """
    blind = flagged.drop("anomaly_score", "flag_reasons", "is_flagged", "risk_level")
    return score(blind, use_label=False).withColumnRenamed("isFraud", LABEL)


def _truth():
    return F.coalesce(F.col(LABEL) == 1, F.lit(False))


def confusion_matrix(fact):
    """The four cells, zeros included."""
    truth, flagged = _truth(), F.col("is_flagged")
    cells = [
        ("Actual Clean", "Predicted Clean", ~truth & ~flagged),
        ("Actual Clean", "Predicted Flagged", ~truth & flagged),
        ("Actual Fraud", "Predicted Clean", truth & ~flagged),
        ("Actual Fraud", "Predicted Flagged", truth & flagged),
    ]
    counts = fact.agg(*[F.count_if(c).alias(f"c{i}") for i, (_, _, c) in enumerate(cells)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{i}").alias("transactions"))
        for i, (a, p, _) in enumerate(cells)])
    return counts.select(F.inline(rows))


def classification_report(fact):
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages."""
    truth, flagged = _truth(), F.col("is_flagged")
    n = fact.agg(
        F.count_if(~truth & ~flagged).cast("double").alias("tn"),
        F.count_if(~truth & flagged).cast("double").alias("fp"),
        F.count_if(truth & ~flagged).cast("double").alias("fn"),
        F.count_if(truth & flagged).cast("double").alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def scores(hit, wrong, missed):
        return ratio(hit, hit + wrong), ratio(hit, hit + missed), ratio(2 * hit, 2 * hit + wrong + missed)

    normal, fraud = scores(tn, fn, fp), scores(tp, fp, fn)
    clean_rows, fraud_rows, rows = tn + fp, tp + fn, tn + fp + fn + tp
    accuracy = ratio(tn + tp, rows)
    lines = [
        ("Normal", *normal, clean_rows),
        ("Fraud / Anomaly", *fraud, fraud_rows),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), accuracy, rows),
        ("macro avg", *[(a + b) / 2 for a, b in zip(normal, fraud)], rows),
        ("weighted avg", *[
            ratio(a * clean_rows + b * fraud_rows, rows) for a, b in zip(normal, fraud)], rows),
    ]
    return n.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
            f.alias("f1_score"), s.cast("bigint").alias("support"))
        for name, p, r, f, s in lines])))


def total_cost(fact, review_cost=25.0, chargeback_fee=0.0, penalty=0.0, churn_cost=0.0):
    """Loss of missed frauds plus the cost of false alarms."""
    truth, flagged = _truth(), F.col("is_flagged")
    missed = truth & ~flagged
    return fact.agg(
        F.count_if(missed).alias("false_negatives"),
        F.count_if(~truth & flagged).alias("false_positives"),
        F.coalesce(money_sum(F.when(missed, F.col("amount"))), F.lit(0.0)).alias("missed_amount"),
    ).select(
        "*",
        (F.col("missed_amount") + F.col("false_negatives") * F.lit(chargeback_fee + penalty)).alias("cost_fn"),
        (F.col("false_positives") * F.lit(review_cost + churn_cost)).alias("cost_fp"),
    ).withColumn("total_cost", F.col("cost_fn") + F.col("cost_fp"))


def threshold_sweep(fact, review_cost=25.0, fee=0.0):
    """Confusion counts and cost if everything from a score upwards were flagged, for 0..100."""
    truth = _truth()
    scores = fact.groupBy("anomaly_score").agg(
        F.count_if(truth).alias("fraud"), F.count_if(~truth).alias("clean"),
        F.sum(F.when(truth, F.col("amount").cast("decimal(18,2)")).otherwise(0)).alias("fraud_value"))
    cutoffs = fact.sparkSession.range(101).select(F.col("id").cast("int").alias("anomaly_score"))
    # 101 rows at most from here on
    above = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy("threshold").rowsBetween(Window.unboundedPreceding, -1)

    def filled(c):
        return F.coalesce(F.col(c), F.lit(0))

    return (
        cutoffs.join(scores, "anomaly_score", "left").withColumnRenamed("anomaly_score", "threshold")
        .select(
            "threshold",
            F.sum(filled("fraud")).over(above).alias("true_positives"),
            F.sum(filled("clean")).over(above).alias("false_positives"),
            F.coalesce(F.sum(filled("fraud")).over(below), F.lit(0)).alias("false_negatives"),
            F.coalesce(F.sum(filled("fraud_value")).over(below), F.lit(0)).cast("double").alias("missed_value"))
        .withColumn(
            "total_cost", F.col("missed_value") + F.col("false_negatives") * F.lit(fee)
            + F.col("false_positives") * F.lit(review_cost))
        .drop("missed_value")
    )


def action_tier(fact):
    """Transactions per review action."""
    return (
        fact.groupBy(tiered(F.col("anomaly_score"), ACTION_TIERS, "Auto-Approve").alias("action"))
        .agg(F.count("*").alias("transactions"), money_sum(F.col("amount")).alias("value"))
    )


def roc_auc(fact, by="anomaly_score"):
    """Area under the ROC curve of any score; ties count half."""
    truth = _truth()
    scores = staged(fact.groupBy(F.col(by).alias("score")).agg(
        F.count_if(truth).alias("fraud"), F.count_if(~truth).alias("clean")), "scores")
    won = F.col("fraud") * (F.col("_below") + F.col("clean") / 2)
    sums = running_start(scores, ["score"], "clean", "_below").withColumn("won", won).agg(
        F.sum("won").alias("won"), F.sum("fraud").alias("fraud"), F.sum("clean").alias("clean"))
    pairs = F.col("fraud").cast("double") * F.col("clean")
    return sums.select(F.try_divide("won", pairs).alias("roc_auc"), "fraud", "clean")


def precision_recall_curve(fact):
    """Precision and recall at every cutoff of the score."""
    sweep = threshold_sweep(fact)
    flagged = F.col("true_positives") + F.col("false_positives")
    return sweep.select(
        "threshold", ratio(F.col("true_positives"), flagged).alias("precision"),
        ratio(F.col("true_positives"), F.col("true_positives") + F.col("false_negatives")).alias("recall"))


def log_zscore(df, category_col="category", limit=3.0):
    """Mark amounts whose logarithm lies far above the mean of the category."""
    rows = df.where(F.col("amount") > 0).withColumn("_log", F.ln("amount"))
    spread = rows.where(F.col(category_col).isNotNull()).groupBy(category_col).agg(
        F.count("*").alias("_n"), F.avg("_log").alias("log_mean"), F.stddev_samp("_log").alias("log_std"))
    rows = lookup(rows, staged(spread, "logs"), [category_col], "_n")
    z = F.try_divide(F.col("_log") - F.col("log_mean"), F.col("log_std"))
    return rows.withColumn("log_z", z).withColumn("flag_log_outlier", F.coalesce(z > limit, F.lit(False))).drop(
        "_log", "log_mean", "log_std")
