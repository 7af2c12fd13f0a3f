"""Composite score, reasons, decision and tier."""

from pyspark.sql import functions as F

from auditloom.functions.columns import tiered
from auditloom.schema import FLAG_SCORE, MAX_SCORE, RISK_LEVELS, SCORE_RULES


def _mark(column):
    """A signal as a boolean; a missing label or flag counts as not set."""
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def score(df, use_label=True):
    """Add anomaly_score, flag_reasons, is_flagged and risk_level.

    Signals whose column is absent are skipped. ``use_label=False`` leaves the fraud label
    out of score and decision, for an evaluation against that label.
    """
    rules = [r for r in SCORE_RULES if r[0] in df.columns and (use_label or r[0] != "isFraud")]
    total = F.lit(0)
    for column, weight, _ in rules:
        total = total + F.when(_mark(column), weight).otherwise(0)
    reasons = F.concat_ws("; ", *[F.when(_mark(column), text) for column, _, text in rules])
    flagged = F.col("anomaly_score") >= FLAG_SCORE
    for column in ("flag_duplicate", "isFraud"):
        if column in [r[0] for r in rules]:
            flagged = flagged | _mark(column)
    return (
        df.withColumn("anomaly_score", F.least(total, F.lit(MAX_SCORE)))
        .withColumn("flag_reasons", reasons)
        .withColumn("is_flagged", flagged)
        .withColumn("risk_level", tiered(F.col("anomaly_score"), RISK_LEVELS, "LOW"))
    )
