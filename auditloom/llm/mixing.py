"""Mix sources to target weights by Poisson replication.

A source's repetition rate is its share of the target size over the documents it has. Each
document gets a uniform number from a seeded hash of its id, and its number of copies is the
inverse of the Poisson distribution with that rate. So copies do not depend on order, layout or
other documents, and no source is gathered anywhere.
"""

from pyspark.sql import functions as F

from auditloom.storage import staged

EXPONENT = 0.5     # without weights, a source's weight is its document count to this power
SEED = "mix-1"
TAIL = 12.0        # standard deviations of the distribution that are tabulated


def source_rates(docs, weights=None, size=None, exponent=EXPONENT):
    """(source, rate, cumulative) for each source of ``docs``; missing sources are one source.

    ``weights`` has (source, weight), one row per source; a source without a row, or with a weight
    that is missing or not above zero, gets rate 0. ``size`` is the expected number of rows of the
    mixture (default: that of ``docs``). ``cumulative`` holds the probabilities of at most k copies.
    """
    counts = staged(docs.groupBy("source").agg(F.count("*").alias("n")), "sources")
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n"), F.lit(float(exponent))))
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
        counts = counts.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        counts = counts.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0))
    total = counts.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    wanted = float(total.n or 0) if size is None else float(size)
    rate = F.lit(wanted) * F.col("weight") / F.lit(total.w or 1.0) / F.col("n")
    rows = counts.withColumn("rate", rate)
    # logarithms of the probabilities of 0, 1, 2, ... copies, each from the one before
    rate, most = F.col("rate"), F.ceil(F.col("rate") + TAIL * F.sqrt("rate") + 30).cast("int")
    chance = F.aggregate(
        F.sequence(F.lit(0), most),
        F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("all")),
        lambda acc, k: F.struct(
            (_log := F.when(k == 0, -rate).otherwise(acc["log"] + F.log(rate) - F.log(k))).alias("log"),
            (acc["sum"] + F.exp(_log)).alias("sum"),
            F.concat(acc["all"], F.array(acc["sum"] + F.exp(_log))).alias("all")))["all"]
    cumulative = F.when(rate > 0, chance).otherwise(F.array(F.lit(1.0)))
    return rows.select("source", "rate", cumulative.alias("cumulative"))


def document_key(doc_id, text):
    """What the hashes see of a document: its id, or where it has none a digest of its text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def _hash(*parts):
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def mix(docs, weights=None, size=None, exponent=EXPONENT, seed=SEED):
    """Replicate rows of ``docs`` (doc_id, text, source, any others) and shuffle them globally.

    Returns the row as the struct ``doc``, ``copy`` (from 0) and ``shuffle_key``, whose order is the
    order of the files written. A document drawn zero times is out, as the method has it. Rows
    with one id, or without an id and with one text, get the same number of copies. The table of
    rates is staged, so Spark broadcasts it only if its files are small, and splits a hot source
    otherwise. An empty table gives no rows.
    """
    rates = staged(source_rates(docs, weights, size, exponent), "rates").withColumnRenamed("source", "_source")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("source").alias("_from"),
        document_key(F.col("doc_id"), F.col("text")).alias("key"), F.monotonically_increasing_id().alias("row"))
    rows = rows.join(rates, F.col("_from").eqNullSafe(F.col("_source")))
    digits = F.substring(_hash(F.lit(seed), F.col("key")), 1, 13)
    uniform = F.conv(digits, 16, 10).cast("double") / float(1 << 52)
    copies = F.size(F.filter("cumulative", lambda c: c <= uniform))
    rows = rows.withColumn("n", copies).where("n > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.withColumn("shuffle_key", _hash(F.lit(seed), F.lit("order"), F.col("key"), F.col("copy").cast("string")))
    rows = rows.select("doc", "copy", "shuffle_key", "row").repartitionByRange("shuffle_key", "row")
    return rows.sortWithinPartitions("shuffle_key", "row").select("doc", "copy", "shuffle_key")
