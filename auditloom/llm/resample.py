"""Importance resampling towards a target distribution of hashed n-grams.

Separators collapse to single spaces, so one overlapped regular expression with lookarounds at word
boundaries gives the span of every n-gram, and the CRC of its bytes names the bucket. The buckets of
all documents and of all target texts are counted whole; a document's weight is the mean log ratio
of its buckets' rates, and the documents with the largest weight plus seeded Gumbel noise are drawn.
"""

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import map_arrow, small_batches, utf8
from auditloom.storage import staged

BUCKETS = 10_000
WORDS = 1             # longest n-gram
SEED = "2024"
LEAST_WORDS = 20      # words of a document that may be drawn
PERCENT = 10          # of the documents that may be drawn

# Words are digits, a-z and everything outside ASCII, so bytes of UTF-8 can be told apart one by one.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_COLLAPSE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def scanners(words=WORDS):
    """A pattern for the n-grams of each length up to ``words``; runs are possessive, so scans are linear."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % n) for n in range(words)]


def collapse(value):
    """A text given as UTF-8 with A-Z lowered and its words joined by single spaces."""
    return b" ".join(value.lower().translate(_COLLAPSE).split())


def features(value, patterns, buckets=BUCKETS):
    """The bucket of each n-gram of a text, repeats included, and its number of words."""
    line = collapse(value)
    found = [np.fromiter((crc32(line[slice(*m.span())]) for m in p.finditer(line, overlapped=True)), np.uint32)
             for p in patterns]
    return (np.concatenate(found) % buckets).astype(np.int32), line.count(b" ") + 1 if line else 0


def scan(rows, carried=(), words=WORDS, buckets=BUCKETS):
    """The ``carried`` columns, n_words and buckets (an array, one entry per n-gram) of each row with a text."""
    kept = list(carried)
    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept)
    patterns = scanners(words)

    def buckets_of(batch):
        for part in small_batches(batch, "text"):
            found = [features(x, patterns, buckets) for x in utf8(part.column("text"))]
            ends = np.cumsum([0, *(len(b) for b, _ in found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([b for b, _ in found])))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], pa.array([n for _, n in found], pa.int64()), lists],
                [*kept, "n_words", "buckets"])

    return map_arrow(rows.select(*kept, "text"), buckets_of, f"{kinds}n_words bigint, buckets array<int>")


def histogram(scanned, buckets=BUCKETS):
    """The number of n-grams in each bucket; a task sums its rows before anything is shuffled."""
    def count(stream):
        total = np.zeros(buckets, np.int64)
        for batch in stream:
            total += np.bincount(batch.column("buckets").flatten().to_numpy(), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    rows = scanned.select("buckets").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for r in rows.collect():
        total[r.bucket] = r.n
    return total


def gains(source, target):
    """floor(1000 ln) of the ratio of smoothed rates of each bucket."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(scanned, gain):
    """row, doc_id, n_words, n_features and weight, the floored mean gain, of scanned rows."""
    def weights(batch):
        lists = batch.column("buckets")
        ends = lists.offsets.to_numpy().astype(np.int64)
        total = np.concatenate([[0], np.cumsum(gain[lists.values.to_numpy()])])
        n = np.diff(ends)
        mean = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(n, 1)
        kept = ("row", "doc_id", "n_words")
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array(n), pa.array(mean)], [*kept, "n_features", "weight"])

    return map_arrow(
        scanned.select("row", "doc_id", "n_words", "buckets"), weights,
        "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id, seed=SEED):
    """floor(1000 Gumbel) from the first 8 hex digits of sha256(seed:doc_id); a missing id is empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def rank_largest(rows, wanted, may):
    """Add ``rank`` (from 1) to the ``wanted`` rows with the largest ``score`` among those that ``may``; others get null.

    Scores are whole numbers of a narrow range, so a histogram of them, one row per score, finds the
    least score drawn. Only the rows from there up are sorted, over ranges of score, doc_id and row, so
    no task holds a score, and ranks are places in the range plus the rows of earlier ranges.
    """
    cells = rows.where(may).groupBy("score").agg(F.count("*").alias("n")).collect()
    least, left = None, wanted
    for r in sorted(cells, key=lambda r: -r.score):
        if left <= 0:
            break
        least, left = r.score, left - r.n
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.lit(None).cast("bigint")
    if least is None:
        return rows.select(*columns, rank.alias("rank"))
    near = F.coalesce(may & (F.col("score") >= least), F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    drawn = rows.where(near).repartitionByRange(*order).sortWithinPartitions(*order).select(
        *columns, F.spark_partition_id().alias("shard"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    drawn = staged(drawn, "drawn")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = drawn.groupBy("shard").agg(F.count("*").alias("n")).select(   # one row per range
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("place") + 1
    drawn = drawn.join(starts, "shard").select(*columns, F.when(place <= wanted, place).alias("rank"))
    return rows.where(~near).select(*columns, rank.alias("rank")).unionByName(drawn)


def resample(docs, targets, words=WORDS, buckets=BUCKETS, seed=SEED, least_words=LEAST_WORDS, percent=PERCENT):
    """doc_id, n_features, weight, score and rank (null if not drawn) for each row of ``docs`` (doc_id, text).

    ``targets`` holds the texts whose distribution is wanted. Missing texts are empty: they have no
    features and weight 0. Repeated rows count and rank one by one (equal scores and ids in order of
    place), missing ids come last among equal scores. With an empty target table gains only even
    out the documents' own buckets; an empty document table gives no rows. Further columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    scanned = staged(scan(rows, ["row", "doc_id"], words, buckets), "buckets")
    target = histogram(scan(targets.select(F.col("text").cast("string").alias("text")), (), words, buckets), buckets)
    gain = gains(histogram(scanned, buckets), target)
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    rows = staged(weigh(scanned, gain).withColumn("score", score), "weights")
    may = F.col("n_words") >= least_words
    return rank_largest(rows, percent * rows.where(may).count() // 100, may)
