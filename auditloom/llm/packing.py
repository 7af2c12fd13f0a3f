"""Length buckets with the least padding, and batches of a token budget inside each bucket.

Documents longer than ``max_tokens`` are cut into pieces, so the histogram of lengths has at most
that many cells whatever the number of documents. Dynamic programming over it finds the bucket
boundaries with the least total padding. Pieces get their rank inside the bucket from ranks in
hashed shards and the sizes of earlier shards, so no task holds a bucket.
"""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.token_output import count_tokens
from auditloom.storage import staged

MAX_TOKENS = 2_048
BUCKETS = 16
BATCH_TOKENS = 65_536
SHARD_ROWS = 50_000     # pieces of a shard, on average
SEED = "pack-1"


def best_boundaries(lengths, counts, buckets):
    """Boundaries (largest lengths of at most ``buckets`` buckets) with the least total padding.

    ``lengths`` ascend, ``counts`` are their frequencies. The padded size of a bucket is its
    boundary times its pieces; the total of lengths does not depend on the boundaries.
    """
    values = np.asarray(lengths, np.int64)
    if not len(values):
        return []
    total = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])
    m = len(values)
    cost = values * total[1:]
    choice = []
    for _ in range(1, min(buckets, m)):
        step = np.empty(m, np.int64)
        best = np.empty(m, np.int64)
        for j in range(m):
            # the bucket that ends with length j begins after length i - 1
            padded = np.concatenate([[0], cost[:j]]) + values[j] * (total[j + 1] - total[:j + 1])
            best[j] = np.argmin(padded)
            step[j] = padded[best[j]]
        choice.append(best)
        cost = step
    found, j = [], m - 1
    for best in reversed(choice):
        found.append(int(values[j]))
        j = int(best[j]) - 1
        if j < 0:
            return found[::-1]
    return [int(values[j]), *found[::-1]]


def pieces(lengths, max_tokens=MAX_TOKENS):
    """Cut rows of (doc_id, n_tokens) into pieces: doc_id, piece from 0, first token, n_tokens."""
    n = F.col("n_tokens")
    last = F.greatest(F.ceil(n / max_tokens), F.lit(1)) - 1
    rows = lengths.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
    first = F.col("piece") * max_tokens
    return rows.select(
        *[c for c in lengths.columns if c != "n_tokens"], "piece", first.alias("first_token"),
        F.least(n - first, F.lit(max_tokens)).cast("bigint").alias("n_tokens"))


def pack(lengths, max_tokens=MAX_TOKENS, buckets=BUCKETS, batch_tokens=BATCH_TOKENS, shard_rows=SHARD_ROWS):
    """Batches for rows of (doc_id, n_tokens); further columns are ignored.

    Returns doc_id, piece, first_token, n_tokens, bucket, padded_tokens (the bucket's boundary) and
    batch (from 0 inside the bucket). A batch pads its pieces to the boundary and holds as many as
    fit ``batch_tokens``, one at least; only the last batch of a bucket may hold fewer. Every
    token is in one piece. Rows without a length count as empty, and an empty document is a piece
    of 0 tokens; repeated rows are packed one by one. The order inside a bucket is a hash of the
    document, taken from ``key`` if there is such a column, else from doc_id and n_tokens, so the members
    of a batch do not depend on the file layout. Only rows whose key occurs more than ``shard_rows``
    times are spread by their place, too, as such a group may hold a third of all rows. An empty table
    gives no rows.
    """
    spark = lengths.sparkSession
    tokens = F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(0))
    key = F.col("key") if "key" in lengths.columns else F.xxhash64("doc_id", tokens)
    rows = lengths.select(F.col("doc_id"), tokens.alias("n_tokens"), key.cast("bigint").alias("key"),
                          F.monotonically_increasing_id().alias("row"))
    frequent = staged(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows).select(
        "key", F.lit(True).alias("hot")), "frequent")
    rows = rows.join(frequent, "key", "left").withColumn("row", F.when(F.col("hot"), F.col("row")).otherwise(0)).drop("hot")
    parts = staged(pieces(rows, max_tokens), "pieces")
    histogram = parts.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").collect()
    bounds = best_boundaries([r.n_tokens for r in histogram], [r.n for r in histogram], buckets)
    total = sum(r.n for r in histogram)
    shards = max(math.ceil(total / shard_rows), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    limits = F.array(*[F.lit(b).cast("bigint") for b in bounds or [0]])
    order = F.xxhash64(F.lit(SEED), "key", "row", "piece")
    rows = parts.withColumns({
        "bucket": F.size(F.filter(limits, lambda b: b < F.col("n_tokens"))),
        "order": order, "shard": F.pmod(order, F.lit(shards))})
    rows = rows.withColumn("padded_tokens", F.element_at(limits, F.col("bucket") + 1))
    sizes = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("order", "key", "row", "piece", "doc_id", "n_tokens"))
    room = F.greatest(F.floor(F.lit(batch_tokens) / F.greatest("padded_tokens", F.lit(1))), F.lit(1))
    return rows.withColumn("place", place).join(starts, ["bucket", "shard"]).select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket", "padded_tokens",
        F.floor((F.col("start") + F.col("place") - 1) / room).alias("batch"))


def token_lengths(docs, tokenizer_path):
    """doc_id, n_tokens (with the end id) and key, a hash of both columns, of each row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return count_tokens(rows.withColumn("key", F.xxhash64("doc_id", "text")), tokenizer_path)


def pack_documents(docs, tokenizer_path, **options):
    """Tokenise rows of (doc_id, text) and pack them; a missing text is an empty one."""
    return pack(staged(token_lengths(docs, tokenizer_path), "lengths"), **options)
