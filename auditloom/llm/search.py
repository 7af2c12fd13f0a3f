"""Ranked lexical search over posting lists in geometric blocks with coordinatewise-maximum summaries.

Documents are indexed in shards of bounded size, as they lie in the table. Inside a shard the posting
list of each term is clustered by document similarity (nearest of some of its documents, in a random
projection), and each cluster is a block with the largest impact of every term in it. Terms are
ordered from rare to common, and a block's summary holds the terms from its own on: a document
that also has a rarer term of the query is found in that term's list. A block is skipped only if the
sum over its summary, which no document in it exceeds, is less than a score that ``k`` documents reach.

All scores are whole numbers, so bounds and results are exact.
"""

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import let_workers_import, map_arrow, small_batches, utf8
from auditloom.storage import new_path, staged

K = 20
QUERY_BYTES = 16 << 20       # text of the items that are searched at once
SHARD_DOCS = 1_024           # documents of a shard at most,
SHARD_ENTRIES = 8_000_000    # and entries of its summaries before the maxima are taken,
CHUNK_ENTRIES = 500_000      # of which so many, or one block's, are in memory at once
BLOCK_DOCS = 32              # documents of a block, on average, in lists longer than that
DIMENSIONS = 16              # of the projection that says which documents are similar
LEAD = 16                    # one shard in so many gives the first bounds
SCALE, TF, LENGTH = 1_000_000_000, 1_000, 12     # fixed values of the score
SEED = 12

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_SPLIT = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))

FORWARD = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
_ARRAYS = ("ends", "terms", "impacts", "block_term", "block_ends", "block_docs", "summary_ends", "summary_terms", "summary_max")
SHARD = "doc_ids array<bigint>, sizes array<bigint>, data binary, lead boolean"     # data: all arrays, compressed
FOUND = "item bigint, doc_id bigint, score bigint"


def terms(value):
    """The terms of a text given as UTF-8, with A-Z lowered."""
    return value.lower().translate(_SPLIT).split()


def _ranges(starts, ends):
    """All whole numbers of the ranges, one range after the other."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


def _offsets(sizes):
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def forward(docs, vocabulary):
    """doc_id, the number of terms, and number and count of each term of ``vocabulary`` (a list) in each document."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def count(batch):
        for part in small_batches(batch, "text"):
            sizes, found = [], []
            for value in utf8(part.column("text")):
                words = terms(value)
                ids = np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words))
                sizes.append(len(words))
                found.append(np.unique(ids[ids >= 0], return_counts=True))
            ends = pa.array(_offsets([len(t) for t, _ in found]))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int32))) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, count, FORWARD)


def _blocks(rows, columns, sketch, block_docs):
    """Cluster the posting lists: for postings in order of (term, document), the number of each one's block."""
    order = np.argsort(columns, kind="stable")
    lists = np.flatnonzero(np.diff(columns[order], prepend=-1))
    ends = np.append(lists[1:], len(order))
    group = np.zeros(len(order), np.int64)
    for a, b in zip(lists.tolist(), ends.tolist()):
        if b - a > block_docs:
            near = sketch[rows[order[a:b]]]
            group[a:b] = np.argmax(near @ near[::block_docs].T, axis=1)
    at = np.lexsort((group, columns[order]))
    order, group = order[at], group[at]
    return order, np.cumsum((np.diff(columns[order], prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0)) - 1


def _summaries(order, block, columns, impacts, stops, block_ends):
    """(block, term) pairs, ascending, with the largest impact, for blocks of several documents, from each one's term on.

    A posting gives an entry for itself and for each later one of its document. Entries of some blocks
    at a time are sorted as one number each, of which the impact, always below ``SCALE // TF``, is the end.
    """
    many = np.flatnonzero(np.diff(block_ends)[block] > 1)
    sizes = stops[many] - order[many]
    blocks, terms_, most = [], [], []
    total = np.cumsum(sizes)
    a = 0
    while a < len(many):
        b = max(int(np.searchsorted(total, (total[a - 1] if a else 0) + CHUNK_ENTRIES, "right")), a + 1)
        while b < len(many) and block[many[b]] == block[many[b - 1]]:    # blocks stay whole
            b += 1
        at = _ranges(order[many[a:b]], stops[many[a:b]])
        key = np.repeat(block[many[a:b]] - block[many[a]], sizes[a:b]) << 44 | columns[at] << 20 | impacts[at]
        key.sort()
        key = key[np.flatnonzero(np.diff(key >> 20, append=-1))]
        blocks.append((key >> 44) + block[many[a]])
        terms_.append(key >> 20 & (1 << 24) - 1)
        most.append(key & (1 << 20) - 1)
        a = b
    join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return (join(blocks), join(terms_)), join(most)


def build_shard(ids, sizes, columns, impacts, projection, block_docs=BLOCK_DOCS):
    """The arrays of a shard, from the numbers of postings of its documents and the postings, by document and term."""
    ends = _offsets(sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    sketch = np.zeros((len(sizes), projection.shape[1]), np.float32)
    held = np.flatnonzero(sizes)
    sketch[held] = np.add.reduceat(projection[columns] * impacts[:, None].astype(np.float32), ends[held], axis=0)
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    order, block = _blocks(rows, columns, sketch, block_docs)
    first = np.flatnonzero(np.diff(block, prepend=-1))
    block_ends = _offsets(np.diff(np.append(first, len(block))))

    heads, most = _summaries(order, block, columns, impacts, ends[rows[order] + 1].astype(np.int64), block_ends)
    summary = np.bincount(heads[0], minlength=len(first))
    arrays = [ends, columns, impacts, columns[order[first]], block_ends, rows[order], _offsets(summary), heads[1], most]
    data = pa.compress(b"".join([a.astype("<i4").tobytes() for a in arrays]), codec="zstd", asbytes=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(pa.int64())), pa.array([[len(a) for a in arrays]], pa.list_(pa.int64())),
         pa.array([data], pa.binary())], ["doc_ids", "sizes", "data"])


class Index:
    """An index of documents for the terms of a vocabulary: its folder, the terms' places from rare to common, and weights."""

    def __init__(self, path, places, weights):
        self.path, self.places, self.weights = path, places, weights

    def shards(self, spark, lead=False):
        rows = spark.read.schema(SHARD).parquet(self.path)
        return (rows.where("lead") if lead else rows).drop("lead")


def build_index(docs, vocabulary, path=None, shard_docs=SHARD_DOCS, shard_entries=SHARD_ENTRIES, block_docs=BLOCK_DOCS):
    """Index all of ``docs`` (doc_id, text) for the terms of ``vocabulary`` (a list of UTF-8 terms, which the driver holds)."""
    path = path or new_path(docs.sparkSession, "index")
    rows = staged(forward(docs, vocabulary), "forward")
    n_docs, length = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():   # a row per term
        df[r.term] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * x + 1))) for x in df.tolist()], np.int64)
    order = np.argsort(-weights, kind="stable")
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))

    def shards(stream):
        projection = np.random.default_rng(SEED).standard_normal((len(places), DIMENSIONS)).astype(np.float32)
        projection *= weights[order][:, None]
        pending, docs_held, entries, done = [], 0, 0, 0

        def flush():
            ids, sizes, columns, impacts = zip(*pending)
            made = build_shard([i for part in ids for i in part], *[np.concatenate(x) for x in (sizes, columns, impacts)],
                               projection, block_docs)
            return made.append_column("lead", pa.array([done % LEAD == 0]))

        for batch in stream:
            n = batch.column("n").to_numpy()
            m = 75 + (25 * n * n_docs) // max(length, 1)
            lists, counts = batch.column("terms"), batch.column("tfs")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sizes = np.diff(ends)
            columns = places[lists.flatten().to_numpy()]
            tf = counts.flatten().to_numpy().astype(np.int64)
            ends -= ends[0]
            rows_of = np.repeat(np.arange(len(n)), sizes)
            by = np.lexsort((columns, rows_of))
            columns, tf = columns[by], tf[by]
            impacts = (SCALE * tf) // (TF * tf + LENGTH * m[rows_of])
            doc_ids = batch.column("doc_id").to_pylist()
            cost = np.cumsum(sizes * (sizes + 1) // 2)
            a = 0
            while a < len(n):    # as many documents as the shard still takes, one at least if it is empty
                room = np.searchsorted(cost, (cost[a - 1] if a else 0) + shard_entries - entries, "right")
                b = min(max(int(room), a + (not docs_held)), a + shard_docs - docs_held, len(n))
                if b > a:
                    pending.append((doc_ids[a:b], sizes[a:b], columns[ends[a]:ends[b]], impacts[ends[a]:ends[b]]))
                    docs_held += b - a
                    entries += int(cost[b - 1] - (cost[a - 1] if a else 0))
                    a = b
                if a < len(n):
                    yield flush()
                    pending, docs_held, entries, done = [], 0, 0, done + 1
        if pending:
            yield flush()

    let_workers_import(docs.sparkSession)
    # a shard is a row of some megabytes, so row groups are checked and kept small
    (rows.where(F.size("terms") > 0).mapInArrow(shards, SHARD).write.option("compression", "none")
        .option("parquet.block.size", 16 << 20).option("parquet.block.size.row.check.min", 1)
        .option("parquet.page.size.row.check.min", 1).parquet(path))
    return Index(path, dict(zip(vocabulary, places.tolist())), weights[order])


class _Query:
    """An item's terms from rare to common, its best documents so far, and the least score worth having."""

    def __init__(self, item, counts, floor, weights, k):
        self.item, self.k, self.floor = item, k, max(floor, 1)
        self.terms = np.array(sorted(counts), np.int64)
        self.values = np.array([counts[t] for t in sorted(counts)], np.int64) * weights[self.terms]
        self.best = []

    def offer(self, scores, ids):
        keep = np.flatnonzero(scores >= self.floor)
        if len(keep):
            self.best += [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in keep]
            self.best = sorted(self.best)[:self.k]
            if len(self.best) == self.k:
                self.floor = max(self.floor, -self.best[-1][0])


class _Shard:
    def __init__(self, row):
        self.ids = row["doc_ids"]
        data = np.frombuffer(pa.decompress(row["data"], 4 * sum(row["sizes"]), codec="zstd"), "<i4")
        for name, part in zip(_ARRAYS, np.split(data, np.cumsum(row["sizes"])[:-1])):
            setattr(self, name, part)
        self.scored = self.visited = self.skipped = 0
        self.most = {}
        columns = np.argsort(self.terms, kind="stable")
        heads = np.flatnonzero(np.diff(self.terms[columns], prepend=-1))
        self.listed = self.terms[columns[heads]]
        self.most = np.maximum.reduceat(self.impacts[columns], heads)

    def search(self, query, dense):
        """Offer the query every document that its floor lets pass; ``dense`` holds zeros, one per term."""
        at = np.minimum(np.searchsorted(self.listed, query.terms), len(self.listed) - 1)
        here = self.listed[at] == query.terms
        columns, values = query.terms[here], query.values[here]
        # no document that only has terms from here on can reach more than this
        rest = np.cumsum((values * self.most[at[here]])[::-1])[::-1]
        columns = columns[rest >= query.floor]
        if not len(columns):
            return
        dense[query.terms] = query.values
        low, high = (np.searchsorted(self.block_term, columns, side) for side in ("left", "right"))
        blocks = _ranges(low, high)
        starts, ends = self.summary_ends[blocks].astype(np.int64), self.summary_ends[blocks + 1].astype(np.int64)
        entries = _ranges(starts, ends)
        several = np.flatnonzero(ends > starts)
        bound = np.full(len(blocks), np.iinfo(np.int64).max)    # a single document is its own summary: it is scored
        if len(several):
            sums = dense[self.summary_terms[entries]] * self.summary_max[entries]
            bound[several] = np.add.reduceat(sums, (np.cumsum(ends - starts) - (ends - starts))[several])
        kept = blocks[bound >= query.floor]
        docs = np.unique(self.block_docs[_ranges(self.block_ends[kept].astype(np.int64), self.block_ends[kept + 1].astype(np.int64))])
        self.visited, self.skipped, self.scored = self.visited + len(kept), self.skipped + len(blocks) - len(kept), self.scored + len(docs)
        if len(docs):
            starts, ends = self.ends[docs].astype(np.int64), self.ends[docs + 1].astype(np.int64)
            postings = _ranges(starts, ends)
            scores = np.add.reduceat(dense[self.terms[postings]] * self.impacts[postings], np.cumsum(ends - starts) - (ends - starts))
            query.offer(scores, [self.ids[d] for d in docs.tolist()])
        dense[query.terms] = 0


def find(shards, queries, weights, k, floors=None):
    """The best documents of each task's shards for ``queries``, (item, counts by place) pairs."""
    floors = floors or {}

    def batches(stream):
        asked = [_Query(item, counts, floors.get(item, 1), weights, k) for item, counts in queries]
        dense = np.zeros(len(weights), np.int64)
        for batch in stream:
            for i in range(batch.num_rows):
                shard = _Shard({c: batch.column(c)[i].as_py() for c in ("doc_ids", "sizes", "data")})
                for query in asked:
                    shard.search(query, dense)
        found = [(q.item, None if missing else i, -score) for q in asked for score, missing, i in q.best]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["item", "doc_id", "score"])

    let_workers_import(shards.sparkSession)
    return shards.mapInArrow(batches, FOUND)


def _best(found, k):
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(first).cast("int")).where(F.col("rank") <= k)


def query_index(spark, index, queries, k=K):
    """item, rank, doc_id and score of the ``k`` best documents of each of ``queries``, (item, terms) pairs.

    One shard in ``LEAD`` is searched first; the k-th best score in it is reached by k documents, so it
    bounds the search of all shards from the start.
    """
    asked = []
    for item, words in queries:
        counts = {}
        for word in words:
            if (place := index.places.get(word)) is not None:
                counts[place] = counts.get(place, 0) + 1
        asked.append((item, counts))
    lead = _best(find(index.shards(spark, lead=True), asked, index.weights, k), k).where(F.col("rank") == k)
    floors = {r["item"]: r.score for r in lead.select("item", "score").collect()}     # a row per query
    return _best(find(index.shards(spark), asked, index.weights, k, floors), k)


def search(docs, items, k=K, query_bytes=QUERY_BYTES, **options):
    """item_id, rank, doc_id and score of the ``k`` best documents for each row of ``items`` (item_id, text).

    Items are searched in blocks of about ``query_bytes`` of text; the driver holds one block of items
    and one row per term of it. Missing and empty texts have no terms: such documents are never
    found, such items find nothing. Repeated rows of ``docs`` are documents of their own; equal scores
    go by doc_id, missing ids last. Each row of ``items`` is ranked for itself. Empty tables give no
    rows; further columns are ignored.
    """
    spark = docs.sparkSession
    rows = staged(items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id"), F.col("text").cast("string").alias("text")), "items")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(size / query_bytes) or 1
    found = None
    for block in range(blocks):
        queries = [(r["item"], terms((r.text or "").encode()))
                   for r in rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").collect()]
        vocabulary = sorted({t for _, words in queries for t in words})
        part = query_index(spark, build_index(docs, vocabulary, **options), queries, k)
        found = part if found is None else found.unionByName(part)
    return found.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
