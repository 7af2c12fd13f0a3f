"""Nearest neighbours of a stated query set by a block matrix join.

Vectors are packed into blocks; each block of queries meets each block of candidates once, by an
equality join on strips of candidate blocks. A tile multiplies 8-bit codes and bounds the
quantisation error of every product. Pairs whose upper bound reaches the k-th best lower bound are
computed again from the original numbers and merged by a heap per query. The result is exact.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import let_workers_import
from auditloom.storage import staged

NEIGHBOURS = 20
CANDIDATE_ROWS = 2_048     # vectors of a candidate block
QUERY_ROWS = 512           # vectors of a query block
BLOCK_BYTES = 4 << 20      # of a block, where vectors are long
STRIP_ROWS = 65_536        # candidates a copy of a query block meets
OPEN_BLOCKS = 32           # query blocks whose heaps a task holds
LEVELS = 127

_BLOCK = "dim int, block bigint, ids binary, vectors binary"


def usable(rows):
    """(vec_id, vector as doubles) of the rows that take part, one per vec_id.

    Left out are rows without an id, and vectors that are missing, empty, zero or hold a missing
    or non-finite component. Of rows with one id, the greatest vector counts.
    """
    v = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.max("v").alias("v"))


def blocks(vectors, block_rows):
    """Pack rows (vec_id, v) of a task into blocks of vectors with one dimension."""
    let_workers_import(vectors.sparkSession)

    def block(dim, ids, rows):
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([dim], pa.int32()),
            "block": pa.array([int(ids[0])], pa.int64()),
            "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([np.concatenate(rows).tobytes()], pa.binary())})

    def pack(stream):
        open_blocks = {}
        for batch in stream:
            lists = batch.column("v")
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
                row = values[ends[i]:ends[i + 1]]
                ids, rows = open_blocks.setdefault(len(row), ([], []))
                ids.append(vec_id)
                rows.append(row)
                if len(ids) >= min(block_rows, max(1, BLOCK_BYTES // (8 * len(row)))):
                    yield block(len(row), ids, rows)
                    del open_blocks[len(row)]
        for dim, (ids, rows) in open_blocks.items():
            yield block(dim, ids, rows)

    return vectors.mapInArrow(pack, _BLOCK)


def quantise(x):
    """8-bit codes, scales, norms of what the codes stand for, and norms of the error, per row."""
    scale = np.abs(x).max(axis=1) / LEVELS
    scale[scale == 0] = 1.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    stands = codes * scale[:, None]
    return codes, scale, np.linalg.norm(stands, axis=1), np.linalg.norm(x - stands, axis=1)


def tile_bounds(queries, candidates):
    """Products of the codes, and bounds of their distance from the true inner products."""
    (qc, qs, qn, qe), (cc, cs, cn, ce) = queries, candidates
    # float32 holds sums of products of codes exactly up to 2^24
    kind = np.float32 if qc.shape[1] * LEVELS * LEVELS < 1 << 24 else np.float64
    products = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
    bound = qe[:, None] * (cn + ce)[None, :] + qn[:, None] * ce[None, :]
    return products, bound * (1 + 1e-9) + 1e-12 * (qn + qe)[:, None] * (cn + ce)[None, :]


def exact(q, rows):
    """Inner products in double precision, summed in order of the components."""
    out = np.zeros(len(rows))
    for j in range(len(q)):
        out += rows[:, j] * q[j]
    return out


def merge_tile(heaps, q_ids, q, q_codes, c_ids, c, k):
    """Merge a tile into the heaps, one per query, of (score, -vec_id), the worst first."""
    c_codes = quantise(c)
    products, bound = tile_bounds(q_codes, c_codes)
    least = products - bound
    if least.shape[1] > k + 1:    # one candidate may be the query itself
        floor = np.partition(least, least.shape[1] - k - 1, axis=1)[:, least.shape[1] - k - 1]
    else:
        floor = np.full(len(q), -np.inf)
    for i, heap in enumerate(heaps):
        lowest = max(floor[i], heap[0][0]) if len(heap) == k else floor[i]
        found = np.flatnonzero(~(products[i] + bound[i] < lowest))
        found = found[c_ids[found] != q_ids[i]]
        for pair in zip(exact(q[i], c[found]).tolist(), (-c_ids[found]).tolist()):
            if len(heap) < k:
                heapq.heappush(heap, pair)
            elif pair > heap[0]:
                heapq.heapreplace(heap, pair)


def _search_tiles(tiles, k):
    """Task-wise best rows (query_id, vec_id, score) over all tiles of the task."""
    let_workers_import(tiles.sparkSession)

    def rows_of(state):
        q_ids, _, _, heaps = state
        rows = [(i, -n, s) for i, heap in zip(q_ids.tolist(), heaps) for s, n in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
            ["query_id", "vec_id", "score"])

    def search(stream):
        open_blocks = {}
        for batch in stream:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                dim, key = row["dim"].as_py(), (row["dim"].as_py(), row["q_block"].as_py())
                if key not in open_blocks:
                    if len(open_blocks) >= OPEN_BLOCKS:
                        yield rows_of(open_blocks.pop(next(iter(open_blocks))))
                    ids = np.frombuffer(row["q_ids"].as_py(), np.int64)
                    q = np.frombuffer(row["q_vectors"].as_py(), np.float64).reshape(-1, dim)
                    open_blocks[key] = ids, q, quantise(q), [[] for _ in ids]
                ids, q, codes, heaps = open_blocks[key]
                c_ids = np.frombuffer(row["ids"].as_py(), np.int64)
                c = np.frombuffer(row["vectors"].as_py(), np.float64).reshape(-1, dim)
                merge_tile(heaps, ids, q, codes, c_ids, c, k)
        for state in open_blocks.values():
            yield rows_of(state)

    return tiles.mapInArrow(search, "query_id bigint, vec_id bigint, score double")


def nearest(rows, is_query, k=NEIGHBOURS, candidate_rows=CANDIDATE_ROWS, query_rows=QUERY_ROWS,
            strip_rows=STRIP_ROWS):
    """The ``k`` candidates with the largest inner product for each query.

    ``rows`` has (vec_id, embedding), further columns are ignored; ``is_query`` is a condition on
    vec_id. Candidates are all usable rows of the query's dimension but those with its own id.
    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Fewer
    candidates than ``k`` are all returned; a query without any, or an empty table, gives no rows.
    """
    spark = rows.sparkSession
    vectors = staged(usable(rows), "vectors")
    n = vectors.count()
    cores = spark.sparkContext.defaultParallelism
    strips = max(math.ceil(n / strip_rows), min(4 * cores, math.ceil(n / candidate_rows)), 1)
    candidates = blocks(vectors, candidate_rows).withColumn(
        "strip", F.pmod(F.xxhash64("dim", "block"), F.lit(strips)))
    queries = blocks(vectors.where(is_query).repartition("vec_id"), query_rows).select(
        F.col("dim").alias("q_dim"), F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"), F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("q_strip"))
    tiles = candidates.join(
        queries, (F.col("strip") == F.col("q_strip").cast("bigint")) & (F.col("dim") == F.col("q_dim")))
    found = _search_tiles(tiles.select("dim", "q_block", "q_ids", "q_vectors", "ids", "vectors"), k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
