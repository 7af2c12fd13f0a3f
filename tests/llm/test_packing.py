import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from auditloom.llm import packing as op
from auditloom.llm.queries import tokenizer_path
from tests.llm.rows import awkward_documents, empty_documents, ordered
from tests.llm.test_token_output import whole_text_ids


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= v) - v) for v, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_have_the_least_padding(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(60), 9))
    counts = [rng.randint(1, 50) for _ in lengths]
    for k in range(1, 11):
        found = op.best_boundaries(lengths, counts, k)
        assert len(found) <= k and found == sorted(set(found)) and found[-1] == lengths[-1]
        best = min(padding(lengths, counts, c) for n in range(1, min(k, 9) + 1)
                   for c in itertools.combinations(lengths, n) if c[-1] == lengths[-1])
        assert padding(lengths, counts, found) == best
    assert op.best_boundaries([], [], 4) == []


def check(found, lengths, max_tokens, buckets, batch_tokens):
    tokens = defaultdict(list)
    batches = defaultdict(list)
    for r in found:
        tokens[r.doc_id].append((r.first_token, r.n_tokens))
        batches[r.bucket, r.batch].append(r)
        assert 0 <= r.n_tokens <= r.padded_tokens <= max_tokens
    total = defaultdict(int)
    for i, n in lengths:
        total[i] += n
    assert {i: sum(n for _, n in t) for i, t in tokens.items()} == dict(total)
    bounds = {r.bucket: r.padded_tokens for r in found}
    assert len(bounds) <= buckets
    for b, bound in bounds.items():
        numbers = sorted(n for k, n in batches if k == b)
        assert numbers == list(range(len(numbers)))
        room = max(batch_tokens // max(bound, 1), 1)
        sizes = [len(batches[b, n]) for n in numbers]
        assert all(s == room for s in sizes[:-1]) and 0 < sizes[-1] <= room
    cells = defaultdict(int)
    for r in found:
        cells[r.n_tokens] += 1
    best = op.best_boundaries(sorted(cells), [cells[v] for v in sorted(cells)], buckets)
    assert sum(r.padded_tokens - r.n_tokens for r in found) == padding(sorted(cells), [cells[v] for v in sorted(cells)], best)


def test_batches_hold_every_token_once(spark):
    rng = random.Random(1)
    lengths = [(i, 30 if i % 3 == 0 else rng.randint(0, 400)) for i in range(3000)] + [(7, 5), (7, 5), (None, 9)]
    frame = spark.createDataFrame([(i, n, "x") for i, n in lengths], "doc_id bigint, n_tokens bigint, batch string")
    found = op.pack(frame, max_tokens=128, buckets=5, batch_tokens=512, shard_rows=50).collect()
    check(found, lengths, 128, 5, 512)


def test_awkward_documents(spark):
    docs = awkward_documents(spark)
    rows = docs.select("doc_id", "text").collect()
    lengths = [(r.doc_id, len(x)) for r, x in zip(rows, whole_text_ids([r.text for r in rows]))]
    found = op.pack_documents(docs, tokenizer_path(), max_tokens=64, buckets=3, batch_tokens=256).collect()
    check(found, lengths, 64, 3, 256)
    assert ordered({r.doc_id for r in found}) == ordered({i for i, _ in lengths})


def test_missing_lengths_and_empty_table(spark):
    frame = spark.createDataFrame([(1, None), (2, 0)], "doc_id bigint, n_tokens bigint")
    assert [(r.n_tokens, r.padded_tokens, r.batch) for r in op.pack(frame).collect()] == [(0, 0, 0)] * 2
    assert op.pack_documents(empty_documents(spark), tokenizer_path()).count() == 0


def test_no_window_holds_a_bucket(spark):
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(10).alias("n_tokens"))
    plan = op.pack(frame)._jdf.queryExecution().toString()
    assert "windowspecdefinition(bucket" in plan and "shard" in plan.split("windowspecdefinition(bucket", 1)[1][:60]


@pytest.mark.parametrize("splits", [1, 7])
def test_batches_do_not_depend_on_the_layout(spark, splits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    packed = lambda frame: ordered(map(tuple, op.pack_documents(
        frame, tokenizer_path(), max_tokens=128, buckets=4, batch_tokens=1024, shard_rows=40).collect()))
    assert packed(docs.repartition(splits, "text")) == packed(docs.orderBy(F.desc("doc_id")).repartition(3))


def test_a_third_of_equal_rows_is_spread(spark):
    frame = spark.range(3_000).select(F.when(F.col("id") < 1_000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(10).alias("n_tokens"))
    found = op.pack(frame, shard_rows=50, batch_tokens=100).collect()
    check(found, [(7 if i < 1_000 else i, 10) for i in range(3_000)], op.MAX_TOKENS, op.BUCKETS, 100)
