import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from auditloom.llm import search as op
from tests.llm.rows import awkward_documents, empty_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    """item_id, rank, doc_id and score, by the definition."""
    held = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in words(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if missing else i, -s) for rank, (s, missing, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, k=20, **options):
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    found = op.search(docs, frame, k, **options).collect()
    assert sorted(map(tuple, found), key=repr) == brute(given, items, k)


ITEMS = [(0, "one two three"), (1, None), (2, ""), (3, "tie TIE école lorem"), (4, "nowhere"), (None, "one"), (0, "x password")]


def test_awkward_rows(spark):
    check(spark, awkward_documents(spark), ITEMS, k=5)


@pytest.mark.parametrize("options", [
    {"shard_docs": 7, "block_docs": 2}, {"shard_entries": 30, "block_docs": 3}, {"query_bytes": 40}])
def test_any_shards_blocks_and_query_blocks_give_the_same(spark, options):
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.expovariate(0.1))}" for _ in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(250)] + [(7, docs_copy := "w1 w2 w3 w3")] * 90
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    items = [(i, " ".join(rng.choices(vocabulary, k=8))) for i in range(30)] + [(99, docs_copy)]
    check(spark, frame, items, k=4, **options)


def test_empty_tables(spark):
    check(spark, empty_documents(spark), ITEMS)
    check(spark, awkward_documents(spark), [])
    check(spark, awkward_documents(spark), [(1, None)])


def shard_of(rng, n_docs, n_terms, topics):
    """A shard of documents about a few topics, and its impacts as a dense table."""
    table = np.zeros((n_docs, n_terms), np.int64)
    for d in range(n_docs):
        own = rng.choice(n_terms // topics, 12) * topics + d % topics
        table[d, own] = rng.integers(1_000, 900_000, len(own))
        table[d, rng.choice(n_terms, 3)] = rng.integers(1_000, 900_000, 3)
    rows, columns = np.nonzero(table)
    made = op.build_shard(list(range(n_docs)), np.count_nonzero(table, axis=1), columns, table[rows, columns],
                          rng.standard_normal((n_terms, 8)).astype(np.float32), block_docs=6)
    return table, op._Shard({c: made.column(c)[0].as_py() for c in made.schema.names})


def test_summaries_hold_the_maxima_of_their_blocks():
    table, shard = shard_of(np.random.default_rng(1), 90, 60, 3)
    held = [[] for _ in range(60)]
    for b, term in enumerate(shard.block_term.tolist()):
        docs = shard.block_docs[shard.block_ends[b]:shard.block_ends[b + 1]]
        held[term] += docs.tolist()
        lo, hi = shard.summary_ends[b], shard.summary_ends[b + 1]
        if len(docs) == 1:
            assert lo == hi
            continue
        most = table[docs].max(axis=0)
        most[:term] = 0
        stored = np.zeros(60, np.int64)
        stored[shard.summary_terms[lo:hi]] = shard.summary_max[lo:hi]
        assert (stored == most).all()
    for term in range(60):    # every posting is in one block of its term
        assert sorted(held[term]) == np.flatnonzero(table[:, term]).tolist()


def test_blocks_are_skipped_and_nothing_is_lost():
    rng = np.random.default_rng(2)
    table, shard = shard_of(rng, 400, 90, 5)
    weights, dense = np.arange(90, 0, -1), np.zeros(90, np.int64)
    for _ in range(40):
        asked = {int(t): 1 for t in rng.choice(18, 6) * 5 + int(rng.integers(5))}
        scores = sum(table[:, t] * weights[t] for t in asked)
        best = sorted((-int(s), False, i) for i, s in enumerate(scores) if s > 0)[:3]
        query = op._Query(0, asked, -best[-1][0], weights, 3)
        shard.search(query, dense)
        assert query.best == best and not dense.any()
    assert shard.skipped > 0.3 * (shard.skipped + shard.visited)
    assert shard.scored < 0.5 * 40 * 400


def test_long_words_and_texts(spark):
    docs = spark.createDataFrame([(1, "x" * 1_000_000), (2, "a b " * 200_000), (3, "a")], "doc_id bigint, text string")
    check(spark, docs, [(1, "x" * 1_000_000), (2, "b a a")])
