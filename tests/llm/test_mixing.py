import hashlib
import math

import pytest
from pyspark.sql import functions as F

from auditloom.llm import mixing as op
from tests.llm.rows import awkward_documents, empty_documents, ordered


def draws(u, rate):
    """The smallest k with u below the probability of at most k copies."""
    if rate <= 0:
        return 0
    k, below = 0, math.exp(-rate)
    while u >= below:
        k += 1
        below += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
    return k


def uniform(key):
    return int(hashlib.md5(f"mix-1|{key}".encode()).hexdigest()[:13], 16) / 2 ** 52


def key(r):
    return str(r.doc_id) if r.doc_id is not None else "text:" + hashlib.md5((r.text or "").encode()).hexdigest()


def expected(rows, weights, size):
    n = {}
    for r in rows:
        n[r.source] = n.get(r.source, 0) + 1
    w = {s: weights(s, c) for s, c in n.items()}
    rate = {s: size * w[s] / (sum(w.values()) or 1) / n[s] for s in n}
    out = []
    for r in rows:
        out += [(r.doc_id, r.text, r.source, c) for c in range(draws(uniform(key(r)), rate[r.source]))]
    return ordered(out)


def found(frame):
    return ordered((r.doc_id, r.text, r.source, r.copy) for r in frame.select(
        "doc.doc_id", "doc.text", "doc.source", "copy").collect())


def test_awkward_rows_against_brute_force(spark):
    docs = awkward_documents(spark)
    rows = docs.select("doc_id", "text", "source").collect()
    assert found(op.mix(docs)) == expected(rows, lambda s, n: n ** 0.5, len(rows))
    assert op.mix(docs).select("doc.*").columns == docs.columns


@pytest.mark.parametrize("size", [0, 50, 5000, 2_000_000])
def test_given_weights_and_size(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("source IN ('src0', 'src1', 'src2')")
    rows = docs.select("doc_id", "text", "source").collect()
    weights = spark.createDataFrame([("src0", 3.0), ("src1", 1.0), ("src2", -1.0)], "source string, weight double")
    table = {"src0": 3.0, "src1": 1.0}
    if size > 10_000:    # high rates: compare the counts only
        counts = op.mix(docs, weights, size).groupBy("doc.doc_id").count().collect()
        want = {}
        for r in expected(rows, lambda s, n: table.get(s, 0.0), size):
            want[r[0]] = want.get(r[0], 0) + 1
        assert {r.doc_id: r["count"] for r in counts} == want
    else:
        assert found(op.mix(docs, weights, size)) == expected(rows, lambda s, n: table.get(s, 0.0), size)


def test_shares_follow_the_targets(spark):
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    counts = {r.source: r["count"] for r in op.mix(docs, weights).groupBy("doc.source").count().collect()}
    assert abs(counts["a"] / 45_000 - 1) < 0.03 and abs(counts["b"] / 15_000 - 1) < 0.03


def test_order_is_global_and_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    op.mix(docs).select("shuffle_key").write.parquet(str(tmp_path / "mix"))
    keys = []
    for f in sorted((tmp_path / "mix").glob("*.parquet")):
        keys += [r.shuffle_key for r in spark.read.parquet(str(f)).collect()]
    assert keys == sorted(keys)
    assert op.mix(empty_documents(spark)).count() == 0
