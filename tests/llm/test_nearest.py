import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.llm import nearest as op


def brute(rows, is_query, k):
    best = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = max(best.get(i, list(v)), list(v))
    out = []
    for q, x in best.items():
        if is_query(q):
            pairs = []
            for c, y in best.items():
                if c != q and len(y) == len(x):
                    s = 0.0
                    for a, b in zip(x, y):
                        s += a * b
                    pairs.append((-s, c))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(pairs)[:k], 1)]
    return sorted(out)


def found(frame, every=5, k=6, **sizes):
    out = op.nearest(frame, F.col("vec_id") % every == 0, k, **sizes)
    return sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_brute_force_with_awkward_vectors(spark, kind):
    rng = np.random.default_rng(2)
    vectors = [v.tolist() for v in rng.normal(size=(300, 16)).astype(np.float32).astype(float)]
    for i in range(40, 80):
        vectors[i] = vectors[40]                      # ties
    vectors[3], vectors[5], vectors[6] = None, [], [0.0] * 16
    vectors[7], vectors[8] = [None] + [1.0] * 15, [float("nan")] + [1.0] * 15
    vectors[9], vectors[11] = [float("inf")] + [1.0] * 15, [1.0, 2.0]
    vectors[15], vectors[20] = [3.0, 4.0], [-5.0, 1.0]
    rows = [*enumerate(vectors), (None, [1.0] * 16), (10, vectors[10]), (25, [9.0] * 16), (30, [-9.0] * 16), (1000, [1e-30] * 16)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, score string")
    if kind == "float":
        rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = brute(rows, lambda i: i % 5 == 0, 6)
    assert found(frame, candidate_rows=7, query_rows=3, strip_rows=20) == expected
    assert found(frame) == expected


def test_bounds_hold():
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(40, 33)) * 10, rng.normal(size=(50, 33)) ** 3
    products, bound = op.tile_bounds(op.quantise(q), op.quantise(c))
    assert (np.abs(products - q @ c.T) <= bound).all()


def test_fewer_candidates_than_wanted_and_empty_table(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert found(frame) == [(0, 1, 1, 4.0)]
    assert found(frame.where("vec_id = 0")) == []
    assert found(frame.limit(0)) == []


def test_no_cross_join(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    plan = op.nearest(frame, F.col("vec_id") % 20 == 0)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
