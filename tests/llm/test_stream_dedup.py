import hashlib

import pytest
from pyspark.sql import functions as F

from auditloom.llm import stream_dedup as op
from tests.llm.rows import CLASHES, awkward_documents, empty_documents, ordered


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def groups(rows):
    out = {}
    for i, t in rows:
        out.setdefault(lowered(t), []).append(i)
    return out


def expected(rows):
    """keep_id, group_size and text of each row."""
    out = []
    for text, ids in groups(rows).items():
        best = max((i for i in ids if i is not None), default=None)
        out += [(i, best, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return ordered(out)


@pytest.mark.parametrize("batch_bytes", [1, 1 << 30])
def test_awkward_rows_in_one_and_many_batches(spark, batch_bytes):
    docs = awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = op.deduplicate(docs, max_batch_bytes=batch_bytes).select(
        F.col("doc.doc_id").alias("id"), "keep_id", "group_size", "digest", "kept", F.col("doc.text").alias("text")).collect()
    assert ordered((r.id, r.keep_id, r.group_size, r.digest) for r in found) == expected(rows)
    kept = [(lowered(r.text), r.id) for r in found if r.kept]
    assert ordered(kept) == ordered(
        (t, max((i for i in ids if i is not None), default=None)) for t, ids in groups(rows).items())


def test_texts_that_share_a_digest_stay_apart(spark):
    docs = awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = op.deduplicate(docs, digest=lambda text: F.length(text).cast("string")).select(
        F.col("doc.doc_id").alias("id"), "keep_id", "group_size", F.col("doc.text").alias("text")).collect()
    assert ordered((r.id, r.keep_id, r.group_size, hashlib.sha256(lowered(r.text).encode()).hexdigest())
                   for r in found) == expected(rows)


def test_survivors_keep_all_columns(spark):
    docs = awkward_documents(spark)
    out = op.survivors(docs)
    assert out.columns == docs.columns and set(CLASHES) <= set(out.columns)
    assert out.count() == len(groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))


def test_empty_table(spark):
    assert op.deduplicate(empty_documents(spark)).count() == 0
    assert op.survivors(empty_documents(spark)).columns == empty_documents(spark).columns


def test_the_state_is_on_disk_and_combined_before_the_shuffle(spark):
    session = op._stream_session(spark)
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("slots", [None, 1 << 15, 1 << 17])
def test_filter_lets_every_hit_through(spark, slots):
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    hits = rows.where("id % 10 = 0").select("digest")
    found = {r.id for r in op._may_hit(rows, hits, "digest", slots).collect()}
    assert {i for i in range(20_000) if i % 10 == 0} <= found
    assert slots == 1 << 15 or len(found) < 4500
    assert op._may_hit(rows, hits.limit(0), "digest").count() == 0


def test_stores_keep_no_threads_for_checksum_files(spark):
    session = op._stream_session(spark)
    assert session.conf.get("spark.sql.streaming.checkpoint.fileChecksum.enabled") == "false"
