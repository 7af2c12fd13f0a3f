import glob
import random
import zlib
from array import array
from functools import cache

import pyarrow.orc as orc
from hypothesis import given, settings
from hypothesis import strategies as st

from auditloom.llm import token_output as op
from auditloom.llm.queries import tokenizer_path
from tests.llm.rows import awkward_documents, empty_documents, ordered


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def whole_text_ids(texts):
    return [[*e.ids, 1] for e in tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.characters(codec="utf-8"), st.sampled_from(" \n\t  \u0085\u001ć̈ßÉİΣσς'<|endoftext|>s.1")),
    max_size=40), max_size=8) | st.lists(st.text(alphabet="aJjHTWYI.,!?' \u030c\u0331\u0307\u0308\u030a<|ENDOFTXendoftx>é", max_size=30)))
def test_word_by_word_equals_whole_texts(texts):
    found = op.encoder(tokenizer_path()).encode([t.encode("utf-8") for t in texts])
    assert [list(array("I", x)) + [1] for x in found] == whole_text_ids(texts)


def test_cache_is_emptied_and_refilled():
    encoder = op.WordEncoder(tokenizer_path(), cache_words=2)
    texts = ["alpha beta gamma", "alpha delta", "beta beta " + "z" * 500]
    for _ in range(3):
        found = encoder.encode([t.encode() for t in texts])
        assert [list(array("I", x)) + [1] for x in found] == whole_text_ids(texts)
    assert b"z" * 500 not in encoder.known


def test_round_trip_with_awkward_rows(spark, tmp_path):
    docs = awkward_documents(spark)
    path = str(tmp_path / "tokens")
    op.write_tokens(docs, path, tokenizer_path(), shards=4)
    rows = docs.select("doc_id", "text").collect()
    expected = ordered(zip([r.doc_id for r in rows], whole_text_ids([r.text for r in rows])))
    tokens = op.read_tokens(spark, path)
    assert ordered((r.doc_id, r.ids) for r in tokens.collect()) == expected

    index = op.token_index(tokens).collect()
    by_start = sorted(index, key=lambda r: r.start)
    place = 0
    for r in by_start:
        assert r.start == place
        place += r.n_tokens
    ids = [r.doc_id for r in by_start]
    missing = sum(i is None for i in ids)
    assert ids[:missing] == [None] * missing and ids[missing:] == sorted(ids[missing:])
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in index) == ordered(
        (i, len(x), crc(x)) for i, x in expected)


def test_files_ascend_and_prune(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id * 7 AS doc_id", "concat('word ', id) AS text")
    path = str(tmp_path / "tokens")
    op.write_tokens(docs, path, tokenizer_path(), shards=3, stripe_bytes=4096)
    files = sorted(glob.glob(f"{path}/*.orc"))
    assert len(files) == 3
    ends = []
    for f in files:
        ids = orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        ends += [ids[0], ids[-1]]
    assert ends == sorted(ends)
    some = op.read_tokens(spark, path, doc_ids=[7, 70, 71])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in some.collect()) == [7, 70]
    assert op.read_tokens(spark, path, low=100, high=140).count() == 6


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    op.write_tokens(empty_documents(spark), path, tokenizer_path())
    assert op.token_index(op.read_tokens(spark, path)).count() == 0


def test_hot_id_is_split_over_files(spark, tmp_path):
    docs = spark.range(4000).selectExpr("IF(id % 3 = 0, 5, id) AS doc_id", "concat('word ', id) AS text")
    path = str(tmp_path / "tokens")
    op.write_tokens(docs, path, tokenizer_path(), shards=8)
    sizes = op.read_tokens(spark, path).groupBy("shard").count().collect()
    assert max(r["count"] for r in sizes) < 1000
    assert random.Random(1).sample([r.start for r in op.token_index(op.read_tokens(spark, path)).collect()], 3)
