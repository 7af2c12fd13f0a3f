import random
import re
import string
import time
import uuid

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from auditloom.llm import markov_secrets as op
from tests.llm.rows import awkward_documents, empty_documents, ordered

# The base patterns as stated, without the operator's shortcuts.
PATTERNS = [
    re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|"""
               r"""(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")]


def stated(text):
    out = [(m.start(), 0, m.end()) for m in PATTERNS[0].finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in PATTERNS[1].finditer(text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in PATTERNS[2].finditer(text) if len(m.group()) >= 24]
    return sorted(out)


pieces = st.sampled_from([
    "token", "Password", "secret", "api_key", "APIKEY", "passwd", "=", ":", " = ", "'", '"', " ", "abc", "é", "ſecret",
    "toKen", "AKIA", "AKIAAKIA", "ABCDEFGHIJ012345", "0123456789abcdef", "deadbeef", "A1b2C3d4", ".", "\n", "token=token=ab"])


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_base_spans_are_the_stated_ones(text):
    assert op.base_spans(text) == stated(text)


def words_model(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return op.train(op.sample_strings(documents, 300))


def test_model_tells_random_strings_from_words(spark):
    model = words_model(spark)
    held = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    strings = op.sample_strings(held, 200).collect()
    long = [(r.random, model.is_random(r.value)) for r in strings if len(r.value) >= 16 and r.value.isalnum()]
    assert sum(r for r, _ in long) > 50
    right = sum(r == found for r, found in long)
    assert right / len(long) > 0.95
    text = "see kT9vXq2LmZ81RwYb4HsNcE7d and internationalization1 internationally"
    base, spans = op.find_spans(text, model)
    assert not base and [text[s:e] for s, _, e in spans] == ["kT9vXq2LmZ81RwYb4HsNcE7d"]


def test_tokens_without_a_digit_are_judged_by_the_models(spark):
    model = words_model(spark)
    rng = random.Random(3)
    found = lambda token: [token[s:e] for s, _, e in op.find_spans(token, model)[1]] == [token]
    secrets = ["".join(rng.choice(string.ascii_letters) for _ in range(24)) for _ in range(500)]
    assert sum(map(found, secrets)) > 475
    ordinary = [
        "internationalization", "Geschwindigkeitsbegrenzung", "anticonstitutionnellement", "responsabilidades",
        "RESPONSIBILITIES", "NON-INFRINGEMENT", "snake_case_names_like_this", "multi-word-hyphen-slug-title",
        "/usr/local/share/applications/", "-" * 80, "=" * 80, "_" * 80]
    assert [t for t in ordinary if found(t)] == []
    held = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    tokens = {m.group() for r in held for m in op.TOKEN.finditer(r.text or "") if m.group().isalpha()}
    assert tokens and not any(map(found, tokens))


def test_identifiers_are_left_and_keys_found(spark):
    model, rng = words_model(spark), random.Random(5)
    ids = [str(uuid.UUID(int=rng.getrandbits(128), version=4)) for _ in range(500)]
    assert sum(map(model.is_random, ids)) <= 5
    assert not any(map(model.is_random, [
        "2024-01-01T00", "4539148803436467", "getElementsByClassName", "XMLHttpRequestEventTargetPrototype",
        "max_connection_pool_size", "/var/lib/data/part-00017"]))
    for size, share in ((8, 0.8), (12, 0.95), (16, 0.97), (24, 0.99), (40, 0.97)):
        keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(size)) for _ in range(500)]
        assert sum(map(model.is_random, keys)) >= share * 500


def test_threshold_holds_the_false_rate_on_held_out_strings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strings = op.sample_strings(docs, 300).collect()
    model = words_model(spark)
    held = [r.value for r in strings if r.held and not r.random and len(r.value) >= op.BANDS[0]]
    trained = {r.value for r in strings if not r.held and r.value.isalpha()}
    assert len(held) > 1_000 and trained.isdisjoint(held)
    bands = [[v for v in held if op.band(len(v)) == b] for b in range(len(op.BANDS))]
    for found in bands:
        if len(found) >= op.LEAST_HELD:
            assert sum(map(model.is_random, found)) <= op.FALSE_RATE * len(found)


def test_thresholds_by_brute_force(spark):
    rng, rows = random.Random(2), []
    for size in [9] * 400 + [13] * 150 + [20] * 99 + [100] * 3:
        rows.append(("".join(rng.choice("abcXYZ019") for _ in range(size)),))
    table = np.random.default_rng(4).normal(size=(op.START + 1, op.START + 1))
    least = op.learn_least(spark.createDataFrame(rows, "value string").repartition(3), table)
    most = [max(op.ratio(table, v) / len(v) for v, in rows if len(v) == size) for size in (9, 13)]
    for got, score in zip(least, most):
        assert max(score, 0) < got <= max(score, 0) + op.CELL * 1.001
    assert least[2:] == [max(least[:2])] * (len(op.BANDS) - 2)
    none = op.learn_least(spark.createDataFrame([], "value string"), table)
    assert none == [np.inf] * len(op.BANDS) and not op.Model(table, none).is_random("kT9vXq2LmZ81RwYb")


def test_scan_counts_code_points_and_keeps_rows(spark):
    docs = awkward_documents(spark)
    rows = op.scan(docs, words_model(spark)).collect()
    assert ordered(r.doc_id for r in rows) == ordered(r.doc_id for r in docs.select("doc_id").collect())
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id == 10}
    spans = [r.spans for r in rows if r.doc_id == 10][0]
    assert [texts[10][s.start:s.end] for s in spans] == ["Password = 'hunter2000"]
    wide = spark.createDataFrame([(1, "😀é " + "a1" * 15)], "doc_id bigint, text string")
    assert [(s.kind, s.start, s.end) for s in op.scan(wide, words_model(spark)).first().spans] == [("hex", 3, 33)]


def test_training_without_strings_and_empty_table(spark):
    found = op.find_secrets(empty_documents(spark))
    assert found.count() == 0
    only = spark.createDataFrame([(None, None, 1), (None, "token = abcdef", 2)], "doc_id bigint, text string, spans int")
    assert sorted(len(r.spans) for r in op.find_secrets(only).collect()) == [0, 1]


def test_rows_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = op.find_secrets(docs.coalesce(1)), op.find_secrets(docs.repartition(7))
    assert ordered(map(tuple, one.collect())) == ordered(map(tuple, many.collect()))


def test_long_texts_take_linear_time():
    model = op.Model(np.zeros((op.START + 1, op.START + 1)), [1.0] * len(op.BANDS))
    rng = random.Random(1)
    hexes = " ".join("%032x" % rng.getrandbits(128) for _ in range(31_000))
    for text in (hexes, "x" * 1_000_000, "0" * 1_000_000, "password=" * 110_000):
        started = time.process_time()
        op.find_spans(text, model)
        assert time.process_time() - started < 3
