import random
import string
import time
import zlib

import pytest
from pyspark.sql import functions as F

from auditloom.llm import toxicity as op
from tests.llm.rows import awkward_documents, empty_documents, ordered

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(8)
    return docs, spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return op.train(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    rows = op.score(docs, model).where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    bad = [r for r in rows if r.toxic]
    good = [r for r in rows if not r.toxic]
    assert len(bad) > 20
    assert sum(r.predicted for r in bad) / len(bad) > 0.9
    assert sum(r.predicted for r in good) / len(good) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_are_never_used(spark, tables):
    docs, labels = tables[0].where("doc_id < 2500"), tables[1]
    turned = labels.withColumn("toxic", F.when(op.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = [ordered(map(tuple, op.score(docs, op.train(docs, x)).collect())) for x in (labels, turned)]
    assert rows[0] == rows[1]
    assert {r[0]: r[1] for r in rows[0]} == {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows[0]}


def test_awkward_rows(spark, model):
    docs = awkward_documents(spark)
    rows = op.score(docs, model).collect()
    assert ordered(r.doc_id for r in rows) == ordered(r.doc_id for r in docs.select("doc_id").collect())
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5, 6)}) == 1
    assert op.clean(docs, model).columns == docs.columns
    assert op.score(empty_documents(spark), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0, 0), (2, 0, 0)], [(None, 1, 1), (1, 1, None)]])
def test_without_labels_of_both_kinds_the_score_is_constant(spark, labels):
    docs = awkward_documents(spark)
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert {r.score for r in op.score(docs, op.train(docs, frame)).collect()} == {0.0}


@pytest.mark.parametrize("bad", [2, 8])
def test_few_labels_without_a_lexicon_still_fit_trees(spark, bad):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(9))
    ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % 5][:40]
    texts = {i: " ".join(word() for _ in range(6)) for i in range(80)}
    toxic = {i for i in range(80) if i in ids[:bad] or i >= 75}
    rows = [(i, t.upper() + "!!!" if i in toxic else t + ".") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0, int(i in toxic)) for i in ids], "doc_id bigint, quality int, toxic int")
    found = op.score(docs, op.train(docs, labels)).collect()
    assert {r.doc_id for r in found if r.predicted} == toxic


def test_features_see_disguise():
    lexicon = op.Lexicon({"idiot": 5.0, "idio-": 4.0})
    at = {name: i for i, name in enumerate(op.FEATURES)}
    row = lambda t: op.features(t.encode(), t, lexicon)
    assert row("you idiot")[at["near_second"]] > 0 and row("idiotic man")[at["stem_density"]] == 0.5
    assert row("an 1d10t here")[at["obfuscated_hits"]] > 0 and row("an i.d.i.o.t here")[at["obfuscated_hits"]] > 0
    assert row("SHUT up!!!")[at["shouted"]] > 0 and row("")[at["length"]] == 0


def test_masked_words_are_whole_runs():
    found = [w for w in op.MASKED.findall("an 1d10t, 1d!ot sh*t a$$ plain 2024 é1é x_1 ! l8r 42") if op.LETTER.search(w)]
    assert found == ["1d10t", "1d!ot", "sh*t", "a$$", "é1é", "x_1", "l8r"]


@pytest.mark.parametrize("text", ["x" * 1_000_000, "01" * 500_000, "\u4e2d" * 300_000, "a1 " * 300_000, "a-" * 400_000, "A" * 1_000_000])
def test_long_words_take_linear_time(text):
    started = time.process_time()
    op.features(text.encode(), text, op.Lexicon({"idiot": 5.0}))
    assert time.process_time() - started < 3
