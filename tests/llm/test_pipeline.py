import pytest

import corpus_pipeline as pipeline
from auditloom.llm import toxicity
from auditloom.llm.queries import tokenizer_path
from tests.llm.rows import DOCUMENTS, awkward_documents, empty_documents, ordered
from tests.llm.test_mixing import expected as mixed
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_fingerprint, brute_links, roots
from tests.llm.test_stream_dedup import groups
from tests.llm.test_token_output import whole_text_ids

FOLDER = "/root/testdata/sf0.001"


def stage(name):
    return dict(pipeline.STAGES)[name]


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def one_per_component(rows):
    keys = [brute_fingerprint(t) for _, t in rows]
    root = roots(set(keys), brute_links(set(keys)))
    least = {}
    for (i, t), k in zip(rows, keys):
        if i is not None or root[k] not in least:
            old = least.get(root[k])
            if old is None or old[0] is None or (i is not None and i < old[0]):
                least[root[k]] = (i, t)
    return ordered(i for i, _ in least.values())


def test_every_stage_against_brute_force(spark, tmp_path):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = documents
    for n, (name, run) in enumerate(pipeline.STAGES):
        before = pairs(kept)
        out = run(spark, kept, FOLDER)
        if name != "packing":
            assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        if name == "toxicity":
            model = toxicity.train(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            clean = [r.doc_id for r in toxicity.score(documents, model).where("predicted = 0").collect()]
            assert sorted(i for i, _ in pairs(after)) == sorted(clean)
        elif name == "exact dedup":
            assert sorted(i for i, _ in pairs(after)) == sorted(max(ids) for ids in groups(before).values())
        elif name == "simhash near-dedup":
            assert ordered(i for i, _ in pairs(after)) == one_per_component(before)
        elif name == "mixing":
            rows = kept.select("doc_id", "text", "source").collect()
            assert ordered(pairs(after)) == ordered(r[:2] for r in mixed(rows, lambda s, n: n ** 0.5, len(rows)))
        else:
            lengths = [(i, len(x)) for (i, _), x in zip(before, whole_text_ids([t for _, t in before]))]
            check(after.collect(), lengths, 2048, 16, 65_536)
        kept = after
    assert kept.count() == pipeline.run(spark, FOLDER).count()


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    for k, docs in enumerate((awkward_documents(spark), empty_documents(spark))):
        for n, (name, run) in enumerate(pipeline.STAGES):
            out = run(spark, docs, FOLDER)
            if name == "packing":
                assert (out.count() > 0) == (k == 0)
                continue
            assert out.columns == docs.columns
            if name == "simhash near-dedup":
                assert ordered(i for i, _ in pairs(out)) == (one_per_component(pairs(docs)))
            path = str(tmp_path / f"{k}-{n}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)


def test_order_and_names():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "mixing", "packing"]
    assert tokenizer_path().endswith(".json")


def test_run_keeps_the_intermediate_tables_of_one_stage(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(pipeline.__dict__, "_scratch", {})
    spark.conf.set("auditloom.shared.scope", str(tmp_path))
    try:
        out = pipeline.run(spark, FOLDER)
        names = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
        assert names == {"pack_batches", "mixing"}
        assert out.count() > 0
    finally:
        spark.conf.unset("auditloom.shared.scope")


@pytest.mark.parametrize("name", ["exact dedup", "simhash near-dedup"])
def test_narrow_tables_are_written_by_few_tasks_whatever_the_shuffle_partitions(spark, tmp_path, monkeypatch, name):
    monkeypatch.setitem(pipeline.__dict__, "_scratch", {})
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "auditloom.shared.scope": str(tmp_path)}
    before = {key: spark.conf.get(key, None) for key in held}
    rows = [(i, f"w{i % 150} w{i % 7} common words of text {i % 150}", "en", "s", 20) for i in range(300)]
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        docs = spark.createDataFrame(rows, DOCUMENTS)
        kept = ordered(i for i, _ in pairs(stage(name)(spark, docs, FOLDER)))
        files = {}
        for table in tmp_path.glob("*/*"):
            files[table.name.rsplit("-", 1)[0]] = len(list(table.glob("part-*")))
        if name == "exact dedup":
            assert kept == ordered(max(ids) for ids in groups([r[:2] for r in rows]).values())
            narrow = {"groups", "decided"}
        else:
            assert kept == one_per_component([r[:2] for r in rows])
            narrow = {"classes", "named", "components", "parents", "frontier"}
        assert narrow <= set(files)
        assert all(files[t] <= spark.sparkContext.defaultParallelism for t in narrow), files
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
