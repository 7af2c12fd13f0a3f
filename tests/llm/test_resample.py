import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from auditloom.llm import resample as op
from tests.llm.rows import awkward_documents, empty_documents, ordered

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, targets, longest, buckets, least, percent):
    cell = lambda g: zlib.crc32(g.encode()) % buckets
    made = [(i, *grams(t, longest)) for i, t in docs]
    s = Counter(cell(g) for _, found, _ in made for g in found)
    t = Counter(cell(g) for x in targets for g in grams(x, longest)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for i, found, n in made:
        weight = sum(gain(cell(g)) for g in found) // max(len(found), 1)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    may = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, may[:percent * len(may) // 100]


def check(spark, docs, targets, longest=1, buckets=10_000, least=20, percent=10):
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    frame = spark.createDataFrame([(x,) for x in targets], "text string")
    found = op.resample(docs, frame, longest, buckets, least_words=least, percent=percent).collect()
    rows, drawn = brute(given, targets, longest, buckets, least, percent)
    assert ordered((r.doc_id, r.n_features, r.weight, r.score) for r in found) == ordered(r[:4] for r in rows)
    ranked = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[3]) for r in drawn]


@pytest.mark.parametrize("longest, buckets, least, percent", [(1, 10_000, 20, 10), (3, 97, 1, 50), (2, 11, 0, 100), (1, 5, 2, 0)])
def test_equals_brute_force(spark, longest, buckets, least, percent):
    check(spark, awkward_documents(spark), ["one two three", None, "", "TIE dolor É", "tie"], longest, buckets, least, percent)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    targets = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    check(spark, docs, targets)


def test_empty_tables(spark):
    check(spark, empty_documents(spark), ["one"])
    check(spark, awkward_documents(spark), [], least=1)


def test_ties_and_hot_ids_rank_once_each(spark):
    """A third of all rows are copies of one; no rank is missing or doubled."""
    rows = [(i, f"w{i % 7} x y") for i in range(600)] + [(5, "hot copy of a text")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    check(spark, docs, ["hot copy", "w3"], least=1, percent=70)


def test_scan_is_linear_in_the_length_of_a_word():
    patterns = op.scanners(3)
    for value in (b"x" * 1_000_000, b"- " * 500_000, b"a " * 200_000):
        cells, n = op.features(value, patterns)
        assert len(cells) == sum(max(n - k, 0) for k in range(3))


def test_lookarounds_give_whole_words():
    line = op.collapse("Ab-c\tÉcole x2,,  y".encode())
    assert line.decode() == "ab c École x2 y"
    spans = [[m.group().decode() for m in p.finditer(line, overlapped=True)] for p in op.scanners(2)]
    assert spans == [["ab", "c", "École", "x2", "y"], ["ab c", "c École", "École x2", "x2 y"]]
