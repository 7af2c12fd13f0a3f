import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from auditloom.llm import simhash as op
from auditloom.llm.components import connected_components
from auditloom.storage import staged
from tests.llm.rows import awkward_documents, empty_documents, ordered


def brute_fingerprint(text, n=3):
    words = []
    for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words.append("")
        elif words:
            words[-1] += c
        else:
            words = [c]
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(keys, pairs):
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {k: find(k) for k in keys}


def brute_links(keys, bits=2):
    values = np.array(sorted(keys), np.uint64)
    out = set()
    for i, v in enumerate(values):
        near = np.flatnonzero(np.bitwise_count(values[i + 1:] ^ v) <= bits) + i + 1
        out |= {(int(v), int(values[j])) for j in near}
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_trie_join_finds_exactly_the_close_pairs(spark, bits):
    rng = random.Random(bits)
    centres = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    keys = {rng.getrandbits(64) for _ in range(300)}
    for c in centres:
        for _ in range(40):
            flips = rng.sample(range(64), rng.randint(0, 4))
            keys.add(c ^ sum(1 << f for f in flips))
    frame = spark.createDataFrame([(signed(k),) for k in keys], "key bigint")
    found = [tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in op.links(frame, bits).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_links(keys, bits)


@pytest.mark.parametrize("keys", [[], [5], [0, 1], [0, -1, 3]])
def test_few_keys(spark, keys):
    frame = spark.createDataFrame([(k,) for k in keys], "key bigint")
    found = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in op.links(frame).collect()}
    assert found == brute_links([k % (1 << 64) for k in keys])


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    pairs += [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)] + [(-5, -9), (-9, 7000)]
    rng.shuffle(pairs)
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(frame).collect()}
    nodes = {n for p in pairs for n in p}
    expected = roots(nodes, pairs)
    least = {}
    for n, r in expected.items():
        least[r] = min(least.get(r, n), n)
    assert found == {n: least[r] for n, r in expected.items()}


def classes(rows):
    """Expected (doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    marks = [(i, brute_fingerprint(t)) for i, t in rows]
    keys = {f for _, f in marks}
    root = roots(keys, brute_links(keys))
    least = {}
    for i, f in marks:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    return ordered((i, f"{f:016x}", least.get(root[f])) for i, f in marks)


def test_awkward_rows_against_brute_force(spark):
    docs = awkward_documents(spark)
    found = op.near_duplicates(docs).collect()
    expected = classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert ordered((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = op.near_duplicates(docs).collect()
    expected = classes([(r.doc_id, r.text) for r in docs.collect()])
    assert ordered((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected


def test_long_texts_are_read_in_chunks(monkeypatch):
    text = " ".join(str(i * i) for i in range(1000))
    monkeypatch.setattr(op, "CHUNK", 7)
    assert op.fingerprint(text.encode()) % (1 << 64) == brute_fingerprint(text)


def test_empty_table(spark):
    assert op.near_duplicates(empty_documents(spark)).count() == 0


def seen(spark, keys, monkeypatch):
    """Links of the keys, and how many node pairs the walks wrote."""
    rows = []

    def count(df, name="stage"):
        table = staged(df, name)
        if name == "frontier":
            rows.append(table.count())
        return table

    monkeypatch.setattr(op, "staged", count)
    frame = staged(spark.createDataFrame([(signed(k),) for k in keys], "key bigint"), "keys")
    return {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in op.links(frame).collect()}, sum(rows)


def test_keys_that_share_a_half_are_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(5)
    half = rng.getrandbits(32) << 32
    keys = {half | rng.getrandbits(32) for _ in range(3_000)}
    found, pairs = seen(spark, keys, monkeypatch)
    assert found == brute_links(keys)
    assert pairs < 3_000 ** 2 / 20


def test_variants_of_a_template_leave_the_walk_early(spark, monkeypatch):
    rng = random.Random(6)
    keys = {sum(1 << i for i in range(64) if rng.random() < 4 / 64) for _ in range(2_500)}
    found, pairs = seen(spark, keys, monkeypatch)
    assert found == brute_links(keys)
    assert pairs < len(keys) ** 2 / 8


def test_node_pairs_of_unlike_keys_do_not_grow_with_their_square(spark, monkeypatch):
    rng = random.Random(7)
    for size in (4_000, 20_000):
        keys = {rng.getrandbits(64) for _ in range(size)}
        keys |= {k ^ 1 << rng.randrange(64) for k in list(keys)[:size // 20]}
        found, pairs = seen(spark, keys, monkeypatch)
        assert found == brute_links(keys)
        assert pairs < size / 2
