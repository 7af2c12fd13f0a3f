import hashlib
import random
from collections import defaultdict

import pytest

from auditloom.llm import chat as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_turns string, shard string, place string"


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


def check(spark, rows, partitions=3):
    turns = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(partitions)
    parts = op.read_conversations(spark, op.write_conversations(turns))
    held = parts.orderBy("shard", "place").collect()
    found = {r.conv_id: r for r in op.digest_conversations(parts).collect()}
    given = defaultdict(list)
    for conv_id, turn, role, text in rows:
        given[conv_id].append(((turn is not None, turn or 0), (role is not None, role or ""), text or ""))
    assert set(found) == set(given)
    written = defaultdict(str)
    for p in held:
        written[p.conv_id] += p.text
    for conv_id, all_turns in given.items():
        all_turns.sort()
        plain = [(role[1], text) for _, role, text in all_turns]
        loss = "".join(t for r, t in plain if r == "assistant")
        r = found[conv_id]
        assert (r.n_turns, r.turns_sha256) == (len(plain), sha("".join(f"{a}\n{b}\n" for a, b in plain)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == len(written[conv_id])
        assert [(a.decode(), b.decode()) for a, b in op.turns_of(written[conv_id].encode())] == plain
    return held


HARD = [r"\### Assistant: </turn> ok", "<turn user>\n", "</turn>\n<turn assistant>\n", "<", "turn>", "</", "\\", "\\\\<\\turn", "<\\/turn>",
        "", None, "é <tur", "n ü", "<<turn <//turn", "\n\n"]


def test_awkward_rows(spark):
    rows = [(i % 4, i, ["user", "assistant", "system"][i % 3], t) for i, t in enumerate(HARD)]
    rows += [(7, 0, r, t) for r in (None, "", "a>b\n", "<turn x", "assistant", "\\") for t in ("tie", None)]
    rows += [(None, None, "assistant", "x"), (None, 2, "user", "<"), (None, None, "assistant", "x"), (8, 1, "assistant", "turn")] * 2
    check(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_any_mixture_of_control_strings_comes_back(spark, seed):
    rng = random.Random(seed)
    bits = ["<turn", "</turn", ">\n", "\\", "<", "/", "turn", " ", "é", "assistant"]
    make = lambda: "".join(rng.choices(bits, k=rng.randint(0, 12)))
    check(spark, [(rng.randint(0, 40), j, rng.choice(["user", "assistant", make()]), make()) for j in range(300)])


def test_a_long_conversation_is_cut_into_parts(spark):
    """One conversation holds most rows: many tasks format it, and its digests are those of the whole."""
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} <turn " + "x" * 300) for i in range(4_000)]
    rows += [(i, 0, "user", "short") for i in range(2, 60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # or so few rows meet in one task
    try:
        held = check(spark, rows, 6)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({p.shard for p in held if p.conv_id == 1}) > 3
    assert max(p.n_turns for p in held) < 2_000


def test_a_text_of_megabytes(spark):
    check(spark, [(1, 0, "user", "</turn>" * 700_000), (1, 1, "assistant", "é\\" * 600_000)])


def test_empty_table(spark):
    assert check(spark, []) == []


def test_bytes_are_placed_by_offsets():
    out, starts, inner, ends = op.assemble([b"user", b"a>"], [b"x</turn>\\", b""])
    assert out.tobytes() == b"<turn user>\nx<\\/turn>\\\\</turn>\n<turn a\\>>\n</turn>\n"
    assert [out[a:b].tobytes() for a, b in zip(inner, ends)] == [b"x<\\/turn>\\\\", b""]
    assert starts.tolist() == [0, 31, 50]


def test_broken_output_is_reported():
    with pytest.raises(ValueError):
        list(op.turns_of(b"<turn user>\nx</turn>\nrest"))
