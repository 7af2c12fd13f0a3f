"""Chat formatting: conversations as templated text with a loss mask, assembled in columns of bytes.

Turns are range partitioned and sorted by conversation and turn. For a slice of turns numpy computes
the lengths of headers, escaped contents and closings, their cumulative offsets and the place of each
source byte; headers and contents are then scattered into one preallocated buffer, which becomes the
Arrow text column. A conversation cut by a slice or a range gives several parts, in order.

The template is ``<turn ROLE>\\n`` CONTENT ``</turn>\\n``. In contents a backslash goes before every
backslash and between ``<`` and a following ``turn`` or ``/turn``, so no control string remains; in
roles it goes before every backslash, ``<`` and ``>``. Dropping it gives the original back.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from auditloom.llm.common import let_workers_import, map_arrow, small_batches, utf8
from auditloom.storage import new_path, staged

ASSISTANT = "assistant"
OPEN, CLOSE = b"<turn %s>\n", b"</turn>\n"
CONTROL = re.compile(rb"</?turn")
ROLE_CONTROL = re.compile(rb"[\\<>]")
ESCAPED = re.compile(rb"\\(.)", re.S)
TURN = re.compile(rb"<turn ((?:[^\\>]|\\.)*+)>\n(.*?)</turn>\n", re.S)

PARTS = "conv_id bigint, n_turns bigint, text string, loss_starts array<int>, loss_ends array<int>"
DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")


def unescape(value):
    return ESCAPED.sub(rb"\1", value) if b"\\" in value else value


def _joined(values):
    """Byte strings as one array, with the start of each and the end of the last."""
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)), out=offsets[1:])
    return np.frombuffer(b"".join(values), np.uint8), offsets


def _escapes(data, offsets):
    """Places in ``data`` before which a backslash goes, ascending; no control string crosses two contents."""
    spans = np.array([m.span() for m in CONTROL.finditer(data)], np.int64).reshape(-1, 2)
    end = offsets[np.searchsorted(offsets, spans[:, 0], "right")]
    return np.sort(np.concatenate([np.flatnonzero(data == ord("\\")), spans[spans[:, 1] <= end, 0] + 1]))


def assemble(roles, contents):
    """The formatted bytes of turns, the start of each turn (and the end), and where its content lies."""
    heads, head_at = _joined([OPEN % ROLE_CONTROL.sub(rb"\\\g<0>", r) for r in roles])
    data, at = _joined(contents)
    marks = _escapes(data, at)
    before = np.searchsorted(marks, at)                      # escapes before each content
    sizes = np.diff(at) + np.diff(before)
    n, close = len(roles), len(CLOSE)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(np.diff(head_at) + sizes + close, out=starts[1:])
    inner = starts[:-1] + np.diff(head_at)
    out = np.empty(starts[-1], np.uint8)
    out[np.arange(len(heads)) + np.repeat(starts[:-1] - head_at[:-1], np.diff(head_at))] = heads
    passed = np.zeros(len(data), np.int64)
    passed[marks] = 1
    place = np.arange(len(data)) + np.cumsum(passed) + np.repeat(inner - at[:-1] - before[:-1], np.diff(at))
    out[place] = data
    out[place[marks] - 1] = ord("\\")
    out[((starts[1:] - close)[:, None] + np.arange(close)).ravel()] = np.tile(np.frombuffer(CLOSE, np.uint8), n)
    return out, starts, inner, inner + sizes


def _parts(batch):
    """A part for each run of turns of one conversation in a slice."""
    for part in small_batches(batch, "text"):
        ids, roles = part.column("conv_id"), utf8(part.column("role"))
        known, values = ids.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
        out, starts, inner, ends = assemble(roles, utf8(part.column("text")))
        first = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (known[1:] != known[:-1])]))
        last = np.append(first[1:], len(values))
        loss = np.flatnonzero(np.fromiter((r == ASSISTANT.encode() for r in roles), bool, len(roles)))
        held = np.searchsorted(loss, np.append(first, len(values))).astype(np.int32)
        base = np.repeat(starts[first], np.diff(held))
        text = pa.StringArray.from_buffers(
            len(first), pa.py_buffer(starts[np.append(first, len(values))].astype(np.int32)), pa.py_buffer(out))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(first)), pa.array(last - first), text,
             *[pa.ListArray.from_arrays(pa.array(held), pa.array((x[loss] - base).astype(np.int32))) for x in (inner, ends)]],
            ["conv_id", "n_turns", "text", "loss_starts", "loss_ends"])


def write_conversations(turns, path=None):
    """Write rows of (conv_id, turn, role, text) as formatted parts and return the path.

    Turns come in order of turn, then role, text and place; missing turns come first, missing roles and
    texts are empty, and missing conv_ids are one conversation. Repeated rows are turns of their own.
    A part has conv_id, n_turns, text, the byte offsets in it under the loss mask (assistant contents),
    and shard and place, in which the parts of a conversation ascend. Ranges are cut by all of these,
    so a very long conversation is formatted by many tasks. An empty table gives no parts.
    """
    path = path or new_path(turns.sparkSession, "chats")
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", F.xxhash64("text"), "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions("conv_id", "turn", "role", "text", "row")
    parts = map_arrow(rows.select("conv_id", "role", "text"), _parts, PARTS).withColumns({
        "shard": F.spark_partition_id(),
        "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    parts.write.option("compression", "zstd").parquet(path)
    return path


def read_conversations(spark, path):
    return spark.read.schema(f"{PARTS}, shard int, place bigint").parquet(path)


def turns_of(text):
    """(role, content) of each turn of a formatted text, unescaped."""
    end = 0
    for m in TURN.finditer(text):
        if m.start() != end:
            break
        end = m.end()
        yield unescape(m[1]), unescape(m[2])
    if end != len(text):
        raise ValueError(f"no turn at byte {end}: {text[end:end + 40]!r}")


def _chars(value):
    return len(value) - int(np.count_nonzero((np.frombuffer(value, np.uint8) & 0xC0) == 0x80))


class _Digest:
    """Running digests of one conversation; it holds one part's text at a time."""

    def __init__(self, conv_id):
        self.row = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]

    def add(self, n_turns, text, starts, ends):
        row = self.row
        found = list(turns_of(text))
        if len(found) != n_turns:
            raise ValueError(f"{len(found)} turns instead of {n_turns}")
        row[2].update(b"".join([b"%s\n%s\n" % x for x in found]))
        loss = unescape(b"".join([text[a:b] for a, b in zip(starts, ends)]))   # no escape crosses two contents
        row[4].update(loss)
        row[1], row[3], row[5] = row[1] + n_turns, row[3] + _chars(loss), row[5] + _chars(text)

    def result(self):
        return [x.hexdigest() if hasattr(x, "hexdigest") else x for x in self.row]


def _digests(stream):
    """Digests of runs of parts with one conv_id."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current = None
    for batch in stream:
        done = []
        for part in small_batches(batch, "text"):
            columns = [part.column(c) for c in ("conv_id", "n_turns", "loss_starts", "loss_ends")]
            for (i, n, starts, ends), text in zip(zip(*[c.to_pylist() for c in columns]), utf8(part.column("text"))):
                if current is None or current.row[0] != i:
                    done += [current.result()] if current else []
                    current = _Digest(i)
                current.add(n, text, starts, ends)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(current.result(), types)], names)


def digest_conversations(parts):
    """Per conversation: conv_id, n_turns, digests of turns and of the text under the loss mask, and lengths.

    Conversations of one part, nearly all, are digested where they are read. The parts of others are
    shuffled by conv_id and pass a task in order; a SHA-256 has to see a conversation's bytes one
    after the other, but the task holds one part at a time, and a part is some megabytes.
    """
    let_workers_import(parts.sparkSession)
    several = staged(parts.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("conv_id").alias("several")), "several")
    same = F.col("conv_id").eqNullSafe(F.col("several"))
    whole = parts.join(several, same, "left_anti")
    cut = parts.join(several, same, "left_semi").repartition("conv_id").sortWithinPartitions("conv_id", "shard", "place")
    columns = ["conv_id", "n_turns", "text", "loss_starts", "loss_ends"]
    return whole.select(*columns).mapInArrow(_digests, DIGESTS).unionByName(cut.select(*columns).mapInArrow(_digests, DIGESTS))
