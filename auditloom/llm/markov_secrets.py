"""Secrets in text: fixed patterns, and character Markov models for what no pattern names.

Two models of the order of characters, one of random strings and one of ordinary identifiers, are
trained from labelled samples. A token whose log-likelihood ratio exceeds the threshold is a
secret. The samples come from documents: values that the patterns find and digests of the sampled
ids are random strings; words outside found spans, alone and joined as in identifiers and paths, and
UUIDs are ordinary. No condition but the ratio and the length decides: a token may have no digit.

The threshold is learned, too. A third of all words, alone and joined, and of the UUIDs is held back from
training; of these strings, band by band of the length, at most ``FALSE_RATE`` may reach the threshold. It
also is at least the log of 1 / ``FALSE_RATE``: so large a ratio has no more than that chance under the
model of ordinary strings.
"""

import hashlib
import re
from binascii import crc32
from bisect import bisect_left, bisect_right
from math import log
from uuid import UUID

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm.common import map_arrow, small_batches, texts
from auditloom.storage import staged

FIT_DOCS = 4_000        # sampled documents the models are trained on, smallest hashes first
FALSE_RATE = 1e-4       # share of held-out ordinary strings of a length that may be called random
LEAST_HELD = 100        # held-out strings a band needs for a threshold of its own
BANDS = (8, 12, 16, 24, 32, 48, 64, 96)   # least lengths of the bands; shorter tokens are not judged
CELL = 0.01             # scores of held-out strings are counted in cells of this width, per character
HELD = 3                # one word in so many is held back from training
LEAST_RANDOM = 16       # characters of an assigned value that trains the model of random strings
SMOOTHING = 0.5
KNOWN = 200_000         # tokens whose answer a task remembers

KINDS = ("assign", "access", "hex", "random")

# Patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % BANDS[0])
WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
START = len(SYMBOLS)
_CODE = np.full(128, START, np.int64)
_CODE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))


def base_spans(text):
    """(start, kind number, end) of the base kinds, in order of start, then kind."""
    found = []
    lowered = text.encode("utf-8", "replace").lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= ASSIGN_LEAST:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class _Taken:
    """The places that spans, in order of start, cover."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for start, _, end in spans:
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start, end):
        i = bisect_left(self.starts, end) - 1    # the last covered run that begins before the end
        return i < 0 or self.ends[i] <= start


def _codes(token):
    return _CODE[np.frombuffer(token.encode("ascii"), np.uint8)]


def _pairs(token):
    codes = _codes(token)
    return np.concatenate([[START], codes[:-1]]) * (START + 1) + codes


def sample_strings(docs, fit_docs=FIT_DOCS):
    """Labelled strings (value, random, held) of at most ``fit_docs`` documents, chosen by hash of their id.

    Only the chosen ids, never texts, pass through the sort; rows that share a chosen id all count.
    ``held`` strings are kept from training; a word is held in all documents or in none.
    """
    chosen = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id")

    def strings(batch):
        for part in small_batches(batch, "text"):
            found = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part.column("text"))):
                spans = base_spans(text)
                secrets = [text[s:e] for s, k, e in spans if k]
                secrets += [m.group(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_RANDOM]
                digest = hashlib.sha256(str(doc_id).encode()).digest()
                secrets += [digest.hex()[:40], _letters(digest, 62)]
                found += [(value, True, _is_held(value)) for value in secrets]
                taken = _Taken(spans)
                words = sorted({m.group() for m in WORD.finditer(text) if taken.free(*m.span())})
                for held in (False, True):
                    some = [w for w in words if _is_held(w) == held]
                    found += [(value, False, held) for value in some + _joined(some, digest)]
                name = str(UUID(bytes=digest[:16], version=4))
                found.append((name, False, _is_held(name)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.bool_()),
                 pa.array([f[2] for f in found], pa.bool_())], ["value", "random", "held"])

    return map_arrow(rows, strings, "value string, random boolean, held boolean")


def _is_held(word):
    return crc32(word.lower().encode()) % HELD == 0


def _letters(digest, size):
    """A string of letters and digits made from the bytes of a digest."""
    return "".join(SYMBOLS[b % size] for b in digest)


def _joined(words, digest):
    """Two to eight words at a time, as identifiers and paths join them, and a rule of each joining sign.

    The bytes of the digest choose how many words are joined, and how: by a sign, by capitals, or by
    capitals behind a short name in capitals.
    """
    out, i, place = ["-" * 16, "_" * 16, "/" * 16] if words else [], 0, 0
    while i < len(words):
        byte = digest[place % len(digest)] + place // len(digest)
        some, style = words[i:i + 2 + byte % 7], byte // 7 % 7
        if style < 4:
            out.append("-_/_"[style].join(w.upper() if style == 3 else w for w in some))
        else:
            first = [some[0], some[0][0].upper() + some[0][1:], some[0][:2 + byte % 3].upper()][style - 4]
            out.append(first + "".join(w[0].upper() + w[1:] for w in some[1:]))
        i, place = i + len(some), place + 1
    return out


class Model:
    """Log ratios of the transitions, and the least ratio per character of a random string in each band.

    ``least`` is infinite in a band without a threshold: the models call no token of it random.
    Answers for short tokens, which repeat, are remembered, for at most ``KNOWN`` of them.
    """

    def __init__(self, table, least):
        self.table, self.least = table, least
        self.known = {}

    def is_random(self, token):
        if (found := self.known.get(token)) is None:
            found = ratio(self.table, token) >= max(len(token) * self.least[band(len(token))], -log(FALSE_RATE))
            if len(token) < BANDS[-1]:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[token] = found
        return found


def band(length):
    """The number of the band of a token's length."""
    return bisect_right(BANDS, length) - 1


def train(strings):
    """The model of labelled strings (value, random, held): tables of those not held, thresholds of those held."""
    table = train_table(strings.where("NOT held"))
    return Model(table, learn_least(strings.where("held AND NOT random"), table))


def train_table(strings):
    """The log ratio of the two transition tables, from labelled strings (value, random).

    Transitions are counted in Spark; the driver gets at most one row per pair of symbols and
    label. Without strings of a label its table is uniform.
    """
    def transitions(batch):
        counts = {}
        for value, random in zip(texts(batch.column("value")), batch.column("random").to_pylist()):
            token = "".join(c for c in value if c in SYMBOLS)
            for p in _pairs(token).tolist() if token else ():
                counts[p, random] = counts.get((p, random), 0) + 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.bool_()),
             pa.array(list(counts.values()), pa.int64())], ["pair", "random", "n"])

    rows = map_arrow(strings.select("value", "random"), transitions, "pair int, random boolean, n bigint").groupBy(
        "pair", "random").agg(F.sum("n").alias("n")).collect()
    counts = np.full((2, START + 1, START), SMOOTHING)
    for r in rows:
        before, symbol = divmod(r.pair, START + 1)
        if symbol < START:
            counts[int(r.random), before, symbol] += r.n
    rates = np.log(counts / counts.sum(axis=2, keepdims=True))
    return np.pad(rates[1] - rates[0], ((0, 0), (0, 1)))


def learn_least(strings, table):
    """The least ratio per character of a random string for each band, from held-out ordinary strings (value).

    It is positive and above all but ``FALSE_RATE`` of the band's strings. A band with fewer than ``LEAST_HELD`` strings takes the largest of the shorter bands, as ratios per
    character spread less the longer strings are. The driver gets one row per band and cell of scores.
    """
    def cells(batch):
        counts = {}
        for value in texts(batch.column("value")):
            if len(value) >= BANDS[0] and TOKEN.fullmatch(value):
                key = band(len(value)), int(np.floor(ratio(table, value) / len(value) / CELL))
                counts[key] = counts.get(key, 0) + 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array(list(counts.values()), pa.int64())], ["band", "cell", "n"])

    rows = map_arrow(strings.select("value"), cells, "band int, cell int, n bigint").groupBy("band", "cell").agg(
        F.sum("n").alias("n")).collect()
    least, largest = [], np.inf
    for number in range(len(BANDS)):
        counted = sorted((r.cell, r.n) for r in rows if r.band == number)
        cell, n = np.array(counted, np.int64).reshape(-1, 2).T
        if n.sum() >= LEAST_HELD:
            above = n.sum() - np.cumsum(n)       # strings in higher cells
            own = max((cell[np.argmax(above <= FALSE_RATE * n.sum())] + 1) * CELL, CELL)
            largest = own if largest == np.inf else max(largest, own)
            least.append(float(own))
        else:
            least.append(float(largest))
    return least


def ratio(table, token):
    """Log-likelihood ratio of a token: above zero if it is more like a random string."""
    return float(table.ravel()[_pairs(token)].sum())


def find_spans(text, model):
    """Base spans and those of tokens outside them that the models call random."""
    base = base_spans(text)
    added, taken = [], _Taken(base)
    for m in TOKEN.finditer(text):
        if taken.free(*m.span()) and model.is_random(m.group()):
            added.append((m.start(), 3, m.end()))
    return base, sorted(base + added)


def scan(docs, model):
    """doc_id and ``spans``, an array of (kind, start, end, base), for each row of (doc_id, text).

    Positions count code points, ends are exclusive. A missing or empty text has no spans; every
    row of the input gives one row.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def spans(batch):
        for part in small_batches(batch, "text"):
            out = []
            for text in texts(part.column("text")):
                _, found = find_spans(text, model)
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": k < 3} for s, k, e in found])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(out, pa.list_(kind))], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(
        rows, spans, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")


def written(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs, fit_docs=FIT_DOCS):
    """Train on a bounded sample of ``docs`` and scan every row."""
    return scan(docs, train(staged(sample_strings(docs, fit_docs), "strings")))
