"""Token ids as ORC: run-length encoded integers, row indexes and Bloom filters on document ids.

Documents are range partitioned and sorted by id before they are tokenised, so ids ascend over
the files, and stripes and row groups hold narrow id ranges. A reader that filters on ``doc_id``
skips stripes by their minimum and maximum, and row groups by Bloom filter; a scan without a
filter is split by stripes.
"""

import os
import string
import zlib
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import map_arrow, small_batches, utf8

END_ID = 1
CACHE_WORDS = 1_000_000   # distinct words a worker remembers
LONG_WORD = 64          # bytes; longer words are rarely seen again
MARKS = string.punctuation
ROW_INDEX_STRIDE = 1_000
STRIPE_BYTES = 16 << 20

TOKENS = "doc_id bigint, ids array<int>, n_tokens bigint"
FILE_SCHEMA = f"{TOKENS}, shard int, pos bigint"


class _Words(dict):
    """A form of the ids of words; an unknown word is encoded when asked for.

    Forms of words add up: bytes of ids, or their number. Closing marks after a letter are a piece of their
    own, and capitals A-Z are lower-cased, by the tokenizer itself as well. So such a word takes the form
    of its plain one. Not so in a special token's name. A word of ASCII and Latin-1 letters alone is one
    piece, so it goes to the tokenizer's model directly, without the steps before it.
    """

    def __init__(self, tokenizer, form):
        super().__init__()
        self.tokenizer, self.form, self.model = tokenizer, form, tokenizer.model
        self.letters, self.forms = frozenset(), {}
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        if tokenizer.pre_tokenizer is not None:
            self.forms = {ord(c): "".join(p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in letters}
            probes = ["".join(letters), *letters, "hello", "École"]
            if all(self._piece(x) == self._whole(x) for x in probes):
                self.letters = frozenset(letters)

    def _whole(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, text):
        return [t.id for t in self.model.tokenize(text.lower().translate(self.forms))]

    def __missing__(self, word):
        text = word.decode("utf-8", "replace")
        if (tail := len(text) - len(text.rstrip(MARKS))) and text[:-tail][-1:] in self.letters and "<|" not in text:
            value = self[word[:-tail]] + self[word[-tail:]]
        elif self.letters.issuperset(text):
            value = self.form(self._piece(text))
        elif text.isascii() and (plain := word.lower()) != word and "<|" not in text:
            value = self[plain]
        else:
            value = self.form(self._whole(text))
        if len(word) <= LONG_WORD:
            self[word] = value
        return value


class WordEncoder:
    """Encodes texts word by word and remembers the ids of words, or the numbers of their ids.

    The tokenizer must treat words between ASCII white space on their own, as one does that
    drops white space while it splits, and lower-case; then the ids of a text are those of its words.
    """

    def __init__(self, path, cache_words=CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.cache_words = cache_words
        tokenizer = Tokenizer.from_file(path)
        self.known = _Words(tokenizer, lambda ids: array("I", ids).tobytes())
        self.sizes = _Words(tokenizer, len)

    def _look_up(self, words):
        if len(words) > self.cache_words:    # forget the half that came first
            for word in list(islice(words, len(words) - self.cache_words // 2)):
                del words[word]
        return words.__getitem__

    def encode(self, values):
        """For each text, as UTF-8, its ids as little-endian unsigned 32-bit integers."""
        find = self._look_up(self.known)
        return [b"".join(map(find, v.split())) for v in values]

    def count(self, values):
        """For each text, as UTF-8, the number of its ids."""
        find = self._look_up(self.sizes)
        return [sum(map(find, v.split())) for v in values]


_encoders = {}


def encoder(path):
    """The encoder of this Python worker, kept over tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def count_tokens(docs, tokenizer_path):
    """n_tokens (with the end id) in place of the text of each row of (text, any others); no ids are built."""
    kept = [c for c in docs.columns if c != "text"]

    def count(batch):
        for part in small_batches(batch, "text"):
            sizes = encoder(tokenizer_path).count(utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], pa.array(np.array(sizes, np.int64) + 1)], [*kept, "n_tokens"])

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in kept)
    return map_arrow(docs.select(*kept, "text"), count, f"{kinds}n_tokens bigint")


def tokenize(docs, tokenizer_path, end_id=END_ID):
    """doc_id, ids and n_tokens of each row of (doc_id, text), in the same order and partitions."""
    end = array("I", [end_id]).tobytes()

    def encode(batch):
        for part in small_batches(batch, "text"):
            encoded = encoder(tokenizer_path).encode(utf8(part.column("text")))
            sizes = np.fromiter((len(x) // 4 + 1 for x in encoded), np.int64, len(encoded))
            flat = np.frombuffer(b"".join([x + end for x in encoded]), "<i4")
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), ids, pa.array(sizes)], ["doc_id", "ids", "n_tokens"])

    return map_arrow(docs, encode, TOKENS)


def write_tokens(docs, path, tokenizer_path, end_id=END_ID, shards=None, stripe_bytes=STRIPE_BYTES):
    """Write the token ids of ``docs`` (doc_id, text; further columns are ignored) as ORC.

    A missing or empty text gives the end id alone. Rows come in ascending doc_id, missing ids
    first; rows with one id are ordered by text, and equal rows are all kept. Ids with very many
    rows are split over files, as the ranges are cut by id and text. An empty table gives files
    without rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    order = ["doc_id", "_tie"]
    rows = rows.repartitionByRange(*([shards] if shards else []), *order)
    rows = rows.sortWithinPartitions(*order, "text").select("doc_id", "text")
    tokens = tokenize(rows, tokenizer_path, end_id)
    tokens = tokens.withColumns({
        "shard": F.spark_partition_id(),
        "pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    (tokens.write.option("compression", "zstd").option("orc.create.index", "true")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE).option("orc.stripe.size", stripe_bytes)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark, path, doc_ids=None, low=None, high=None):
    """The written rows; a list or a range of ids prunes stripes and row groups by metadata."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(list(doc_ids)))
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def _crc(batch):
    lists = batch.column("ids")
    data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
    ends = lists.offsets.to_numpy()
    crc = [zlib.crc32(data[4 * int(a):4 * int(b)]) for a, b in zip(ends[:-1], ends[1:])]
    keep = ("doc_id", "shard", "pos")
    yield pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in keep], pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
        [*keep, "n_tokens", "ids_crc32"])


def token_index(tokens):
    """Per document: doc_id, start (ids of all documents before it), n_tokens and crc32 of the ids.

    Starts are running totals inside a shard plus the totals of earlier shards, of which there is
    one row per shard, read from the n_tokens column alone.
    """
    rows = map_arrow(
        tokens.select("doc_id", "ids", "shard", "pos"), _crc,
        "doc_id bigint, shard int, pos bigint, n_tokens bigint, ids_crc32 bigint")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    shards = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("_size"))
    shards = shards.select("shard", F.coalesce(
        F.sum("_size").over(before.orderBy("shard")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_tokens").over(before.partitionBy("shard").orderBy("pos")), F.lit(0))
    return rows.withColumn("_inside", inside).join(shards, "shard").select(
        "doc_id", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32")
