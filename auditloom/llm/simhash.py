"""SimHash fingerprints and their near-duplicate classes by a self-join of a binary trie.

The trie over the distinct fingerprints is walked level by level. A frontier row is a pair of
nodes of one depth with the bits they differ in. A child of the one node names all nodes that lie
within the error budget below the other one, and an equality join finds those that exist, so no
children are compared pair by pair. Of two fingerprints within k bits,
either the upper halves differ in at most k/2 bits, or the lower halves in at most (k-1)/2. So the
trie is walked once in bit order with budget k/2 inside the upper half, and once with the halves
exchanged and budget (k-1)/2, which keeps frontiers near the number of nodes. With a budget of one bit at most
the first step takes the whole half: higher up, where the trie is full, nearly every node has a
neighbour. Below the half the budget is k less the bits already spent.
"""

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm.common import map_arrow, small_batches, utf8
from auditloom.llm.components import connected_components
from auditloom.storage import concurrently, few_tasks, staged

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
BITS = 64
HALF = BITS // 2
STRIDE = 8                # bits a frontier descends at once
CHUNK = 200_000           # shingles whose bits are unpacked at once


def fingerprint(value, words=SHINGLE_WORDS, seed=SEED):
    """The signed 64-bit SimHash of a text given as UTF-8; 0 for a text without words."""
    from xxhash import xxh64_digest

    tokens = value.lower().split()
    if not tokens:
        return 0
    data = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(tokens) >= words:
        starts, ends = starts[:len(tokens) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i:i + CHUNK].tolist(), ends[i:i + CHUNK].tolist())
        hashes = np.frombuffer(b"".join([xxh64_digest(data[a:b], seed) for a, b in spans]), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs, words=SHINGLE_WORDS, seed=SEED):
    """doc_id and fingerprint (bigint) of each row of (doc_id, text); a missing text is empty."""
    def signed(batch):
        for part in small_batches(batch, "text"):
            found = [fingerprint(x, words, seed) for x in utf8(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(rows, signed, "doc_id bigint, fingerprint bigint")


def _prefix(key, depth):
    if depth == 0:    # a shift by all bits is none
        return F.lit(0).cast("bigint")
    return F.shiftrightunsigned(key, BITS - depth) if depth < BITS else F.col(key)


def _nodes(keys, depth, to):
    """The trie's nodes at depth ``to``: parent at ``depth``, node, number of keys, and the keys of one that holds three at most."""
    nodes = keys.groupBy(_prefix("key", depth).alias("a"), _prefix("key", to).alias("x")).agg(
        F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.bit_xor("key").alias("all"))
    middle = F.col("all").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))
    return nodes.select("a", "x", "n", F.when(F.col("n") == 1, F.array("low")).when(F.col("n") == 2, F.array("low", "high"))
                        .when(F.col("n") == 3, F.array("low", "high", middle)).alias("ax"))


def _masks(bits, most):
    return [sum(1 << i for i in places) for n in range(min(most, bits) + 1) for places in combinations(range(bits), n)]


def _flips(bits, most):
    """The whole numbers of ``bits`` bits of which at most ``most`` are set."""
    return F.array(*[F.lit(mask).cast("bigint") for mask in _masks(bits, most)])


def _walk(keys, n, upper, budget):
    """Pairs of different keys that differ in at most ``budget`` bits, and in at most ``upper`` of the upper half.

    ``n`` is the number of keys.

    A frontier row is a pair of nodes of one depth with the bits they differ in so far. A node with
    at most three keys is a leaf: pairs of leaves are compared whole and leave the walk, other pairs go on
    with their children, down to the last bit where there are that many keys.
    """
    found = []
    depth = HALF if upper <= 1 else 2 * STRIDE
    nodes = _nodes(keys, 0, depth).drop("a")
    pairs = nodes.withColumn("flips", F.explode(_flips(depth, upper))).select(
        "x", "n", "ax", F.col("x").bitwiseXOR(F.col("flips")).alias("y"), F.bit_count("flips").alias("diff"))
    pairs = pairs.where("x <= y").join(nodes.select(F.col("x").alias("y"), F.col("ax").alias("by")), "y")
    read = n + n * len(_masks(depth, upper))   # rows that meet in the join, at most
    while True:
        alone = (F.col("x") == F.col("y")) & (F.size("ax") == 1)
        pairs = pairs.where(~F.coalesce(alone, F.lit(False))).select("x", "n", "ax", "y", "by", "diff")
        pairs = staged(few_tasks(pairs, read), "frontier")
        leaves = F.col("ax").isNotNull() & F.col("by").isNotNull()
        met = pairs.where(leaves).select("x", "y", F.explode("ax").alias("a"), "by").withColumn("b", F.explode("by"))
        found.append(met.where("a < b OR (x <> y AND a > b)").select("a", "b"))
        frontier = pairs.where(~leaves).select(F.col("x").alias("a"), "n", F.col("y").alias("b"), "diff")
        to = min(depth + STRIDE, HALF if depth < HALF else BITS)
        # a node has a child for each of its keys at most
        children = depth < BITS and frontier.agg(F.sum(F.least("n", F.lit(1 << (to - depth)).cast("bigint")))).first()[0]
        if not children:
            return reduce(lambda one, other: one.unionByName(other), found)
        frontier = frontier.drop("n")
        # only keys below a node of the frontier are looked at again
        wanted = frontier.select(F.explode(F.array("a", "b")).alias("wanted")).distinct()
        left = _nodes(keys.join(wanted, _prefix("key", depth) == F.col("wanted"), "left_semi"), depth, to)
        right = left.select(F.col("x").alias("y"), F.col("ax").alias("by"))
        limit = upper if to <= HALF else budget
        flips = F.filter(_flips(to - depth, limit), lambda m: F.bit_count(m) <= limit - F.col("diff"))
        fresh = F.col("x").bitwiseAND(F.lit((1 << (to - depth)) - 1)).bitwiseXOR(F.col("flips"))
        pairs = frontier.join(left, "a").withColumn("flips", F.explode(flips)).select(
            "a", "b", "x", "n", "ax", F.shiftleft("b", to - depth).bitwiseOR(fresh).alias("y"),
            (F.col("diff") + F.bit_count("flips")).alias("diff"))
        pairs = pairs.where("a <> b OR x <= y").join(right, "y")
        read = n + children * len(_masks(to - depth, limit))
        depth = to


def links(keys, max_bits=MAX_BITS):
    """Pairs (a, b) of the distinct fingerprints in ``keys`` (key) within ``max_bits`` bits.

    Node pairs over the budget leave the walk where they exceed it, so fingerprints that share a half
    or stem from one template are told apart further down instead of being compared pair by pair.
    """
    a, b = F.col("a"), F.col("b")
    upper = F.bit_count(F.shiftrightunsigned(a.bitwiseXOR(b), HALF))
    within = F.bit_count(a.bitwiseXOR(b)) <= max_bits
    n = keys.count()
    if max_bits == 0:
        return _walk(keys, n, 0, 0).where(within)
    turned = keys.select(F.shiftleft("key", HALF).bitwiseOR(F.shiftrightunsigned("key", HALF)).alias("key"))
    lower = F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit((1 << HALF) - 1)))   # the upper half, turned
    # both walks have many small steps, so they go side by side
    straight, other = concurrently(
        keys.sparkSession, lambda: _walk(keys, n, max_bits // 2, max_bits),
        lambda: _walk(turned, n, (max_bits - 1) // 2, max_bits))
    straight = straight.where(within & (upper <= max_bits // 2))
    other = other.where(within & (upper <= (max_bits - 1) // 2) & (lower > max_bits // 2))
    back = [F.shiftleft(c, HALF).bitwiseOR(F.shiftrightunsigned(c, HALF)).alias(c) for c in ("a", "b")]
    return straight.unionByName(other.select(*back))


def near_duplicates(docs, words=SHINGLE_WORDS, max_bits=MAX_BITS, seed=SEED):
    """doc_id, fingerprint (16 hex digits), component_id and size for each row of (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits`` bits; rows
    without an id belong to components, but name none (it is missing if no row of the component
    has an id). Empty and missing texts have fingerprint zero and link like any other. Copies share
    one fingerprint and are counted before any join. An empty table gives no rows.
    """
    rows = staged(fingerprints(docs, words, seed), "fingerprints")
    n = rows.count()
    classes = staged(few_tasks(rows.groupBy("fingerprint").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies")), n), "classes")
    found = staged(links(classes.select(F.col("fingerprint").alias("key")), max_bits), "links")
    roots = connected_components(found).withColumnRenamed("node", "fingerprint")
    classes = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = classes.groupBy("root").agg(
        F.min("least").alias("component_id"), F.sum("copies").alias("component_size"))
    classes = staged(few_tasks(
        classes.join(named, "root").select("fingerprint", "component_id", "component_size"), 2 * n), "named")
    return rows.join(classes, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id", "component_size")
