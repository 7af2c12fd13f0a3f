"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Lexicons of words and word stems are learned from labelled documents; their densities, the
proximity of hits to second-person words, capitals, punctuation and obfuscation rates are the
features. All are fitted on a bounded sample of labelled rows, cross-fitted: the features of a fold
come from a lexicon learned without it, and the calibration sees raw scores of trees that did not
see the row, so none of them trusts what an earlier one learned by heart, however few labels there are.
"""

import re
from collections import Counter
from functools import reduce
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import map_arrow, small_batches, texts, utf8
from auditloom.storage import few_tasks, staged

FIT_ROWS = 20_000      # labelled rows used, smallest hashes of the id first
FOLDS = 3              # each is left out once; both labels are dealt evenly to them
LEXICON_TERMS = 4_000  # terms kept, best first
LEAST_DOCS = 3         # toxic documents a term must be in
LEAST_ODDS = 2.0       # least log ratio of its document rates
STEMS = (4, 5, 6)      # lengths of word beginnings that count as terms
NEAR = 5               # words between a hit and a second-person word
TREES, DEPTH, STEP = 25, 3, 0.2
SEED = 7

WORD = re.compile(r"[^\W\d_]+")
# a whole run of letters, digits and marks with a mark in it; tried only where a run begins, so scans are linear
MASKED = re.compile(r"(?<![\w@$!*#+])[^\W0134578]*+[@$!*#0134578+][\w@$!*#+]*+")
LETTER = re.compile(r"[^\W\d_]")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
PLAIN = str.maketrans("@$!013457", "asioieast")
SPACED = re.compile(r"\b(?:[^\W\d_][ .*-]){3,}[^\W\d_]\b")

# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner deinem deinen ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra vuestros".split())

FEATURES = (
    "word_density", "stem_density", "word_hits", "stem_hits", "word_kinds", "odds_density", "odds_most", "near_second",
    "second_density", "capitals", "shouted", "exclamations", "questions", "punctuation", "symbols", "digits",
    "obfuscated", "obfuscated_hits", "spaced", "length")
_SCHEMA = ", ".join(f"{f} double" for f in FEATURES)


def held_out(doc_id):
    """Rows whose labels are never used: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def terms_of(word):
    """A word and its beginnings; a stem is marked by a closing dash."""
    return [word, *[word[:n] + "-" for n in STEMS if len(word) > n]]


class Lexicon:
    """Terms with the log ratio of their document rates in toxic and other documents."""

    def __init__(self, odds):
        self.odds = odds
        self.found = {}

    def best(self, word):
        """(odds as a word, odds as a stem) of a word; remembered, for at most a million words."""
        if (known := self.found.get(word)) is None:
            terms = terms_of(word)
            stems = [self.odds[t] for t in terms[1:] if t in self.odds]
            known = self.odds.get(word, 0.0), max(stems, default=0.0)
            if len(self.found) > 1_000_000:
                self.found.clear()
            self.found[word] = known
        return known


def _byte_rates(data):
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(len(data), 1)
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    symbols = sum(int(counts[ord(c)]) for c in "#$%&*@^~<>|=+")
    return (upper / max(upper + lower, 1), counts[33] / size, counts[63] / size, marks / size, symbols / size,
            digits / size)


def features(data, text, lexicon):
    """The features of a text, given as UTF-8 and as a string, in the order of ``FEATURES``."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    n = max(len(words), 1)
    word_hits = stem_hits = odds = most = second = kinds = 0
    hit_words = set()
    for word, times in Counter(words).items():
        as_word, as_stem = lexicon.best(word)
        if as_word:
            word_hits += times
            kinds += 1
        if as_stem:
            stem_hits += times
        if as_word or as_stem:
            hit_words.add(word)
            odds += times * max(as_word, as_stem)
            most = max(most, as_word, as_stem)
        if word in SECOND_PERSON:
            second += times
    near = 0
    if hit_words and second:
        last_hit = last_second = -n - NEAR
        for i, word in enumerate(words):
            if word in hit_words:
                near += i - last_second <= NEAR
                last_hit = i
            elif word in SECOND_PERSON:
                near += i - last_hit <= NEAR
                last_second = i
    hidden = [w for w in MASKED.findall(text) if LETTER.search(w)]
    unmasked = sum(lexicon.best(w.lower().translate(PLAIN).strip("*#8+"))[0] > 0 for w in hidden)
    spaced = SPACED.findall(lowered)
    unmasked += sum(lexicon.best(re.sub(r"[ .*-]", "", w))[0] > 0 for w in spaced)
    capitals, exclaim, ask, marks, symbols, digits = _byte_rates(data)
    return (word_hits / n, stem_hits / n, log1p(word_hits), log1p(stem_hits), log1p(kinds), odds / n, float(most),
            near / n, second / n, capitals, len(SHOUTED.findall(text)) / n, exclaim, ask, marks, symbols, digits,
            len(hidden) / n, unmasked / n, len(spaced) / n, log1p(len(words)))


def _with_features(docs, lexicon, carried):
    """Rows of (text, *carried) with the feature columns in place of the text."""
    kept = [f.name for f in docs.schema if f.name in carried]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)

    def batches(batch):
        for part in small_batches(batch, "text"):
            rows = [features(d, t, lexicon) for d, t in zip(utf8(part.column("text")), texts(part.column("text")))]
            columns = [pa.array(np.array(c, np.float64)) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *columns], [*kept, *FEATURES])

    return map_arrow(docs.select(*kept, "text"), batches, f"{kinds}, {_SCHEMA}")


def fit_sample(docs, labels, fit_rows=FIT_ROWS):
    """Staged rows (text, toxic, fold): at most ``fit_rows`` labelled ids, none of them held out.

    Of several labels of an id the larger counts. Only ids and labels pass through the sort; a
    chosen id that many rows share is represented by its greatest text.
    """
    ids = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = ids.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # the window sees ids and labels of the bounded sample only
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id"))
    chosen = staged(chosen.withColumn("fold", (place % FOLDS).cast("int")), "chosen")
    return staged(
        rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"), F.max("fold").alias("fold")), "labelled")


def term_counts(sample):
    """Staged rows (term, toxic, fold, n): in how many texts of a fold and label each term is."""
    def counts(batch):
        found = Counter()
        for part in small_batches(batch, "text"):
            for text, toxic, fold in zip(
                    texts(part.column("text")), part.column("toxic").to_pylist(), part.column("fold").to_pylist()):
                for term in {t for w in set(WORD.findall(text.lower())) for t in terms_of(w)}:
                    found[term, toxic, fold] += 1
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())],
            ["term", "toxic", "fold", "n"])

    rows = map_arrow(sample.select("text", "toxic", "fold"), counts, "term string, toxic int, fold int, n bigint")
    return staged(rows.groupBy("term", "toxic", "fold").agg(F.sum("n").alias("n")), "terms")


def learn_lexicon(counts, sizes, without=-1):
    """The terms whose document rate is much larger in toxic documents; a bounded number of them.

    ``counts`` is ``term_counts``, ``sizes`` the texts by (fold, toxic); the fold ``without`` is left out.
    """
    bad, good = [sum(n for (fold, toxic), n in sizes.items() if toxic == kind and fold != without) for kind in (1, 0)]
    in_bad = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0))
    in_good = F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0))
    terms = counts.where(F.col("fold") != without).groupBy("term").agg(
        in_bad.alias("bad"), in_good.alias("good")).where(F.col("bad") >= LEAST_DOCS)
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) - F.lit(log((bad + 1) / (good + 1)))
    best = terms.withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS).orderBy(
        F.desc("odds"), F.desc("bad"), "term").limit(LEXICON_TERMS)
    return Lexicon({r.term: r.odds for r in best.collect()})


class Model:
    """Lexicon (it may be empty), trees and calibration; with fewer than two labels of a kind, a constant."""

    def __init__(self, lexicon, trees, calibration, constant):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, rows):
        """Add ``score`` to rows of (text, any others), in place of the text."""
        kept = [c for c in rows.columns if c != "text"]
        if self.trees is None:
            return rows.select(*kept, F.lit(float(self.constant)).alias("score"))
        scored = _raw_scores(_with_features(rows, self.lexicon, kept), self.trees)
        return self.calibration.transform(scored).select(*kept, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def _raw_scores(rows, trees):
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(rows)
    return trees.transform(assembled).withColumn("raw", vector_to_array("probability")[1])


def train(docs, labels, fit_rows=FIT_ROWS):
    """Fit on labelled rows that are not held out; see ``fit_sample`` for the bound.

    With fewer than two labelled rows of a kind nothing can be confirmed by another row, and the
    score is a constant: 1 if there are more toxic rows than others, else 0.
    """
    sample = fit_sample(docs, labels, fit_rows)
    sizes = {(r.fold, r.toxic): r.n for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = [sum(n for (_, toxic), n in sizes.items() if toxic == kind) for kind in (1, 0)]
    if min(bad, good) < 2:
        return Model(None, None, None, float(bad > good))
    counts = term_counts(sample)
    folds = [
        _with_features(sample.where(F.col("fold") == i), learn_lexicon(counts, sizes, i), ["doc_id", "toxic", "fold"])
        for i in range(FOLDS)]
    rows = staged(reduce(lambda one, other: one.unionByName(other), folds), "features").withColumn(
        "label", F.col("toxic").cast("double"))

    def grow(without=-1):
        # one order and one partition, of bounded size, whatever the cluster: the same trees each time
        fit = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(
            rows.where(F.col("fold") != without).coalesce(1).sortWithinPartitions("doc_id"))
        return GBTClassifier(
            featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED).fit(fit)

    # one fit after the other, as each takes room on the driver
    unseen = [_raw_scores(rows.where(F.col("fold") == i), grow(i)).select("label", "raw") for i in range(FOLDS)]
    # equal raw scores, of which there are few, meet in one task: they are averaged first
    held = staged(few_tasks(reduce(lambda one, other: one.unionByName(other), unseen).groupBy("raw").agg(
        F.avg("label").alias("label"), F.count("*").cast("double").alias("weight")), bad + good), "calibration")
    calibration = IsotonicRegression(
        featuresCol="raw", labelCol="label", predictionCol="score", weightCol="weight").fit(held)
    return Model(learn_lexicon(counts, sizes), grow(), calibration, 0.0)


def score(docs, model):
    """doc_id, held_out, score and predicted for each row of (doc_id, text); further columns are ignored.

    A missing or empty text gets the score of its features, which are all zero. A missing id counts
    as held out. Repeated rows get equal scores; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return model.score(rows).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs, model):
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").cast("string").alias("text"))
    return model.score(rows).where("score < 0.5").select("doc.*")
