"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its distinct words; a word is the character n-grams of the
word between two boundary marks. The n-gram's value is its log-count ratio
between toxic and clean training texts, and a logistic regression learns a
weight for each value. As the model is linear, a text's log-odds are an
intercept plus the sum of one number for each of its distinct words, so scoring
is one look-up a word.

The classifier is fitted on a sample of labelled rows bounded by ``per_class``:
those of each class with the smallest hash of their id. Scoring reads every
text whole. Labels, language, source and id are never inputs of a score.

Null texts are empty and get the intercept alone; a class without any training
row gives the share of the other class as every score; no labels at all give 0.
Repeated ids: every row is scored by its text; a label counts once for each text
it joins. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidflow.llm.common import batch, doc_crc, mix64, pieces

#: Labelled rows of each class that the classifier is fitted on, at most.
PER_CLASS = 1500
ORDERS = (3, 4, 5, 6)
BITS = 18
_WORD = re.compile(r"\w+")
_ARROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def distinct_words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def word_grams(words: list[str], wanted: np.ndarray | None = None) -> np.ndarray:
    """The distinct pairs of a word's number and an n-gram's bucket, ``number << BITS | bucket``, sorted; ``wanted`` buckets only."""
    if not words:
        return np.zeros(0, np.int64)
    chars = np.frombuffer("".join(f"\2{w}\3" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    hashed = mix64(chars + np.uint64(1))
    found, rolling = [], np.zeros(len(chars), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(chars) - n + 1
        if m <= 0:
            break
        rolling = mix64(rolling[:m] * np.uint64(31) + hashed[n - 1 :])
        if n in ORDERS:
            bucket = (rolling >> np.uint64(64 - BITS)).astype(np.int64)
            inside = word[:m] == word[n - 1 :]
            if wanted is not None:
                inside &= wanted[bucket]
            found.append((word[:m][inside] << BITS) | bucket[inside])
    return np.unique(np.concatenate(found))


@dataclass
class Model:
    """``weights`` by bucket and the intercept; ``constant`` replaces both where a class had no rows."""

    weights: np.ndarray
    intercept: float
    constant: float | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """What each word adds to the log-odds: the weights of its n-grams, each once."""
        pairs = word_grams(words, self.weights != 0)
        grams, word = pairs & ((1 << BITS) - 1), pairs >> BITS
        return np.bincount(word, self.weights[grams].astype(np.float64), len(words))


def fit(texts: list[set[str]], labels: list[int], *, share_toxic: float | None = None, rounds: int = 150, ridge: float = 1e-4, alpha: float = 1.0, errors: float = 3.5) -> Model:
    """Fit on sets of words. The classes weigh as in ``share_toxic``, the share of toxic ones among all labelled rows (by default
    among these), which is where the intercept starts.

    n-grams whose ratio is within ``errors`` standard errors of 0 have no weight: in a text of thousands of clean
    words their chance ratios would add up to more than a few toxic words.
    """
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0, float(y.mean()) if len(y) else 0.0)
    words = sorted(set().union(*texts))
    index = {w: i for i, w in enumerate(words)}
    sizes = np.array([len(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    word = np.fromiter((index[w] for t in texts for w in t), np.int64, sizes.sum())
    order = np.lexsort((word, doc))
    doc, word = doc[order], word[order]
    grams, owner = [], []
    for at in range(0, len(words), 20_000):  # in parts, for memory
        pairs = word_grams(words[at : at + 20_000])
        grams.append((pairs & ((1 << BITS) - 1)).astype(np.int32))
        owner.append((at + (pairs >> BITS)).astype(np.int32))
    grams, owner = np.concatenate(grams), np.concatenate(owner)
    first = np.searchsorted(owner, np.arange(len(words) + 1))
    # How many training texts of each class have each n-gram, a text counted once.
    have = np.zeros((2, 1 << BITS))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    for i in range(len(texts)):
        own = word[bounds[i] : bounds[i + 1]]
        if len(own):
            mine = np.zeros(1 << BITS, bool)
            mine[np.concatenate([grams[first[w] : first[w + 1]] for w in own])] = True
            have[labels[i]] += mine
    clean, toxic = have[0] + alpha, have[1] + alpha
    ratio = np.log(toxic / toxic.sum()) - np.log(clean / clean.sum())
    ratio[np.abs(ratio) < errors * np.sqrt(1 / toxic + 1 / clean)] = 0
    keep = ratio[grams] != 0
    grams, owner = grams[keep], owner[keep]
    value = ratio[grams]
    prior = float(np.clip(y.mean() if share_toxic is None else share_toxic, 1e-6, 1 - 1e-6))
    w, b = np.zeros(1 << BITS), math.log(prior / (1 - prior))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    share = np.where(y > 0, prior / y.sum(), (1 - prior) / (len(y) - y.sum()))
    for step in range(1, rounds + 1):
        each = np.bincount(owner, value * w[grams], len(words))
        z = b + np.bincount(doc, each[word], len(texts))
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        grad = np.bincount(grams, value * np.bincount(word, err[doc], len(words))[owner], 1 << BITS) + ridge * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        down, up = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.02 * (m / down) / (np.sqrt(v / up) + 1e-8)
        b -= 0.02 * (mb / down) / (np.sqrt(vb / up) + 1e-8)
    return Model((w * ratio).astype(np.float32), float(b))


def sample(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, per_class: int, held_out: Column) -> tuple[list[set[str]], list[int], float]:
    """The words and labels of the training texts, on the driver, at most ``per_class`` of each class; and the share of toxic ones among all."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out).select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("int").alias("label")).distinct()
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    of = lambda c: usable.where(F.col("label") == c).orderBy(F.xxhash64("k"), "k").limit(per_class)
    chosen = of(1).unionAll(of(0))
    texts = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "k")

    def words(batches):
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("label"), pa.array([" ".join(sorted(distinct_words(t))) for t in b.column("text").to_pylist()], pa.string())], names=["k", "label", "words"])

    rows = sorted(tuple(r) for r in texts.mapInArrow(words, "k long, label int, words string").collect())
    return [set(r[2].split()) for r in rows], [r[1] for r in rows], counts.get(1, 0) / max(1, sum(counts.values()))


class Scorer:
    """Scores texts with a model, keeping the scores of the words seen."""

    def __init__(self, model: Model, cached_words: int = 500_000):
        self.model, self.most, self.cache = model, cached_words, {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        sets, cache = [distinct_words(t) for t in texts], self.cache
        unseen = list({w for s in sets for w in s if w not in cache})
        if len(cache) + len(unseen) > self.most:
            cache.clear()
            unseen = list(set().union(*sets))
        cache.update(zip(unseen, self.model.word_scores(unseen).tolist(), strict=True))
        z = np.array([self.model.intercept + math.fsum(map(cache.__getitem__, s)) for s in sets])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        scorer = Scorer(shared.value)
        for b in pieces(batches):
            yield batch(_ARROW, doc_id=b.column(0), score=scorer(b.column(1).to_pylist()))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scored, "doc_id long, score double")


def below(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores less than ``threshold``, with all their columns, where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        scorer = Scorer(shared.value)
        for b in pieces(batches):
            yield b.filter(pa.array(scorer(b.column(text_col).to_pylist()) < threshold))

    return docs.mapInArrow(kept, docs.schema)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, held_out: Column | None = None) -> Model:
    """``held_out``: a condition on the labels' rows that are never learnt from (by default those whose crc32 of the id mod 5 is 0)."""
    if held_out is None:
        held_out = doc_crc(F.col(id_col)) % 5 == 0
    texts, classes, share = sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_class=per_class, held_out=held_out)
    return fit(texts, classes, share_toxic=share)


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: rows whose score is 0.5 or more go; the others keep all their columns."""
    return below(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score and prediction of every document; rows with crc32(doc_id) mod 5 = 0 are held out."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (doc_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
