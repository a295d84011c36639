"""Toxicity by non-negative positive-unlabelled learning.

A logistic model on the distinct words and word stems of a text learns from texts confirmed as
toxic and from texts without a label. An unlabelled text is toxic with the
class's prior probability, so the risk on toxic texts, weighted by the prior, is
taken off the risk of calling unlabelled texts toxic; where that difference falls
below zero, its gradient is turned (the non-negative risk estimator).
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pathkin.llm.arrays import freed, offsets
from pathkin.session import cut_lineage

#: Bounds of the two samples that the model is fitted on.
POSITIVES = 4_000
UNLABELLED = 12_000
#: A word must stand in so many of the samples' texts, whatever their number; the penalty weighs it.
LEAST_TEXTS = 5
EPOCHS = 150
RATE = 0.02
PENALTY = 3e-2
CUT = 0.3
#: Texts that are summed at a time.
TEXTS = 1_000

# ASCII letters in lower case; all other ASCII but digits becomes a space.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


#: Bytes of the stems.
STEMS = (4, 5, 6)


def features(text: str) -> set[bytes]:
    """The distinct words of ``text`` and, as stems, the first bytes of its longer words."""
    words = set(text.encode("utf-8", "surrogatepass").translate(_TABLE).split())
    return words.union(*({w[:n] + b"-" for w in words if len(w) > n} for n in STEMS))


@dataclass
class Model:
    """Weight of each known word, and bias."""

    weights: dict[bytes, float]
    bias: float

    def scores(self, texts: pd.Series) -> pd.Series:
        known = self.weights
        sums = [sum(known[w] for w in known.keys() & features(t or "")) for t in texts]
        margins = np.clip(self.bias + np.array(sums, float), -40, 40)
        return pd.Series(1 / (1 + np.exp(-margins)), dtype="float64")


def fit(positive: list[bytes], unlabelled: list[bytes], words: list[bytes], prior: float) -> Model:
    """The model for a class ``prior``; a text is its features' places in ``words``, as 32-bit numbers."""
    sides = (positive, unlabelled)
    n_words = len(words)
    rows = [
        (np.frombuffer(b"".join(side), "<i4"), offsets(np.array([len(t) // 4 for t in side], np.int64))) for side in sides
    ]

    def parts(side):
        flat, cuts = side
        for a in range(0, len(cuts) - 1, TEXTS):
            c = cuts[a : a + TEXTS + 1]
            yield slice(a, a + TEXTS), flat[c[0] : c[-1]], c - c[0]

    def margins(w: np.ndarray, side) -> np.ndarray:
        out = np.empty(len(side[1]) - 1)
        for at, flat, cuts in parts(side):
            total = np.concatenate([[0.0], np.cumsum(w[flat])])
            out[at] = total[cuts[1:]] - total[cuts[:-1]] + w[-1]
        return out

    def back(gradient: np.ndarray, side) -> np.ndarray:
        out = np.zeros(n_words + 1)
        for at, flat, cuts in parts(side):
            out[:-1] += np.bincount(flat, np.repeat(gradient[at], np.diff(cuts)), n_words)[:n_words]
        out[-1] = gradient.sum()
        return out

    w, first, second = np.zeros(n_words + 1), np.zeros(n_words + 1), np.zeros(n_words + 1)
    prior = min(max(prior, 1e-6), 0.999)
    w[-1] = np.log(prior / (1 - prior))
    n_p, n_u = max(len(sides[0]), 1), max(len(sides[1]), 1)
    average = np.zeros(n_words + 1)
    for step in range(1, EPOCHS + 1):
        f_p, f_u = margins(w, rows[0]), margins(w, rows[1])
        s_p, s_u = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))
        negative = np.logaddexp(0, f_u).sum() / n_u - prior * np.logaddexp(0, f_p).sum() / n_p
        g_negative = back(s_u / n_u, rows[1]) - back(prior * s_p / n_p, rows[0])
        if negative >= 0:
            gradient = back(prior * (s_p - 1) / n_p, rows[0]) + g_negative
        else:
            gradient = -g_negative
        gradient[:-1] += PENALTY * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        if step > EPOCHS // 2:
            average += w / (EPOCHS - EPOCHS // 2)
    scale, shift = calibrate(margins(average, rows[0]), margins(average, rows[1]), prior)
    average *= scale
    average[-1] += shift
    return Model(dict(zip(words, average[:-1].tolist())), float(average[-1]))


def calibrate(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> tuple[float, float]:
    """Scale and shift that make margins those of class probabilities.

    The penalty shrinks margins. Scale and shift minimise the unpenalised
    positive-unlabelled risk, which is convex in them, by Newton's steps.
    """
    if not len(f_p) or not len(f_u):
        return 1.0, 0.0
    x = np.stack([f_u, np.ones(len(f_u))])
    x_p = np.array([f_p.mean(), 1.0])
    theta = np.array([1.0, 0.0])

    def risk(t: np.ndarray) -> float:
        return float(np.logaddexp(0, t @ x).mean() - prior * (t @ x_p) + 1e-4 * (t[0] - 1) ** 2)

    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(theta @ x, -500, 500)))
        gradient = (s * x).mean(axis=1) - prior * x_p + np.array([2e-4 * (theta[0] - 1), 0.0])
        curve = (x * (s * (1 - s))) @ x.T / x.shape[1] + np.diag([2e-4, 1e-9])
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while size > 1e-6 and risk(theta - size * step) > risk(theta):
            size /= 2
        theta = theta - size * step
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def held_out(doc_id: Column) -> Column:
    """Whether crc32(id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string").cast("binary")) % 4 == 2, F.lit(False))


SAMPLED = "side int, doc_id bigint, hash bigint, words array<binary>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the sampled rows (side, doc_id, hash, text); a row that a partition repeats is left out."""
    seen: set[tuple] = set()
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("side", "doc_id", "hash"))))
        new = []
        for k, key in enumerate(keys):
            if key not in seen:
                seen.add(key)
                new.append(k)
        batch = batch.take(pa.array(new, pa.int64()))
        words = [list(features(t)) for t in batch.column("text").to_pylist()]
        columns = [*(batch.column(c) for c in ("side", "doc_id", "hash")), pa.array(words, pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["side", "doc_id", "hash", "words"])


def _numbered(words: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(words)}
        for batch in batches:
            ids = (sorted(place[w] for w in text if w in place) for text in batch.column("words").to_pylist())
            texts = [np.array(x, "<i4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("side"), pa.array(texts, pa.binary())], ["side", "ids"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) of ids that aren't held out.

    Confirmed toxic texts and texts taken without regard to labels are those with
    the smallest hashes of id and text, POSITIVES and UNLABELLED at most; a row that
    repeats counts once. The prior is the share of toxic labels. Without any toxic label every score is the prior's.
    Features are counted and numbered in Spark; only those that are frequent enough,
    and each text's numbers, come to the driver.
    """
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
    marked = marked.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = marked.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.filter(~held_out(F.col("doc_id")))

    def sample(ids: DataFrame | None, n: int, side: int) -> DataFrame:
        # Distinct keys first: texts never meet in one task, and a row that repeats takes one place.
        rows = texts.filter("doc_id is not null").withColumn("hash", F.xxhash64("doc_id", "text", F.lit(side)))
        keys = rows.select("doc_id", "hash").distinct()
        keys = keys if ids is None else keys.join(ids, "doc_id", "left_semi")
        picked = rows.join(F.broadcast(keys.orderBy("hash", "doc_id").limit(n)), ["doc_id", "hash"])
        picked = picked.select(F.lit(side).alias("side"), "doc_id", "hash", "text")
        return picked.mapInArrow(freed(_features), SAMPLED).dropDuplicates(["side", "doc_id", "hash"])

    sampled = sample(marked.filter("toxic = 1").select("doc_id"), POSITIVES, 1).union(sample(None, UNLABELLED, 2))
    sampled = cut_lineage(sampled.select("side", "words"))
    counted = sampled.select(F.explode("words").alias("word")).groupBy("word").count()
    words = sorted(counted.filter(F.col("count") >= LEAST_TEXTS).select("word").toArrow().column("word").to_pylist())
    found = sampled.mapInArrow(freed(_numbered(words)), "side int, ids binary").toArrow()
    by_side: dict[int, list[bytes]] = {1: [], 2: []}
    for side, ids in zip(found.column("side").to_pylist(), found.column("ids").to_pylist()):
        by_side[side].append(ids)
    return fit(sorted(by_side[1]), sorted(by_side[2]), words, share)


def score_of(model: Model) -> Column:
    """The score of column ``text``: from 0 to 1; a null or empty text has the bias alone."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return model.scores(texts)

    return score(F.col("text").cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Every row is answered, repeated ones and those with a null id too; other
    columns are left out.
    """
    out = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("score", score_of(learn(docs, labels)))
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below CUT, with their columns."""
    return docs.filter(score_of(learn(docs, labels)) < CUT)
