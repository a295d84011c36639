"""Quality rules: limits on simple statistics, and robust multivariate outliers.

Texts that pass the limits are vectors of transformed statistics. For each
language and source the centre and covariance of the tightest three quarters of
the vectors (minimum covariance determinant) are found by concentration steps;
vectors far from the centre in Mahalanobis distance are rejected.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pathkin.llm.arrays import freed
from pathkin.session import cut_lineage

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
P = 5
KEEP = 0.75
STEPS = 4
#: Groups with fewer vectors are pooled within their language, and those of rare languages together.
LEAST_ROWS = 100
#: Added to each variance: differences of this size never count as large.
FLOOR = np.array([0.5, 0.1, 0.1, 0.1, 0.15]) ** 2
#: Largest squared distance that is kept: the 0.9999 quantile for a normal vector.
CUTOFF = 25.74


def text_stats(text: str) -> tuple[int, int, int, int, int]:
    """STATS of a whole text. Lines are cut at \\n; a repeated line holds a word and equals
    an earlier one; a repeated word stands in a window of three words found twice or more."""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)] if "\n" in text else []
    repeat = 0
    if len(words) > 3:
        places: dict[bytes, int] = {}
        x = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words))
        n = len(places)
        pairs = np.unique(x[:-1] * n + x[1:], return_inverse=True)[1]
        windows = pairs[:-1] * n + x[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        if twice.any():
            inside = np.zeros(len(words), bool)
            for k in range(3):
                inside[k : k + len(twice)] |= twice
            repeat = int(inside.sum())
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeat


@F.pandas_udf(T.StructType([T.StructField(s, T.LongType()) for s in STATS]))
def stats_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t or "") for t in texts], columns=list(STATS), dtype="int64")


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_s`` of statistics, whether the limits fail, and the vector."""
    s = F.col("_s")
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    vector = F.array(
        F.log(s["n_words"].cast("double")),
        F.log(s["word_chars"] / s["n_words"]),
        F.sqrt(s["n_symbols"] / s["word_chars"]),
        F.sqrt(s["n_dup_lines"] / s["n_words"]),
        F.sqrt(s["n_repeat_words"] / s["n_words"]),
    )
    out = docs.withColumn("_s", stats_of(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return out.withColumn("_failed", failed).withColumn("_x", F.when(~F.col("_failed"), vector))


def _chi2_below(x: float, k: int) -> float:
    """Chi-squared distribution function for ``k`` degrees of freedom, by its series."""
    a, h = k / 2, x / 2
    term = total = math.exp(a * math.log(h) - h - math.lgamma(a + 1))
    for n in range(1, 200):
        term *= h / (a + n)
        total += term
    return total


def _consistency() -> float:
    """By how much the covariance of the inner KEEP of normal vectors falls short."""
    low, high = 0.0, 100.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_below(mid, P) < KEEP else (low, mid)
    return KEEP / _chi2_below(low, P + 2)


GROUP = "g_lang string, g_source string"
ESTIMATE = f"{GROUP}, mu array<double>, whiten array<double>"


def _whitening(mu: np.ndarray, cov: np.ndarray) -> list[float]:
    return np.linalg.inv(np.linalg.cholesky(cov + np.diag(FLOOR))).ravel().tolist()


def _start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First estimate of each group: medians, and quarter distances for the spread."""
    for rows in batches:
        mu, whiten = [], []
        for q in rows.pop("q"):
            q = np.array([list(x) for x in q])
            mu.append(q[:, 1].tolist())
            whiten.append(_whitening(q[:, 1], np.diag(((q[:, 2] - q[:, 0]) / 1.349) ** 2)))
        yield rows.assign(mu=mu, whiten=whiten)


def _refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    factor = _consistency()
    for rows in batches:
        mu, whiten = [], []
        for n, s1, s2, old in zip(rows.pop("n"), rows.pop("s1"), rows.pop("s2"), rows.pop("old")):
            shift = np.array(s1, float) / n
            cov = np.zeros((P, P))
            cov[np.triu_indices(P)] = np.array(s2, float) / n
            cov = cov + np.triu(cov, 1).T - np.outer(shift, shift)
            centre = np.array(old, float) + shift
            mu.append(centre.tolist())
            whiten.append(_whitening(centre, factor * (cov + 1e-12 * np.eye(P))))
        yield rows.assign(mu=mu, whiten=whiten)


def distance() -> Column:
    """Squared Mahalanobis distance of ``_x`` from ``mu``, by the whitening matrix ``whiten``."""
    d = [F.get("_x", F.lit(j)) - F.get("mu", F.lit(j)) for j in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        row = F.lit(0.0)
        for j in range(i + 1):
            row = row + F.get("whiten", F.lit(i * P + j)) * d[j]
        total = total + row * row
    return total


def estimates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, centres): the group of each (lang, source), and each group's estimate.

    All vectors count. A language or source may be null; null is a value like
    others. Both tables are stored, with one row per language and source at most.
    """
    key = [F.concat(F.lit("="), F.coalesce(F.col(c).cast("string"), F.lit("=null"))).alias(c) for c in ("lang", "source")]
    vectors = cut_lineage(with_stats(docs.select("lang", "source", "text")).filter("_x is not null").select(*key, "_x"))
    sizes = vectors.groupBy("lang", "source").count()
    own = F.col("count") >= LEAST_ROWS
    rest = sizes.filter(~own).groupBy("lang").agg((F.sum("count") >= LEAST_ROWS).alias("pooled"))
    groups = cut_lineage(
        sizes.join(rest, "lang", "left").select(
            "lang",
            "source",
            F.when(own | F.col("pooled"), F.col("lang")).otherwise("").alias("g_lang"),
            F.when(own, F.col("source")).otherwise("").alias("g_source"),
        )
    )
    grouped = vectors.join(groups, ["lang", "source"]).select("g_lang", "g_source", "_x")
    x = [F.get("_x", F.lit(j)) for j in range(P)]
    quarters = F.array(*(F.percentile_approx(v, [0.25, 0.5, 0.75], F.lit(1000)) for v in x))
    start = grouped.groupBy("g_lang", "g_source").agg(quarters.alias("q"))
    centres = cut_lineage(start.mapInPandas(freed(_start), ESTIMATE))
    for _ in range(STEPS):
        far = grouped.join(centres, ["g_lang", "g_source"]).withColumn("d", distance())
        cut = cut_lineage(
            far.groupBy("g_lang", "g_source").agg(F.percentile_approx("d", KEEP, F.lit(1000)).alias("cut"))
            .join(centres, ["g_lang", "g_source"])
        )
        near = grouped.join(cut, ["g_lang", "g_source"]).filter(distance() <= F.col("cut"))
        d = [x[j] - F.get("mu", F.lit(j)) for j in range(P)]
        sums = near.groupBy("g_lang", "g_source").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*(F.sum(v) for v in d)).alias("s1"),
            F.array(*(F.sum(d[i] * d[j]) for i in range(P) for j in range(i, P))).alias("s2"),
            F.first("mu").alias("old"),
        )
        centres = cut_lineage(sums.mapInPandas(freed(_refine), ESTIMATE))
    return groups, centres


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` with ``_s``, ``_failed``, ``_d`` (squared distance) and ``_kept``.

    A row is kept if it passes the limits and lies within ``cutoff`` of its
    group's centre. A null or empty text has no words and fails. Every row is
    answered, repeated ones too; other columns stay.
    """
    groups, centres = estimates(docs)
    table = cut_lineage(groups.join(centres, ["g_lang", "g_source"]).withColumnsRenamed({"lang": "_lang", "source": "_source"}))
    own = [F.concat(F.lit("="), F.coalesce(F.col(c).cast("string"), F.lit("=null"))) for c in ("lang", "source")]
    rows = with_stats(docs).withColumn("_l", own[0]).withColumn("_o", own[1])
    met = rows.join(table, (F.col("_l") == F.col("_lang")) & (F.col("_o") == F.col("_source")), "left")
    far = F.when(~F.col("_failed"), distance())
    kept = ~F.col("_failed") & (F.coalesce("_d", F.lit(0.0)) <= cutoff)
    out = met.withColumn("_d", far).withColumn("_kept", kept)
    return out.select(*docs.columns, "_s", "_failed", "_d", "_kept")


def quality_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, STATS, base_failed, kept, distance) of every row of ``docs`` (doc_id, text, lang, source)."""
    return judge(docs.select(F.col("doc_id").cast("bigint"), "text", "lang", "source")).select(
        "doc_id", *(f"_s.{s}" for s in STATS), F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"),
        F.col("_d").alias("distance"),
    )


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return judge(docs).filter("_kept").select(*docs.columns)
