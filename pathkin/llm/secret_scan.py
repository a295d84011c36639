"""Secrets in text: known forms, and strings that pass a battery of randomness tests.

The battery takes a string's characters as places in the smallest encoding that
holds them all and tests three properties of uniform draws: a chi-squared test of
the alphabet's use, a runs test about the middle of the alphabet, and the serial
correlation of neighbours. Fisher's method joins the three p-values to a score
that is high for random strings and minute for ordinary text.

How far chance lets ordinary text look random depends on its length. So for every
class of lengths the plain letters of every whole text are cut into runs of that
length, and the scores of all runs are the null distribution of the class. A
candidate's p-value is the share of them that look at least as random; a Benjamini-Hochberg bound over all
candidates, in which longer strings weigh more, holds the share of false finds.
"""

import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pathkin.llm.arrays import freed
from pathkin.session import cut_lineage

# Fixed patterns of the known forms, with the least length of each find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a shorter run of these characters holds no longer one
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_OTHER = bytes(set(range(256)) - set(string.ascii_letters.encode()))
#: Least lengths of the classes of lengths.
CLASSES = (16, 20, 24, 32, 48, 64, 96)
#: A score s falls into bin floor(-log2 s); the last bin holds the rest.
BINS = 64
#: Plain letters tested at once in a Python worker, about.
CHUNK = 1 << 20
#: Share of false finds among the strings the battery adds.
FALSE_SHARE = 0.01

ENCODINGS = tuple(
    sorted(
        (
            string.digits,
            string.digits + "abcdef",
            string.digits + "ABCDEF",
            string.ascii_lowercase,
            string.ascii_uppercase,
            string.ascii_uppercase + "234567",
            string.digits + string.ascii_lowercase,
            string.digits + string.ascii_uppercase,
            string.ascii_letters,
            string.digits + string.ascii_letters,
            string.digits + string.ascii_letters + "+/",
            string.digits + string.ascii_letters + "-_",
            string.digits + string.ascii_letters + "+/-_",
        ),
        key=len,
    )
)
_SETS = tuple((frozenset(e), {c: k for k, c in enumerate(e)}) for e in ENCODINGS)

SCAN = (
    "doc_id bigint, base array<struct<start:bigint,kind:int,end:bigint>>,"
    " found array<struct<start:bigint,end:bigint,cell:int>>, plain array<struct<cell:int,n:bigint>>"
)


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(text: str) -> tuple[int, float, float, float]:
    """Size of the encoding of ``text`` and p-values of the chi-squared, runs and serial tests.

    ``text`` holds characters of the candidates only.
    """
    used = set(text)
    place = next(p for letters, p in _SETS if used <= letters)
    m, n = len(place), len(text)
    x = [place[c] for c in text]
    counts: dict[int, int] = {}
    for k in x:
        counts[k] = counts.get(k, 0) + 1
    chi = sum(c * c for c in counts.values()) * m / n - n
    # Cube root of a chi-squared value with the mean and variance of few draws.
    variance = 2 * (m - 1) * (n - 1) / n
    scale, df = variance / (2 * (m - 1)), 2 * (m - 1) ** 2 / variance
    cube = (max(chi, 0.0) / scale / df) ** (1 / 3)
    p_chi = _upper((cube - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    above = [2 * k >= m for k in x]
    a = sum(above)
    b = n - a
    if a and b and n > 2:
        runs = 1 + sum(s != t for s, t in zip(above, above[1:]))
        mean = 2 * a * b / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-12))
        p_runs = min(1.0, 2 * _upper(max(abs(runs - mean) - 0.5, 0.0) / spread))
    else:
        p_runs = 0.5 ** (n - 1)
    centre = sum(x) / n
    d = [k - centre for k in x]
    total = sum(v * v for v in d)
    if total > 0:
        r = sum(s * t for s, t in zip(d, d[1:])) / total + 1 / n
        p_serial = min(1.0, 2 * _upper(abs(r) * math.sqrt(n)))
    else:
        p_serial = 0.0
    return m, p_chi, p_runs, p_serial


def score(text: str) -> float:
    """The p-values of ``battery`` joined by Fisher's method: high for random strings."""
    x = -sum(math.log(max(p, 1e-300)) for p in battery(text)[1:])
    return math.exp(-x) * (1 + x + x * x / 2)


def length_class(n: int) -> int:
    return sum(n >= least for least in CLASSES) - 1


def _cell(text: str) -> int:
    found = int(-math.log2(max(score(text), 2.0**-BINS)))
    return length_class(len(text)) * BINS + min(found, BINS - 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms in code points, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, cell) of the strings that the battery tests; a cell is a class and a bin."""
    return [(m.start(), m.end(), _cell(m[0])) for m in CANDIDATE.finditer(text)]


def _letter_runs(texts: list[bytes], n: int) -> np.ndarray:
    """Places in the alphabet of the runs of ``n`` letters of each text, one run a row."""
    joined = b"".join(t[: len(t) // n * n] for t in texts)
    return np.frombuffer(joined, np.uint8).reshape(-1, n) - np.uint8(97)


_erfc = np.frompyfunc(math.erfc, 1, 1)


def _minus_log(p: np.ndarray) -> np.ndarray:
    return -np.log(np.maximum(p.astype(float), 1e-300))


def run_cells(x: np.ndarray) -> np.ndarray:
    """The cells of runs of lower-case letters, one a row, as ``_cell`` gives them."""
    rows, n = x.shape
    m = len(string.ascii_lowercase)
    if not rows:
        return np.zeros(0, np.int64)
    counts = np.bincount((np.arange(rows)[:, None] * m + x).ravel(), minlength=rows * m).reshape(rows, m)
    squares, at_chi = np.unique((counts * counts).sum(axis=1), return_inverse=True)
    chi = squares * m / n - n
    variance = 2 * (m - 1) * (n - 1) / n
    scale, df = variance / (2 * (m - 1)), 2 * (m - 1) ** 2 / variance
    cube = (np.maximum(chi, 0.0) / scale / df) ** (1 / 3)
    z = (cube - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    total = _minus_log(0.5 * _erfc(z / math.sqrt(2)))[at_chi]
    above = x >= m // 2
    turns = 1 + (above[:, 1:] != above[:, :-1]).sum(axis=1)
    pairs, at_runs = np.unique(above.sum(axis=1) * (n + 1) + turns, return_inverse=True)
    a, runs = np.divmod(pairs, n + 1)
    mean = 2 * a * (n - a) / n + 1
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-12))
    p_runs = _erfc(np.maximum(np.abs(runs - mean) - 0.5, 0.0) / spread / math.sqrt(2)).astype(float)
    p_runs = np.where((a == 0) | (a == n), 0.5 ** (n - 1), np.minimum(p_runs, 1.0))
    total += _minus_log(p_runs)[at_runs]
    # Sums of whole numbers, so that they are exact: sum d*d and sum d*d' times n.
    k = x.astype(np.int32)
    plain = k.sum(axis=1)
    around = n * (k * k).sum(axis=1) - plain * plain
    beside = n * (k[:, 1:] * k[:, :-1]).sum(axis=1) - plain * (2 * plain - k[:, 0] - k[:, -1])
    beside = beside + (n - 1) * plain * plain / n
    varied = around > 0
    r = np.where(varied, beside / np.where(varied, around, 1), 0.0) + 1 / n
    p_serial = np.minimum(_erfc(np.abs(r) * math.sqrt(n) / math.sqrt(2)).astype(float), 1.0)
    total += _minus_log(np.where(varied, p_serial, 0.0))
    joined = np.exp(-total) * (1 + total + total * total / 2)
    bins = np.minimum((-np.log2(np.maximum(joined, 2.0**-BINS))).astype(np.int64), BINS - 1)
    cells = length_class(n) * BINS + bins
    # Runs that fit a smaller encoding than the alphabet: a to f alone, rare.
    for i in np.flatnonzero((x < 6).all(axis=1)):
        cells[i] = _cell(bytes(x[i] + np.uint8(97)).decode())
    return cells


def plain_counts(texts: list[str]) -> np.ndarray:
    """Number of runs of plain letters by cell: for each class of lengths, all letters of
    each whole text, lower-cased, in consecutive runs of the class's least length."""
    out = np.zeros(len(CLASSES) * BINS, np.int64)
    letters = [t.encode("utf-8", "surrogatepass").translate(_LOWER, _OTHER) for t in texts]
    for n in CLASSES:
        step, part, size = CHUNK // n * n, [], 0
        for text in letters:
            for start in range(0, len(text), step):
                part.append(text[start : start + step])
                size += len(part[-1])
                if size >= CHUNK:
                    out += np.bincount(run_cells(_letter_runs(part, n)), minlength=len(out))
                    part, size = [], 0
        out += np.bincount(run_cells(_letter_runs(part, n)), minlength=len(out))
    return out


def random_spans(text: str, cells: frozenset[int]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates in the accepted ``cells`` outside the known forms."""
    taken = base_spans(text)
    found = ((a, 3, b) for a, b, cell in candidates(text) if cell in cells)
    return [s for s in found if all(s[2] <= t[0] or t[2] <= s[0] for t in taken)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    found = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cell", pa.int32())]))
    cells = pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64())]))
    for batch in batches:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        base = [[dict(zip(("start", "kind", "end"), s)) for s in base_spans(text)] for text in texts]
        other = [[dict(zip(("start", "end", "cell"), s)) for s in candidates(text)] for text in texts]
        # The runs of a batch are counted together, at its first row.
        counts = plain_counts(texts)
        plain = [[{"cell": c, "n": counts[c]} for c in np.flatnonzero(counts)]] + [[]] * (len(texts) - 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, spans), pa.array(other, found), pa.array(plain[: len(texts)], cells)],
            ["doc_id", "base", "found", "plain"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """Known forms and candidates of every whole text and counts of its plain runs, stored."""
    plain = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return cut_lineage(plain.mapInArrow(freed(_scan), SCAN))


def accepted_cells(scanned: DataFrame, false_share: float = FALSE_SHARE) -> frozenset[int]:
    """The cells (class of lengths and bin) whose candidates count as random.

    Reads counts per cell only: at most BINS rows for each class.
    """

    def counts(cells: DataFrame) -> np.ndarray:
        rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()
        out = np.zeros(len(CLASSES) * BINS, np.int64)
        for r in rows:
            out[r["cell"]] = r["n"]
        return out.reshape(len(CLASSES), BINS)

    found = scanned.select(F.explode("found.cell").alias("cell"), F.lit(1).alias("n"))
    return choose_cells(counts(found), counts(scanned.select(F.inline("plain"))), false_share)


def choose_cells(found: np.ndarray, plain: np.ndarray, false_share: float) -> frozenset[int]:
    """The weighted Benjamini-Hochberg choice from counts by class and bin."""
    total = int(found.sum())
    if not total:
        return frozenset()
    p = (1 + plain.cumsum(axis=1)) / (1 + plain.sum(axis=1, keepdims=True))
    lengths = np.array(CLASSES, float)[:, None]
    weight = lengths * total / (found.sum(axis=1, keepdims=True) * lengths).sum()
    level = (p / weight).ravel()
    order = np.argsort(level, kind="stable")
    below = found.ravel()[order].cumsum()
    good = np.flatnonzero(level[order] <= false_share * below / total)
    return frozenset(order[: good[-1] + 1].tolist()) if len(good) else frozenset()


def find_secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, base, spans) of ``docs`` (doc_id, text): arrays of (start, kind, end).

    Spans are in code points, the end exclusive; kinds are numbered as in KINDS.
    ``base`` has the known forms, ``spans`` also the random strings that touch none
    of them. A null or empty text has none, a null doc_id stays null, every row
    is answered, repeated ones too, and other columns are left out.
    """
    scanned = scan(docs)
    cells = accepted_cells(scanned, false_share)
    accepted = F.array(*map(F.lit, sorted(cells))).cast("array<int>")

    def apart(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    chosen = F.filter("found", lambda s: F.array_contains(accepted, s["cell"]) & apart(s))
    added = F.transform(
        chosen,
        lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")),
    )
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def listed(spans: str) -> Column:
    """``spans`` as kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, false_share: float = FALSE_SHARE, mark: str = "[secret]") -> DataFrame:
    """``docs`` with ``mark`` in place of every secret of ``text``, and ``n_chars`` counted anew.

    A null text stays null; all other columns and all rows stay.
    """
    cells = accepted_cells(scan(docs), false_share)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else without(t, cells, mark))

    out = docs.withColumn("text", clean(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else out


def without(text: str, cells: frozenset[int], mark: str) -> str:
    """``text`` with ``mark`` for every stretch of secrets that overlap."""
    parts, end = [], 0
    for start, _, stop in sorted(base_spans(text) + random_spans(text, cells)):
        if start >= end:
            parts += [text[end:start], mark]
        end = max(end, stop)
    return "".join(parts) + text[end:]
