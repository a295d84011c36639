"""Spelling variants: words one edit apart, searched by split-half schemes over sorted ranks.

A word w of m code points and a word v one edit away share, by pigeonhole, either
w's first half (the edit lies in the second) or w's second half (the edit lies in
the first). So two search schemes run for every word as a query:

* ``L``: the first half matches exactly; the rest is extended allowing one error;
* ``R``: the second half matches exactly; the part before it is extended, read
  backwards (the reversed vocabulary), allowing one error.

Spark groups every query with the vocabulary entries that share its exact half
(entries are indexed under the halves of the three query lengths they can be near),
and a group larger than ``CELL`` is cut into a grid of cells of bounded size.
Inside a cell the rests are sorted; a query walks down its rest, keeping the rank
interval of the rests that begin like it (binary search on the sorted array - the
interval a suffix array over the delimited vocabulary gives for word starts), and
at each depth tries, once, a deletion, and every character that the interval holds
next as a substitution or insertion. Only true neighbours come out; no group is
expanded into its pairs.
"""

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pathkin.session import cut_lineage

# Fixed values of the contract: runs, deletion rule, word limits, form factor.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
DIVISOR = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
#: Queries, and entries, of one cell at most, about.
CELL = 20_000

_TOP = "\U0010ffff"


def words(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(word, n): runs of ``RUN`` with A-Z lower-cased, one code point deleted where 199 divides
    crc32('<doc_id>:<run>'), kept with at least 6 code points and 5 occurrences.

    A null text has no runs; a run of a row with a null doc_id has no crc32 and keeps
    all its code points.
    """
    runs = docs.select(
        F.col(id_column).cast("string").alias("id"),
        F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUN), 0)).alias("run"),
    ).select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = h % F.length("run")
    cut = F.concat(F.expr("substring(run, 1, cast(pos as int))"), F.expr("substring(run, cast(pos as int) + 2)"))
    runs = runs.withColumn("pos", at).select(F.when(h % DIVISOR == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = runs.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def _find(rests: list[str], q: str) -> Iterator[str]:
    """Entries of sorted ``rests`` exactly one edit (insertion, deletion, substitution) from ``q``."""

    def has(s: str) -> bool:
        i = bisect.bisect_left(rests, s)
        return i < len(rests) and rests[i] == s

    lo, hi = 0, len(rests)
    for j in range(len(q) + 1):
        head = q[:j]
        if j < len(q) and has(head + q[j + 1 :]):
            yield head + q[j + 1 :]
        # Characters that follow ``head`` inside its interval, one jump each.
        k = lo
        while k < hi:
            s = rests[k]
            if len(s) <= j:
                k += 1
                continue
            c = s[j]
            if j < len(q) and c != q[j] and has(head + c + q[j + 1 :]):
                yield head + c + q[j + 1 :]
            if has(head + c + q[j:]):
                yield head + c + q[j:]
            k = bisect.bisect_left(rests, head + chr(ord(c) + 1), k, hi) if c != _TOP else hi
        if j == len(q):
            break
        lo = bisect.bisect_left(rests, head + q[j], lo, hi)
        hi = bisect.bisect_left(rests, head + q[j] + _TOP, lo, hi)
        if lo >= hi:
            # No entry continues the exact part; errors at later depths cannot match.
            break


def _search(cell: pa.Table) -> pa.Table:
    side = cell.column("side")[0].as_py() if cell.num_rows else "L"
    flip = (lambda s: s[::-1]) if side == "R" else (lambda s: s)
    word, key, asked = (cell.column(c).to_pylist() for c in ("word", "key", "query"))
    rest = [flip(w[len(k) :] if side == "L" else w[: len(w) - len(k)]) for w, k in zip(word, key)]
    index = sorted({r: w for r, w, q in zip(rest, word, asked) if not q}.items())
    rests, names = [r for r, _ in index], [w for _, w in index]
    out_w, out_v = [], []
    for r, w, q in zip(rest, word, asked):
        if q:
            for found in set(_find(rests, r)):
                out_w.append(w)
                out_v.append(names[bisect.bisect_left(rests, found)])
    return pa.table({"word": pa.array(out_w, pa.string()), "near": pa.array(out_v, pa.string())})


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, near): ordered pairs of words of ``vocab`` exactly one edit apart."""
    m = F.length("word")
    # Queries: a word of length m under its own halves.
    queries = vocab.select(
        "word",
        m.alias("m"),
        F.lit(True).alias("query"),
        F.explode(
            F.array(
                F.struct(F.lit("L").alias("side"), F.expr("substring(word, 1, floor(length(word) / 2))").alias("key")),
                F.struct(F.lit("R").alias("side"), F.expr("substring(word, floor(length(word) / 2) + 1)").alias("key")),
            )
        ).alias("s"),
    )
    # Entries: a word of length L under the halves of queries of length L - 1, L and L + 1.
    entries = vocab.select("word", F.explode(F.array(m - 1, m, m + 1)).alias("m")).filter(F.col("m") >= LEAST_LENGTH)
    entries = entries.select(
        "word",
        "m",
        F.lit(False).alias("query"),
        F.explode(
            F.array(
                F.struct(F.lit("L").alias("side"), F.expr("substring(word, 1, floor(m / 2))").alias("key")),
                F.struct(
                    F.lit("R").alias("side"),
                    F.expr("substring(word, length(word) - (m - floor(m / 2)) + 1)").alias("key"),
                ),
            )
        ).alias("s"),
    )
    rows = queries.unionByName(entries).select("word", "m", "query", "s.side", "s.key")
    group = ["m", "side", "key"]
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("query").cast("int")).alias("asked"))
    sizes = sizes.filter("asked > 0").select(*group, F.ceil(F.col("size") / CELL).cast("int").alias("cells"))
    rows = rows.join(sizes, group)
    # A query goes to every cell of its row of the grid, an entry to every cell of its column.
    mine = F.pmod(F.xxhash64("word"), F.col("cells")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    rows = rows.select(
        "word",
        "query",
        *group,
        F.when(F.col("query"), mine).alias("qi"),
        F.when(~F.col("query"), mine).alias("ei"),
        other.alias("other"),
    ).select(
        "word",
        "query",
        *group,
        F.coalesce("qi", "other").alias("qi"),
        F.coalesce("ei", "other").alias("ei"),
    )
    found = rows.groupBy(*group, "qi", "ei").applyInArrow(_search, "word string, near string")
    return found.distinct()


def spelling_variants(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word (see ``words``).

    ``n_near`` counts the words one edit away (0 if none). ``form`` is the near word
    of largest n, ties to the smallest in code-point order, where its n is at least
    5 times the word's; else null, and then ``form_n`` is null. ``root`` follows
    forms to the last (the word itself if it has no form); forms have strictly larger
    counts, so chains end. Empty texts and tables give no rows; repeated rows count
    as often as they stand; other columns are ignored.
    """
    vocab = cut_lineage(words(docs, text, id_column))
    pairs = near_pairs(vocab).join(vocab.withColumnRenamed("word", "near").withColumnRenamed("n", "near_n"), "near")
    pairs = cut_lineage(pairs)
    stats = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("near_n").alias("top_n"))
    best = pairs.join(stats, "word").filter(F.col("near_n") == F.col("top_n")).groupBy("word", "top_n", "n_near").agg(F.min("near").alias("best"))
    table = vocab.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("top_n") >= FORM_FACTOR * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("top_n") >= FORM_FACTOR * F.col("n"), F.col("top_n")).alias("form_n"),
    )
    table = cut_lineage(table)
    forms = table.filter(F.col("form").isNotNull()).select(F.col("word").alias("root"), F.col("form").alias("next"))
    roots = table.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        moved = roots.join(forms, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on"))
        moved = cut_lineage(moved)
        if moved.filter("on").isEmpty():
            roots = moved.select("word", "root")
            break
        roots = moved.select("word", "root")
    return table.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
