"""Phrase collocations by trie counting inside tasks, level by level, merged by Spark.

Phrases are counted by size. Each task counts its phrases in a shallow trie: the
first word (with the language) leads to a hash container of the rest of the
phrase. A container that grows past ``BURST`` entries bursts into containers
under its second word. When the trie holds more than ``LIMIT`` entries, whole
first-word subtrees, largest first, are written out as sorted runs and dropped,
so a task's memory stays bounded whatever its input. Spark adds up the runs of
all tasks by phrase (partial sums before the shuffle).

A phrase of count ``least`` has no part of a smaller count. So after the words,
only places whose two parts of one word less are both frequent are counted: few
of the distinct phrases of a text ever leave a task. What is frequent is told by
a bit for the hash of each frequent phrase; phrases that share a bit by chance
are counted too and dropped by their exact count. Pairs are many, so they are first
counted by bit alone; all later passes read only the runs of words in which the
bit of every pair is frequent, stored once.

The rest - cuts, scores, containment and ranks - are joins and windows over the
counts of frequent phrases. Scores are floor(1000 * a * n / (l * r)) in 38-digit
decimals, so products larger than 64 bits stay exact.
"""

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from pathkin.session import cut_lineage

# Fixed values of the contract: where pieces and words end, phrase sizes, limits.
PIECE_END = r"[.,;:!?\x0A-\x0D]"
WORD = r"[^\x20\x09]+"
LONGEST = 5
LEAST_COUNT = 100
TOP = 2000

#: Entries of one task's trie before subtrees are written out.
LIMIT = 200_000
#: Rows of a spilled run handed to Spark at once.
SPILL_ROWS = 50_000
#: Entries of one container before it bursts.
BURST = 4096
#: Bytes of text read together, words counted together, and distinct words remembered between groups.
READ_BYTES = 1_000_000
GROUP_WORDS = 2_000_000
KEPT_WORDS = 500_000
#: Bits for each frequent phrase, as a power of two, and the most bits of all (16 MB).
SPARE_BITS, MOST_BITS = 4, 27
#: Runs of frequent pairs stored in one row.
ROW_RUNS = 200

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PIECES = re.compile(PIECE_END)
_WORDS = re.compile(WORD)


def pieces(text: str | None) -> list[list[str]]:
    """Word lists of the pieces of ``text``: A-Z lower-cased, cut at piece ends, words split at spaces and tabs."""
    return [w for p in _PIECES.split((text or "").translate(_LOWER)) if (w := _WORDS.findall(p))]


class _Subtree:
    """Counts of the phrases that begin with one word: flat, or after a burst, under their second word."""

    __slots__ = ("alone", "flat", "kids", "size")

    def __init__(self):
        self.alone, self.flat, self.kids, self.size = 0, {}, None, 1

    def add(self, rest: tuple, count: int) -> int:
        """Adds ``count`` to the phrase (first word, *rest); the number of new entries."""
        if not rest:
            self.alone += count
            return 0
        if self.kids is None:
            box, key = self.flat, rest
        else:
            box, key = self.kids.setdefault(rest[0], {}), rest[1:]
        old = box.get(key)
        box[key] = count + (old or 0)
        if old is not None:
            return 0
        self.size += 1
        if self.kids is None and len(self.flat) > BURST:
            self.kids = {}
            for k, c in self.flat.items():
                self.kids.setdefault(k[0], {})[k[1:]] = c
            self.flat = {}
        return 1

    def run(self, first: str) -> Iterator[tuple[str, int, int]]:
        """(phrase, size, count) of the subtree in phrase order."""
        out = [((first,), self.alone)] if self.alone else []
        if self.kids is None:
            out += [((first, *k), c) for k, c in self.flat.items()]
        else:
            out += [((first, second, *k), c) for second, box in self.kids.items() for k, c in box.items()]
        out.sort()
        space = b" " if isinstance(first, bytes) else " "
        return ((space.join(p), len(p), c) for p, c in out)


class PhraseTrie:
    """Bounded counts of phrases by (lang, first word); ``spill`` hands out sorted runs."""

    def __init__(self, limit: int = LIMIT):
        self.limit, self.entries, self.top = limit, 0, {}

    def add(self, lang: str, counts: Counter) -> Iterator[tuple[str, str, int, int]]:
        for phrase, count in counts.items():
            sub = self.top.get((lang, phrase[0]))
            if sub is None:
                sub = self.top[(lang, phrase[0])] = _Subtree()
                self.entries += 1
            self.entries += sub.add(phrase[1:], count)
        if self.entries > self.limit:
            yield from self.spill(self.limit // 2)

    def spill(self, keep: int = 0) -> Iterator[tuple[str, str, int, int]]:
        """Writes out the largest subtrees until at most ``keep`` entries are left."""
        for key in sorted(self.top, key=lambda k: self.top[k].size, reverse=True):
            if self.entries <= keep:
                break
            sub = self.top.pop(key)
            self.entries -= sub.size
            for phrase, size, count in sub.run(key[1]):
                yield key[0], phrase, size, count


def _grams(words: list[str], counts: Counter) -> None:
    for k in range(1, min(LONGEST, len(words)) + 1):
        counts.update(zip(*(words[i:] for i in range(k))))


# Bytes of a text: A-Z in lower case, a point for every piece end. A point stands in no word.
_MARKED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def _hash(lang: str, word: bytes) -> int:
    return int.from_bytes(blake2b(lang.encode() + b"\0" + word, digest_size=8).digest(), "little")


def _joined(hashes: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from those of their first, second, ... words."""
    out = hashes[0]
    for h in hashes[1:]:
        out = out * _ODD + h
    return out


def _bits_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each hash, of 2 ** ``bits``."""
    return (((hashes ^ (hashes >> np.uint64(31))) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


class _Words(dict):
    """A number from 1 for every word of a language, and the words' hashes; 0 is a piece end."""

    def __init__(self, lang: str):
        super().__init__({b".": 0})
        self.lang, self.hashes = lang, [0]

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.hashes)
        self.hashes.append(_hash(self.lang, word))
        return place


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """(lang, its words, their numbers in the order of the texts, the hash of each number) of up to about ``GROUP_WORDS`` words."""
    texts: dict[str, list[bytes]] = {}
    known: dict[str, _Words] = {}
    places: dict[str, list[np.ndarray]] = {}

    def read() -> int:
        """Words of the texts to numbers; how many there are."""
        n = 0
        for lang, parts in texts.items():
            tokens = b".".join([*parts, b""]).translate(_MARKED).replace(b".", b" . ").split()
            words = known.get(lang) or known.setdefault(lang, _Words(lang))
            places.setdefault(lang, []).append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
            n += len(tokens)
        texts.clear()
        return n

    def groups():
        for lang, parts in places.items():
            yield lang, list(known[lang]), np.concatenate(parts), np.array(known[lang].hashes, np.uint64)
        places.clear()
        if sum(map(len, known.values())) > KEPT_WORDS // 2:
            known.clear()

    size = n_words = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if text:
                texts.setdefault(lang, []).append(text)
                size += len(text)
                if size >= READ_BYTES:
                    n_words, size = n_words + read(), 0
                    if n_words >= GROUP_WORDS or sum(map(len, known.values())) > KEPT_WORDS:
                        yield from groups()
                        n_words = 0
    read()
    yield from groups()


def _frequent_at(places: np.ndarray, hashes: np.ndarray, size: int, known: tuple[int, bytes]) -> np.ndarray:
    """For each place whether the phrase of ``size`` words that begins there may be frequent."""
    bits, flags = known
    n = max(len(places) - size + 1, 0)
    inside = np.ones(n, bool)
    for k in range(size):
        inside &= places[k : k + n] > 0
    at = np.flatnonzero(inside)
    bit = _bits_of(_joined([hashes[places[at + k]] for k in range(size)]), bits)
    inside[at] = (np.frombuffer(flags, np.uint8)[bit >> 3] >> (bit & 7)) & 1
    return inside


def _distinct(places: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One of the places ``at`` for each distinct phrase of ``size`` words that begins there, and the phrase's count."""
    n_words = int(places.max(initial=0)) + 1
    keys = places[at].astype(np.int64)
    for k in range(1, size):
        if k > 1:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * n_words + places[at + k]
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    return at[first], counts


SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("count", pa.int64())])


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SCHEMA)], schema=SCHEMA)


def _count(size: int, known: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, rows = PhraseTrie(), []
        for lang, words, places, hashes in _groups(batches):
            if known is None:
                at = np.flatnonzero(places)
            else:
                part = _frequent_at(places, hashes, size - 1, known.value)
                at = np.flatnonzero(part[:-1] & part[1:])
            first, counts = _distinct(places, at, size)
            for s in range(0, len(first), SPILL_ROWS):
                part = first[s : s + SPILL_ROWS]
                phrases = zip(*(map(words.__getitem__, places[part + k].tolist()) for k in range(size)))
                counted = dict(zip(phrases, counts[s : s + SPILL_ROWS].tolist()))
                rows.extend((lang, phrase, n) for lang, phrase, _, n in trie.add(lang, counted))
                if len(rows) >= SPILL_ROWS:
                    yield _batch(rows)
                    rows = []
        rows.extend((lang, phrase, n) for lang, phrase, _, n in trie.spill())
        for s in range(0, len(rows), SPILL_ROWS):
            yield _batch(rows[s : s + SPILL_ROWS])

    return run


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("string").cast("binary").alias("text"),
    )


def phrase_counts(texts: DataFrame, size: int, known: Broadcast | None = None) -> DataFrame:
    """(lang, phrase, size, f): phrases of ``size`` words in ``texts`` (lang, text as bytes) with their number of occurrences.

    With ``known`` (``frequent_bits`` of the phrases of one word less), only phrases
    of which both parts of one word less are known; without, ``size`` is 1.
    """
    runs = texts.mapInArrow(_count(size, known), "lang string, phrase binary, count long")
    return runs.groupBy("lang", "phrase").agg(F.sum("count").alias("f")).select(
        "lang", F.col("phrase").cast("string").alias("phrase"), F.lit(size).alias("size"), "f"
    )


def _hashed(known: Broadcast, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, places, hashes in _groups(batches):
            word = _frequent_at(places, hashes, 1, known.value)
            at = np.flatnonzero(word[:-1] & word[1:])
            pairs = _joined([hashes[places[at]], hashes[places[at + 1]]])
            bit, counts = np.unique(_bits_of(pairs, bits), return_counts=True)
            for s in range(0, len(bit), SPILL_ROWS):
                part = slice(s, s + SPILL_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(bit[part]), pa.array(counts[part])], ["bit", "count"])

    return run


def _bit_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [_hash(lang, word) for word in phrase.split(b" ")]
                for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            ]
            hashes = np.array(found, np.uint64).reshape(len(found), -1)
            bit = _bits_of(_joined(list(hashes.T)), bits) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bit)], ["bit"])

    return run


def _bits_for(n_phrases: int) -> int:
    return min(max(n_phrases, 1).bit_length() + SPARE_BITS, MOST_BITS)


def _sent(rows: DataFrame, bits: int) -> Broadcast:
    """The bits ``rows`` (bit) set, of 2 ** ``bits``; sent to all tasks."""
    # Bits are put together in tasks, 4 KB at a time.
    blocks = rows.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("flags")
    )
    flags = bytearray(max(1 << bits >> 3, 4096))
    for block, part in blocks.collect():
        flags[(block - 1) * 4096 : block * 4096] = part
    return rows.sparkSession.sparkContext.broadcast((bits, bytes(flags)))


def frequent_bits(phrases: DataFrame, n_phrases: int) -> Broadcast:
    """A bit set for each of the ``phrases`` (lang, phrase), all of one size, by its hash; sent to all tasks.

    At most ``2 ** MOST_BITS`` bits: more phrases than that would make tasks
    count more than needed, and change no result.
    """
    bits = _bits_for(n_phrases)
    rows = phrases.select("lang", F.col("phrase").cast("binary")).mapInArrow(_bit_rows(bits), "bit long")
    return _sent(rows, bits)


def pair_bits(texts: DataFrame, words: Broadcast, least: int) -> Broadcast:
    """The bits of all pairs of known ``words`` that stand ``least`` times or more in ``texts``, counted by bit alone.

    Pairs that share a bit are counted as one, so that the bits of some rarer pairs are set as well.
    """
    counts = texts.mapInArrow(_hashed(words, MOST_BITS), "bit long, count long")
    return _sent(counts.groupBy("bit").agg(F.sum("count").alias("f")).filter(F.col("f") >= least).select("bit"), MOST_BITS)


def _runs(known: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, places, hashes in _groups(batches):
            pair = np.concatenate([[False], _frequent_at(places, hashes, 2, known.value), [False]]).astype(np.int8)
            starts, ends = np.flatnonzero(np.diff(pair) > 0), np.flatnonzero(np.diff(pair) < 0) + 1
            for k in range(0, len(starts), SPILL_ROWS):
                found = [
                    b" ".join(map(words.__getitem__, places[s:e].tolist()))
                    for s, e in zip(starts[k : k + SPILL_ROWS].tolist(), ends[k : k + SPILL_ROWS].tolist())
                ]
                rows = [b".".join(found[s : s + ROW_RUNS]) for s in range(0, len(found), ROW_RUNS)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(rows, pa.binary())], ["lang", "text"])

    return run


def frequent_runs(texts: DataFrame, known: Broadcast) -> DataFrame:
    """(lang, text): all runs of 2 words or more of ``texts`` in which every pair is ``known``, as pieces of texts."""
    return texts.mapInArrow(_runs(known), "lang string, text binary")


def frequent_phrases(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """All words of ``texts`` and all phrases of up to ``LONGEST`` words with at least ``least`` occurrences; both
    (lang, phrase, size, f) and stored."""
    words = cut_lineage(phrase_counts(texts, 1))
    frequent = found = words.filter(F.col("f") >= least)
    for size in range(2, LONGEST + 1):
        n = found.count()
        if not n:
            break
        known = frequent_bits(found, n)
        if size == 2:
            texts = cut_lineage(frequent_runs(texts, pair_bits(texts, known, least)))
        found = cut_lineage(phrase_counts(texts, size, known).filter(F.col("f") >= least))
        frequent = frequent.unionByName(found)
    return words, frequent


def _words(column: str):
    return F.split(F.col(column), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to 5 words.

    ``a`` is the phrase's count (at least ``least``), ``n`` the language's word
    count; of the cuts after the first k words, the one of least
    floor(1000 * a * n / (l * r)) counts, ties to the smallest k. A phrase that
    lies inside a longer phrase of count >= ``least`` with the same count goes.
    Ranked by score, then a descending, then phrase (UTF-8 order); the first
    ``top`` of each language. Empty texts and tables give no rows; repeated rows
    count as often as they stand; other columns are ignored.
    """
    words, frequent = frequent_phrases(_texts(docs, text, lang), least)
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    cands = frequent.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"))
    cut = cands.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), _words("phrase").alias("w"))
    cut = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, LONGEST), " ").alias("right"),
    )
    parts = frequent.select("lang", F.col("phrase").alias("part"), "f")
    cut = (
        cut.join(parts.withColumnRenamed("part", "left").withColumnRenamed("f", "l"), ["lang", "left"])
        .join(parts.withColumnRenamed("part", "right").withColumnRenamed("f", "r"), ["lang", "right"])
        .join(n, "lang")
    )
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(1000 as {wide}) * a * n) div (cast(l as {wide}) * r)").cast("bigint")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    inner = cands.filter("size >= 3").select(
        "lang", F.col("a").alias("outer"), _words("phrase").alias("w"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k")
    )
    inner = inner.select("lang", "outer", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("i"))
    inner = inner.select("lang", "outer", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase"))
    inside = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.col("outer").isNull() | (F.col("outer") < F.col("a")))
    kept = kept.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    # A filter on row_number lets Spark keep each task's first ``top`` before the shuffle by lang.
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
           regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]') AS ps
    FROM documents
), p AS (
    SELECT rid, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pno FROM d
), pw AS (
    SELECT rid, lang, pno, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), w AS (
    SELECT rid, lang, pno, unnest(ws) AS w1, generate_subscripts(ws, 1) AS pos FROM pw
), nx AS (
    SELECT lang, w1,
           lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5
    FROM w
    WINDOW o AS (PARTITION BY rid, pno ORDER BY pos)
), g AS (
    SELECT lang, w1 AS phrase, 1 AS size FROM nx
    UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM nx WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM nx WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM nx WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, 5 FROM nx WHERE w5 IS NOT NULL
), f AS (
    SELECT lang, phrase, size, count(*) AS f FROM g GROUP BY ALL
), n AS (
    SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang
), fr AS (
    SELECT * FROM f WHERE f >= 100
), c AS (
    SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM fr WHERE size >= 2
), cuts AS (
    SELECT c.lang, c.phrase, c.a, s.k,
           array_to_string(c.ws[1 : s.k], ' ') AS lp, array_to_string(c.ws[s.k + 1 : c.size], ' ') AS rp
    FROM c, range(1, 5) AS s(k)
    WHERE s.k < c.size
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.a, cuts.k, l.f AS l, r.f AS r, n.n,
           ((1000::HUGEINT * cuts.a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts
    JOIN fr l ON l.lang = cuts.lang AND l.phrase = cuts.lp
    JOIN fr r ON r.lang = cuts.lang AND r.phrase = cuts.rp
    JOIN n ON n.lang = cuts.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner0 AS (
    SELECT c.lang, c.a, c.ws, s.k, unnest(range(1, c.size - s.k + 2)) AS i
    FROM c, range(2, 5) AS s(k)
    WHERE s.k < c.size
), inner_ AS (
    SELECT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, max(a) AS outer_a FROM inner0 GROUP BY 1, 2
), kept AS (
    SELECT best.* FROM best LEFT JOIN inner_ USING (lang, phrase)
    WHERE inner_.outer_a IS NULL OR inner_.outer_a < best.a
)
SELECT lang,
       row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score
FROM kept
QUALIFY rank <= 2000
"""
