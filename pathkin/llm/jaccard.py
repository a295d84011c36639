"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

1. Each text is sketched: a hash of its set of word n-grams, its node, and one
   hash per band of MinHash rows. Texts of equal sets share a node.
2. Nodes that share a band hash are linked to the least of them. The connected
   components of these links hold every candidate pair.
3. Components are dealt out as units of bounded size; a larger one is cut into
   blocks that meet two by two. A unit compares the nodes that share a band by
   their full sets, and keeps counts and a spanning forest of the true links
   instead of the pairs.
4. The components of the forests are the classes.
"""

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from pathkin.llm.arrays import freed, give_back
from pathkin.llm.components import connected_components
from pathkin.session import cut_lineage

N = 5
SIMILARITY = 0.8
RECALL = 0.9995
#: Rows of a band; more rows give fewer false candidates and need more bands.
ROWS = 6
#: n-grams of a unit, about.
UNIT = 1 << 19
KEPT_WORDS = 150_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` rows by which pairs of ``similarity`` meet with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


@functools.lru_cache(1)
def _word_hashes() -> _WordHashes:
    """Word hashes that a Python worker keeps during a task."""
    return _WordHashes()


def ngrams(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of ``text``; of a shorter text, of all its words."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mix(out + h[k : k + len(out)])
    return np.unique(out)


class Sketcher:
    """Band hashes of n-gram sets."""

    def __init__(self, bands: int, rows: int):
        noise = np.random.default_rng(11)
        self.bands, self.rows = bands, rows
        self.factor = (noise.integers(0, 1 << 32, bands * rows, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
        self.shift = noise.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)[:, None]

    def bands_of(self, grams: np.ndarray) -> np.ndarray:
        x = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.bands * self.rows, 0xFFFFFFFF, np.uint32)
        for s in range(0, len(x), 2048):
            np.minimum(least, (self.factor * x[s : s + 2048] + self.shift).min(axis=1), out=least)
        rows = least.reshape(self.bands, self.rows).astype(np.uint64)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for k in range(self.rows):
            out = _mix(out + rows[:, k])
        return out


def _node(grams: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).astype(np.int64))) if len(grams) else None


def _sketch(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands, rows)
        for batch in batches:
            nodes, hashes = [], []
            for text in batch.column("text").to_pylist():
                grams = ngrams(text or "", n)
                nodes.append(_node(grams))
                hashes.append(sketcher.bands_of(grams).astype(np.int64) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))],
                ["doc_id", "node", "bands"],
            )
        _word_hashes().clear()

    return run


def _sets(n: int):
    """Full sets of the texts that are the chosen ones of their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                grams = ngrams(text or "", n)
                rows.append((grams.tobytes(), len(grams)) if _node(grams) == node else (None, None))
            sets, sizes = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.binary()), pa.array(sizes, pa.int64())], ["node", "grams", "size"]
            )
        _word_hashes().clear()

    return run


def compare(
    group: np.ndarray, side: np.ndarray, bands: np.ndarray, sets: list[np.ndarray], similarity: float
) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js) with the true partners js > i of row i, rows being sorted by ``group``.

    Partners are in the same group, share a band hash, and reach ``similarity``.
    Where ``side`` has two values, partners come from different sides.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, number = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0, int))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    two = len(side) > 0 and side.min() != side.max()
    marked = np.zeros(len(flat), bool)
    stop = np.searchsorted(group, group, "right")
    for i in range(len(group)):
        rest = slice(i + 1, int(stop[i]))
        near = (bands[rest] == bands[i]).any(axis=1)
        if two:
            near &= side[rest] != side[i]
        js = np.flatnonzero(near) + i + 1
        if len(js):
            js = js[np.minimum(sizes[js], sizes[i]) >= similarity * np.maximum(sizes[js], sizes[i]) - 1e-9]
        if not len(js):
            continue
        own = number[starts[i] : ends[i]]
        marked[own] = True
        n = sizes[js]
        at = np.cumsum(n) - n
        places = np.repeat(starts[js] - at, n) + np.arange(int(n.sum()))
        both = np.add.reduceat(marked[number[places]].astype(np.int64), at)
        marked[own] = False
        js = js[both >= similarity * (sizes[i] + n - both) - 1e-9]
        if len(js):
            yield i, js


def _verify(similarity: float, bands: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, _, i, j = (k.as_py() for k in key)
        if i != j and pc.count_distinct(table.column("side")).as_py() < 2:
            table = table.slice(0, 0)  # one side is empty; the other is compared within itself in its own cell
        table = table.combine_chunks().sort_by([("group", "ascending"), ("node", "ascending")])
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("grams").to_pylist()]
        hashes = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, bands)
        links = np.zeros(len(node), np.int64)
        root = np.arange(len(node))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        forest = []
        group, side = table.column("group").to_numpy(), table.column("side").to_numpy()
        for i, js in compare(group, side, hashes, sets, similarity):
            links[i] += copies[js].sum()
            links[js] += copies[i]
            for j in js.tolist():
                a, b = top(i), top(j)
                if a != b:
                    root[b] = a
                    forest.append((int(node[i]), int(node[j])))
        # A worker goes on to other cells; the sets of this one are not kept beside theirs.
        del table, sets, hashes
        give_back()
        some = np.flatnonzero(links)
        a = [*node[some].tolist(), *(x for x, _ in forest)]
        b = [*[None] * len(some), *(y for _, y in forest)]
        n = [*links[some].tolist(), *[0] * len(forest)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(n, pa.int64())})

    return run


def verify_groups(sets: DataFrame, similarity: float, bands: int) -> DataFrame:
    """(a, b, links): a spanning forest of the true links, and with b null the links of each node a.

    ``sets`` is (node, group, copies, size, grams, bands): nodes of a group that
    share a band hash are compared by their full sets, in units of bounded size. The
    result is stored.
    """
    sizes = sets.groupBy("group").agg(F.sum("size").alias("grams_all"))
    sizes = cut_lineage(sizes.withColumn("blocks", F.ceil(F.col("grams_all") / UNIT).cast("int")))
    small = sizes.filter("blocks = 1").agg(F.sum("grams_all")).first()[0] or 0
    units = max(1, -(-small // UNIT))
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    placed = sets.join(sizes, "group").withColumn("side", block)
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), F.lit(units))).otherwise(F.col("group"))
    cells = cells.select(
        "group", "node", "copies", "side", "grams", "bands",
        unit.alias("unit"), "blocks", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
    )
    return cut_lineage(
        cells.groupBy("unit", "blocks", "i", "j").applyInArrow(
            _verify(similarity, bands), "a bigint, b bigint, links bigint"
        )
    )


def similar_documents(
    docs: DataFrame, similarity: float = SIMILARITY, n: int = N, recall: float = RECALL, rows: int = ROWS
) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs`` (doc_id, text).

    Rows are linked whose sets of word n-grams have a Jaccard index of
    ``similarity`` or more; a link of just that index is found with probability
    ``recall``, stronger ones more surely. Words are stretches without ASCII
    white space; a text of fewer than n words has one n-gram, all its words.
    ``class_id`` is the least doc_id of all rows that links connect, ``n_links``
    the number of other rows linked to the row.

    Rows that repeat, or have equal sets, are linked. A null or empty text has no
    words and no links; it is a class of its own under its doc_id. A null doc_id
    is linked like others, but doesn't name a class that has another id. Other
    columns are left out.
    """
    bands = bands_for(similarity, recall, rows)
    plain = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sketched = cut_lineage(plain.mapInArrow(freed(_sketch(n, bands, rows)), "doc_id bigint, node bigint, bands array<bigint>"))
    nodes = cut_lineage(
        sketched.filter("node is not null")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"))
    )
    pairs = sketched.filter("node is not null").select("node", F.explode("bands").alias("band")).distinct()
    pairs = cut_lineage(pairs)
    centres = pairs.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a <> last")
    edges = pairs.join(centres, "band").filter("node <> a").select("a", F.col("node").alias("b"))
    found = cut_lineage(connected_components(edges).withColumnsRenamed({"component": "group"}))

    # A node's text is that of its row with the least id.
    chosen = found.join(nodes, "node").select("node", F.coalesce("least_id", F.lit(-(2**63))).alias("id"))
    texts = plain.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "text")
    sets = texts.join(chosen, "id").select("node", "text")
    sets = sets.mapInArrow(freed(_sets(n)), "node bigint, grams binary, size bigint").filter("grams is not null")
    sets = cut_lineage(sets.dropDuplicates(["node"]).join(found, "node").join(nodes, "node"))
    wanted = sketched.filter("node is not null").select("node", "bands").join(found.select("node"), "node", "left_semi")
    sets = sets.join(wanted.dropDuplicates(["node"]), "node")
    verified = verify_groups(sets, similarity, bands)
    links = verified.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = connected_components(verified.filter("b is not null").select("a", "b"))
    named = nodes.join(classes, "node", "left").join(links, "node", "left").select(
        "node", "copies", "least_id", F.coalesce("component", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links")
    )
    least = named.groupBy("class").agg(F.min("least_id").alias("class_id"))
    named = cut_lineage(
        named.join(least, "class").select("node", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    )
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return sketched.select("doc_id", "node").join(named, "node", "left").select(
        "doc_id", own.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every class of ``docs``, with all its columns.

    It is the row of the least doc_id; rows without an id come last. Rows are told
    apart by their own numbers: of rows that repeat, one is kept, and rows of one
    doc_id with different texts are in different classes. Each row with a null or
    empty text is kept.
    """
    numbered = cut_lineage(docs.withColumn("_row", F.monotonically_increasing_id()))
    classes = similar_documents(numbered.select(F.col("_row").alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("_row"), "class_id")
    ids = numbered.select("_row", F.col("doc_id").cast("bigint").alias("id"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "_row")
    kept = classes.join(ids, "_row").groupBy("class_id").agg(F.min(order).alias("least"))
    return numbered.join(kept.select(F.col("least._row").alias("_row")), "_row", "left_semi").select(docs.columns)
