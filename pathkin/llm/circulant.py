"""Near-duplicate documents by circulant MinHash, links confirmed on full shingle sets.

1. Every text becomes a set of word shingles (64-bit hashes). Its signature has
   ``BANDS * ROWS`` coordinates from two permutations of the 64-bit universe: the
   shingle hash is the first, and coordinate k is the least value of the second,
   a fixed bijective mixer, over the set shifted circularly by k.
2. Texts of equal sets share a node: the least row number among them.
3. Nodes that share a band hash form a bucket; each is tied to the bucket's least
   node. The connected components of these ties hold every candidate pair.
4. Components are dealt out as units of bounded size, a larger one cut into blocks
   that meet two by two (``jaccard.verify_groups``). Every two nodes of a unit that
   share a band hash are compared on full sets; a spanning forest of the true
   links is kept, so neither pairs nor copies of sets for each pair are shuffled.
5. The components of the forests are named by the least doc_id of their rows.

Shingles are told apart by 64-bit hashes.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pathkin.llm.components import connected_components
from pathkin.llm.jaccard import verify_groups
from pathkin.session import cut_lineage

SHINGLE = 3
#: Linked when 100 * intersection >= 85 * union.
SIMILAR = (85, 100)
#: A pair at 0.85 shares a band with probability 1 - (1 - 0.85**6)**15 = 0.9990.
ROWS, BANDS = 6, 15
#: Shingles hashed at once in a Python worker, about.
CHUNK = 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers (the second permutation)."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


def words(text: str | None) -> list[bytes]:
    """Words of ``text``: A-Z lower-cased, split at runs of [\\x20\\x09-\\x0D] (bytes.split does that)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; of a shorter text, of its whole sequence; else empty."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    joined = [b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), np.uint64, len(joined)))


def signatures(sets: list[np.ndarray], coordinates: int = ROWS * BANDS) -> np.ndarray:
    """(len(sets), coordinates) circulant MinHash values; a row of an empty set is all ones."""
    out = np.full((len(sets), coordinates), np.iinfo(np.uint64).max, np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    start = 0
    while start < len(full):
        stop, size = start, 0
        while stop < len(full) and (size == 0 or size + len(sets[full[stop]]) <= CHUNK):
            size += len(sets[full[stop]])
            stop += 1
        part = full[start:stop]
        flat = np.concatenate([sets[i] for i in part])
        lengths = np.array([len(sets[i]) for i in part])
        starts = np.cumsum(lengths) - lengths
        for k in range(coordinates):
            out[part, k] = np.minimum.reduceat(_mix(flat + np.uint64(k)), starts)
        start = stop
    return out


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(n, bands) hashes of consecutive groups of ``rows`` coordinates, the band number mixed in."""
    n, width = signature.shape
    bands = width // rows
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (n, 1))
    grouped = signature.reshape(n, bands, rows)
    for k in range(rows):
        out = _mix(out + grouped[:, :, k])
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        bands = band_hashes(signatures(sets))
        prints = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([int.from_bytes(p[:8], "little", signed=True) for p in prints], pa.int64()),
                pa.array([int.from_bytes(p[8:], "little", signed=True) for p in prints], pa.int64()),
                pa.array([_signed(b) if len(s) else [] for b, s in zip(bands, sets)], pa.list_(pa.int64())),
            ],
            ["row", "n_shingles", "fp1", "fp2", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())],
            ["node", "grams", "size"],
        )


def _bucketed(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``df`` stored as a table of the session's warehouse, bucketed and sorted by ``key``
    into as many buckets as shuffle partitions; the table and its name."""
    spark = df.sparkSession
    name = f"pathkin_rows_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return spark.table(name), name


def _drop(df: DataFrame) -> None:
    """Deletes the stored table that ``df`` reads, once nothing else will read it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


SKETCH = "row long, n_shingles long, fp1 long, fp2 long, bands array<bigint>"


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs``.

    ``n_shingles`` is the size of the set of distinct 3-word shingles (A-Z
    lower-cased, words split at [\\x20\\x09-\\x0D]); a text of one or two words has
    the whole sequence as its one shingle; a null, empty or blank text has none
    and is linked with nothing. ``component_id`` is the least doc_id reachable by
    links of similarity >= 0.85, the row's own included; it is null where all rows
    of the component have null ids. ``kept`` is doc_id = component_id, false for
    a null id. Repeated rows share a component, and each is kept when its id is
    the least. Other columns of ``docs`` are ignored; an empty table gives an
    empty result.
    """
    # Texts are stored bucketed by row number, so that picking the texts of candidates
    # moves only the candidates' numbers, never the texts.
    rows, table = _bucketed(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).cast("bigint").alias("doc_id"),
            F.col(text).cast("string").alias("text"),
        ),
        "row",
    )
    spark = docs.sparkSession
    sketch = cut_lineage(rows.select("row", "text").mapInArrow(_sketch, SKETCH))
    full = sketch.filter("n_shingles > 0")
    leaders = full.groupBy("fp1", "fp2").agg(F.min("row").alias("node"))
    nodes = cut_lineage(
        sketch.join(leaders, ["fp1", "fp2"], "left")
        .join(rows.select("row", "doc_id"), "row")
        .select(
            "row",
            "doc_id",
            "n_shingles",
            F.coalesce("node", "row").alias("node"),
            "bands",
            (F.col("row") == F.col("node")).alias("own"),
        )
    )
    _drop(sketch)
    banded = nodes.filter("own").select("node", F.posexplode("bands").alias("band", "hash"))
    # A bucket's leader is its least node, found by partial minima before the shuffle.
    leaders = banded.groupBy("band", "hash").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("size"))
    pairs = cut_lineage(
        banded.join(leaders.filter("size > 1"), ["band", "hash"]).filter("node <> leader").select("leader", "node").distinct()
    )
    ties = pairs.select(F.col("leader").alias("a"), F.col("node").alias("b"))
    found = cut_lineage(connected_components(ties).withColumnsRenamed({"component": "group"}))
    _drop(pairs)
    needed = rows.join(found.select(F.col("node").alias("row")), "row", "left_semi").select("row", "text")
    sets = cut_lineage(needed.mapInArrow(_sets, "node long, grams binary, size long"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    bands = nodes.filter("own").select("node", "bands", F.lit(1).cast("bigint").alias("copies"))
    verified = verify_groups(sets.join(found, "node").join(bands, "node"), SIMILAR[0] / SIMILAR[1], BANDS)
    _drop(sets)
    parts = connected_components(verified.filter("b is not null").select("a", "b"))
    placed = nodes.join(parts, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("part"))
    names = placed.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return placed.join(names, "part").select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
