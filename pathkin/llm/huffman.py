"""Token files: canonical length-limited Huffman codes in independent blocks.

A token file is a folder of Parquet: ``blocks`` has a row per block, ``codebook``
the code length of every id. Codes are canonical (ordered by length, then id), so
lengths are all a reader needs. A block holds whole documents in ascending order
and can be read alone; it keeps the bit offset of every ``CHECKPOINT``-th id, and
the decoder follows all checkpoints of a block side by side through one table.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from pathkin.llm.arrays import offsets
from pathkin.llm.tokens import chunk_encoder
from pathkin.session import cut_lineage

LIMIT = 20
CHECKPOINT = 256
BLOCK_TOKENS = 1 << 16
#: Token ids in a partition of the written files, about.
SHARD_TOKENS = 1 << 23

BLOCKS = (
    "shard int, block int, first bigint, n_tokens bigint, doc_ids binary, known_ids binary,"
    " doc_tokens binary, checkpoints binary, payload binary"
)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over ``limit`` bits, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    merged, is_leaf = leaves, []
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        is_leaf.append(rank < n)
        merged = both[rank]
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(is_leaf):
        k = int(level[:taken].sum())
        lengths[:k] += 1
        taken = 2 * (taken - k)
    lengths[:taken] += 1
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes of ``symbols`` with code lengths ``lengths``."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = symbols[order].astype(np.int64), lengths[order]
        self.width = int(self.lengths.max(initial=1))
        steps = np.left_shift(1, self.width - self.lengths)
        self.codes = (offsets(steps)[:-1] >> (self.width - self.lengths)).astype(np.int64)
        self.steps = steps

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids``, and the bit offset of every CHECKPOINT-th id."""
        size = int(self.symbols.max(initial=0)) + 1
        code, length = np.zeros(size, np.int64), np.zeros(size, np.int64)
        code[self.symbols], length[self.symbols] = self.codes, self.lengths
        lengths = length[ids]
        at = offsets(lengths)
        places = at[:-1] >> 3
        shifted = code[ids] << (32 - (at[:-1] & 7) - lengths)
        out = np.zeros(int(at[-1] >> 3) + 5, np.float64)
        for k in range(4):
            part = (shifted >> (24 - 8 * k)) & 255
            out += np.bincount(places + k, part, len(out))
        return out.astype(np.uint8)[: int(at[-1] + 7) >> 3].tobytes(), at[:-1:CHECKPOINT]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and code length for every ``width`` bits that may come next."""
        return np.repeat(self.symbols, self.steps), np.repeat(self.lengths, self.steps)

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, tables) -> np.ndarray:
        """The ``n`` ids of a block."""
        symbols, lengths = tables
        data = np.zeros(len(payload) + 8, np.int64)
        data[: len(payload)] = np.frombuffer(payload, np.uint8)
        words = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        out = np.zeros((len(checkpoints), CHECKPOINT), np.uint32)
        at, tail, mask = checkpoints.copy(), n - CHECKPOINT * (len(checkpoints) - 1), (1 << self.width) - 1
        for step in range(min(n, CHECKPOINT)):
            if step == tail:  # the last checkpoint has fewer ids
                at = at[:-1]
            window = (words[at >> 3] >> (32 - self.width - (at & 7))) & mask
            out[: len(at), step] = symbols[window]
            at = at + lengths[window]
        return out.reshape(-1)[:n]


#: Ids on their way to the files: two bytes are enough for the vocabularies of up to 65,536 ids.
SHORT, WIDE = "<u2", "<u4"


def _width(path: str, end_id: int) -> str:
    return SHORT if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else WIDE


def _tokenize(path: str, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = chunk_encoder(path), np.array([end_id], np.uint32)
        for batch in batches:
            texts = (t or "" for t in batch.column("text").to_pylist())
            sizes, packed = [], []
            for ids in encoder.encode(texts):
                sizes.append(len(ids) + 1)
                packed.append(np.concatenate([ids, end]).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )
        encoder.clear()

    return run


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of each whole text and ``end_id``, little-endian, as wide as ``_width`` says."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _tokenize(tokenizer, end_id, _width(tokenizer, end_id)), "doc_id bigint, n_tokens bigint, ids binary"
    )


def _count(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind))
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return run


def _write(symbols: np.ndarray, lengths: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, shard = Codebook(symbols, lengths), TaskContext.get().partitionId()
        docs, parts, size, first, block = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            payload, checkpoints = book.encode(np.concatenate(parts).astype(np.int64))
            row = {
                "shard": shard,
                "block": block,
                "first": first,
                "n_tokens": size,
                "doc_ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
                "known_ids": np.array([d is not None for d in docs], bool).tobytes(),
                "doc_tokens": np.array([len(p) for p in parts], "<i8").tobytes(),
                "checkpoints": checkpoints.astype("<i8").tobytes(),
                "payload": payload,
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], list(row))

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                docs.append(doc)
                parts.append(np.frombuffer(ids, kind))
                size += len(parts[-1])
                if size >= BLOCK_TOKENS:
                    yield close()
                    docs, parts, size, first, block = [], [], 0, first + size, block + 1
        if docs:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of all ``docs`` (doc_id, text) as a token file in the folder ``path``.

    Code lengths come from the counts of all ids. Documents are written in
    ascending doc_id; a null id comes first, repeated ids stand side by side, a
    null text counts as empty and other columns are left out. An empty table
    gives a file without blocks.
    """
    spark, kind = docs.sparkSession, _width(tokenizer, end_id)
    ids = cut_lineage(tokenize(docs, tokenizer, end_id))
    counted = ids.mapInArrow(_count(kind), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = counted.orderBy("id").toPandas()  # at most one row per id of the vocabulary
    symbols, total = counts["id"].to_numpy(), int(counts["n"].sum())
    lengths = code_lengths(counts["n"].to_numpy())
    book = [(int(s), int(n)) for s, n in zip(symbols, lengths)]
    spark.createDataFrame(book, "id bigint, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shards = max(1, -(-total // SHARD_TOKENS))
    (
        ids.repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "n_tokens", "ids")
        .mapInArrow(_write(symbols, lengths, kind), BLOCKS)
        .write.parquet(f"{path}/blocks")
    )


def _read(symbols: np.ndarray, lengths: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(symbols, lengths)
        tables = book.tables()
        for batch in batches:
            for row in batch.to_pylist():
                checkpoints = np.frombuffer(row["checkpoints"], "<i8")
                ids = book.decode(row["payload"], checkpoints, row["n_tokens"], tables).astype("<u4")
                sizes = np.frombuffer(row["doc_tokens"], "<i8")
                known = np.frombuffer(row["known_ids"], bool)
                cuts = offsets(sizes)
                docs = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                out = {
                    "doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=~known),
                    "start": pa.array(row["first"] + cuts[:-1], pa.int64()),
                    "shard": pa.array([row["shard"]] * len(docs), pa.int32()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array(map(zlib.crc32, docs), pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array(docs, pa.binary())
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a token file.

    ``start`` is the number of ids of all documents before it.
    """
    book = spark.read.parquet(f"{path}/codebook").orderBy("id").toPandas()
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per written partition.
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before = offsets(np.array([r["n"] for r in sizes], np.int64))
    starts = spark.createDataFrame(
        [(r["shard"], int(b)) for r, b in zip(sizes, before)], "shard int, before bigint"
    )
    schema = "doc_id bigint, start bigint, shard int, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids binary" if with_ids else ""
    reader = _read(book["id"].to_numpy(), book["length"].to_numpy(), with_ids)
    rows = blocks.mapInArrow(reader, schema).join(F.broadcast(starts), "shard")
    return rows.withColumn("start", F.col("start") + F.col("before")).drop("shard", "before")
