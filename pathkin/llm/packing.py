"""Packing of examples into sequences under several limits, by the dot-product heuristic."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pathkin.llm.arrays import freed
from pathkin.llm.tokens import chunk_encoder

#: Remainders of documents that are packed together.
WINDOW = 512

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, loss_tokens bigint"
)


#: Size of an item that is already placed.
PLACED = 1 << 60


def choose(tokens: np.ndarray, loss: np.ndarray, room: list[int], limits: tuple[int, ...]) -> int:
    """The item that fits into ``room`` and whose size (tokens, one segment, loss-bearing
    tokens), in units of the limits, has the largest dot product with the room; -1 if none fits.
    """
    if room[1] < 1:
        return -1
    a, b, c = (r / limit**2 for r, limit in zip(room, limits))
    fits = (tokens <= room[0]) & (loss <= room[2])
    k = int(np.argmax(np.where(fits, tokens * a + b + loss * c, -1.0)))
    return k if fits[k] else -1


class Packer:
    """Packs pieces of documents; a piece is (row, start, length) of a document's ids.

    ``limits`` are those of tokens, segments and loss-bearing tokens of a
    sequence. The first id of a document bears no loss, as nothing precedes it.
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int):
        self.limits = (max_tokens, max_segments, max_loss)
        self.pool: list[tuple[int, int, int]] = []

    def full(self, row: int, n: int) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences that one document fills; its remainder goes to the pool."""
        step, start = min(self.limits[0], self.limits[2]), 0
        while n - start >= step:
            yield [(row, start, step)]
            start += step
        if start < n:
            self.pool.append((row, start, n - start))

    def pack(self, last: bool) -> Iterator[list[tuple[int, int, int]]]:
        """Sequences of the pool; unless it is the ``last`` call, what doesn't fill one stays."""
        row, start, tokens = np.array(self.pool, np.int64).reshape(-1, 3).T.copy()
        loss = tokens - (start == 0)
        left = len(row)
        while left:
            room, pieces = list(self.limits), []
            while left and min(room) > 0:
                k = choose(tokens, loss, room, self.limits)
                if k < 0:  # cut the longest to fill what is left
                    k = int(np.argmax(np.where(tokens < PLACED, tokens, -1)))
                cut = min(room[0], room[2] + int(start[k] == 0), int(tokens[k]))
                pieces.append((int(row[k]), int(start[k]), cut))
                room = [room[0] - cut, room[1] - 1, room[2] - cut + int(start[k] == 0)]
                if cut == tokens[k]:
                    tokens[k] = loss[k] = PLACED
                    left -= 1
                else:
                    start[k] += cut
                    tokens[k] -= cut
                    loss[k] = tokens[k]
            if not left and not last and min(room) > 0:
                self.pool = pieces
                return
            yield pieces
        self.pool = []


def _pack(path: str, end_id: int, limits: tuple[int, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = chunk_encoder(path), Packer(*limits)
        sequence = TaskContext.get().partitionId() << 32
        docs: dict[int, tuple] = {}  # id, number of ids, the ids from a place on, that place
        out: list[tuple] = []

        def put(pieces: list[tuple[int, int, int]]) -> None:
            nonlocal sequence
            offset = 0
            for row, start, n in pieces:
                doc, total, ids, at = docs[row]
                crc = zlib.crc32(ids[start - at : start - at + n].tobytes())
                out.append((doc, start, n, crc, total, sequence, offset, n - (start == 0)))
                offset += n
            sequence += 1

        def flush() -> pa.RecordBatch:
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        row = 0
        for batch in batches:
            texts = (t or "" for t in batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                docs[row] = (doc, len(ids), ids, 0)
                for pieces in packer.full(row, len(ids)):
                    put(pieces)
                at = packer.pool[-1][1] if packer.pool and packer.pool[-1][0] == row else len(ids)
                docs[row] = (doc, len(ids), ids[at:].copy(), at)
                row += 1
                if len(packer.pool) >= WINDOW:
                    for pieces in packer.pack(last=False):
                        put(pieces)
                    kept = {p[0] for p in packer.pool}
                    docs = {k: v for k, v in docs.items() if k in kept}
                    yield flush()
        for pieces in packer.pack(last=True):
            put(pieces)
        encoder.clear()
        yield flush()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    max_tokens: int = 1024,
    max_segments: int = 64,
    max_loss: int = 1024,
) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in sequences, one row per piece.

    A document's ids are those of its whole text and ``end_id``; each lies in
    exactly one piece. A document that is longer than a sequence fills whole
    sequences first. Remainders are packed by the dot product of their size
    (tokens, segments, loss-bearing tokens) with the room left, and cut only to
    fill a sequence; the last sequence of a partition may stay short. No row is
    shuffled: every partition packs its own documents, so that sequence ids are
    unique but depend on how the input is split.

    A null text counts as empty (one piece, the end id), a null doc_id stays
    null, repeated rows are packed each, other columns are left out and an empty
    table gives no piece.
    """
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("every limit must be at least 1")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        freed(_pack(tokenizer, end_id, (max_tokens, max_segments, max_loss))), PIECES
    )
