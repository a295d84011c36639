"""Byte-level BPE by ranks on padded numpy matrices, and back.

Distinct matches of the split pattern are put in buckets by length. In a bucket
every row is one match, padded to the bucket's width; in each round every row
merges its leftmost pair of the smallest rank, found through a hash table of
pairs, and the matrix is compacted where rows have become shorter or are done.
"""

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from pathkin.llm.arrays import gather, in_groups, offsets

GROUP_CHARS = 2_000_000
KEPT_WORDS = 400_000
KEPT_CHARS = 8_000_000
#: Cells of one matrix. Matches over LONG bytes are merged one by one through a heap.
CELLS = 1 << 20
LONG = 1024
NONE = np.int32(2**31 - 1)


class PairTable:
    """A hash table from two neighbouring ids to the id, which is the rank, of their join."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, joined = [], [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(rank)
        keys = self._key(np.array(left, np.int64), np.array(right, np.int64))
        values = np.array(joined, np.int32)
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):  # one key takes each free slot, the others go on to the next slot
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left << 32) | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the join of each pair; NONE where there is none."""
        keys = self._key(left.astype(np.int64), right.astype(np.int64))
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class RankEncoder:
    """Encodes matches of ``pattern`` by the ``ranks`` of byte strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.pairs = PairTable(ranks)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        tokens, numbers = [b""] * size, [b""] * size
        for token, rank in ranks.items():
            tokens[rank], numbers[rank] = token, b"%d," % rank
        self.tokens, self.numbers = self._table(tokens), self._table(numbers)
        self._forget()

    @staticmethod
    def _table(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, items), np.int64, len(items))
        return np.frombuffer(b"".join(items), np.uint8), offsets(lengths)[:-1], lengths

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.chars = 0

    def _merge_rows(self, rows: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row numbers, ids, lengths) of rows that have no pair left, round by round."""
        number = np.arange(len(rows))
        width = rows.shape[1]
        pair = np.full((len(rows), width), NONE, np.int32)
        r, c = np.nonzero(np.arange(width - 1)[None, :] < lengths[:, None] - 1)
        pair[r, c] = self.pairs.ranks(rows[r, c], rows[r, c + 1])
        while len(rows):
            at = pair.argmin(axis=1)
            line = np.arange(len(rows))
            rank = pair[line, at]
            done = rank == NONE
            if done.any():
                yield number[done], rows[done], lengths[done]
                keep = ~done
                width = int(lengths[keep].max(initial=1))
                rows, pair = rows[keep, :width], pair[keep, :width]
                number, lengths, at, rank = number[keep], lengths[keep], at[keep], rank[keep]
                line = np.arange(len(rows))
                if not len(rows):
                    return
            rows[line, at] = rank
            for a in (rows, pair):  # close the gap of the right half of each pair
                moved = np.arange(width - 1)[None, :] > at[:, None]
                a[:, :-1] = np.where(moved, a[:, 1:], a[:, :-1])
            pair[:, -1] = NONE
            lengths = lengths - 1
            for side in (at - 1, at):  # the two pairs that the new id is part of
                known = (side >= 0) & (side + 1 < lengths)
                k, s = line[known], side[known]
                pair[k, s] = self.pairs.ranks(rows[k, s], rows[k, s + 1])
                k, s = line[~known & (side >= 0)], side[~known & (side >= 0)]
                pair[k, s] = NONE

    def _merge_long(self, data: bytes) -> list[int]:
        """The same merges for one long match, through a heap of (rank, place)."""
        ids = self.of_byte[np.frombuffer(data, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        first = self.pairs.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        current = [*first, int(NONE)]
        heap = [(rank, k) for k, rank in enumerate(first) if rank != NONE]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            if current[k] != rank:
                continue
            gone = after[k]
            ids[k], ids[gone], current[gone] = rank, -1, int(NONE)
            after[k] = after[gone]
            if after[k] >= 0:
                before[after[k]] = k
            for s in (before[k], k):
                if s >= 0:
                    e = after[s]
                    current[s] = int(self.pairs.ranks(np.array([ids[s]]), np.array([ids[e]]))[0]) if e >= 0 else int(NONE)
                    if current[s] != NONE:
                        heapq.heappush(heap, (current[s], s))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each of ``words``, none of which is split before."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        buckets: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[k] = np.array([whole], np.int32)
            elif len(word) > LONG:
                out[k] = np.array(self._merge_long(word), np.int32)
            elif word:
                buckets.setdefault((len(word) - 1).bit_length(), []).append(k)
        for bits, members in buckets.items():
            width = max(2, 1 << bits)
            step = max(1, CELLS // width)
            for s in range(0, len(members), step):
                part = members[s : s + step]
                lengths = np.fromiter((len(words[k]) for k in part), np.int64, len(part))
                joined = self.of_byte[np.frombuffer(b"".join(words[k] for k in part), np.uint8)]
                rows = np.zeros((len(part), width), np.int32)
                rows[np.arange(width)[None, :] < lengths[:, None]] = joined
                for number, ids, sizes in self._merge_rows(rows, lengths):
                    for k, line, n in zip(number.tolist(), ids, sizes.tolist()):
                        out[part[k]] = line[:n].copy()
        return out

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each whole text."""
        for group in in_groups(texts, GROUP_CHARS):
            if len(self.places) > KEPT_WORDS or self.chars > KEPT_CHARS:
                self._forget()
            words = [self.split(text) for text in group]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            places, fresh = self.places, []
            for match in set().union(*words):
                if match not in places:
                    places[match] = len(places)
                    fresh.append(match)
            found = self.merge([w.encode("utf-8", "surrogatepass") for w in fresh])
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self.starts = np.concatenate([self.starts, len(self.flat) + offsets(lengths)[:-1]])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, *found])
            self.chars += sum(map(len, fresh))
            at = np.fromiter((p for w in words for p in map(places.__getitem__, w)), np.int64, int(counts.sum()))
            del words
            sizes = self.lengths[at]
            ids, ends = gather(self.flat, self.starts[at], sizes), offsets(sizes)[offsets(counts)]
            for a, b in zip(ends[:-1], ends[1:]):
                yield ids[a:b]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``."""
        flat, starts, lengths = self.tokens
        return gather(flat, starts[ids], lengths[ids]).tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """``ids`` as decimal numbers with commas between them."""
        flat, starts, lengths = self.numbers
        return gather(flat, starts[ids], lengths[ids]).tobytes()[:-1]


def read_ranks(path: str) -> dict[bytes, int]:
    """The byte strings of a rank file, one base64 string and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(1)
def rank_encoder(path: str, pattern: str) -> RankEncoder:
    """One encoder for each Python worker, kept from task to task."""
    return RankEncoder(read_ranks(path), pattern)


def encode_bpe(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of the whole texts of ``docs`` (doc_id, text) by the rank file ``ranks``.

    Every match of ``pattern`` is encoded by itself; a match that has a rank is
    one id, without merges. A null or empty text has no ids, a null doc_id stays
    null, rows are kept as they are, repeated ones too, and other columns are
    left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks, pattern)
        for batch in batches:
            ids = encoder.encode(t or "" for t in batch.column("text").to_pylist())
            rows = pa.array((x.tolist() for x in ids), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "ids"])

    plain = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_bpe(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids); null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            rows = pa.array((encoder.decode(np.array(x or [], np.int64)) for x in ids), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "bytes"])

    plain = encoded.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>"))
    return plain.mapInArrow(run, "doc_id bigint, bytes binary")


def bpe_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts, encoded and decoded again.

    Nulls, empty texts and repeated rows as in ``encode_bpe``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks, pattern)
        for batch in batches:
            sizes, of_ids, of_bytes = [], [], []
            for ids in encoder.encode(t or "" for t in batch.column("text").to_pylist()):
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(encoder.decimal(ids)).hexdigest())
                of_bytes.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    plain = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
