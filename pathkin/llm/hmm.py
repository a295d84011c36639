"""A hidden Markov language model, trained by Baum-Welch over all partitions.

A word w stands in one of BUCKETS buckets by its hash. A latent state emits a
bucket, and the bucket emits the word with a smoothed share g(w) of the bucket's
training tokens that doesn't depend on the state. So the model is a distribution
over all words while its parameters have a fixed size.

Texts are handled in blocks: local word numbers of all tokens, and a row for each
distinct word of a block, through which the block gets global counts. Recursions
run over segments of SEG tokens side by side: the product of a segment's transfer
matrices takes a text's forward vector over the whole segment, which gives the
exact scaled forward recursion with few steps.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pathkin.llm.arrays import offsets
from pathkin.session import cut_lineage

STATES = 4
BUCKETS = 8192
ROUNDS = 3
SEG = 64
#: Characters of a block, about; a text is never cut.
BLOCK_CHARS = 8_000_000
#: The token after the last word; no word holds white space.
END = b"\n"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of ``text``, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def held_out(doc_id: int | None) -> bool:
    """Whether crc32(id as text) mod 5 is 1; false for a null id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


BLOCKS = "block bigint, doc_ids binary, known_ids binary, held binary, sizes binary, tokens binary, hashes binary, trained binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    ids: list[int | None] = []
    places: dict[bytes, int] = {END: 0}
    rows: list[np.ndarray] = []
    chars = 0

    def close() -> pa.RecordBatch:
        held = np.array([held_out(d) for d in ids], bool)
        sizes = np.array([len(r) for r in rows], np.int64)
        tokens = np.concatenate(rows)
        trained = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(places))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, places), np.uint64, len(places))
        values = [
            number,
            np.array([d or 0 for d in ids], "<i8"),
            np.array([d is not None for d in ids], bool),
            held,
            sizes,
            zstandard.compress(tokens.tobytes(), 3),
            hashes,
            zstandard.compress(trained.astype("<i8").tobytes(), 3),
        ]
        kinds = [pa.int64(), *[pa.binary()] * 7]
        return pa.RecordBatch.from_arrays(
            [pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], t) for v, t in zip(values, kinds)], names
        )

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text or "")
            rows.append(np.array([*(places.setdefault(w, len(places)) for w in words), 0], "<u4"))
            ids.append(doc)
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield close()
                number, ids, places, rows, chars = number + 1, [], {END: 0}, [], 0
    if rows:
        yield close()


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            hashes = np.frombuffer(row["hashes"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(hashes), row["block"], np.int64)),
                    pa.array(np.arange(len(hashes), dtype=np.int32)),
                    pa.array(hashes),
                    pa.array(np.frombuffer(zstandard.decompress(row["trained"]), "<i8")),
                ],
                ["block", "place", "hash", "n"],
            )


@dataclass
class Counts:
    """Training tokens and distinct training words of every bucket."""

    tokens: np.ndarray
    words: np.ndarray

    @property
    def total(self) -> int:
        return int(self.tokens.sum())

    @property
    def distinct(self) -> int:
        return int(self.words.sum())


CODED = (
    "doc_ids binary, known_ids binary, held binary, sizes binary, buckets binary,"
    " n_known binary, base binary, inner binary"
)


def _code(counts: Counts):
    """Bucket numbers of all tokens of a block, and the sums that don't depend on states."""
    names = [c.split()[0] for c in CODED.split(", ")]

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        n = words.num_rows
        count, bucket = np.empty(n, np.int64), np.empty(n, np.int64)
        place = words.column("place").to_numpy()
        count[place] = words.column("total").to_numpy()
        bucket[place] = words.column("bucket").to_numpy()
        tokens = np.frombuffer(zstandard.decompress(row["tokens"]), "<u4")
        starts = offsets(np.frombuffer(row["sizes"], np.int64))[:-1]
        base = np.log10((count + 0.5) / (counts.total + 0.5 * (counts.distinct + 1)))
        inner = np.log((count + 0.5) / (counts.tokens[bucket] + 0.5 * (counts.words[bucket] + 1)))
        values = [row["doc_ids"], row["known_ids"], row["held"], row["sizes"], bucket[tokens].astype("<u2").tobytes()]
        for per_word in ((count > 0).astype(np.int64), base, inner):
            values.append(np.add.reduceat(per_word[tokens], starts).tobytes())
        return pa.table([pa.array([v], pa.binary()) for v in values], names=names)

    return run


@dataclass
class Hmm:
    """Start vector before the first token, transitions, and emissions of buckets by state."""

    start: np.ndarray
    moves: np.ndarray
    emit: np.ndarray

    @staticmethod
    def first(counts: Counts, states: int) -> "Hmm":
        """States that differ by fixed random factors."""
        noise = np.random.default_rng(7)
        emit = (counts.tokens + 0.5 * (counts.words + 1))[None, :] * noise.uniform(0.5, 1.5, (states, len(counts.tokens)))
        moves = noise.uniform(0.5, 1.5, (states, states)) + 2 * np.eye(states)
        return Hmm(
            np.full(states, 1 / states), moves / moves.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
        )

    def next(self, start: np.ndarray, moves: np.ndarray, emit: np.ndarray, counts: Counts) -> "Hmm":
        """The model of expected counts; every word and one new word of a bucket weigh half a token more."""
        share = emit.sum(1, keepdims=True) / max(emit.sum(), 1e-300)
        emit = emit + 0.5 * (counts.words + 1)[None, :] * share + 1e-12
        start, moves = start + 1, moves + 1
        return Hmm(start / start.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


class Lanes:
    """Texts of a block cut into segments; longer segments and texts of more segments come first."""

    def __init__(self, buckets: np.ndarray, sizes: np.ndarray):
        per_text = -(-sizes // SEG)
        cuts = offsets(per_text)
        n = int(cuts[-1])
        text = np.repeat(np.arange(len(sizes)), per_text)
        index = np.arange(n) - cuts[:-1][text]
        length = np.minimum(sizes[text] - index * SEG, SEG)
        order = np.argsort(-length, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.length = length[order]
        self.live = [int(np.searchsorted(-self.length, -t)) for t in range(SEG)]  # segments longer than t
        begin = offsets(sizes)[:-1][text] + index * SEG
        grid = begin[order][None, :] + np.arange(SEG)[:, None]
        self.seen = buckets[np.minimum(grid, len(buckets) - 1)]
        self.texts = np.argsort(-per_text, kind="stable")
        most = int(per_text.max(initial=0))
        n_of = per_text[self.texts]
        self.steps = [place[cuts[:-1][self.texts[: int((n_of > j).sum())]] + j] for j in range(most)]
        self.n_texts = len(sizes)

    def transfer(self, model: Hmm) -> tuple[np.ndarray, np.ndarray]:
        """Product of a segment's transfer matrices, scaled, and the logarithm of the scale."""
        k, n = len(model.start), len(self.length)
        out, logs = np.tile(np.eye(k), (n, 1, 1)), np.zeros(n)
        emit = np.ascontiguousarray(model.emit.T)
        for t, m in enumerate(self.live):
            if m:
                out[:m] = (out[:m].reshape(-1, k) @ model.moves).reshape(m, k, k) * emit[self.seen[t, :m]][:, None, :]
            if t % 8 == 7 or t == SEG - 1:
                top = out.max(axis=(1, 2))
                out /= top[:, None, None]
                logs += np.log(top)
        return out, logs

    def forward(self, model: Hmm, transfer: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of every text, and the forward vector before every segment."""
        k = len(model.start)
        before = np.empty((len(self.length), k))
        now, like = np.tile(model.start, (self.n_texts, 1)), np.zeros(self.n_texts)
        for lanes in self.steps:
            m = len(lanes)
            before[lanes] = now[:m]
            moved = np.einsum("ni,nij->nj", now[:m], transfer[lanes])
            scale = moved.sum(1)
            now[:m] = moved / scale[:, None]
            like[:m] += np.log(scale) + logs[lanes]
        out = np.empty(self.n_texts)
        out[self.texts] = like
        return out, before

    def expect(self, model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of start states, moves and emissions, and the log likelihood."""
        k, n = len(model.start), len(self.length)
        transfer, logs = self.transfer(model)
        like, before = self.forward(model, transfer, logs)
        after = np.ones((n, k))
        for j in range(len(self.steps) - 1, 0, -1):
            lanes = self.steps[j]
            back = np.einsum("nij,nj->ni", transfer[lanes], after[lanes])
            after[self.steps[j - 1][: len(lanes)]] = back / back.sum(1, keepdims=True)
        emit = np.ascontiguousarray(model.emit.T)
        forward = np.empty((SEG, n, k))
        now = before.copy()
        for t, m in enumerate(self.live):
            now[:m] = (now[:m] @ model.moves) * emit[self.seen[t, :m]]
            now[:m] /= now[:m].sum(1, keepdims=True)
            forward[t] = now
        moves, n_buckets = np.zeros((k, k)), model.emit.shape[1]
        emitted = np.zeros((k, n_buckets))
        behind = after
        for t in range(SEG - 1, -1, -1):
            m = self.live[t]
            if not m:
                continue
            seen = self.seen[t, :m]
            state = forward[t, :m] * behind[:m]
            state /= state.sum(1, keepdims=True)
            for s in range(k):
                emitted[s] += np.bincount(seen, state[:, s], n_buckets)
            ahead = emit[seen] * behind[:m]
            previous = forward[t - 1, :m] if t else before[:m]
            total = ((previous @ model.moves) * ahead).sum(1, keepdims=True)
            moves += model.moves * ((previous / total).T @ ahead)
            behind[:m] = (ahead @ model.moves.T) / total
        first = model.start * behind[self.steps[0]] if self.steps else np.zeros((0, k))
        return (first / first.sum(1, keepdims=True)).sum(0), moves, emitted, float(like.sum())


def _expectations(model: Hmm):
    k, n_buckets = model.emit.shape
    names = ["row", *(f"s{s}" for s in range(k))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, some = np.zeros((n_buckets + k + 1, k)), False
        for batch in batches:
            for row in batch.to_pylist():
                held, sizes = np.frombuffer(row["held"], bool), np.frombuffer(row["sizes"], np.int64)
                buckets = np.frombuffer(row["buckets"], "<u2")[np.repeat(~held, sizes)]
                if held.all():
                    continue
                start, moves, emitted, _ = Lanes(buckets, sizes[~held]).expect(model)
                out[:n_buckets] += emitted.T
                out[n_buckets : n_buckets + k] += moves
                out[-1] += start
                some = True
        if some:
            used = np.flatnonzero(out.sum(1))
            columns = [pa.array(used, pa.int64()), *(pa.array(out[used, s]) for s in range(k))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run, "row bigint, " + ", ".join(f"{x} double" for x in names[1:])


def _scores(model: Hmm, total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["sizes"], np.int64)
                lanes = Lanes(np.frombuffer(row["buckets"], "<u2"), sizes)
                like, _ = lanes.forward(model, *lanes.transfer(model))
                known = np.frombuffer(row["known_ids"], bool)
                out = {
                    "doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=~known),
                    "held_out": pa.array(np.frombuffer(row["held"], bool)),
                    "n_tokens": pa.array(sizes),
                    "n_known": pa.array(np.frombuffer(row["n_known"], np.int64)),
                    "train_tokens": pa.array(np.full(len(sizes), total, np.int64)),
                    "base_score": pa.array(np.frombuffer(row["base"], float)),
                    "score": pa.array((like + np.frombuffer(row["inner"], float)) / np.log(10)),
                }
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
        " base_score double, score double"
    )
    return run, schema


def score_texts(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Log10 probabilities of the whole texts of ``docs`` (doc_id, text), one row per row.

    Texts that aren't held out by their id train the model. ``base_score`` is
    that of smoothed token counts, ``score`` that of the hidden Markov model. A
    null or empty text is its end token alone; a null id counts as training;
    repeated rows count each; other columns are left out. Without any training
    text all counts are zero and the scores are those of the smoothing.
    Words are told apart by 64-bit hashes.
    """
    plain = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    blocks = cut_lineage(plain.mapInArrow(_blocks, BLOCKS))
    words = blocks.select("block", "hashes", "trained").mapInArrow(
        _word_rows, "block bigint, place int, hash bigint, n bigint"
    )
    same = Window.partitionBy("hash")
    counted = cut_lineage(
        words.select(
            "block",
            "place",
            F.pmod("hash", F.lit(BUCKETS)).cast("int").alias("bucket"),
            F.sum("n").over(same).alias("total"),
            (F.row_number().over(same.orderBy("block")) == 1).alias("first"),
        )
    )
    per_bucket = (
        counted.filter("first and total > 0")
        .groupBy("bucket")
        .agg(F.sum("total").alias("tokens"), F.count(F.lit(1)).alias("words"))
        .collect()  # one row per bucket at most
    )
    counts = Counts(np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64))
    for r in per_bucket:
        counts.tokens[r["bucket"]], counts.words[r["bucket"]] = r["tokens"], r["words"]
    coded = cut_lineage(
        blocks.drop("hashes", "trained")
        .groupBy("block")
        .cogroup(counted.drop("first").groupBy("block"))
        .applyInArrow(_code(counts), CODED)
    )
    model = Hmm.first(counts, states)
    for _ in range(rounds if counts.total else 0):
        run, schema = _expectations(model)
        sums = coded.mapInArrow(run, schema).groupBy("row").agg(*(F.sum(f"s{s}").alias(f"s{s}") for s in range(states)))
        out = np.zeros((BUCKETS + states + 1, states))
        for r in sums.collect():  # one row per bucket, state and for the start
            out[r["row"]] = r[1:]
        model = model.next(out[-1], out[BUCKETS:-1], out[:BUCKETS].T, counts)
    run, schema = _scores(model, counts.total)
    return coded.mapInArrow(run, schema)
