"""Token ids of whole texts by a byte-level BPE file of the tokenizers library."""

import functools
import os
from collections.abc import Iterable, Iterator
from itertools import repeat
from operator import itemgetter

import numpy as np
from tokenizers import Tokenizer

from pathkin.llm.arrays import gather, in_groups, offsets

#: Characters encoded together, and chunks and characters remembered between texts.
GROUP_CHARS = 1_000_000
#: New chunks that the library is given as one text.
TOGETHER = 4096
KEPT_CHUNKS = 300_000
KEPT_CHARS = 6_000_000
#: Marks at the end of a chunk, which the pre-tokenizer parts from a letter or digit before them.
END_MARKS = ",.;:!?"
_LAST = itemgetter(slice(-1, None))


class _Places(dict):
    """A number for every key asked for; new keys are also put in ``fresh``."""

    def __init__(self, fresh: list, before: str):
        super().__init__()
        self.fresh, self.before = fresh, before

    def __missing__(self, word: str) -> int:
        place = self.fresh[0]
        self.fresh[0] = place + 1
        self.fresh.append(self.before + word)
        self[word] = place
        return place


class ChunkEncoder:
    """The library's ids of whole texts, each distinct chunk of text encoded once.

    The pre-tokenizer of byte-level BPE never joins a character that is not
    white space to a space after it, so a text may be cut before each such space
    without changing an id. A text with a space after other white space is given
    to the library whole. Nor does it join a letter or digit to a mark after it, so
    a chunk that ends in marks has the ids of the chunk before them and of the marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        self.tokenizer = Tokenizer.from_file(path)
        # A character of a byte-level token stands for one byte; added tokens are plain text.
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.n_bytes[i] = len(token)
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[i] = len(added.content.encode())
        self.clear()

    def clear(self) -> None:
        """Forget all chunks; done at the end of a task, as workers go on to other work."""
        self.fresh: list = [0]
        self.first, self.later = _Places(self.fresh, ""), _Places(self.fresh, " ")
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.open_end = np.zeros(0, bool)
        self.used = np.zeros(0, np.int64)
        self.chars = 0

    def _forget(self) -> None:
        """Keep the chunks met most often, half of the room for them at most."""
        least = 2
        while (keep := self.used >= least).sum() > KEPT_CHUNKS // 2 or self.lengths[keep].sum() > KEPT_CHARS // 2:
            least *= 2
        place = np.cumsum(keep) - 1
        for words in (self.first, self.later):
            kept = {w: int(place[k]) for w, k in words.items() if keep[k]}
            words.clear()
            words.update(kept)
        self.flat = gather(self.flat, self.starts[keep], self.lengths[keep])
        self.lengths, self.open_end, self.used = self.lengths[keep], self.open_end[keep], self.used[keep] // 2
        self.starts = offsets(self.lengths)[:-1]
        self.fresh[0] = len(self.lengths)
        self.chars = sum(map(len, self.first)) + sum(map(len, self.later))
        if self.chars > KEPT_CHARS // 2:  # few but very long chunks
            self.clear()

    def _ids(self, chunks: list[str], open_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of ``chunks`` in any order, and where those of each chunk start and how many they are.

        Chunks that begin with a space and end in another character may stand one
        after the other in one text; the bytes of its ids tell where each one ends.
        """
        starts, lengths = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        sizes = np.fromiter(map(len, map(str.encode, chunks)), np.int64, len(chunks))
        spaced = np.fromiter(map(str.startswith, chunks, repeat(" ")), bool, len(chunks)) & ~open_end
        alone, parts, total = np.flatnonzero(~spaced).tolist(), [np.zeros(0, np.uint32)], 0
        many = np.flatnonzero(spaced)
        for s in range(0, len(many), TOGETHER):
            part = many[s : s + TOGETHER]
            text = "".join(chunks[k] for k in part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            reach, stops = offsets(self.n_bytes[ids]), offsets(sizes[part])
            cuts = np.searchsorted(reach, stops)
            if reach[-1] != stops[-1] or (reach[cuts] != stops).any():
                alone += part.tolist()
                continue
            starts[part], lengths[part] = total + cuts[:-1], np.diff(cuts)
            parts.append(ids)
            total += len(ids)
        for k, x in zip(alone, self.tokenizer.encode_batch_fast([chunks[k] for k in alone], add_special_tokens=False)):
            parts.append(np.array(x.ids, np.uint32))
            starts[k], lengths[k] = total, len(parts[-1])
            total += len(parts[-1])
        return np.concatenate(parts), starts, lengths

    def _marked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New chunks that end in marks after a letter or digit: their number among the new ones,
        and the places of the chunk before the marks and of the marks, which may be new too."""
        numbers, cores, marks = [], [], []
        chunks = self.fresh[1:]
        for k, (chunk, core) in enumerate(zip(chunks, list(map(str.rstrip, chunks, repeat(END_MARKS))))):
            if len(core) < len(chunk) and core[-1:].isalnum():
                numbers.append(k)
                cores.append(self.later[core[1:]] if core[0] == " " else self.first[core])
                marks.append(self.first[chunk[len(core) :]])
        return np.array(numbers, np.int64), np.array(cores, np.int64), np.array(marks, np.int64)

    def _learn(self) -> None:
        if len(self.fresh) == 1:
            return
        old = len(self.lengths)
        marked, cores, marks = self._marked()
        chunks = self.fresh[1:]
        del self.fresh[1:]
        ends = np.fromiter(map(str.isspace, map(_LAST, chunks)), bool, len(chunks))
        plain = np.ones(len(chunks), bool)
        plain[marked] = False
        at = np.flatnonzero(plain)
        flat, starts, lengths = self._ids([chunks[k] for k in at.tolist()], ends[at])
        self.starts = np.concatenate([self.starts, np.zeros(len(chunks), np.int64)])
        self.lengths = np.concatenate([self.lengths, np.zeros(len(chunks), np.int64)])
        self.starts[old + at], self.lengths[old + at] = len(self.flat) + starts, lengths
        self.flat = np.concatenate([self.flat, flat])
        both = np.stack([cores, marks], axis=1).ravel()
        joined = self.lengths[cores] + self.lengths[marks]
        self.starts[old + marked] = len(self.flat) + offsets(joined)[:-1]
        self.flat = np.concatenate([self.flat, gather(self.flat, self.starts[both], self.lengths[both])])
        self.lengths[old + marked] = joined
        self.open_end = np.concatenate([self.open_end, ends])
        self.used = np.concatenate([self.used, np.zeros(len(chunks), np.int64)])
        self.chars += sum(map(len, chunks))

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        for group in in_groups(texts, GROUP_CHARS):
            if len(self.lengths) > KEPT_CHUNKS or self.chars > KEPT_CHARS:
                self._forget()
            rows = []
            for text in group:
                head, *rest = text.split(" ")
                rows.append(self.first[head])
                rows.extend(map(self.later.__getitem__, rest))
            self._learn()
            places = np.array(rows, np.int64)
            del rows
            self.used += np.bincount(places, minlength=len(self.used))
            counts = self.lengths[places]
            ids = gather(self.flat, self.starts[places], counts)
            cuts = offsets(np.fromiter((t.count(" ") + 1 for t in group), np.int64, len(group)))
            ends, open_end = offsets(counts)[cuts], self.open_end[places]
            for k, text in enumerate(group):
                if open_end[cuts[k] : cuts[k + 1] - 1].any():
                    whole = self.tokenizer.encode(text, add_special_tokens=False)
                    yield np.array(whole.ids, np.uint32)
                else:
                    yield ids[ends[k] : ends[k + 1]]


@functools.lru_cache(1)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker; the tokenizer is read once."""
    return ChunkEncoder(path)
