"""Small numpy helpers for rows of different lengths laid out one after the other, and for tasks on them."""

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Start of every row and, last, the end of all rows."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def in_groups(texts: Iterable[str], chars: int) -> Iterator[list[str]]:
    """``texts`` in order, in lists of about ``chars`` characters; none is cut."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def give_back() -> None:
    """Give memory that is free in this process back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freed(run: Callable) -> Callable:
    """The task function ``run`` over batches, after which its free memory is given back.

    Spark keeps Python workers for later stages; what one stage freed would add
    to what the next one takes.
    """

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return task
