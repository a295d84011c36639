"""Column expressions on raw text: trimming, numbers, stems."""

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from pathkin import fixed

_CONTROL_CHARS = "".join(map(chr, range(0x21)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_control(col: Column) -> Column:
    """Strip spaces and control characters (up to U+0020) from both ends."""
    return F.btrim(col, F.lit(_CONTROL_CHARS))


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    return reduce(or_, (col.startswith(prefix) for prefix in prefixes))


def ends_with_any(col: Column, endings: Sequence[str]) -> Column:
    return reduce(or_, (col.endswith(ending) for ending in endings))


def to_whole(col: Column) -> Column:
    """64-bit integer written in ``col``, or null."""
    text = trim_control(col)
    return F.when(text.rlike(fixed.WHOLE_NUMBER), text.try_cast("bigint"))


def to_real(col: Column) -> Column:
    """Double written in ``col``, or null."""
    text = trim_control(col)
    return F.when(text.rlike(fixed.REAL_NUMBER), text.try_cast("double"))


def to_score(col: Column) -> Column:
    """Double written in ``col`` as score files write it, or null; NaN is 0.0."""
    text = trim_control(col)
    number = F.nanvl(F.coalesce(text.try_cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.when(text.rlike(fixed.SCORE_NUMBER), number)


def score_or_zero(col: Column) -> Column:
    """Double written in ``col``, 0.0 where it is not a number."""
    return F.coalesce(to_score(col), F.lit(0.0))


def stem(col: Column) -> Column:
    """Lower-case ``col`` and take off one verb or plural ending.

    As ``fixed.WORD_ENDINGS`` says, by comparing last letters: patterns cost several times as much.
    """
    word = F.lower(col)
    size = F.length(word)

    def without(n: int) -> Column:
        return F.substring(word, F.lit(1), size - n)

    def doubled(n: int) -> Column:
        """A body of three letters or more before the last ``n``, that ends in a doubled consonant."""
        last = F.substring(word, -n - 1, 1)
        return (size >= n + 3) & (last == F.substring(word, -n - 2, 1)) & ~last.isin(*"aeiou")

    ing = (
        F.when(doubled(3), without(4))
        .when(word.endswith("ying") & (size >= 5), F.concat(without(3), F.lit("y")))
        .when(size >= 5, without(3))
        .otherwise(word)
    )
    ed = (
        F.when(doubled(2), without(3))
        .when(word.endswith("ied") & (size >= 4), F.concat(without(3), F.lit("y")))
        .when(size >= 4, without(2))
        .otherwise(word)
    )
    s = (
        F.when(word.endswith("ies"), F.concat(without(3), F.lit("y")))
        .when(ends_with_any(word, ("ses", "xes", "zes", "hes", "oes")) & (size >= 4), without(2))
        .when((size < 3) | ends_with_any(word, ("ss", "is", "us")), word)
        .otherwise(without(1))
    )
    return (
        F.when(word.endswith("s"), s)
        .when(word.endswith("ed"), ed)
        .when(word.endswith("ing"), ing)
        .otherwise(word)
    )
