"""Column expressions for scores, pairs and quality measures."""

from pyspark.sql import Column, functions as F

from pathkin.functions.text import trim_control


def mi(cnt: Column, path_slot: Column, slot_word: Column, total: Column) -> Column:
    """ln(cnt * total / (path_slot * slot_word)); null where that is undefined.

    Products are taken in double, so large counts cannot overflow.
    """
    ratio = (cnt.cast("double") * total.cast("double")) / (
        path_slot.cast("double") * slot_word.cast("double")
    )
    defined = (total > 0) & (path_slot > 0) & (slot_word > 0) & (cnt > 0)
    return F.when(defined, F.ln(ratio))


def partial(mi_a: Column, mi_b: Column) -> Column:
    """Contribution of one shared feature to a pair of paths."""
    return mi_a + mi_b


def lin(numerator: Column, total_a: Column, total_b: Column) -> Column:
    """numerator / (total_a + total_b); the numerator itself where the sum is missing or <= 0."""
    return lin_over(numerator, total_a + total_b)


def lin_over(numerator: Column, weight: Column) -> Column:
    """As ``lin``, for totals that are already added up."""
    return F.when(weight > 0, numerator / weight).otherwise(numerator)


def ordered_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """The two strings, smaller first."""
    return F.least(a, b), F.greatest(a, b)


def pair_key(a: Column, b: Column) -> tuple[Column, Column]:
    """Order-free key of a pair as two columns ``k1``, ``k2``, blanks stripped; null if either is."""
    first, second = ordered_pair(trim_control(a), trim_control(b))
    whole = a.isNotNull() & b.isNotNull()
    return F.when(whole, first).alias("k1"), F.when(whole, second).alias("k2")


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def f1(precision: Column, recall: Column, epsilon: float = 0.0) -> Column:
    """Harmonic mean of precision and recall, 0 when both are 0.

    With ``epsilon`` the denominator is padded by it, as curve summaries do.
    """
    weight = precision + recall + F.lit(epsilon)
    return ratio_or_zero(2 * precision * recall, weight)
