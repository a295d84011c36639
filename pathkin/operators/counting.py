"""Counts of facts and their marginals."""

from pyspark.sql import DataFrame, functions as F

KEY = ["path", "slot", "word"]


def count_triples(occurrences: DataFrame) -> DataFrame:
    """Number of occurrences of each (path, slot, word)."""
    return occurrences.groupBy(*KEY).agg(F.count(F.lit(1)).alias("cnt"))


def path_slot_counts(triples: DataFrame) -> DataFrame:
    """n(path, slot) as ``n``, with the number of triples behind it as ``n_rows``."""
    return triples.groupBy("path", "slot").agg(
        F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("n_rows")
    )


def slot_word_counts(triples: DataFrame) -> DataFrame:
    """n(slot, word) as ``n``, with the number of triples behind it as ``n_rows``."""
    return triples.groupBy("slot", "word").agg(
        F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("n_rows")
    )


def total_count(triples: DataFrame) -> DataFrame:
    """One row ``n``: the sum of all counts."""
    return triples.agg(F.sum("cnt").alias("n"))


def marginals(triples: DataFrame) -> DataFrame:
    """All three marginals in one pass: (kind, path, slot, word, n).

    ``kind`` is PS, SW or TOTAL; columns outside the kind's key are null.
    """
    path, slot, word = (F.col(c) for c in KEY)
    kind = (
        F.when((F.grouping("slot") == 1), "TOTAL").when(F.grouping("word") == 1, "PS").otherwise("SW")
    )
    return (
        triples.groupingSets([[path, slot], [slot, word], []], path, slot, word)
        .agg(kind.alias("kind"), F.sum("cnt").alias("n"))
        .filter(F.col("n").isNotNull())
        .select("kind", *KEY, "n")
    )


def path_totals(mi: DataFrame) -> DataFrame:
    """Sum of mutual information per path over all its slots and words."""
    return mi.groupBy("path").agg(F.sum("mi").alias("total_mi"))
