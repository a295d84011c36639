"""Mutual information of facts."""

from pyspark.sql import DataFrame, functions as F

from pathkin.functions import scores
from pathkin.operators.counting import KEY, path_slot_counts, slot_word_counts
from pathkin.operators.skew import attach
from pathkin.session import cut_lineage


def mutual_information(triples: DataFrame, unique: bool = False) -> DataFrame:
    """(path, slot, word, mi) of every triple whose mutual information is defined.

    ``unique`` says that every (path, slot, word) occurs once, as in the output
    of ``count_triples``; otherwise the largest value per key is kept. ``triples`` is
    read several times; store it first if it is costly. Its marginals are stored when
    the plan is built: each join asks for them more than once, and each time for other
    columns, so that Spark would count them again.
    """
    by_path = cut_lineage(path_slot_counts(triples))
    by_word = cut_lineage(slot_word_counts(triples))
    total = by_path.agg(F.sum("n")).scalar()
    counted = attach(
        triples.select(*KEY, "cnt"),
        by_path.withColumnRenamed("n", "path_n"),
        keys=["path", "slot"],
        by=["word"],
    )
    counted = attach(
        counted, by_word.withColumnRenamed("n", "word_n"), keys=["slot", "word"], by=["path"]
    )
    return _scored(counted, total, unique)


def mutual_information_from(
    triples: DataFrame, marginals: DataFrame, unique: bool = False
) -> DataFrame:
    """As ``mutual_information``, from stored marginals (kind, path, slot, word, n).

    Triples without both marginals give no row.
    """
    by_path = marginals.filter(F.col("kind") == "PS").select(
        "path", "slot", F.col("n").alias("path_n")
    )
    by_word = marginals.filter(F.col("kind") == "SW").select(
        "slot", "word", F.col("n").alias("word_n")
    )
    total = marginals.filter(F.col("kind") == "TOTAL").agg(F.max("n")).scalar()
    counted = attach(
        triples.select(*KEY, "cnt"),
        by_path.join(path_slot_counts(triples).drop("n"), ["path", "slot"]),
        keys=["path", "slot"],
        by=["word"],
    )
    counted = attach(
        counted,
        by_word.join(slot_word_counts(triples).drop("n"), ["slot", "word"]),
        keys=["slot", "word"],
        by=["path"],
    )
    return _scored(counted, total, unique)


def _scored(counted: DataFrame, total, unique: bool) -> DataFrame:
    value = scores.mi(F.col("cnt"), F.col("path_n"), F.col("word_n"), total)
    rated = counted.select(*KEY, value.alias("mi")).filter(F.col("mi").isNotNull())
    return rated if unique else rated.groupBy(*KEY).agg(F.max("mi").alias("mi"))
