"""Text sources.

Each ``read_*`` is a ``parse_*`` over ``spark.read.text``; the parsers take any
DataFrame with a string column ``value``. Lines that do not fit are dropped.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pathkin import fixed
from pathkin.functions.text import score_or_zero, to_real, to_score, to_whole, trim_control


def read_ngram_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line of a text file or folder."""
    return spark.read.text(path)


def _fields(lines: DataFrame, at_least: int) -> DataFrame:
    fields = F.split(trim_control(F.col("value")), fixed.FIELD)
    return lines.select(fields.alias("f")).filter(F.size("f") >= at_least)


def _field(i: int) -> Column:
    return F.get("f", F.lit(i))


def parse_triples(lines: DataFrame) -> DataFrame:
    """path, slot, word, cnt."""
    return (
        _fields(lines, 4)
        .select(
            _field(0).alias("path"),
            _field(1).alias("slot"),
            _field(2).alias("word"),
            to_whole(_field(3)).alias("cnt"),
        )
        .filter(F.col("cnt").isNotNull())
    )


def parse_mi(lines: DataFrame) -> DataFrame:
    """path, slot, word, mi."""
    return (
        _fields(lines, 4)
        .select(
            _field(0).alias("path"),
            _field(1).alias("slot"),
            _field(2).alias("word"),
            to_real(_field(3)).alias("mi"),
        )
        .filter(F.col("mi").isNotNull())
    )


def parse_partials(lines: DataFrame) -> DataFrame:
    """path_a, path_b, partial."""
    return (
        _fields(lines, 3)
        .select(
            _field(0).alias("path_a"),
            _field(1).alias("path_b"),
            to_real(_field(2)).alias("partial"),
        )
        .filter(F.col("partial").isNotNull())
    )


def _key_and_value(lines: DataFrame, place: Column) -> DataFrame:
    """``key`` before and ``text`` after the last tab of the trimmed line, with ``place``."""
    whole = trim_control(F.col("value"))
    text = F.substring_index(whole, fixed.FIELD, -1)
    size = F.length(whole) - F.length(text) - 1
    return lines.select(
        F.substring(whole, F.lit(1), size).alias("key"),
        text.alias("text"),
        size.alias("at"),
        place.alias("place"),
    ).filter(F.col("at") > 0)


def parse_path_totals(lines: DataFrame, order: str | None = None) -> DataFrame:
    """path, total_mi.

    Of several lines for a path the last one by the column ``order`` is kept.
    Without ``order`` lines have no sequence, so different totals for one path
    are an error.
    """
    if order is None:
        keyed = _key_and_value(lines, F.lit(0))
        last = F.when(F.min("total_mi") == F.max("total_mi"), F.max("total_mi")).otherwise(
            F.raise_error(F.concat(F.lit("several totals for path "), F.col("path")))
        )
    else:
        keyed = _key_and_value(lines, F.col(order))
        last = F.max_by("total_mi", "place")
    return (
        keyed.select(F.col("key").alias("path"), to_real(F.col("text")).alias("total_mi"), "place")
        .filter(F.col("total_mi").isNotNull())
        .groupBy("path")
        .agg(last.alias("total_mi"))
    )


def parse_marginals(lines: DataFrame) -> DataFrame:
    """kind (PS, SW, TOTAL), path, slot, word, n; columns outside the key are null."""
    key = F.col("key")
    tags = {"PS": fixed.PATH_SUM_TAG, "SW": fixed.WORD_SUM_TAG}
    kind = F.when(key.startswith(fixed.TOTAL_TAG), "TOTAL")
    for name, tag in tags.items():
        kind = kind.when(key.startswith(tag), name)
    first = F.substring_index(F.substring(key, 4, 1 << 30), fixed.FIELD, 1)
    second = F.substring_index(key, fixed.FIELD, -1)
    return (
        _key_and_value(lines, F.lit(0))
        .select(kind.alias("kind"), "key", to_whole(F.col("text")).alias("n"))
        .filter(F.col("kind").isNotNull() & F.col("n").isNotNull())
        .select(
            "kind",
            F.when(F.col("kind") == "PS", first).alias("path"),
            F.when(F.col("kind") == "PS", second)
            .when(F.col("kind") == "SW", first)
            .alias("slot"),
            F.when(F.col("kind") == "SW", second).alias("word"),
            "n",
        )
    )


def parse_system_scores(
    lines: DataFrame, layout: str = "tab", coerce: bool = True
) -> DataFrame:
    """path_a, path_b, score.

    ``layout="tab"``: the first three tab-separated fields, paths stripped; a
    score that is no number, or missing on a line of two fields, becomes 0.0, or
    null with ``coerce=False``. Lines of one field are dropped.
    ``layout="whitespace"``: the last blank-separated field is the score, the
    first is path_a, what lies between is path_b; other lines are dropped.
    """
    if layout == "tab":
        fields = lines.select(F.split("value", fixed.FIELD).alias("f")).filter(F.size("f") >= 2)
        score = score_or_zero(_field(2)) if coerce else to_score(_field(2))
        return fields.select(
            trim_control(_field(0)).alias("path_a"),
            trim_control(_field(1)).alias("path_b"),
            score.alias("score"),
        )
    if layout != "whitespace":
        raise ValueError(f"unknown layout {layout!r}")
    fields = lines.select(F.split(trim_control(F.col("value")), r"\s+").alias("f"))
    return (
        fields.filter(F.size("f") >= 3)
        .select(
            _field(0).alias("path_a"),
            F.array_join(F.slice("f", F.lit(2), F.size("f") - 2), " ").alias("path_b"),
            to_score(F.element_at("f", -1)).alias("score"),
        )
        .filter(F.col("score").isNotNull())
    )


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return parse_triples(spark.read.text(path))


def read_mi(spark: SparkSession, path: str) -> DataFrame:
    return parse_mi(spark.read.text(path))


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return parse_partials(spark.read.text(path))


def read_path_totals(spark: SparkSession, path: str) -> DataFrame:
    """The last line of a path counts, files in the order of their names."""
    place = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    lines = spark.read.text(path).select("value", place.alias("place"))
    return parse_path_totals(lines, order="place")


def read_marginals(spark: SparkSession, path: str) -> DataFrame:
    return parse_marginals(spark.read.text(path))


def read_system_scores(
    spark: SparkSession, path: str, layout: str = "tab", coerce: bool = True
) -> DataFrame:
    return parse_system_scores(spark.read.text(path), layout, coerce)


def read_gold(spark: SparkSession, positive: str, negative: str) -> DataFrame:
    """gold_row, path_a, path_b, label: labelled pairs, positives before negatives.

    Rows are numbered without gaps in the order of the files' names and of the
    lines in them. The splits of the files are numbered by their places and sizes;
    a row adds its own place in its split, whatever task reads it.
    """

    def pairs(path: str, label: int) -> DataFrame:
        rows = spark.read.csv(path, sep=fixed.FIELD, schema="path_a string, path_b string")
        return rows.select(
            "path_a",
            "path_b",
            F.lit(label).alias("label"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        )

    split = ["label", "file", "block"]
    rows = pairs(positive, 1).unionByName(pairs(negative, 0))
    sizes = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # One row per split of a file.
    earlier = Window.orderBy(F.desc("label"), "file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*split, "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("at") - F.col("first")
    return rows.join(starts, split).select(number.alias("gold_row"), "path_a", "path_b", "label")


def label_pairs(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Both tables one after the other, numbered in that order by ``gold_row``."""
    return positive.unionByName(negative).select(
        F.monotonically_increasing_id().alias("gold_row"), "path_a", "path_b", "label"
    )
