"""Text and Parquet sinks. An existing folder is an error, never overwritten."""

from pyspark.sql import DataFrame, functions as F

from pathkin import fixed


def write_tsv(df: DataFrame, path: str) -> None:
    """Write the columns of ``df`` tab-joined, one file per task."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    lines = df.select(F.concat_ws(fixed.FIELD, *fields).alias("value"))
    lines.write.text(path)


def write_marginals(df: DataFrame, path: str) -> None:
    """Write marginals (kind, path, slot, word, n) in their tagged text form."""
    marginal_lines(df).write.text(path)


def marginal_lines(df: DataFrame) -> DataFrame:
    """Tagged text form of marginals, one per row, as ``value``."""
    kind = F.col("kind")
    key = (
        F.when(kind == "PS", F.concat(F.lit(fixed.PATH_SUM_TAG), "path", F.lit(fixed.FIELD), "slot"))
        .when(kind == "SW", F.concat(F.lit(fixed.WORD_SUM_TAG), "slot", F.lit(fixed.FIELD), "word"))
        .otherwise(fixed.TOTAL_TAG)
    )
    return df.select(F.concat_ws(fixed.FIELD, key, F.col("n").cast("string")).alias("value"))


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Store a stage as Parquet and return it as read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
