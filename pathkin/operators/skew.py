"""Joins against per-key tables that stay even when one key holds most rows."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def attach(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """``rows`` with the columns of ``per_key``, one row per key, joined on ``keys``.

    ``per_key`` has a column ``n_rows``, the number of ``rows`` with that key. A
    key with more rows than an average shuffle partition is hot: its rows are
    spread over as many salts as the partitions they would fill, by the hash of
    the columns ``by``, and its ``per_key`` row is repeated once per salt. Fewer
    keys than shuffle partitions can be hot, which bounds both the broadcast
    list of hot keys and the repeated rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = [c for c in per_key.columns if c not in keys and c != "n_rows"]
    # All uses ask for the same keys and values, so that Spark computes them once.
    per_key = per_key.filter(reduce(and_, (F.col(c).isNotNull() for c in keys)))
    known = reduce(and_, (F.col(c).isNotNull() for c in values), F.lit(True))
    all_rows = per_key.filter(known).agg(F.sum("n_rows")).scalar()
    salts = F.when(known, F.ceil(F.col("n_rows") * parts / all_rows)).otherwise(1).cast("int")
    salted = per_key.withColumn("salts", salts)
    hot = salted.filter(known & (F.col("salts") > 1)).select(*keys, "salts")
    spread = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "salt", F.pmod(F.xxhash64(*by), F.coalesce("salts", F.lit(1))).cast("int")
    )
    copies = salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return spread.drop("salts").join(copies.drop("salts", "n_rows"), [*keys, "salt"]).drop("salt")
