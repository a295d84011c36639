"""Licence statements in text by diagonal voting, on DataFrame functions alone.

Rolling word k-grams of all texts are joined with the k-grams of statement
templates. A match votes for the diagonal (place in the text less place in the
template); neighbouring diagonals, which differ by a word put in or left out, are
merged to a span, and the words of the span are compared with the template.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pathkin.session import cut_lineage

# Words are the stretches between these characters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 3
#: Diagonals this far apart are merged; shares of a template's k-grams and words a span must hold.
SLACK = 2
VOTES = 0.6
WORDS = 0.8

# Fixed phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Customary statements, as words.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this work has been released into the public domain"),
]


def words_of(text: Column) -> Column:
    """The words of ``text``, A-Z in lower case; none of a null text."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, BETWEEN), "")


def grams_of(words: Column) -> Column:
    """Hashes of the rolling word k-grams of the array ``words``."""
    return F.when(
        F.size(words) >= K,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - K),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(K))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def phrase_places(words: str, phrases: dict[str, str]) -> Column:
    """Places in the array column ``words`` where one of ``phrases`` starts, and its label."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    some = reduce(or_, (F.contains(joined, F.lit(f" {p} ")) for p in phrases))

    def label(i: Column) -> Column:
        found = [(p.split(), name) for p, name in phrases.items()]
        out = F.lit(None).cast("string")
        for parts, name in found:
            here = reduce(lambda a, b: a & b, (F.get(F.col(words), i + k) == w for k, w in enumerate(parts)))
            out = F.when(here, F.lit(name)).otherwise(out)
        return out

    places = F.transform(
        F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.struct(i.alias("at"), label(i).alias("label"))
    )
    kept = F.filter(places, lambda p: p["label"].isNotNull())
    return F.when(some, kept).otherwise(F.array().cast("array<struct<at:int,label:string>>"))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, label, t_words) of all ``templates``."""
    rows = [(n, label, text.split()) for n, (label, text) in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, label string, t_words array<string>")


def find_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> tuple[DataFrame, DataFrame]:
    """Rows and spans of ``docs`` (doc_id, text).

    Rows: (doc_id, key, n_words, places), one for every row of ``docs``; places
    are the starts of ``phrases`` and their labels. Spans: (doc_id, key, label,
    first, last, share) of verified template statements, words from 0. ``key`` is
    a hash of id and text; a row's spans are those of its id (null equals null)
    and key, so rows that repeat both have the same spans. A null or empty text
    has no words; other columns are left out.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    placed = known.select(
        "template",
        F.size("t_words").alias("t_size"),
        F.posexplode(grams_of(F.col("t_words"))).alias("t_at", "gram"),
    )
    grams = placed.groupBy("gram").agg(F.collect_list(F.struct("template", "t_size", "t_at")).alias("met"))
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).alias("key"),
        words_of(F.col("text")).alias("words"),
    )
    rolled = read.select(
        "doc_id",
        "key",
        F.size("words").cast("bigint").alias("n_words"),
        phrase_places("words", phrases).alias("places"),
        grams_of(F.col("words")).alias("grams"),
    ).select("doc_id", "key", "n_words", "places", F.posexplode_outer("grams").alias("at", "gram"))
    # The template table is a fixed list. Of the k-grams without a match only the first is kept.
    first = F.coalesce("at", F.lit(0)) == 0
    matched = rolled.join(F.broadcast(grams), "gram", "left").filter(F.col("met").isNotNull() | first)
    stored = cut_lineage(matched.drop("gram"))
    votes = (
        stored.select("doc_id", "key", "at", F.inline("met"))
        .withColumn("diagonal", F.col("at") - F.col("t_at"))
        .groupBy("doc_id", "key", "template", "t_size", "diagonal")
        .agg(F.countDistinct("t_at").alias("votes"), F.min("at").alias("first"), F.max("at").alias("last"))
    )
    along = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > SLACK, F.lit(True))
    spans = (
        votes.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(along))
        .groupBy("doc_id", "key", "template", "t_size", "span")
        .agg(
            F.sum("votes").alias("votes"),
            F.min("first").alias("first"),
            (F.max("last") + K - 1).alias("last"),
        )
        .filter(F.col("votes") >= VOTES * (F.col("t_size") - K + 1))
        .join(F.broadcast(known), "template")
        .select("doc_id", "key", "label", "t_words", "first", "last")
    )
    all_grams = F.array(*(F.lit(r[0]) for r in grams.select("gram").collect()))
    # A generator over one array: the words are found once, and kept where a k-gram is known.
    hit = docs.select(
        F.col("doc_id").cast("bigint").alias("h_id"),
        F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).alias("h_key"),
        F.explode(
            F.filter(F.array(words_of(F.col("text"))), lambda w: F.arrays_overlap(grams_of(w), all_grams))
        ).alias("words"),
    ).dropDuplicates(["h_id", "h_key"])
    inside = F.slice("words", F.col("first") + 1, F.col("last") - F.col("first") + 1)
    share = F.size(F.array_intersect(inside, "t_words")) / F.size(F.array_distinct("t_words"))
    checked = (
        spans.join(hit, (F.col("key") == F.col("h_key")) & F.col("doc_id").eqNullSafe(F.col("h_id")))
        .withColumn("share", share)
        .filter(F.col("share") >= WORDS)
        .select("doc_id", "key", "label", "first", "last", "share")
    )
    return stored.filter(first).select("doc_id", "key", "n_words", "places"), checked


def license_labels(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row."""
    rows, spans = find_licenses(docs)
    found = spans.groupBy("doc_id", "key").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share")
    ).withColumnsRenamed({"doc_id": "s_id", "key": "s_key"})
    same = (F.col("key") == F.col("s_key")) & F.col("doc_id").eqNullSafe(F.col("s_id"))
    base = F.array_sort(F.array_distinct("places.label"))
    none = F.array().cast("array<string>")
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.at").cast("bigint").alias("first_word"),
        F.array_max("places.at").cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
