"""One query per operator, each over whole tables. Doubles are rounded for comparison."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import pathkin as pk
from pathkin.session import cut_lineage
from pathkin.workload import inputs

Query = Callable[[SparkSession, str], DataFrame]


def _round(col: str | Column, name: str | None = None) -> Column:
    column = F.col(col) if isinstance(col, str) else col
    return F.round(column, 6).alias(name or col)


def _mi(spark: SparkSession, folder: str) -> DataFrame:
    """Mutual information of all triples, which are read several times and so stored first."""
    triples = cut_lineage(inputs.triples(spark, folder))
    return cut_lineage(pk.mutual_information(triples, unique=True))


def _system(spark: SparkSession, folder: str) -> DataFrame:
    """Similarities in both directions, the reversed ones with half the score."""
    forward = cut_lineage(pk.path_similarity(_mi(spark, folder)))
    back = forward.select(
        F.col("path_b").alias("path_a"), F.col("path_a").alias("path_b"), F.col("score") / 2
    ).toDF("path_a", "path_b", "score")
    return forward.unionByName(back)


# Extraction


def ngram_tokens(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.ngram_lines(spark, folder)
    return (
        lines.select(F.explode_outer(pk.ngram_tokens(F.col("value"))).alias("t"))
        .groupBy("t.word", "t.pos", "t.dep", "t.head", "t.idx")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ngram_segments(spark: SparkSession, folder: str) -> DataFrame:
    segments = pk.ngram_segments(F.col("value"))
    return (
        inputs.ngram_lines(spark, folder)
        .select(segments.alias("s"))
        .groupBy(F.size("s").alias("n_segments"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.length(F.array_join("s", ""))).alias("chars"),
        )
    )


def head_base(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.ngram_lines(spark, folder)
    tokens = lines.select(pk.ngram_tokens(F.col("value")).alias("tokens"))
    based = tokens.select("tokens", pk.detect_head_base(F.col("tokens")).alias("base"))
    resolved = pk.resolve_parents(F.col("tokens"), F.col("base"))
    linked = F.filter(resolved, lambda t: t["parent"].isNotNull())
    # Apart from the counting, which Spark compiles then.
    per_line = based.select("base", F.size(linked).alias("n"))
    return per_line.groupBy("base").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("n").alias("n_linked")
    )


def stem_words(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.words(spark, folder).select("word", pk.stem(F.col("word")).alias("stem"))


def _arcs(spark: SparkSession, folder: str, via_preposition: bool) -> DataFrame:
    arcs = pk.extract_arcs(inputs.ngram_lines(spark, folder))
    path = pk.path_of(F.col("verb"), F.col("relation"))
    return (
        arcs.filter(F.col("via_preposition") == via_preposition)
        .select(path.alias("path"), pk.slot_of(F.col("relation")).alias("slot"), "filler")
        .groupBy("path", "slot", "filler")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def extract_direct(spark: SparkSession, folder: str) -> DataFrame:
    return _arcs(spark, folder, False)


def extract_prep(spark: SparkSession, folder: str) -> DataFrame:
    return _arcs(spark, folder, True)


def extract_nouns(spark: SparkSession, folder: str) -> DataFrame:
    facts = pk.extract_occurrences(inputs.ngram_lines(spark, folder), fillers="noun")
    return facts.groupBy("slot", "word").agg(F.count(F.lit(1)).alias("n"))


def extraction_report(spark: SparkSession, folder: str) -> DataFrame:
    return pk.extraction_report(inputs.ngram_lines(spark, folder)).select("value", "sample")


def split_path(spark: SparkSession, folder: str) -> DataFrame:
    part = inputs.table(spark, folder, "part")
    text = F.when(F.col("p_size") < 10, F.col("p_name")).otherwise(
        F.concat_ws(" -> ", "p_name", F.concat(F.col("p_type"), F.lit(" ")), "p_brand")
    )
    return part.select("p_partkey", pk.split_path(text).alias("s")).select("p_partkey", "s.*")


def format_rule(spark: SparkSession, folder: str) -> DataFrame:
    part = inputs.table(spark, folder, "part")
    path = F.when(F.col("p_size") < 10, F.col("p_name")).otherwise(
        F.concat_ws(" -> ", "p_name", "p_type")
    )
    return part.select("p_partkey", pk.format_rule(path).alias("rule"))


# Counts and mutual information


def triple_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pk.count_corpus(inputs.ngram_lines(spark, folder))


def marginals(spark: SparkSession, folder: str) -> DataFrame:
    return pk.marginals(inputs.triples(spark, folder)).fillna("", ["path", "slot", "word"])


def path_slot_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pk.path_slot_counts(inputs.triples(spark, folder)).select("path", "slot", "n")


def slot_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pk.slot_word_counts(inputs.triples(spark, folder)).select("slot", "word", "n")


def total_count(spark: SparkSession, folder: str) -> DataFrame:
    return pk.total_count(inputs.triples(spark, folder))


def mutual_information(spark: SparkSession, folder: str) -> DataFrame:
    mi = pk.mutual_information(cut_lineage(inputs.triples(spark, folder)), unique=True)
    return mi.select("path", "slot", "word", _round("mi"))


def mutual_information_repeated(spark: SparkSession, folder: str) -> DataFrame:
    mi = pk.mutual_information(cut_lineage(inputs.order_triples(spark, folder)))
    return mi.select("path", "slot", "word", _round("mi"))


def mutual_information_stored(spark: SparkSession, folder: str) -> DataFrame:
    triples = cut_lineage(inputs.triples(spark, folder))
    lines = pk.marginal_lines(pk.marginals(triples))
    mi = pk.mutual_information_from(triples, cut_lineage(pk.parse_marginals(lines)), unique=True)
    return mi.select("path", "slot", "word", _round("mi"))


def mutual_information_text(spark: SparkSession, folder: str) -> DataFrame:
    mi = pk.mutual_information(cut_lineage(triple_counts(spark, folder)), unique=True)
    return mi.select("path", "slot", "word", _round("mi"))


def path_totals(spark: SparkSession, folder: str) -> DataFrame:
    return pk.path_totals(_mi(spark, folder)).select("path", _round("total_mi"))


# Similarity


def _pair_summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("path_a").agg(
        F.count(F.lit(1)).alias("n"),
        _round(F.sum("partial"), "partial_sum"),
        _round(F.min("partial"), "partial_min"),
        _round(F.max("partial"), "partial_max"),
    )


def feature_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _pair_summary(pk.feature_pairs(_mi(spark, folder)))


def feature_pairs_blocked(spark: SparkSession, folder: str) -> DataFrame:
    return _pair_summary(pk.feature_pairs(_mi(spark, folder), block_rows=25))


def pair_numerators(spark: SparkSession, folder: str) -> DataFrame:
    summed = pk.sum_partials(pk.feature_pairs(_mi(spark, folder)))
    return summed.select("path_a", "path_b", _round("score"))


def path_similarity(spark: SparkSession, folder: str) -> DataFrame:
    scored = pk.path_similarity(_mi(spark, folder))
    return scored.select("path_a", "path_b", _round("score"))


def lin_normalize(spark: SparkSession, folder: str) -> DataFrame:
    mi = _mi(spark, folder)
    summed = pk.path_similarity(mi, normalize=False)
    # Paths below this total have none on record, so their pairs keep the raw sum.
    totals = pk.path_totals(mi).filter(F.col("total_mi") > 5)
    return pk.lin_normalize(summed, totals).select("path_a", "path_b", _round("score"))


def discover_rules(spark: SparkSession, folder: str) -> DataFrame:
    scored = pk.discover_rules(inputs.talk_lines(spark, folder))
    return scored.groupBy("path_a").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("score"), 4).alias("score_sum"),
        _round(F.max("score"), "score_max"),
    )


def similarity_stats(spark: SparkSession, folder: str) -> DataFrame:
    triples = cut_lineage(inputs.triples(spark, folder))
    mi = cut_lineage(pk.mutual_information(triples, unique=True))
    return pk.similarity_stats(triples=triples, mi=mi, similarity=pk.path_similarity(mi))


# Stored text


def parse_triples(spark: SparkSession, folder: str) -> DataFrame:
    return pk.parse_triples(inputs.stored_lines(spark, folder, "triples"))


def parse_mi(spark: SparkSession, folder: str) -> DataFrame:
    return pk.parse_mi(inputs.stored_lines(spark, folder, "mi"))


def parse_partials(spark: SparkSession, folder: str) -> DataFrame:
    return pk.parse_partials(inputs.stored_lines(spark, folder, "partials"))


def parse_totals(spark: SparkSession, folder: str) -> DataFrame:
    return pk.parse_path_totals(inputs.stored_lines(spark, folder, "totals"), order="place")


def parse_marginals(spark: SparkSession, folder: str) -> DataFrame:
    parsed = pk.parse_marginals(inputs.stored_lines(spark, folder, "marginals"))
    return parsed.fillna("", ["path", "slot", "word"])


def parse_system(spark: SparkSession, folder: str) -> DataFrame:
    return pk.parse_system_scores(inputs.stored_lines(spark, folder, "system"))


def parse_system_ws(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.stored_lines(spark, folder, "system_ws")
    return pk.parse_system_scores(lines, layout="whitespace")


def marginal_lines(spark: SparkSession, folder: str) -> DataFrame:
    return pk.marginal_lines(pk.marginals(inputs.triples(spark, folder)))


# Evaluation


def read_gold(spark: SparkSession, folder: str) -> DataFrame:
    gold = inputs.gold(spark, folder)
    labelled = pk.label_pairs(gold.filter("label = 1"), gold.filter("label = 0"))
    return labelled.select("path_a", "path_b", "label")


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    """Gold pairs, stored: all that scores them reads them several times."""
    return cut_lineage(inputs.gold(spark, folder))


def score_gold(spark: SparkSession, folder: str) -> DataFrame:
    scored = pk.score_gold(_gold(spark, folder), _system(spark, folder))
    return scored.select("gold_row", "path_a", "path_b", "label", _round("score"))


def score_gold_dups(spark: SparkSession, folder: str) -> DataFrame:
    scored = pk.score_gold(_gold(spark, folder), _system(spark, folder), dedupe=False)
    return scored.select("gold_row", "path_a", "path_b", "label", _round("score"))


def gold_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    scored = cut_lineage(pk.score_gold(_gold(spark, folder), _system(spark, folder)))
    negative = scored.filter(F.col("label") == 0)
    return pk.gold_without(negative, negative.filter(F.col("score") > 0)).drop("score")


def score_gold_direct(spark: SparkSession, folder: str) -> DataFrame:
    """Gold pairs by their own scores; no other pair is scored."""
    gold = _gold(spark, folder)
    scored = pk.score_gold(gold, pk.score_pairs(gold, _mi(spark, folder)))
    return scored.select("gold_row", "path_a", "path_b", "label", _round("score"))


def evaluate_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All quality tables in one long form: (table, place, measure, value)."""
    gold = inputs.scored_gold(spark, folder).drop("score")
    tables = pk.evaluate_rules(inputs.document_scores(spark, folder), gold)
    places = {
        "scored": ("gold_row", ["score"]),
        "threshold_metrics": ("threshold", ["tp", "fp", "fn", "precision", "recall", "f1"]),
        "pr_curve": ("position", ["threshold", "precision", "recall"]),
        "pr_auc": (None, ["auc"]),
        "best_threshold": (None, ["threshold", "f1"]),
        "sample_curve": ("position", ["threshold", "precision", "recall"]),
        "error_cutoffs": (None, ["high", "low"]),
        "error_samples": ("gold_row", ["place"]),
    }
    long = []
    for name, (place, measures) in places.items():
        measure = F.col("class") if name == "error_samples" else None
        values = F.array(
            *(
                F.struct(
                    (F.lit(m) if measure is None else measure).alias("measure"),
                    F.round(F.col(m).cast("double"), 6).alias("value"),
                )
                for m in measures
            )
        )
        at = F.lit(0.0) if place is None else F.col(place).cast("double")
        long.append(
            tables[name].select(F.lit(name).alias("table"), at.alias("place"), F.inline(values))
        )
    return reduce(DataFrame.unionByName, long)


def threshold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    measured = pk.threshold_metrics(inputs.scored_gold(spark, folder))
    return measured.select(
        "threshold", "tp", "fp", "fn", _round("precision"), _round("recall"), _round("f1")
    )


def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    curve = pk.pr_curve(inputs.scored_gold(spark, folder))
    return curve.select("position", "threshold", _round("precision"), _round("recall"))


def pr_auc(spark: SparkSession, folder: str) -> DataFrame:
    return pk.pr_auc(pk.pr_curve(inputs.scored_gold(spark, folder))).select(_round("auc"))


def curve_f1(spark: SparkSession, folder: str) -> DataFrame:
    points = pk.curve_f1(pk.pr_curve(inputs.scored_gold(spark, folder)))
    return points.select("threshold", _round("f1"))


def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    best = pk.best_threshold(pk.pr_curve(inputs.scored_gold(spark, folder)))
    return best.select("threshold", _round("f1"))


def sample_curve(spark: SparkSession, folder: str) -> DataFrame:
    points = pk.sample_curve(pk.pr_curve(inputs.scored_gold(spark, folder)))
    return points.select("position", "threshold", _round("precision"), _round("recall"))


def error_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    cutoffs = pk.error_cutoffs(inputs.scored_gold(spark, folder))
    return cutoffs.select(_round("high"), _round("low"))


def error_samples(spark: SparkSession, folder: str) -> DataFrame:
    samples = pk.error_samples(inputs.scored_gold(spark, folder))
    return samples.select("class", "place", "gold_row", "path_a", "label", "score")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        ngram_segments,
        ngram_tokens,
        head_base,
        stem_words,
        extract_direct,
        extract_prep,
        extract_nouns,
        extraction_report,
        split_path,
        format_rule,
        triple_counts,
        marginals,
        path_slot_counts,
        slot_word_counts,
        total_count,
        mutual_information,
        mutual_information_repeated,
        mutual_information_stored,
        mutual_information_text,
        path_totals,
        feature_pairs,
        feature_pairs_blocked,
        pair_numerators,
        path_similarity,
        lin_normalize,
        discover_rules,
        similarity_stats,
        parse_triples,
        parse_mi,
        parse_partials,
        parse_totals,
        parse_marginals,
        parse_system,
        parse_system_ws,
        marginal_lines,
        read_gold,
        score_gold,
        score_gold_dups,
        score_gold_direct,
        gold_unmatched,
        evaluate_rules,
        threshold_metrics,
        pr_curve,
        pr_auc,
        curve_f1,
        best_threshold,
        sample_curve,
        error_cutoffs,
        error_samples,
    )
}
