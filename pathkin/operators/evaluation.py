"""Scores of gold pairs and quality measures over them.

``gold`` is (gold_row, path_a, path_b, label), ``system`` is (path_a, path_b,
score), ``scored`` is ``gold`` with ``score``.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pathkin import fixed
from pathkin.functions import scores
from pathkin.operators.skew import attach
from pathkin.session import cut_lineage

PAIR = ["k1", "k2"]


def _named() -> Column:
    return F.col("path_a").isNotNull() & F.col("path_b").isNotNull()


def _keyed(pairs: DataFrame, *columns: str) -> DataFrame:
    return pairs.select(*scores.pair_key(F.col("path_a"), F.col("path_b")), *columns)


def _pair_sizes(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_rows"))


def score_gold(
    gold: DataFrame, system: DataFrame, dedupe: bool = True, order: str | None = None
) -> DataFrame:
    """``gold`` with the system's score of each pair in either order, 0.0 where it has none.

    A pair scored more than once counts once, with its first score by the
    column ``order`` or else its largest. With ``dedupe=False`` every score of
    it gives a row. Only scores of gold pairs are regrouped; the system table
    is first reduced to them. Gold rows of one pair may be many; they are
    spread by ``gold_row``. A null path matches nothing: gold pairs that hold one
    keep their row and score 0.0. A score that is not a number counts as 0.0.
    """
    nameless = gold.filter(~_named()).withColumn("score", F.lit(0.0))
    gold_keyed = _keyed(gold.filter(_named()), *gold.columns)
    sizes = _pair_sizes(gold_keyed)
    found = _keyed(system, "score", *({order} - {None, "score"})).join(sizes, PAIR, "left_semi")
    zero_filled = F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)).alias("score")
    if not dedupe:
        all_scores = gold_keyed.join(found.select(*PAIR, "score"), PAIR, "left")
        return all_scores.select(*gold.columns, zero_filled).unionByName(nameless)
    number = F.nanvl("score", F.lit(0.0))
    kept = F.max(number) if order is None else F.min_by(number, order)
    best = sizes.join(found.groupBy(*PAIR).agg(kept.alias("score")), PAIR, "left")
    scored_keys = best.select(*PAIR, "n_rows", zero_filled)
    attached = attach(gold_keyed, scored_keys, PAIR, by=["gold_row"])
    return attached.select(*gold.columns, "score").unionByName(nameless)


def gold_without(gold: DataFrame, taken: DataFrame) -> DataFrame:
    """The gold pairs whose key, in either order, is not among the pairs ``taken``.

    A null path matches nothing, so pairs that hold one stay.
    """
    gold_keyed = _keyed(gold.filter(_named()), *gold.columns)
    left = _pair_sizes(gold_keyed).join(_keyed(taken).distinct(), PAIR, "left_anti")
    attached = attach(gold_keyed, left, PAIR, by=["gold_row"]).select(*gold.columns)
    return attached.unionByName(gold.filter(~_named()))


def threshold_metrics(
    scored: DataFrame, thresholds: Sequence[float] = fixed.SCORE_THRESHOLDS
) -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1) for ``score >= threshold``.

    One aggregate counts for all thresholds; its one row is then unfolded.
    """
    positive = F.col("label") == 1

    def counts(threshold: float) -> list[Column]:
        above = F.col("score") >= threshold
        return [F.count_if(c) for c in (positive & above, ~positive & above, positive & ~above)]

    names = ["tp", "fp", "fn"]
    measured = scored.agg(
        *(
            count.alias(f"{name}_{i}")
            for i, threshold in enumerate(thresholds)
            for name, count in zip(names, counts(threshold))
        )
    )
    points = F.array(
        *(
            F.struct(
                F.lit(float(t)).alias("threshold"), *(F.col(f"{n}_{i}").alias(n) for n in names)
            )
            for i, t in enumerate(thresholds)
        )
    )
    precision = scores.ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = scores.ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fn"))
    return (
        measured.select(F.inline(points))
        .select("*", precision.alias("precision"), recall.alias("recall"))
        .select("*", scores.f1(F.col("precision"), F.col("recall")).alias("f1"))
    )


def score_ladder(scored: DataFrame) -> DataFrame:
    """One row per distinct score with its labels and the running counts down to it.

    Columns: score, pos, neg (labels at this score), tp, fp (labels at this or
    a higher score), position (0 for the lowest score), and on every row
    all_pos, all_neg, n_points over the whole table.

    Equal scores are grouped first, so no score is heavy. The rest is ordered
    by range: running counts inside each range, plus what all higher ranges
    hold. There are no more ranges than shuffle partitions, which bounds the
    table of range sums. The ranges are stored, since both uses must see the
    same ones.
    """
    positive = F.col("label") == 1
    steps = scored.groupBy("score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranged = cut_lineage(
        steps.repartitionByRange("score").withColumn("range", F.spark_partition_id())
    )
    sums = ranged.groupBy("range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count(F.lit(1)).alias("n")
    )
    everywhere = Window.partitionBy(F.lit(0))
    above = everywhere.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)

    def before(count: str) -> Column:
        return F.coalesce(F.sum(count).over(above), F.lit(0))

    offsets = sums.select(
        "range",
        before("pos").alias("tp_above"),
        before("neg").alias("fp_above"),
        before("n").alias("n_above"),
        F.sum("pos").over(everywhere).alias("all_pos"),
        F.sum("neg").over(everywhere).alias("all_neg"),
        F.sum("n").over(everywhere).alias("n_points"),
    )
    down = Window.partitionBy("range").orderBy(F.desc("score"))
    running = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.select(
        "*",
        F.sum("pos").over(running).alias("tp_in"),
        F.sum("neg").over(running).alias("fp_in"),
        F.row_number().over(down).alias("rank"),
    )
    return inside.join(F.broadcast(offsets), "range").select(
        "score",
        "pos",
        "neg",
        (F.col("tp_in") + F.col("tp_above")).alias("tp"),
        (F.col("fp_in") + F.col("fp_above")).alias("fp"),
        (F.col("n_points") - F.col("n_above") - F.col("rank")).alias("position"),
        "all_pos",
        "all_neg",
        "n_points",
    )


def pr_curve(scored: DataFrame, ladder: DataFrame | None = None) -> DataFrame:
    """Precision-recall curve, one point per distinct score and an end point.

    Columns: position, threshold, precision, recall, the running counts tp and
    fp, the counts pos and neg at this score, and n_points, the number of
    thresholds. Positions follow rising thresholds; the end point (precision 1,
    recall 0) comes last and has no threshold. Without positives, recall is 1
    at every threshold. ``ladder`` is the score ladder where it is at hand.
    """
    ladder = score_ladder(scored) if ladder is None else ladder
    counts = ["tp", "fp", "pos", "neg", "n_points"]
    tp, fp, all_pos, n_points = (F.col(c) for c in ("tp", "fp", "all_pos", "n_points"))
    point = F.struct(
        F.col("position"),
        F.col("score").alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        F.when(all_pos > 0, tp / all_pos).otherwise(1.0).alias("recall"),
        *counts,
    )
    none = F.lit(0).cast("long")
    end = F.struct(
        n_points.alias("position"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        *(none.alias(c) for c in counts[:-1]),
        n_points,
    )
    highest = F.col("position") == n_points - 1
    points = F.when(highest, F.array(point, end)).otherwise(F.array(point))
    return ladder.select(F.inline(points))


def pr_auc(curve: DataFrame) -> DataFrame:
    """One row ``auc``: trapezoid area under the curve over recall.

    The next point up is known from the counts of the point itself, so the
    curve need not be sorted again.
    """
    tp, fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    upper_precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    upper_recall = F.when(
        F.col("tp") > 0, F.col("recall") * tp / F.col("tp")
    ).otherwise(F.when(tp + fp > 0, F.col("recall")).otherwise(0.0))
    area = (F.col("recall") - upper_recall) * (F.col("precision") + upper_precision) / 2
    return curve.filter(F.col("threshold").isNotNull()).agg(
        F.coalesce(F.sum(area), F.lit(0.0)).alias("auc")
    )


def curve_f1(curve: DataFrame, epsilon: float = fixed.F1_EPSILON) -> DataFrame:
    """(threshold, precision, recall, f1) of every point that has a threshold."""
    return curve.filter(F.col("threshold").isNotNull()).select(
        "threshold",
        "precision",
        "recall",
        scores.f1(F.col("precision"), F.col("recall"), epsilon).alias("f1"),
    )


def best_threshold(curve: DataFrame, epsilon: float = fixed.F1_EPSILON) -> DataFrame:
    """One row (threshold, f1) with the highest F1, the lowest threshold on ties."""
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("below")))
    return (
        curve_f1(curve, epsilon)
        .agg(best.alias("best"))
        .select((-F.col("best.below")).alias("threshold"), F.col("best.f1").alias("f1"))
    )


def sample_curve(curve: DataFrame, n: int = fixed.CURVE_POINTS) -> DataFrame:
    """Up to ``n`` points at evenly spaced positions, first and last threshold included."""
    points = curve.filter(F.col("threshold").isNotNull())
    size = F.col("n_points")
    taken = F.least(size, F.lit(n))
    step = (size - 1) / F.greatest(taken - 1, F.lit(1))
    places = F.transform(
        F.sequence(F.lit(0).cast("long"), taken - 1),
        lambda i: F.when((i == taken - 1) & (i > 0), size - 1).otherwise(F.floor(i * step)),
    )
    return points.filter(F.array_contains(places, F.col("position"))).select(
        "position", "threshold", "precision", "recall"
    )


def error_cutoffs(scored: DataFrame, ladder: DataFrame | None = None) -> DataFrame:
    """One row (high, low): score limits for confident and for missed pairs.

    High is the median score of positives, low that of negatives. Where they do
    not separate, both are set from the mean and the smallest score. Medians
    are read off the running counts, so no label's scores meet in one task.
    """
    ladder = score_ladder(scored) if ladder is None else ladder
    score = F.col("score")

    def median(run: str, own: str, total: Column) -> Column:
        def at(rank: Column) -> Column:
            here = (F.col(run) - F.col(own) <= rank) & (rank < F.col(run))
            return F.max(F.when(here, score))

        return (at(F.floor((total - 1) / 2)) + at(F.ceil((total - 1) / 2))) / 2

    rows = F.sum(F.col("pos") + F.col("neg"))
    summary = ladder.agg(
        median("tp", "pos", F.col("all_pos")).alias("median_pos"),
        median("fp", "neg", F.col("all_neg")).alias("median_neg"),
        (F.sum(score * (F.col("pos") + F.col("neg"))) / rows).alias("mean"),
        F.min("score").alias("lowest"),
    ).select(
        F.coalesce("median_pos", F.lit(fixed.HIGH_CUTOFF_DEFAULT)).alias("high"),
        F.coalesce("median_neg", F.lit(fixed.LOW_CUTOFF_DEFAULT)).alias("low"),
        "mean",
        "lowest",
    )
    apart = F.col("high") > F.col("low")
    floor = F.lit(fixed.HIGH_CUTOFF_FLOOR)
    ceiling = F.lit(fixed.LOW_CUTOFF_CEILING)
    return summary.select(
        F.when(apart, F.col("high"))
        .otherwise(F.greatest(floor, F.col("mean") + fixed.MEAN_MARGIN))
        .alias("high"),
        F.when(apart, F.col("low"))
        .otherwise(F.least(ceiling, F.greatest(F.lit(0.0), F.col("lowest"))))
        .alias("low"),
    )


def error_samples(
    scored: DataFrame, n: int = fixed.ERROR_EXAMPLES, ladder: DataFrame | None = None
) -> DataFrame:
    """The first ``n`` pairs in gold order of each class: TP, FP, TN, FN.

    Adds ``class`` and ``place`` (1 to n). A pair can be in two classes or none.
    """
    limits = error_cutoffs(scored, ladder).select(F.struct("high", "low")).scalar()
    high, low = F.col("limits.high"), F.col("limits.low")
    positive = F.col("label") == 1
    score = F.col("score")
    rules = {
        "TP": positive & (score >= high),
        "FP": ~positive & (score > 0),
        "TN": ~positive & (score <= low),
        "FN": positive & (score <= low),
    }
    classes = F.filter(
        F.array(*(F.when(rule, name) for name, rule in rules.items())), lambda c: c.isNotNull()
    )
    in_order = Window.partitionBy("class").orderBy("gold_row")
    return (
        scored.withColumn("limits", limits)
        .select(*scored.columns, F.explode(classes).alias("class"))
        .withColumn("place", F.row_number().over(in_order))
        .filter(F.col("place") <= n)
    )


def similarity_stats(**stages: DataFrame) -> DataFrame:
    """(stage, n_rows): the number of rows of each stage's output."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        for name, df in stages.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result
