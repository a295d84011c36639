import math
import random
from statistics import median

import pytest

import pathkin as pk

SCHEMA = "gold_row long, path_a string, path_b string, label int, score double"


def scored_of(spark, pairs):
    rows = [(i, f"a{i}", f"b{i}", label, score) for i, (label, score) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return scored_of(spark, [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.0), (1, 0.0)])


@pytest.fixture(scope="module")
def large(spark):
    """A third of all scores are equal, the others differ, some below zero."""
    rng = random.Random(11)
    pairs = [(rng.randrange(2), 0.0) for _ in range(200)]
    pairs += [(int(rng.random() < 0.7), rng.uniform(-0.1, 1)) for _ in range(400)]
    return pairs, scored_of(spark, pairs).repartition(5)


def test_curve(small, rows):
    curve = pk.pr_curve(small).orderBy("position")
    got = [(r.threshold, round(r.precision, 6), round(r.recall, 6)) for r in curve.collect()]
    assert got == [(0.0, 0.6, 1.0), (0.5, 0.666667, 0.666667), (0.9, 0.5, 0.333333), (None, 1.0, 0.0)]
    assert rows(pk.pr_auc(curve)) == [(0.655556,)]
    assert rows(pk.best_threshold(curve)) == [(0.0, 0.75)]


def test_curve_of_many_scores(large):
    pairs, scored = large
    curve = pk.pr_curve(scored).orderBy("position").collect()
    thresholds = sorted({s for _, s in pairs})
    assert [r.threshold for r in curve] == thresholds + [None]
    assert [r.position for r in curve] == list(range(len(thresholds) + 1))
    all_pos = sum(label for label, _ in pairs)
    for r in curve[:-1]:
        hits = [label for label, s in pairs if s >= r.threshold]
        assert (r.tp, r.fp) == (sum(hits), len(hits) - sum(hits))
        assert math.isclose(r.recall, sum(hits) / all_pos)
    recalls = [r.recall for r in curve]
    assert recalls == sorted(recalls, reverse=True)
    area = sum(
        (a.recall - b.recall) * (a.precision + b.precision) / 2 for a, b in zip(curve, curve[1:])
    )
    assert math.isclose(pk.pr_auc(pk.pr_curve(scored)).first().auc, area)
    f1 = [2 * r.precision * r.recall / (r.precision + r.recall + 1e-10) for r in curve[:-1]]
    best = pk.best_threshold(pk.pr_curve(scored)).first()
    assert best.threshold == thresholds[f1.index(max(f1))]


@pytest.mark.parametrize("n", [1, 2, 7, 20, 1000])
def test_sampled_points(large, n):
    pairs, scored = large
    size = len({s for _, s in pairs})
    taken = min(n, size)
    step = (size - 1) / max(taken - 1, 1)
    want = [int(i * step) for i in range(taken)]
    if taken > 1:
        want[-1] = size - 1
    got = pk.sample_curve(pk.pr_curve(scored), n).orderBy("position").collect()
    assert [r.position for r in got] == want


def test_labels_of_one_kind(spark):
    only_neg = pk.pr_curve(scored_of(spark, [(0, 0.2), (0, 0.1)])).orderBy("position").collect()
    assert [(r.precision, r.recall) for r in only_neg] == [(0.0, 1.0), (0.0, 1.0), (1.0, 0.0)]
    only_pos = pk.pr_curve(scored_of(spark, [(1, 0.2), (1, 0.1)]))
    assert math.isclose(pk.pr_auc(only_pos).first().auc, 1.0)


def test_thresholds(small, rows):
    got = rows(pk.threshold_metrics(small, [0.5, 0.9, 2.0]))
    assert got == [
        (0.5, 2, 1, 1, 0.666667, 0.666667, 0.666667),
        (0.9, 1, 1, 2, 0.5, 0.333333, 0.4),
        (2.0, 0, 0, 3, 0.0, 0.0, 0.0),
    ]
    assert [r.threshold for r in pk.threshold_metrics(small).collect()] == [0.0001, 0.001, 0.01, 0.05, 0.1]


def test_cutoffs(spark, large):
    pairs, scored = large
    got = pk.error_cutoffs(scored).first()
    pos, neg = (median([s for label, s in pairs if label == k]) for k in (1, 0))
    assert pos > neg
    assert math.isclose(got.high, pos) and math.isclose(got.low, neg)
    level = pk.error_cutoffs(scored_of(spark, [(1, 0.3), (0, 0.3), (0, 0.6)])).first()
    assert math.isclose(level.high, 0.4 + 1e-6) and level.low == 0.01
    below = pk.error_cutoffs(scored_of(spark, [(1, -0.5), (0, -0.5)])).first()
    assert (below.high, below.low) == (0.01, 0.0)
    one_kind = pk.error_cutoffs(scored_of(spark, [(1, 0.2), (1, 0.4)])).first()
    assert math.isclose(one_kind.high, 0.3) and one_kind.low == 0.001
    negatives = pk.error_cutoffs(scored_of(spark, [(0, 0.002)])).first()
    assert (negatives.high, negatives.low) == (0.01, 0.002)


def test_error_samples(spark, rows):
    pairs = [(1, 0.9)] * 7 + [(1, 0.0)] * 2 + [(0, 0.0)] * 6 + [(0, 0.2)] * 3
    got = pk.error_samples(scored_of(spark, pairs))
    classes = {}
    for r in got.orderBy("class", "place").collect():
        classes.setdefault(r["class"], []).append(r.gold_row)
    assert classes == {"TP": [0, 1, 2, 3, 4], "FN": [7, 8], "TN": [9, 10, 11, 12, 13], "FP": [15, 16, 17]}


GOLD = "gold_row long, path_a string, path_b string, label int"
SYSTEM = "path_a string, path_b string, score double, line int"


def test_gold_scores(spark, rows):
    gold = spark.createDataFrame([(0, "a ", "b", 1), (1, "b", "a", 0), (2, "c", "d", 0)], GOLD)
    system = spark.createDataFrame([("b", " a", 0.2, 1), ("a", "b", 0.7, 2), ("x", "y", 1.0, 3)], SYSTEM)
    scores = lambda df: [r[4] for r in rows(df)]
    assert scores(pk.score_gold(gold, system)) == [0.7, 0.7, 0.0]
    assert scores(pk.score_gold(gold, system, order="line")) == [0.2, 0.2, 0.0]
    assert scores(pk.score_gold(gold, system, dedupe=False)) == [0.2, 0.7, 0.2, 0.7, 0.0]
    assert [r[0] for r in rows(pk.gold_without(gold, system))] == [2]


def test_one_pair_in_a_third_of_all_gold_rows(spark, rows):
    pairs = [("a", "b")] * 50 + [("x", "y")] * 50 + [(f"p{i}", "q") for i in range(50)]
    gold = spark.createDataFrame([(i, a, b, i % 2) for i, (a, b) in enumerate(pairs)], GOLD)
    system = spark.createDataFrame([("b", "a", 0.5, 1), ("q", "p3", 0.25, 2)], SYSTEM)
    got = {r[0]: r[4] for r in rows(pk.score_gold(gold, system))}
    assert got == {i: {("a", "b"): 0.5, ("p3", "q"): 0.25}.get(p, 0.0) for i, p in enumerate(pairs)}
    left = {r[0] for r in rows(pk.gold_without(gold, system))}
    assert left == {i for i, p in enumerate(pairs) if p not in {("a", "b"), ("p3", "q")}}


def test_everything_together(spark):
    gold = spark.createDataFrame([(0, "a", "b", 1), (1, "c", "d", 0)], GOLD)
    system = spark.createDataFrame([("a", "b", 0.2, 1)], SYSTEM)
    tables = pk.evaluate_rules(system, gold)
    assert tables["scored"].count() == 2
    assert tables["best_threshold"].first().threshold == 0.2
    assert {r["class"] for r in tables["error_samples"].collect()} == {"TP", "TN"}
    assert all(df.count() >= 0 for df in tables.values())


def test_null_paths_keep_their_rows_and_match_nothing(spark, rows):
    gold = spark.createDataFrame(
        [(0, "a", "b", 1), (1, None, None, 0), (2, "a", None, 0)],
        "gold_row long, path_a string, path_b string, label int",
    )
    system = spark.createDataFrame(
        [("a", "b", 0.5), ("a", "a", 0.9), (None, "a", 0.7), (None, None, 0.8)],
        "path_a string, path_b string, score double",
    )
    want = [(0, "a", "b", 1, 0.5), (1, None, None, 0, 0.0), (2, "a", None, 0, 0.0)]
    assert rows(pk.score_gold(gold, system)) == want
    assert rows(pk.score_gold(gold, system, dedupe=False)) == want
    assert rows(pk.gold_without(gold, system.limit(0))) == rows(gold)
    assert [r[0] for r in rows(pk.gold_without(gold, system))] == [1, 2]


def test_a_score_that_is_not_a_number_is_zero(spark, rows):
    gold = spark.createDataFrame([(0, "a", "b", 0)], "gold_row long, path_a string, path_b string, label int")
    system = spark.createDataFrame([("b", "a", float("nan"))], "path_a string, path_b string, score double")
    assert [r[-1] for r in rows(pk.score_gold(gold, system))] == [0.0]


def test_evaluation_reads_the_system_once(spark, rows):
    gold = spark.createDataFrame(
        [(0, "a", "b", 1), (1, "a", "c", 0), (2, "b", "c", 1)], "gold_row long, path_a string, path_b string, label int"
    )
    system = spark.createDataFrame(
        [("a", "b", 0.5, 1), ("b", "a", 0.9, 2), ("c", "a", 0.2, 3)], "path_a string, path_b string, score double, place int"
    )
    tables = pk.evaluate_rules(system, gold, order="place")
    assert [r[-1] for r in rows(tables["scored"])] == [0.5, 0.2, 0.0]
    for table in tables.values():
        assert "LocalTableScan" not in table._jdf.queryExecution().optimizedPlan().toString()
