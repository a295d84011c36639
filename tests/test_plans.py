"""What must hold of the physical plans, whatever the data."""

import pytest
from pyspark.sql import functions as F

import pathkin as pk
from pathkin.session import cut_lineage

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def mi(spark):
    rows = [(f"p{i % 7}", "X", f"w{i % 5}", float(i)) for i in range(60)]
    return cut_lineage(spark.createDataFrame(rows, "path string, slot string, word string, mi double"))


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, f"a{i}", "b", i % 2, i / 10) for i in range(20)]
    return cut_lineage(
        spark.createDataFrame(rows, "gold_row long, path_a string, path_b string, label int, score double")
    )


def test_no_cross_joins_and_no_python(mi, scored):
    triples = mi.withColumn("cnt", F.col("mi").cast("long"))
    lines = mi.select(F.col("word").alias("value"))
    plans = {
        "counts": pk.count_corpus(lines),
        "mi": pk.mutual_information(triples),
        "similarity": pk.path_similarity(mi),
        "pairs": pk.feature_pairs(mi),
        "asked pairs": pk.score_pairs(scored.select("path_a", "path_b"), mi),
        "normalised": pk.lin_normalize(
            pk.sum_partials(pk.feature_pairs(mi)), pk.path_totals(mi)
        ),
        "thresholds": pk.threshold_metrics(scored),
        "curve": pk.pr_curve(scored),
        "samples": pk.error_samples(scored),
        "gold": pk.score_gold(scored.drop("score"), scored.select("path_a", "path_b", "score")),
    }
    for name, df in plans.items():
        plan = plan_of(df)
        found = [word for word in FORBIDDEN if word in plan]
        assert not found, (name, found)


def test_counting_shuffles_once(mi):
    plan = plan_of(pk.count_corpus(mi.select(F.col("word").alias("value"))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


def test_pairs_are_summed_on_numbers(mi):
    plan = pk.path_similarity(mi)._jdf.queryExecution().optimizedPlan().toString()
    summed = next(line for line in plan.splitlines() if "Aggregate" in line and "AS numerator" in line)
    assert not [name for name in ("path#", "slot#", "word#") if name in summed]


def test_pairs_are_not_shuffled_where_paths_share_few_features(spark, mi, monkeypatch):
    """There are as many pairs as partial scores; a shuffle of their sums fills the disk."""
    rows = [(f"p{i}", "X", f"w{i % 2}", 1.0) for i in range(400)]
    sparse = cut_lineage(spark.createDataFrame(rows, mi.schema))
    monkeypatch.setattr("pathkin.operators.similarity.TASK_PAIRS", 10)

    def after_pairs_are_made(df):
        plan = plan_of(df)
        return plan[: plan.index("partial_sum((mi")]

    assert "Exchange" not in after_pairs_are_made(pk.path_similarity(sparse))
    # Seven paths share all features here: their few sums are shuffled, not copies of facts.
    assert "Exchange" in after_pairs_are_made(pk.path_similarity(mi))


def test_marginals_are_counted_once(mi):
    triples = cut_lineage(mi.withColumn("cnt", F.col("mi").cast("long")))
    assert "sum(cnt" not in plan_of(pk.mutual_information(triples, unique=True))


def test_lines_are_parsed_once(mi):
    plan = plan_of(pk.count_corpus(mi.select(F.col("word").alias("value"))))
    assert plan.count("split(") <= 3


def test_parents_are_looked_up_after_the_explode(mi):
    """Spark interprets functions on arrays: a line needs them for its tokens and its base alone."""
    plan = plan_of(pk.extract_arcs(mi.select(F.col("word").alias("value"))))
    assert "places" not in plan and "AS base" in plan


def test_windows_of_words_are_not_zipped(spark):
    from pathkin.workload import inputs

    plan = plan_of(inputs._lines(spark.createDataFrame([("a b c d",)], "text string")))
    assert "arrays_zip" not in plan and "slice" not in plan


def test_error_samples_are_cut_before_the_shuffle(scored):
    assert "WindowGroupLimit" in plan_of(pk.error_samples(scored))


def test_scans_read_only_what_is_used(spark, mi):
    plan = plan_of(pk.path_totals(mi))
    assert "ReadSchema: struct<path:string,mi:double>" in plan


def test_stage_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    from pathkin import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.stage_folder(Session())
