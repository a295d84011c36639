import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import pathkin as pk
from pathkin.session import cut_lineage

KNOWN_LINES = {
    "P1": (
        ["Nora/NNP/nsubj/1\tcuts/VBZ/ROOT/0\tplums/NNS/dobj/1"] * 2
        + [
            "Nora/NNP/nsubj/1\tbuys/VBZ/ROOT/0\tplums/NNS/dobj/1",
            "hopes/VBZ/ROOT/0\tfor/IN/prep/1\tOtto/NNP/pobj/2\t153",
        ],
        [("buy -> dobj", "cut -> dobj", 1.0), ("buy -> nsubj", "cut -> nsubj", 1.0)],
    ),
    "P2": (
        [
            f"{s}/NNP/nsubj/1\t{v}/VBZ/ROOT/0\t{o}/NN/dobj/1"
            for s, v, o, n in [
                ("a", "cut", "p", 4),
                ("a", "cut", "q", 1),
                ("b", "chew", "p", 1),
                ("b", "chew", "q", 2),
                ("c", "grab", "q", 3),
                ("a", "grab", "p", 1),
            ]
            for _ in range(n)
        ],
        [
            ("chew -> dobj", "cut -> dobj", 1.0),
            ("chew -> dobj", "grab -> dobj", 1.0),
            ("cut -> dobj", "grab -> dobj", 1.0),
            ("cut -> nsubj", "grab -> nsubj", 0.436209),
        ],
    ),
}


@pytest.mark.parametrize("name", list(KNOWN_LINES))
def test_known_corpus(spark, rows, name, tmp_path):
    texts, want = KNOWN_LINES[name]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(pk.discover_rules(lines)) == want
    assert rows(pk.discover_rules(lines, stage_dir=str(tmp_path / "stages"))) == want
    folder = str(tmp_path / "stages" / "triples")
    stored = spark.read.parquet(f"{folder}/{pk.stage_manifest(spark, folder)['data']}")
    assert stored.count() == pk.count_corpus(lines).count()


def test_counts_and_mi(spark, rows):
    lines = spark.createDataFrame([(t,) for t in KNOWN_LINES["P1"][0]], "value string")
    triples = pk.count_corpus(lines)
    assert rows(triples) == [
        ("buy -> dobj", "Y", "plum", 1),
        ("buy -> nsubj", "X", "nora", 1),
        ("cut -> dobj", "Y", "plum", 2),
        ("cut -> nsubj", "X", "nora", 2),
        ("hope -> for", "Y", "otto", 1),
    ]
    got = {(r.path, r.word): round(r.mi, 6) for r in pk.mutual_information(triples).collect()}
    assert got[("cut -> dobj", "plum")] == 0.847298
    assert got[("hope -> for", "otto")] == 1.94591
    assert len(got) == 5


def brute(triples):
    """Marginals, mutual information, pair sums and scores in plain Python."""
    ps, sw = Counter(), Counter()
    for p, s, w, c in triples:
        ps[p, s] += c
        sw[s, w] += c
    total = sum(ps.values())
    mi = {(p, s, w): math.log(c * total / (ps[p, s] * sw[s, w])) for p, s, w, c in triples}
    totals, features = Counter(), defaultdict(list)
    for (p, s, w), v in mi.items():
        totals[p] += v
        features[s, w].append((p, v))
    sums = Counter()
    for group in features.values():
        for (a, x), (b, y) in itertools.combinations(sorted(group), 2):
            if a != b:
                sums[a, b] += x + y
    scores = {
        (a, b): n / (totals[a] + totals[b]) if totals[a] + totals[b] > 0 else n
        for (a, b), n in sums.items()
    }
    return mi, sums, scores


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows share one feature, another third one path."""
    rng = random.Random(7)
    keys = {(f"p{i}", "Y", "hot") for i in range(120)}
    keys |= {("p0", "Y", f"w{i}") for i in range(120)}
    while len(keys) < 360:
        keys.add((f"p{rng.randrange(60)}", rng.choice("XY"), f"w{rng.randrange(40)}"))
    return [(*k, rng.randint(1, 9)) for k in sorted(keys)]


@pytest.fixture(scope="module")
def mi_rows(spark, skewed):
    triples = spark.createDataFrame(skewed, "path string, slot string, word string, cnt long")
    return pk.mutual_information(triples, unique=True).cache()


def as_map(df):
    rows = df.collect()
    result = {(r[0], r[1]): r[2] for r in rows}
    assert len(result) == len(rows)
    return result


def close(got, want):
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_mi_under_skew(mi_rows, skewed):
    want = brute(skewed)[0]
    got = {(r.path, r.slot, r.word): r.mi for r in mi_rows.collect()}
    close(got, want)


@pytest.mark.parametrize("block_rows", [1, 7, 50, 1000])
def test_similarity_is_the_same_for_every_block_size(mi_rows, skewed, block_rows):
    _, sums, scores = brute(skewed)
    close(as_map(pk.path_similarity(mi_rows, block_rows=block_rows)), scores)
    raw = pk.path_similarity(mi_rows, normalize=False, block_rows=block_rows)
    close(as_map(raw), dict(sums))
    pairs = pk.feature_pairs(mi_rows, block_rows=block_rows)
    assert pairs.filter("path_a >= path_b").count() == 0


@pytest.mark.parametrize("tiles", [0, 1, 2, 7])
def test_similarity_is_the_same_for_every_number_of_tiles(mi_rows, skewed, tiles):
    _, sums, scores = brute(skewed)
    close(as_map(pk.path_similarity(mi_rows, tiles=tiles)), scores)
    close(as_map(pk.path_similarity(mi_rows, normalize=False, tiles=tiles)), sums)


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_asked_pairs_score_as_all_pairs_do(spark, mi_rows, skewed, block_rows):
    want = brute(skewed)[2]
    asked = [(b, a) for a, b in sorted(want)[::3]] + sorted(want)[::5] + [("p0", f"p{i}") for i in range(120)]
    asked += [("p1", None), (None, None), ("p1", "unknown"), ("p2", "p1"), ("p1", "p2")]
    pairs = spark.createDataFrame(asked, "path_a string, path_b string")
    keys = {tuple(sorted(k)) for k in asked if None not in k}
    got = as_map(pk.score_pairs(pairs, mi_rows, block_rows))
    close(got, {k: v for k, v in want.items() if k in keys})
    assert pk.score_pairs(pairs.limit(0), mi_rows).count() == 0


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_similarity_is_the_same_for_every_partition_count(spark, mi_rows, skewed, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = mi_rows.orderBy(F.rand(3))
        close(as_map(pk.path_similarity(shuffled, block_rows=20)), brute(skewed)[2])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_every_pair_of_every_feature_counts(mi_rows, skewed):
    sizes = Counter((s, w) for _, s, w, _ in skewed)
    whole = pk.feature_pairs(mi_rows).count()
    assert whole == sum(n * (n - 1) // 2 for n in sizes.values())


def test_repeated_keys_pair_with_each_other_path(spark, rows):
    mi = spark.createDataFrame(
        [("a", "X", "w", 1.0), ("a", "X", "w", 2.0), ("b", "X", "w", 0.5)],
        "path string, slot string, word string, mi double",
    )
    assert rows(pk.feature_pairs(mi)) == [("a", "b", 1.5), ("a", "b", 2.5)]


def test_marginals_agree(spark, skewed):
    triples = spark.createDataFrame(skewed, "path string, slot string, word string, cnt long")
    table = pk.marginals(triples).cache()
    sums = {r.kind: r.s for r in table.groupBy("kind").agg(F.sum("n").alias("s")).collect()}
    total = sum(c for *_, c in skewed)
    assert sums == {"PS": total, "SW": total, "TOTAL": total}
    stored = as_triples(pk.mutual_information_from(triples, table))
    close(stored, brute(skewed)[0])


def as_triples(df):
    return {(r.path, r.slot, r.word): r.mi for r in df.collect()}


def test_missing_marginals_give_no_rows(spark):
    schema = "path string, slot string, word string, cnt long"
    triples = spark.createDataFrame([("a", "X", "w", 2), ("b", "X", "v", 1)], schema)
    marginals = spark.createDataFrame(
        [("PS", "a", "X", None, 2), ("PS", "b", "X", None, 1), ("SW", None, "X", "w", 2), ("TOTAL", None, None, None, 3)],
        "kind string, path string, slot string, word string, n long",
    )
    got = as_triples(pk.mutual_information_from(triples, marginals))
    assert got.keys() == {("a", "X", "w")}
    no_total = marginals.filter("kind <> 'TOTAL'")
    assert pk.mutual_information_from(triples, no_total).count() == 0


def test_counts_that_give_no_mi(spark):
    schema = "path string, slot string, word string, cnt long"
    triples = spark.createDataFrame([("a", "X", "w", 0), ("a", "X", "v", 5), ("b", "X", "w", -2)], schema)
    assert as_triples(pk.mutual_information(triples)).keys() == {("a", "X", "v")}
    assert pk.mutual_information(triples.limit(0)).count() == 0


def test_large_counts_do_not_overflow(spark):
    schema = "path string, slot string, word string, cnt long"
    triples = spark.createDataFrame([("a", "X", "w", 1 << 61), ("b", "X", "v", 1 << 61)], schema)
    got = as_triples(pk.mutual_information(triples))
    assert math.isclose(got["a", "X", "w"], math.log(2))


def test_normalisation_guards(spark, rows):
    cases = [("p1", "q1", 2.0), ("p2", "q2", 2.0), ("p3", "q3", 2.0), ("p4", "q4", 2.0)]
    totals = [("p1", 3.0), ("q1", 1.0), ("p2", -3.0), ("q2", 1.0), ("p3", 1.0), ("q3", -1.0), ("q4", 1.0)]
    got = pk.lin_normalize(
        spark.createDataFrame(cases, "path_a string, path_b string, score double"),
        spark.createDataFrame(totals, "path string, total_mi double"),
    )
    assert rows(got) == [("p1", "q1", 0.5), ("p2", "q2", 2.0), ("p3", "q3", 2.0), ("p4", "q4", 2.0)]


def test_normalisation_spreads_a_hot_path_and_keeps_nulls(spark):
    cases = [("hot", f"q{i}", 2.0) for i in range(500)] + [(f"p{i}", "z", 2.0) for i in range(500)]
    scored = spark.createDataFrame([*cases, ("hot", None, 3.0)], "path_a string, path_b string, score double")
    totals = spark.createDataFrame([("hot", 1.0), ("q7", 3.0)], "path string, total_mi double")
    got = pk.lin_normalize(scored, totals)
    found = {(r.path_a, r.path_b): r.score for r in got.collect()}
    assert found == {(a, b): s for a, b, s in cases} | {("hot", "q7"): 0.5, ("hot", None): 3.0}


def test_path_totals_add_up(mi_rows):
    whole = mi_rows.agg(F.sum("mi")).first()[0]
    parts = pk.path_totals(mi_rows).agg(F.sum("total_mi")).first()[0]
    assert math.isclose(whole, parts, abs_tol=1e-9)


@pytest.mark.parametrize("dense", [0.0, 1.5, 4.0, math.inf])
@pytest.mark.parametrize("block_rows", [3, 1000])
def test_asked_pairs_are_the_same_on_both_ways(spark, mi_rows, skewed, dense, block_rows):
    want = brute(skewed)[2]
    asked = sorted(want)[::2] + [("p3", "unknown"), ("p4", None)]
    pairs = spark.createDataFrame(asked, "path_a string, path_b string")
    got = as_map(pk.score_pairs(pairs, mi_rows, block_rows, dense=dense))
    close(got, {k: want[k] for k in asked if k in want})


def test_facts_of_dense_pairs_are_not_copied_to_each_pair(spark):
    """All pairs of 12 paths over 900 features: only facts and sums may be shuffled."""
    mi = cut_lineage(
        spark.range(12 * 900).selectExpr(
            "concat('p', id % 12) AS path", "'X' AS slot", "concat('w', id div 12) AS word", "1.0D AS mi"
        )
    )
    pairs = mi.select("path").distinct().alias("l").join(mi.select("path").distinct().alias("r"), F.col("l.path") < F.col("r.path"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = pk.score_pairs(pairs.select(F.col("l.path").alias("path_a"), F.col("r.path").alias("path_b")), mi)
        assert 0 < shuffled_rows(scored) < 4 * 12 * 900
        assert scored.count() == 66
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled_rows(df):
    """Rows written by the shuffles of ``df``, after its run."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    total, todo = 0, [execution.executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total
