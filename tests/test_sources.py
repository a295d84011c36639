import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import pathkin as pk


def lines_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_triples(spark, rows):
    texts = ["p\tX\tw\t3", " p\tX\tw\t +4 \textra", "p\tX\tw", "p\tX\tw\t2.5", "p\tX\tw\t", "", "p\tX\t\t5", "p\tX\tw\t9223372036854775808", "p\tX\tw\t-1"]
    assert rows(pk.parse_triples(lines_of(spark, texts))) == [
        ("p", "X", "", 5), ("p", "X", "w", -1), ("p", "X", "w", 3), ("p", "X", "w", 4),
    ]


def test_mi_and_partials(spark, rows):
    texts = ["p\tX\tw\t-0.5", "p\tX\tw\t1e2", "p\tX\tw\tx", "p\tX\t1.0", "p\tX\tw\t 3. \tz", "p\tX\tw\t1d", "p\tX\tw\tinf"]
    assert [r[3] for r in rows(pk.parse_mi(lines_of(spark, texts)))] == [-0.5, 1.0, 100.0, 3.0]
    texts = ["a\tb\t.5", "a\tb", "a\tb\tnone", " a\tb\t2\tx"]
    assert rows(pk.parse_partials(lines_of(spark, texts))) == [("a", "b", 0.5), ("a", "b", 2.0)]


def test_path_totals(spark, rows):
    texts = ["a -> b\t1.5", "x\ty\t2", "none", "\t3", "a\tz", "a -> b\t1.5"]
    assert rows(pk.parse_path_totals(lines_of(spark, texts))) == [("a -> b", 1.5), ("x\ty", 2.0)]
    with pytest.raises(Exception, match="several totals for path a"):
        pk.parse_path_totals(lines_of(spark, ["a\t1", "a\t2"])).collect()
    placed = spark.createDataFrame([("a\t1", 2), ("a\t2", 1), ("a\tx", 3)], "value string, n int")
    assert rows(pk.parse_path_totals(placed, order="n")) == [("a", 1.0)]


def test_marginals_round_trip(spark, rows, tmp_path):
    triples = spark.createDataFrame(
        [("eat -> dobj", "Y", "apple", 2), ("eat -> dobj", "Y", "", 1), ("go -> to", "Y", "apple", 4)],
        "path string, slot string, word string, cnt long",
    )
    table = pk.marginals(triples)
    pk.write_marginals(table, str(tmp_path / "m"))
    assert rows(pk.read_marginals(spark, str(tmp_path / "m"))) == rows(table)
    texts = ["PS:a\tX\tn", "XX:a\tX\t1", "TOTAL", "PS:a\tX\t 7 "]
    assert rows(pk.parse_marginals(lines_of(spark, texts))) == [("PS", "a", "X", None, 7)]


def test_system_scores(spark, rows):
    texts = [" a \tb c \t0.5\tmore", "a\tb\tn/a", "a\tb"]
    lines = lines_of(spark, texts)
    # A line of two fields has no score: 0.0, as a missing score in a score file.
    assert rows(pk.parse_system_scores(lines)) == sorted([("a", "b", 0.0), ("a", "b", 0.0), ("a", "b c", 0.5)], key=repr)
    want = sorted([("a", "b", None), ("a", "b", None), ("a", "b c", 0.5)], key=repr)
    assert rows(pk.parse_system_scores(lines, coerce=False)) == want
    assert rows(pk.parse_system_scores(lines_of(spark, ["one field"]))) == []
    texts = ["  a   b c \t 0.5 ", "a 0.5", "a b high", "a b 1"]
    got = pk.parse_system_scores(lines_of(spark, texts), layout="whitespace")
    assert rows(got) == [("a", "b c", 0.5), ("a", "b", 1.0)]
    with pytest.raises(ValueError):
        pk.parse_system_scores(lines, layout="other")


def test_system_scores_are_numbers_of_score_files(spark, rows):
    texts = {"NaN": 0.0, "-nan": 0.0, "1.5f": 0.0, "2d": 0.0, "inf": float("inf"), "-Infinity": float("-inf"), "1e-3": 0.001}
    lines = lines_of(spark, [f"{i}\tb\t{t}" for i, t in enumerate(texts)])
    assert rows(pk.parse_system_scores(lines)) == [(str(i), "b", v) for i, v in enumerate(texts.values())]
    lines = lines_of(spark, [f"{i} b {t}" for i, t in enumerate(texts)])
    kept = [(str(i), "b", v) for i, (t, v) in enumerate(texts.items()) if t[-1] not in "fd" or t == "inf"]
    assert rows(pk.parse_system_scores(lines, layout="whitespace")) == kept


def test_stage_files_round_trip(spark, rows, tmp_path):
    triples = spark.createDataFrame([("a -> b", "X", "w", 3), ('q"x', "Y", "v", 1)], "path string, slot string, word string, cnt long")
    pk.write_tsv(triples, str(tmp_path / "t"))
    assert rows(pk.read_triples(spark, str(tmp_path / "t"))) == rows(triples)
    mi = triples.select("path", "slot", "word", (F.col("cnt") / 7).alias("mi"))
    pk.write_tsv(mi, str(tmp_path / "mi"))
    assert rows(pk.read_mi(spark, str(tmp_path / "mi")), 17) == rows(mi, 17)
    pairs = spark.createDataFrame([("a", "b", 0.1), ("a", "c", -2e-9)], "path_a string, path_b string, partial double")
    pk.write_tsv(pairs, str(tmp_path / "p"))
    assert rows(pk.read_partials(spark, str(tmp_path / "p")), 17) == rows(pairs, 17)
    assert rows(pk.read_system_scores(spark, str(tmp_path / "p")), 17) == rows(pairs, 17)
    totals = spark.createDataFrame([("a", 1.25)], "path string, total_mi double")
    pk.write_tsv(totals, str(tmp_path / "totals"))
    assert rows(pk.read_path_totals(spark, str(tmp_path / "totals"))) == [("a", 1.25)]
    assert rows(pk.write_stage(triples, str(tmp_path / "stage"))) == rows(triples)
    with pytest.raises(AnalysisException):
        pk.write_tsv(triples, str(tmp_path / "t"))


def test_lines_and_gold(spark, rows, tmp_path):
    (tmp_path / "lines").write_text("a/b/c\tx\n\nlast")
    assert rows(pk.read_ngram_lines(spark, str(tmp_path / "lines"))) == [("",), ("a/b/c\tx",), ("last",)]
    (tmp_path / "pos").write_text("X eat Y\tX chew Y\nX go Y\tX run Y\n")
    (tmp_path / "neg").write_text("X eat Y\tX run Y\n")
    gold = pk.read_gold(spark, str(tmp_path / "pos"), str(tmp_path / "neg")).orderBy("gold_row")
    assert [tuple(r)[1:] for r in gold.collect()] == [
        ("X eat Y", "X chew Y", 1), ("X go Y", "X run Y", 1), ("X eat Y", "X run Y", 0),
    ]
    assert gold.select("gold_row").distinct().count() == 3


def test_gold_rows_follow_the_files(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad.tsv"
    good.mkdir()
    (good / "part-00000").write_text("a\tb\n")
    (good / "part-00001").write_text("".join(f"c{i}\td\n" for i in range(500)))
    bad.write_text("e\tf\ng\t\n")
    rows = pk.read_gold(spark, str(good), str(bad)).orderBy("gold_row").collect()
    assert [r["gold_row"] for r in rows] == list(range(503))
    assert [r["path_a"] for r in rows] == ["a", *(f"c{i}" for i in range(500)), "e", "g"]
    assert [r["label"] for r in rows] == [1] * 501 + [0] * 2
    assert rows[-1]["path_b"] is None
