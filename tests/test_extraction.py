import itertools
import re

import pytest
from pyspark.sql import functions as F

import pathkin as pk
from pathkin import fixed

LINES = {
    "preposition": (
        "hopes/VBZ/ROOT/0\tfor/IN/prep/1\tOtto/NNP/pobj/2\t153",
        [("hope -> for", "Y", "otto")],
    ),
    "subject and object": (
        "Nora/NNP/nsubj/1\tcuts/VBZ/ROOT/0\tplums/NNS/dobj/1",
        [("cut -> nsubj", "X", "nora"), ("cut -> dobj", "Y", "plum")],
    ),
    "auxiliary": (
        "Nora/NNP/nsubj/2\tis/VBZ/aux/2\tjumping/VBG/ROOT/0",
        [("jump -> nsubj", "X", "nora")],
    ),
    "pronouns": (
        "She/PRP/nsubj/1\tcounted/VBD/ROOT/0\tthem/PRP/dobj/1",
        [("count -> nsubj", "X", "she"), ("count -> dobj", "Y", "them")],
    ),
    "auxiliary as main verb": (
        "be\train/NN/nsubj/2 be/VB/ccomp/0 for/IN/prep/2 crops/DT/pobj/3\t23\t1834,2",
        [("be -> nsubj", "X", "rain"), ("be -> for", "Y", "crop")],
    ),
    "auxiliary elsewhere": ("be\tthem/PRP/nsubj/2 be/VB/conj/3 go/VB/ROOT/0\t5", []),
    "tie counts from zero": ("be\train/NN/nsubj/2 be/VB/ccomp/0\t23\t1834,2", []),
    "dropped token takes no place": (
        "cut\tcut/VB/ROOT/0 1/2/CD/num/1 plum/NN/dobj/1\t5",
        [("cut -> dobj", "Y", "plum")],
    ),
    "three parts": ("cut\tcut/VB/ROOT/0 plum/NN/dobj\t5", [("cut -> dobj", "Y", "plum")]),
    "blank head": ("cut\tcut/VB/ROOT/0 plum/NN/dobj/\t5", [("cut -> dobj", "Y", "plum")]),
    "empty word": ("cut\tcut/VB/ROOT/0 /NN/dobj/1\t5", [("cut -> dobj", "Y", "")]),
    "preposition keeps case": (
        "hope\thopes/VBZ/ROOT/0 For/IN/prep/1 Otto/NNP/pobj/2\t153",
        [("hope -> For", "Y", "otto")],
    ),
    "tag case": (
        "hope\thopes/VBZ/ROOT/0 for/in/prep/1 otto/nn/pobj/2 me/prp/dobj/1\t153",
        [("hope -> dobj", "Y", "me")],
    ),
    "wh-words": (
        "see\twho/WP/nsubj/2 sees/VBZ/ROOT/0 whose/WP$/dobj/2 which/WDT/dobj/2\t7",
        [("see -> nsubj", "X", "who"), ("see -> dobj", "Y", "whose")],
    ),
    "passive subject": (
        "see\tis/VBZ/aux/2 seen/VBN/ROOT/0 cats/NNS/nsubjpass/2\t7",
        [("seen -> nsubjpass", "X", "cat")],
    ),
    "negative head": ("x\tcat/NN/nsubj/-1 runs/VBZ/ROOT/0\t7", []),
    "head too large": (
        "x\tcat/NN/nsubj/99999999999 runs/VBZ/ROOT/0 far/RB/advmod/2\t7",
        [],
    ),
    "numbers only": ("12\t3,4.5\t,", []),
    "blank": ("  \t ", []),
    "empty": ("", []),
    "counted from one": (
        "dog/NN/nsubj/2 chases/VBZ/ROOT/0 cat/NN/dobj/2\t3",
        [("chas -> nsubj", "X", "dog"), ("chas -> dobj", "Y", "cat")],
    ),
    "control characters at the edge": (
        "\x01cut/VB/ROOT/0 \x02 \x01plum/NN/dobj/\x011\x02\t5",
        [("cut -> dobj", "Y", "plum")],
    ),
    "control character inside": (
        "cut/VB/ROOT/0 ap\x01ple/NN/dobj/1\t5",
        [("cut -> dobj", "Y", "ap\x01ple")],
    ),
    "more parts than used": (
        "cut/VB/ROOT/0/9 plum/NN/dobj/1/x/y",
        [("cut -> dobj", "Y", "plum")],
    ),
    "plus sign": ("cut/VB/ROOT/0 plum/NN/dobj/+1", [("cut -> dobj", "Y", "plum")]),
    "head is no whole number": ("cut/VB/ROOT/0 plum/NN/dobj/1.0", []),
}

STEMS = """walking walk waiting wait running run falling fal studying studyy dying dyy
sing sing king king waited wait solved solv stopped stop tried try red red bed bed need ne
cuts cut plums plum studies study boxes box churches church goes go uses us has ha is is
bus bus pass pass his his as as yes ye Added ad singing sing miss miss kisses kiss ties ty
played play NASA's nasa' ies y es es oes oe""".split()


def lines_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.fixture(scope="module")
def extracted(spark):
    """All lines in one job, each fact with the name of its line carried by a marker column."""
    names = list(LINES)
    result = {}
    for name in names:
        result[name] = pk.extract_occurrences(lines_of(spark, [LINES[name][0]]))
    return result


@pytest.mark.parametrize("name", list(LINES))
def test_line(extracted, rows, name):
    assert rows(extracted[name]) == sorted(LINES[name][1], key=repr)


def test_all_lines_together(spark, rows):
    got = pk.extract_occurrences(lines_of(spark, [text for text, _ in LINES.values()]))
    want = [fact for _, facts in LINES.values() for fact in facts]
    assert rows(got) == sorted(want, key=repr)


def test_nouns_only(spark, rows):
    got = pk.extract_occurrences(lines_of(spark, [LINES["pronouns"][0], LINES["three parts"][0]]), "noun")
    assert rows(got) == [("cut -> dobj", "Y", "plum")]


def test_report_holds_the_lines_without_a_path(spark, rows):
    long = "x/NN/ROOT/0 " + "y" * 300
    texts = [text for text, _ in LINES.values()] + [long]
    got = dict(rows(pk.extraction_report(lines_of(spark, texts))))
    assert set(got) == {text for text, facts in LINES.values() if not facts} | {long}
    assert got[long] == long[:200] + "..."


def test_stem(spark):
    pairs = list(zip(STEMS[::2], STEMS[1::2]))
    frame = spark.createDataFrame(pairs, "word string, want string")
    got = frame.select("word", "want", pk.stem(F.col("word")).alias("got")).collect()
    assert [(r.word, r.got) for r in got] == pairs
    assert spark.createDataFrame([("",)], "w string").select(pk.stem(F.col("w"))).first()[0] == ""


def test_tokens_bases_and_parents(spark):
    frame = lines_of(spark, [LINES["dropped token takes no place"][0], LINES["tie counts from zero"][0]])
    got = frame.select(
        pk.ngram_tokens(F.col("value")).alias("t"),
        pk.detect_head_base(pk.ngram_tokens(F.col("value"))).alias("base"),
        pk.resolve_parents(pk.ngram_tokens(F.col("value"))).alias("p"),
    ).collect()
    assert [tuple(t) for t in got[0].t] == [("cut", "VB", "ROOT", 0, 0), ("plum", "NN", "dobj", 1, 1)]
    assert [r.base for r in got] == [1, 0]
    assert [t.parent for t in got[0].p] == [None, 0]
    # Nothing lies at place 2, and the verb's own head 0 leads to the first token.
    assert [t.parent for t in got[1].p] == [None, 0]


def test_heads_that_are_no_numbers(spark):
    """Heads as a cast to int reads them; all white space parts pieces, with controls or without."""
    heads = ["1", "+1", "-1", "x", "1.0", "+", "1-2", "99999999999", "\x7f1", "1e3", "\u0661", ""]
    line = "\n".join(f"w/NN/dobj/{h}" for h in heads) + "\x0bv/NN/dobj \rq/NN\f\x01y/NN/dobj/ \x02"
    for text in (line, line.replace("\n", " ")):
        frame = lines_of(spark, [text])
        got = frame.select(pk.ngram_tokens(F.col("value")).alias("t")).first().t
        assert [t.head for t in got] == [1, 1, -1, 1, 0, 0, 0]
    plan = frame.select(pk.ngram_tokens(F.col("value")))._jdf.queryExecution().optimizedPlan().toString()
    assert "0123456789) = )" in plan  # no cast, and so no exception, for other fields


def test_segments_without_counts(spark):
    frame = lines_of(spark, [" be \t\t a/b/c d/e/f \t23\t1834,2\t,\t4x ", "  "])
    got = frame.select(pk.ngram_segments(F.col("value")).alias("s")).collect()
    assert [r.s for r in got] == [["be", "a/b/c d/e/f", "4x"], []]


def test_paths(spark):
    texts = ["cut -> dobj -> plum", " a -> nsubj -> b -> c", "a -> b", " x ", "", None, " -> x -> "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r.s) for r in frame.select(pk.split_path(F.col("t")).alias("s")).collect()]
    assert got == [
        ("cut -> dobj", "Y", "plum"),
        ("a -> nsubj", "X", "b"),
        ("a -> b", "", ""),
        ("x", "", ""),
        ("", "", ""),
        ("", "", ""),
        (" -> x", "Y", ""),
    ]
    rules = [r[0] for r in frame.select(pk.format_rule(F.col("t"))).collect()]
    assert rules == ["X cut Y", "X  a Y", "X a Y", "X  x  Y", "", None, "X  -> x ->  Y"]


def test_slots(spark):
    relations = ["nsubj", "NSUBJPASS", "nsubjx", "csubj", "csubjpass", "csubjx", "dobj", None]
    frame = spark.createDataFrame([(r,) for r in relations], "r string")
    got = [r[0] for r in frame.select(pk.slot_of(F.col("r"))).collect()]
    assert got == ["X", "X", "X", "X", "X", "Y", "Y", "Y"]


@pytest.mark.parametrize("fillers", ["filler", "noun"])
def test_code_of_counting_is_compiled(spark, fillers):
    """No method of the generated code is too large for Spark (64 KB) or the JVM (8000 bytes)."""
    counts = pk.count_corpus(lines_of(spark, ["cut/VB/ROOT/0 plum/NN/dobj/1"]), fillers)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = counts._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.length())]
    assert sizes and all(0 < size < 8000 for size in sizes), sizes


def test_report_is_the_rest_of_extraction(spark, rows):
    """Each line, deep and odd ones too, either gives a fact or stands in the report."""
    tags, heads = ["VB", "IN", "NN", "PRP"], ["0", "1", "2", "3", "-1", "150", " ", "x"]
    texts = [
        " ".join(f"w{k}/{tags[(n >> k) % 4]}/{'ROOT' if k == n % 5 else 'dep'}/{heads[(n * (k + 1)) % 8]}" for k in range(4))
        for n in range(120)
    ]
    frame = lines_of(spark, texts)
    facts = pk.extract_arcs(frame.select(F.col("value")))
    assert facts.count() > 0
    silent = {t for t in texts if not pk_facts(t)}
    assert {v for v, _ in rows(pk.extraction_report(frame))} == silent
    assert sorted(r.filler for r in facts.select("filler").collect()) == sorted(
        f for t in texts for f in pk_facts(t)
    )


def pk_facts(line):
    """Fillers of ``line`` that hang on a verb, by plain Python."""
    tokens = []
    for piece in line.split():
        word, pos, dep, *head = piece.split("/")
        number = 0 if not head or not head[0].strip() else head[0]
        try:
            tokens.append((word, pos, dep, int(number)))
        except ValueError:
            pass
    n, lean = len(tokens), 0
    for i, (_, _, dep, h) in enumerate(tokens):
        if not (h == 0 and dep == "ROOT"):
            lean += (1 <= h <= n and h - 1 != i) - (0 <= h < n and h != i)

    def up(i):
        if i is None:
            return None
        _, _, dep, h = tokens[i]
        if lean > 0:
            at = h - 1
        elif h != i and not (h == 0 and dep == "ROOT"):
            at = h
        else:
            return None
        return at if 0 <= at < n else None

    def is_(i, tag):
        return i is not None and tokens[i][1] == tag

    found = []
    for i, (word, pos, _, _) in enumerate(tokens):
        if pos in ("NN", "PRP") and (is_(up(i), "VB") or is_(up(i), "IN") and is_(up(up(i)), "VB")):
            found.append(word)
    return found


def test_stem_takes_no_pattern(spark):
    """Patterns are matched after a copy of the word into a Java string, up to eight a word."""
    frame = spark.createDataFrame([("w",)], "w string").select(pk.stem(F.col("w")))
    plan = frame._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" not in plan and "regexp" not in plan


def test_stem_goes_by_the_endings(spark, rows):
    """As the patterns of ``fixed.WORD_ENDINGS`` say, for every short body and every ending."""
    letters = ["a", "b", "y", "i", "e", "s", "h", "\n", "\u00e9", "\U0001f600"]
    bodies = [""] + [a + b + c for a in ["", *letters] for b in ["", *letters] for c in letters]
    words = sorted({b + e for b in bodies for e in ("ing", "ed", "s", "es", "ies", "ied", "ying", "")})

    def stem(word):
        for pattern, kept in fixed.WORD_ENDINGS:
            found = re.match(pattern.replace(r"\z", r"\Z"), word)
            if found:
                return found.group(1) + kept.replace("$1", "").replace("$2", found.group(2) if "$2" in kept else "")
        return word

    frame = spark.createDataFrame([(w,) for w in words], "w string").select("w", pk.stem(F.col("w")))
    assert rows(frame) == sorted(((w, stem(w)) for w in words), key=repr)


def test_bases_and_parents_of_odd_heads(spark):
    """Heads at both ends of the line, beyond them and at the ends of an int."""
    heads = [0, 1, 2, 3, -1, 2**31 - 1, -(2**31)]
    lines = [[(d, h) for d, h in zip(ds, hs)] for n in (1, 2, 3)
             for ds in itertools.product(("ROOT", "x"), repeat=n) for hs in itertools.product(heads, repeat=n)]

    def want(line):
        n, lean = len(line), 0
        for i, (dep, h) in enumerate(line):
            if not (h == 0 and dep == "ROOT"):
                lean += (1 <= h <= n and h - 1 != i) - (0 <= h < n and h != i)
        at = [
            h - 1 if lean > 0 else h if h != i and not (h == 0 and dep == "ROOT") else None
            for i, (dep, h) in enumerate(line)
        ]
        return int(lean > 0), [a if a is not None and 0 <= a < n else None for a in at]

    frame = spark.createDataFrame(
        [(k, [("w", "p", d, h) for d, h in line]) for k, line in enumerate(lines)],
        "k int, t array<struct<word string, pos string, dep string, head int>>",
    )
    base = pk.detect_head_base(F.col("t"))
    frame = frame.select("k", "t", base.alias("base"))
    for parents in (pk.resolve_parents(F.col("t")), pk.resolve_parents(F.col("t"), F.col("base"))):
        got = frame.select("k", "base", parents["parent"].alias("p")).collect()
        assert all((r.base, r.p) == want(lines[r.k]) for r in got) and len(got) == len(lines)


def test_report_searches_up_to_the_first_path(spark, rows):
    frame = lines_of(spark, ["cut/VB/ROOT/0 plum/NN/dobj/1 pear/NN/dobj/1", "", "cut/VB/ROOT/0"])
    report = pk.extraction_report(frame)
    assert "exists(" in report._jdf.queryExecution().optimizedPlan().toString()
    assert [v for v, _ in rows(report)] == ["", "cut/VB/ROOT/0"]


def test_report_filters_lines_once_made(spark):
    """The filter parses made lines; below their making, each row would carry its whole text."""
    texts = spark.createDataFrame([("a b c d",)], "t string").select(F.split("t", " ").alias("w"))
    made = texts.select("w", F.posexplode("w").alias("i", "w1")).select(
        F.concat("w1", F.lit("/NN/nsubj/"), F.get("w", F.col("i") + 1)).alias("value")
    )
    plan = pk.extraction_report(made)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if line.strip(" +-:").startswith("Filter")]
    assert filters and not any("w#" in line for line in filters), filters
