"""Inputs that Spark derives from the driver's tables.

No table holds parse lines, fact counts or gold pairs, so these are derived,
over whole tables and whole texts, without hash functions and random numbers:
the same inputs can be written in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _windows(texts: DataFrame) -> DataFrame:
    """(i, w1, w2, w3): every three words in a row of every text, ``i`` from 0."""
    words = F.regexp_extract_all(F.col("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    return (
        texts.select("text")
        .repartition(texts.sparkSession.sparkContext.defaultParallelism)
        .select(words.alias("w"))
        .select("w", F.posexplode_outer("w").alias("i", "w1"))
        .select(
            "i", "w1", F.get("w", F.col("i") + 1).alias("w2"), F.get("w", F.col("i") + 2).alias("w3")
        )
        .filter(F.col("w3").isNotNull())
    )


# Parse lines built around three words; the place of a window picks the form.
# {0}, {1} and {2} are the words.
LINE_FORMS = (
    "{1}\t{0}/NN/nsubj/2 {1}/VBZ/ROOT/0 {2}/NN/dobj/2\t17",
    "{0}/NNP/nsubj/1\t{1}/VBZ/ROOT/0\t{2}/NNS/dobj/1",
    "{1}\t{1}/VBZ/ROOT/0 {0}/IN/prep/1 {2}/NNP/pobj/2\t153\t1834,2",
    "{0}/NNP/nsubj/2\t{2}/VBZ/aux/2\t{1}/VBG/ROOT/0",
    "{0}/PRP/nsubj/1 {1}/VBD/conj/3 {2}/WP$/dobj/1 said/VBD/ROOT/0\t1,204.5",
    "{1}\t{1}/VB/ROOT/0 1/2/CD/num/1 {2}/NN/dobj/1\t5",
    "  \t{1}\t{1}/VB/ROOT/0 {2}/dt/dobj\t5 ",
    "{1}/NN/ROOT/0 {0}/JJ/amod/1 {2}/RB/advmod/-1\t8",
)


def _line(form: str) -> Column:
    words = [F.col(c) for c in ("w1", "w2", "w3")]
    parts: list[Column] = []
    text = form
    while "{" in text:
        before, _, rest = text.partition("{")
        number, _, text = rest.partition("}")
        parts += [F.lit(before), words[int(number)]]
    return F.concat(*parts, F.lit(text))


def _lines(texts: DataFrame) -> DataFrame:
    form = F.col("i") % len(LINE_FORMS)
    value = F.when(form == 0, _line(LINE_FORMS[0]))
    for k in range(1, len(LINE_FORMS)):
        value = value.when(form == k, _line(LINE_FORMS[k]))
    return _windows(texts).select(value.alias("value"))


def ngram_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parse lines of all documents."""
    return _lines(table(spark, folder, "documents"))


def talk_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parse lines of all conversation turns."""
    return _lines(table(spark, folder, "conversations"))


def words(spark: SparkSession, folder: str) -> DataFrame:
    """All distinct words of all documents, as ``word``."""
    found = F.regexp_extract_all(F.col("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    return table(spark, folder, "documents").select(F.explode(found).alias("word")).distinct()


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the path ``brand -> type`` of their part."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    path = F.concat_ws(" -> ", "p_brand", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("path", path)


def triples(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of (brand and type, return flag, supplier) over all order lines."""
    return (
        _sold(spark, folder)
        .groupBy(
            "path",
            F.col("l_returnflag").alias("slot"),
            F.col("l_suppkey").cast("string").alias("word"),
        )
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def order_triples(spark: SparkSession, folder: str) -> DataFrame:
    """One uncounted triple per order line, with the amount bought as count; keys repeat."""
    return _sold(spark, folder).select(
        "path",
        F.col("l_returnflag").alias("slot"),
        F.col("l_suppkey").cast("string").alias("word"),
        F.col("l_quantity").cast("bigint").alias("cnt"),
    )


def gold(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of paths on neighbouring lines of an order; 1 if a large amount was bought."""
    sold = _sold(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "path")
    first = sold.select(
        "l_orderkey",
        (F.col("l_linenumber") + 1).alias("l_linenumber"),
        F.col("path").alias("path_a"),
        "l_quantity",
    )
    second = sold.select("l_orderkey", "l_linenumber", F.col("path").alias("path_b"))
    row = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return (
        first.join(second, ["l_orderkey", "l_linenumber"])
        .groupBy("path_a", "path_b")
        .agg(
            F.min(row).alias("gold_row"),
            (F.max("l_quantity") >= 40).cast("int").alias("label"),
        )
        .select("gold_row", "path_a", "path_b", "label")
    )


def scored_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Every labelled document: its quality label, and its length as score."""
    texts = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return labels.join(texts, "doc_id").select(
        F.col("doc_id").alias("gold_row"),
        F.concat(F.lit("doc "), "doc_id").alias("path_a"),
        F.lit("labels").alias("path_b"),
        F.col("quality").alias("label"),
        (F.floor(F.col("n_chars") / 100) / 1000).alias("score"),
    )


def document_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The scores of ``scored_gold`` for every document, labelled or not, as a system's."""
    return table(spark, folder, "documents").select(
        F.concat(F.lit("doc "), "doc_id").alias("path_a"),
        F.lit("labels").alias("path_b"),
        (F.floor(F.col("n_chars") / 100) / 1000).alias("score"),
    )


def _tsv(*fields: Column | str) -> Column:
    return F.concat_ws("\t", *fields)


def _by_case(column: Column, cases: dict[int, Column], otherwise: Column) -> Column:
    value = None
    for k, v in cases.items():
        value = F.when(column == k, v) if value is None else value.when(column == k, v)
    return value.otherwise(otherwise)


def stored_lines(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Every order line as a stored text row of ``kind``; its line number picks a defect.

    ``place`` tells the order of the rows.
    """
    flag, supplier, part = F.col("l_returnflag"), F.col("l_suppkey"), F.col("l_partkey")
    amount, price, number = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_linenumber")
    count = amount.cast("bigint").cast("string")
    path = F.concat(F.lit("part "), part)
    cents = F.round(price * 100).cast("bigint").cast("string")
    real = F.concat(cents, F.lit("e-2"))
    lit = F.lit
    good, cases = {
        "triples": (
            _tsv(path, flag, supplier, count),
            {
                1: _tsv(path, flag, count),
                2: F.concat(_tsv(path, flag, supplier, F.concat(lit("+"), count)), lit("\t x")),
                3: _tsv(path, flag, supplier, F.concat(count, lit(".5"))),
                4: F.concat(lit(" "), _tsv(path, flag, supplier, F.concat(lit(" "), count)), lit(" \t")),
                5: _tsv(path, flag, supplier, F.concat(lit("9999999999999999999"), count)),
            },
        ),
        "mi": (
            _tsv(path, flag, supplier, real),
            {
                1: _tsv(path, flag, real),
                2: F.concat(_tsv(path, flag, supplier, F.concat(lit("-"), real)), lit("\tx")),
                3: _tsv(path, flag, supplier, F.concat(real, lit("x"))),
                4: _tsv(path, flag, supplier, F.concat(lit(" "), cents, lit(" "))),
                5: _tsv(path, flag, supplier, lit("")),
            },
        ),
        "partials": (
            _tsv(path, supplier, real),
            {
                1: _tsv(path, real),
                2: _tsv(path, supplier, F.concat(lit("-"), real), lit("x")),
                3: _tsv(path, supplier, F.concat(lit("."), cents)),
                4: _tsv(path, supplier, lit("none")),
            },
        ),
        "totals": (
            _tsv(path, real),
            {
                1: path,
                2: _tsv(path, F.concat(lit("-"), real)),
                3: _tsv(path, F.concat(lit("n"), real)),
                4: F.concat(lit("\t"), real),
            },
        ),
        "marginals": (
            _tsv(F.concat(lit("PS:"), path), flag, count),
            {
                1: _tsv(F.concat(lit("SW:"), flag), supplier, count),
                2: _tsv(lit("TOTAL"), count),
                3: _tsv(F.concat(lit("XY:"), flag), supplier, count),
                4: _tsv(F.concat(lit("PS:"), path), flag, F.concat(count, lit("x"))),
            },
        ),
        "system": (
            _tsv(path, supplier, real),
            {
                1: _tsv(F.concat(lit(" "), path, lit(" ")), F.concat(supplier, lit(" ")), cents),
                2: _tsv(path, supplier, lit("n/a")),
                3: _tsv(path, supplier, real, lit("x")),
                4: _tsv(path, supplier),
            },
        ),
        "system_ws": (
            F.concat_ws("   ", supplier, path, real),
            {
                1: F.concat_ws(" ", supplier, cents),
                2: F.concat_ws(" ", supplier, path, lit("high")),
                3: F.concat(lit("  "), F.concat_ws(" \t ", supplier, path, cents), lit(" ")),
                4: F.concat_ws(" ", supplier, flag, cents),
            },
        ),
    }[kind]
    return table(spark, folder, "lineitem").select(
        ((F.col("l_orderkey") * 100 + number) * 100_000_000 + cents.cast("bigint")).alias("place"),
        _by_case(number, cases, good).alias("value"),
    )
