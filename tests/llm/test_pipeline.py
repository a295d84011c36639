import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r[0] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, FOLDER).cache()
        after = {r[0] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and after <= before
        if name in ("quality_rules", "ngram_jaccard_join"):
            assert after < before
        if name == "secret_scans":
            assert after == before
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r[0] for r in pieces.select("doc_id").collect()} == after
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_its_stages(spark):
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.count() > 0 and "sequence_id" in whole.columns
