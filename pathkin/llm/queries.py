"""One query per operator, over whole tables, and their SQL where SQL can express them."""

import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pathkin.llm import bpe, circulant, hmm, huffman, jaccard, licenses, mtree, packing, phrases, quality, secret_scan, toxicity, variants
from pathkin.session import stage_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Workers that didn't start in this repository find the package too.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    # Texts may be long: few of them go to a Python worker at once.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))

    def n(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(secret_scan.listed("base").cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"),
    )


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return mtree.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{stage_folder(spark)}/tokens-{uuid.uuid4().hex}"
    huffman.write_tokens(table(spark, folder, "documents"), path, BYTE_BPE, end_id=2)
    return huffman.read_tokens(spark, path, with_ids=False)


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score_texts(table(spark, folder, "documents"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


def op7_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_labels(table(spark, folder, "documents"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_stats(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), BYTE_BPE, end_id=0)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(table(spark, folder, "documents"))


def op13_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return circulant.near_duplicates(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_exact_top_k,
        op3_ngram_jaccard_join,
        op4_token_files,
        op5_lm_scoring,
        op6_byte_bpe,
        op7_license_scans,
        op8_quality_rules,
        op9_packing,
        op10_toxicity,
        op11_phrase_collocations,
        op12_spelling_variants,
        op13_minhash_near_dedup,
    )
}

ORACLES: dict[str, str] = {
    "op11_phrase_collocations": phrases.ORACLE,
    "op2_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
            FROM embeddings
        ), valid AS (
            SELECT vec_id, x FROM whole
            WHERE vec_id IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
            FROM valid q JOIN valid c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored
        QUALIFY rank <= 5
    """,
}
