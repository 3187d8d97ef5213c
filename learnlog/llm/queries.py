"""Registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.llm import sql
from learnlog.llm.byte_bpe import bpe_decode, bpe_encode
from learnlog.llm.language_id import predict_language
from learnlog.llm.license_scan import license_scan
from learnlog.llm.naive_bayes_svm import THRESHOLD, quality_scores
from learnlog.llm.nearest import nearest_neighbours
from learnlog.llm.ngram_join import ngram_jaccard_join
from learnlog.llm.packing import pack_documents
from learnlog.llm.phrase_mining import phrase_collocations
from learnlog.llm.quality_rules import quality_rules
from learnlog.llm.secret_scan import secret_scan
from learnlog.llm.spelling import spelling_variants
from learnlog.llm.substring_dedup import substring_dedup
from learnlog.llm.suffix_dedup import suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op1_substring_dedup": sql.SUBSTRING_DEDUP, "op2_ngram_jaccard_join": sql.NGRAM_JACCARD_JOIN,
                          "op9_suffix_dedup": sql.SUFFIX_DEDUP, "op11_phrase_mining": sql.PHRASE_MINING, "op12_spelling_variants": sql.SPELLING_VARIANTS}


#: Texts that go to a Python worker at once, where the session has Spark's default of 10,000: texts are long.
BATCH_ROWS = 1000


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it, and send them small batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == 10_000:
        spark.conf.set(name, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def query(fn: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def remainder(id_col, n: int):
    """crc32 of the id as text, modulo ``n``; 0 for a missing id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % n, F.lit(0))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                         learn_from=lambda doc_id: remainder(doc_id, 5) != 0)
    return out.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def bpe_ranks() -> str:
    """Place of the rank file that texts are encoded with."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe_encode(table(spark, sf_dir, "documents"), bpe_ranks())
    return bpe_decode(ids, bpe_ranks()).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                               F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict_language(docs, docs.where(remainder(F.col("doc_id"), 4) != 2))
    return out.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex",
                      F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def packing_tokenizer() -> str:
    """Place of the vocabulary file that documents are packed with."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), packing_tokenizer())


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_collocations(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), misspell=97)


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")
