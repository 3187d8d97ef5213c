"""Corpus pipeline: quality rules, near duplicates, repeated passages, secrets, packing.

``STAGES`` are functions of (spark, docs, sf_dir); each one's result is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``; the last returns the packed pieces with their ids.
Extra columns of ``docs`` are dropped by the first stage, missing text is
treated as empty text.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlog.llm.ngram_join import ngram_jaccard_join
from learnlog.llm.packing import pack_documents
from learnlog.llm.quality_rules import quality_rules
from learnlog.llm.queries import packing_tokenizer, workers_find_package
from learnlog.llm.secret_scan import secret_scan
from learnlog.llm.substring_dedup import substring_dedup
from learnlog.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates: words of a shingle and least Jaccard similarity (op2's contract has its own).
NEAR_SHINGLE, NEAR_NUM, NEAR_DEN = 5, 80, 100


def _stage(fn):
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


def _documents(rows: DataFrame, text: str) -> DataFrame:
    return rows.select("doc_id", F.col(text).alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = docs.select(*COLUMNS, F.col("lang").alias("_lang"))
    judged = quality_rules(rows, lang_col="_lang", carry=["text", "lang", "source", "n_chars"])
    return judged.where("kept").select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents: that of the smallest id.

    Rows that repeat that id stay one each; rows without an id all stay.
    """
    joined = ngram_jaccard_join(docs, num=NEAR_NUM, den=NEAR_DEN, shingle=NEAR_SHINGLE).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(joined, "doc_id", "left_anti")


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that earlier documents or lines hold; texts left without words go."""
    out = substring_dedup(docs, carry=["text", "lang", "source"])
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return _documents(out.where("n_words > n_removed").withColumn("_new", text), "_new")


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    return _documents(secret_scan(docs, carry=["lang", "source"]), "clean_text")


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return pack_documents(docs, packing_tokenizer(), with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: Tokenizers, hashes and fitted distances are no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
