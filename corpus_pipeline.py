"""A corpus from raw documents to packed sequences, each stage one operator of cellweave.llm.

Every stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; its result is written as Parquet and read again. All stages
but the last return the columns of documents.

1. language: documents without a known language go: those without a letter, and
   those that the filter of no learned language supports.
2. near_duplicates: of each group of texts that share 80 % or more of their
   five-word shingles the one with the smallest doc_id stays.
3. private_data: spans of personal data become <KIND>, n_chars follows.
4. mixing: documents are left out, kept or repeated so that sources meet
   their target weights.
5. packing: the documents as pieces of sequences of 2048 tokens.

Rows without a doc_id are never duplicates of others and otherwise treated
alike; those that share a text are mixed alike too. Repeated rows of a doc_id are
one document from stage 2 on. Null and empty texts, and those without a letter,
have no language and go in stage 1; texts of any length pass whole; null sources
are a source of their own; ties go to the smaller doc_id, then to the smaller
hash of the text; an empty table gives an empty result; other columns are kept
up to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.llm import language, mixing, near_duplicates, packing, private_data
from cellweave.llm.common import forget, scratch, store
from cellweave.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.fit(docs), language.LEAST_SCORE)


def whole(docs: DataFrame) -> Column:
    """The row as one value, so that no column of docs meets a column of the stage's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(docs, percent=80)
    kept = store(found.where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    nth = F.row_number().over(W.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    once = docs.join(kept, "doc_id", "left_semi").select(whole(docs), nth.alias("nth")).where("nth = 1").select("row.*")
    return once.unionByName(docs.where("doc_id is null"))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = private_data.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce(F.sha2("text", 256), F.lit(""))))
    return mixing.repeated(docs, key)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("private_data", without_private_data),
    ("mixing", mixed),
    ("packing", packed),
]

#: The mixing stage is an iterative fit, which SQL can't express; tests hold run() against a version without Spark.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as own:  # what the stage wrote for itself goes, its result stays until the next stage has read it
            made = store(stage(spark, docs, sf_dir), name)
            own.remove(made._stored_at)
        forget(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
