"""The subpackage's registered queries and the SQL that states what they must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest

    return nearest(_read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    packed = pack_documents(_read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import fingerprint

    return fingerprint(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .web_archive import read, write

    index = write(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    records = read(index, index._archives)
    return records.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .private_data import BASE_KINDS, digest, find, joined

    found = find(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, digest("base").alias("base_sha256"), joined("spans").alias("spans"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_duplicates import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, held_out, predict

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge

    return judge(_read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(_read(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, held_out, score

    docs, labels = _read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = score(docs, fit(docs, labels.where(~held_out())))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked_search import search

    return search(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import deduplicate_files

    return deduplicate_files(spark, f"{sf_dir}/documents.parquet")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(_read(spark, sf_dir, "documents").select("text", "lang", "source"))


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9_mixing aims at, which SQL can state: the rounding of its copies it can't."""
    return op9_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited texts that op3_fingerprints compares, which SQL can state."""
    return op3_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_web_archive": op4_web_archive,
    "op5_private_data": op5_private_data,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language": op7_language,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_ranked_search": op11_ranked_search,
    "op12_exact_copies": op12_exact_copies,
    "op13_divergence": op13_divergence,
    "mixing_targets": mixing_targets,
    "fingerprint_edits": fingerprint_edits,
}

SQL: dict[str, str] = {
    "op4_web_archive": sql.WEB_ARCHIVE,
    "op6_near_duplicates": sql.NEAR_DUPLICATES,
    "op8_url_filter": sql.URL_FILTER,
    "op11_ranked_search": sql.RANKED_SEARCH,
    "op12_exact_copies": sql.EXACT_COPIES,
    "op13_divergence": sql.DIVERGENCE,
    "mixing_targets": sql.MIXING_TARGETS,
    "fingerprint_edits": sql.FINGERPRINT_EDITS,
}
