"""The registered queries of the llm operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from edgelens.llm import conversation_repair, exact_dedup, html_extract, lang_id, mixing, pair_sql, quality_rules, secret_scan, spelling, warc
from edgelens.llm.ngram_join import ngram_jaccard_join
from edgelens.llm.nn_descent import embedding_near_duplicates
from edgelens.llm.packing import pack_documents
from edgelens.llm.token_count import count_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = lang_id.identify_languages(docs, lang_id.train(docs))
    return found.select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_extract.extract_main_text(pages, html_extract.train(pages))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.span_digest(secret_scan.scan_secrets(docs, secret_scan.train(docs)))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return verdicts.drop("class_divergence", "word_divergence")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.corpus_words(_table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_ngram_join, op2_mixing, op3_language_id, op4_html_extraction, op5_packing,
        op6_token_counts, op7_warc, op8_embedding_near_dedup, op9_exact_dedup, op10_secret_scan,
        op11_quality_rules, op12_spelling_variants, op13_conversation_repair,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for those that SQL can express; the tests hold the others against plain Python."""
    return {
        "op1_ngram_join": pair_sql.NGRAM_JOIN,
        "op2_mixing": mixing.ORACLE_SQL,
        "op7_warc": warc.ORACLE_SQL,
        "op8_embedding_near_dedup": pair_sql.EMBEDDING_NEAR_DEDUP,
        "op9_exact_dedup": exact_dedup.ORACLE_SQL,
        "op11_quality_rules": quality_rules.ORACLE_SQL,
        "op12_spelling_variants": spelling.ORACLE_SQL,
        "op13_conversation_repair": conversation_repair.ORACLE_SQL,
    }
