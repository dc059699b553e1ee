"""A corpus pipeline: language ID, exact and near deduplication, mixing and packing.

Every stage takes whole tables and returns the columns of ``documents``, whatever others there
are, with their values; the last returns the pieces of the packed sequences. Each result is
written to the shared folder and read again. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgelens.llm import lang_id
from edgelens.llm.exact_dedup import exact_dedup
from edgelens.llm.mixing import mix_sources
from edgelens.llm.ngram_join import ngram_jaccard_join
from edgelens.llm.packing import pack_documents
from edgelens.llm.scratch import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (null and empty texts too) and those whose language is in
    doubt. Repeated rows are judged alike."""
    renamed, restored = _guarded(docs)
    found = lang_id.identify_languages(renamed, lang_id.train(renamed))
    return restored(found.where("NOT rejected"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the longest as written, then the one with the smallest id, a null id
    last, then the first row. Null texts are equal to empty ones."""
    docs, keyed = _keyed(spark, docs)
    kept = exact_dedup(keyed, id_col="_key").where("kept")
    return _rows(docs, kept)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the smallest id, a null id last; null
    and empty texts are linked with nothing and stay."""
    docs, keyed = _keyed(spark, docs)
    kept = ngram_jaccard_join(keyed, id_col="_key").where("_key = component_id")
    return _rows(docs, kept)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; those it does not take go. Null
    sources are one source, empty documents stay as often as their source is taken whole."""
    docs, keyed = _keyed(spark, docs, "doc_id", "source")
    taken = mix_sources(keyed).where("copies > 0").select("_key", "copies")
    return _rows(docs, taken, F.col("copies"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the documents' tokens to sequences."""
    return pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: Language ID cannot be expressed in SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Columns of documents that the stages read.
_READ = ("doc_id", "text", "lang", "source")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _guarded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns that no stage reads renamed, so that none has the name of one
    that an operator adds, and how to name them again."""
    inner = [c if c in _READ else f"_column{i}" for i, c in enumerate(docs.columns)]
    names = docs.columns
    return docs.toDF(*inner), lambda df: df.select(*(F.col(a).alias(b) for a, b in zip(inner, names, strict=True)))


def _keyed(spark: SparkSession, docs: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """``docs``, and (_key, text) of its rows. A key orders by id, null last, and tells
    repeated rows apart by their place in the files. Frames that are more than a scan of files
    are written first, as rows made after a scan share their places."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = Scratch(spark, "rows").keep(docs, "documents")
    row = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), row.alias("row"))
    return docs, docs.select(key.alias("_key"), "text", *more)


def _rows(docs: DataFrame, keys: DataFrame, copies: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with these keys, each as many times as ``copies`` says."""
    inner = [f"_column{i}" for i in range(len(docs.columns))]
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    marked = docs.select(*(F.col(_quoted(c)).alias(i) for c, i in zip(docs.columns, inner, strict=True)), *place)
    times = F.lit(1) if copies is None else copies
    keys = keys.select(F.col("_key.row.file").alias("_file"), F.col("_key.row.at").alias("_at"), times.cast("long").alias("_times"))
    found = marked.join(keys, ["_file", "_at"])
    if copies is not None:
        found = found.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return found.select(*(F.col(i).alias(c) for c, i in zip(docs.columns, inner, strict=True)))
