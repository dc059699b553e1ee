"""The pipeline's stages on tables with other columns, folders of files and derived frames."""

import itertools

import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from edgelens.llm.scratch import Scratch

WORDS = "one two three four five six seven eight nine ten eleven twelve".split()
CLASHING = ("size", "target", "score", "copies", "taken", "rejected", "_key", "a.b", "`q`", "_file", "_at", "_times", "_column0")


@pytest.fixture(scope="module")
def docs(spark):
    """Forty documents in two sources, each row told by its further columns."""
    texts = [" ".join(p) + f" closing words of document {i}." for i, p in enumerate(itertools.islice(itertools.permutations(WORDS, 9), 0, 40000, 1000))]
    rows = [(i, t, "en", "ab"[i % 2], len(t), *(f"{c}-{i}" for c in CLASHING)) for i, t in enumerate(texts)]
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    return Scratch(spark, "test").keep(spark.createDataFrame(rows, "d long, t string, l string, s string, n int, " + ", ".join(f"c{i} string" for i in range(len(CLASHING)))).toDF(*names), "docs")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_other_columns_keep_their_values(spark, docs, name):
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert found.columns == docs.columns
    assert [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
    rows = found.collect()
    assert rows
    for row in rows:
        assert [row[5 + i] for i in range(len(CLASHING))] == [f"{c}-{row.doc_id}" for c in CLASHING]


def test_files_of_one_name_in_two_folders(spark, docs, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        pq.write_table(docs.where("doc_id = 0").toArrow(), tmp_path / folder / "part-0.parquet")
    both = spark.read.parquet(f"{tmp_path}/x", f"{tmp_path}/y")
    assert both.count() == 2
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        assert stage(spark, both, "").count() == 1


def test_rows_made_after_a_scan(spark, docs):
    thrice = docs.limit(4).withColumn("time", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        assert stage(spark, thrice, "").count() == 4
    mixed = corpus_pipeline.mix(spark, thrice, "")
    assert mixed.columns == thrice.columns


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, docs, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.where("doc_id < 0"), "").collect() == []
