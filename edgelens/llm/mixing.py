"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgelens.llm.scratch import Scratch

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and so a document, is taken this many times at most.
MAX_EPOCHS = 3
SEED = 17
#: Leading hex digits of the seeded hash that deal a source's documents over buckets.
BUCKET_DIGITS = 3


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` with what the mix takes of each.

    Adds ``size`` (words ``[^\\x20\\x09-\\x0D]+`` of the text; null: 0), ``source_size``,
    ``target`` (words that the mix wants of the source), ``copies`` (times the document is
    taken) and ``taken`` (``copies * size``); columns of ``docs`` with these names are replaced.

    Targets share the total size by weight. Where a target exceeds ``max_epochs`` times its
    source's size it stops there, and the excess goes to the other sources by weight until none
    is above. Sources are in the order of their code points and null, a source like any other,
    is last. Every document of a source is taken ``floor(target / source_size)`` times, and once
    more in the order of a seeded hash of its id while the sum stays nearest to the target, so
    the mix misses a target by half a document at most. Documents alike in id and size are
    interchangeable. Empty documents take nothing; an empty table gives an empty result.

    Sums are taken by source and hash bucket, so a source with a third of all rows is spread
    over ``16 ** BUCKET_DIGITS`` groups. Only the table of sources is ordered in one task.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c not in added]
    docs = docs.select(
        *(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(kept)),
        F.col(source_col).alias("_source"),
        F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("_size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_turn"),
        F.col(id_col).alias("_id"),
    ).withColumn("_bucket", F.substring("_turn", 1, BUCKET_DIGITS))

    sums = scratch.keep(docs.groupBy("_source", "_bucket").agg(F.sum("_size").alias("in_bucket")), "buckets")
    plan = scratch.keep(_targets(sums, weights, max_epochs), "targets")
    upto = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(upto), F.lit(0)))
        .alias("b").join(plan.alias("p"), F.expr("b._source <=> p._source"))
        .select("b._source", "b._bucket", "before", "source_size", "target", "whole", "quota")
    )
    buckets = scratch.keep(buckets, "bucket-targets")

    in_bucket = Window.partitionBy("_source", "_bucket").orderBy("_turn", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    dealt = docs.withColumn("_upto", F.sum("_size").over(in_bucket)).alias("d").join(
        buckets.alias("b"), F.expr("d._source <=> b._source AND d._bucket = b._bucket")
    )
    half_way: Column = F.expr("CAST(before + _upto - _size AS DOUBLE) + _size / 2.0D")
    copies = F.col("whole") + (half_way <= F.col("quota")).cast("long")
    copies = F.when(F.col("_size") > 0, copies).otherwise(F.least(F.col("whole"), F.lit(max_epochs)))
    return dealt.select(
        *(F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)),
        F.col("_size").alias("size"), "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("_size")).cast("long").alias("taken"),
    )


def _targets(sums: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source: its size, its target, and how often it is taken whole and in part.

    In the order of size over weight the capped sources come first; with them gone, the rest
    share what is left by weight. All sums are whole numbers until the last division.
    """
    place = Window.orderBy(F.col("_source").asc_nulls_last())
    sources = sums.groupBy("_source").agg(F.sum("in_bucket").alias("source_size")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    fill = Window.orderBy(F.expr("source_size / weight"), F.col("_source").asc_nulls_last())
    whole_table = Window.partitionBy()
    return (
        sources.withColumn("at", F.row_number().over(fill))
        .withColumn("words", F.sum("source_size").over(whole_table) - max_epochs * F.coalesce(F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("share", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("free", F.col("source_size") * max_epochs * F.col("share") >= F.col("weight") * F.col("words"))
        .withColumn("first", F.min(F.when(F.col("free"), F.struct("at", "words", "share"))).over(whole_table))
        .withColumn("target", F.when(F.col("at") < F.col("first.at"), (F.col("source_size") * max_epochs).cast("double"))
                    .otherwise((F.col("weight") * F.col("first.words")).cast("double") / F.col("first.share").cast("double")))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("quota", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double"))
        .select("_source", "source_size", "target", "whole", "quota")
    )


#: DuckDB SQL with doc_id, size, source_size, target and taken of ``mix_sources``.
ORACLE_SQL = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS BIGINT) AS weight FROM s
), f AS (
    SELECT *, row_number() OVER o AS place,
           CAST(sum(source_size) OVER () - {MAX_EPOCHS} * (sum(source_size) OVER o - source_size) AS BIGINT) AS words,
           CAST(sum(weight) OVER () - (sum(weight) OVER o - weight) AS BIGINT) AS share
    FROM w WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), k AS (
    SELECT place AS first_place, words AS first_words, share AS first_share FROM f
    WHERE source_size * {MAX_EPOCHS} * share >= weight * words ORDER BY place LIMIT 1
), t AS (
    SELECT source, source_size,
           CASE WHEN place < first_place THEN CAST(source_size * {MAX_EPOCHS} AS DOUBLE)
                ELSE CAST(weight * first_words AS DOUBLE) / CAST(first_share AS DOUBLE) END AS target
    FROM f, k
), q AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), u AS (
    SELECT d.*, q.source_size, q.target, q.whole, q.target - CAST(q.whole * q.source_size AS DOUBLE) AS quota,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.turn, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
    FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN CAST(upto - size AS DOUBLE) + size / 2.0 <= quota THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM u
"""
