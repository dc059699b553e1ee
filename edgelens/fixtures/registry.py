"""Every operator and query over the derived tables, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgelens.fixtures.tables import fixture_tables, pair_list
from edgelens.functions import Bounds, Resolution, ScoreFn
from edgelens.operators import edges as E
from edgelens.operators import filters, ordering, pairs, ranking
from edgelens.operators.dimensions import body_dimension, enrich_edges, sv_boxes, sv_dimension
from edgelens.operators.skew import find_hot_keys
from edgelens.operators.storage import shared_folder
from edgelens.parameters import EdgeCriteria, EdgeType
from edgelens.plans import (
    best_edges_all_res,
    best_edges_one_res,
    edge_query,
    edge_query_resolutions,
    export_batch,
    extract_pairs,
)
from edgelens.plans.best_edges import inter_body_candidates
from edgelens.plans.skew_profile import measure_skew
from edgelens.plans.edge_query import EDGE_COLUMNS
from edgelens.sources import TableSet, run_sql
from edgelens.sources.export import (
    input_identity,
    preview,
    read_in_order,
    read_inputs,
    read_provenance,
    read_results,
    summarize,
    write_results,
)

Query = Callable[[SparkSession, str], DataFrame]

NM8, NM16, NM32 = Resolution.NM8, Resolution.NM16, Resolution.NM32
STORED, INTEGER, FLOAT = E.Coordinates.STORED, E.Coordinates.INTEGER, E.Coordinates.FLOAT

FLAT_COLUMNS = ("sv_a", "sv_b", *E.SCORE_FIELDS, *E.COORDINATE_FIELDS)
SCORED_COLUMNS = (*FLAT_COLUMNS, "score")

# Tasks that a key is compared with where the registered queries split hot keys: at 400, each
# of the suppliers of a small scale has more rows than two tasks should get.
SPLIT_TASKS = 400

# The batch criteria. No derived body reaches the customary 1e9 voxels, hence 5e7.
INTRA_CRITERIA = EdgeCriteria(
    edge_type=EdgeType.INTRA_BODY, min_sv_size_both=1e6, min_body_size_either=5e7
)


def scored_edges(tables: TableSet, res: Resolution = NM8) -> DataFrame:
    return E.with_score(E.flatten_edges(tables.rsg[res], res), ScoreFn.OPTIMISTIC)


def mapped_edges(tables: TableSet) -> DataFrame:
    return E.map_bodies(scored_edges(tables), tables.agglo)


def enriched_edges(tables: TableSet) -> DataFrame:
    return enrich_edges(scored_edges(tables), sv_dimension(tables))


def scan_edges(tables: TableSet) -> DataFrame:
    names = ("oax", "oay", "oaz", "obx", "oby", "obz", "px", "py", "pz")
    return tables.rsg[NM8].select(
        "label_a",
        "label_b",
        *(F.col(f).alias(c) for c, f in E.SCORE_FIELDS.items()),
        *(F.col(f).alias(c) for c, f in zip(names, E.COORDINATE_FIELDS.values())),
    )


def _tagged(tables: TableSet, coordinates: E.Coordinates) -> DataFrame:
    return E.union_resolutions(tables.rsg, coordinates=coordinates)


def _candidates_all_res(tables: TableSet) -> DataFrame:
    return inter_body_candidates(tables, _tagged(tables, INTEGER), ScoreFn.PESSIMISTIC)


def _candidates_32(tables: TableSet) -> DataFrame:
    edges = E.flatten_edges(tables.rsg[NM32], NM32)
    return inter_body_candidates(tables, edges, ScoreFn.OPTIMISTIC)


def _stored_16(tables: TableSet) -> DataFrame:
    edges = E.flatten_edges(tables.rsg[NM16], NM16, STORED)
    return E.with_score(edges, ScoreFn.OPTIMISTIC)


def _thresholds(attribute: str, bounds: Bounds):
    return lambda t: filters.within(enriched_edges(t), attribute, bounds).select(*EDGE_COLUMNS)


# Queries that need the bound tables only.
_ON_TABLES: dict[str, Callable[[TableSet], DataFrame]] = {
    "scan_edges": scan_edges,
    "scan_edges_all_res": lambda t: _tagged(t, INTEGER),
    "flatten_edges": lambda t: E.flatten_edges(t.rsg[NM8], NM8, STORED),
    "scale_coords_pow2": lambda t: _tagged(t, FLOAT),
    "scale_coords_res": lambda t: _tagged(t, INTEGER),
    "score_greatest": lambda t: scored_edges(t).select(
        "sv_a", "sv_b", "score_ab", "score_ba", "score"
    ),
    "score_least": lambda t: E.with_score(
        E.flatten_edges(t.rsg[NM8], NM8), ScoreFn.PESSIMISTIC
    ).select("sv_a", "sv_b", "score_ab", "score_ba", "score"),
    "box_end": lambda t: sv_boxes(t.objinfo),
    "map_bodies": mapped_edges,
    "valid_edges": lambda t: E.valid_edges(scored_edges(t), t.objinfo),
    "drop_self_edges": lambda t: E.drop_self_edges(scored_edges(t)),
    "edges_inter": lambda t: E.edges_inter(mapped_edges(t)),
    "edges_intra": lambda t: E.edges_intra(mapped_edges(t)),
    "body_dimension": body_dimension,
    "sv_dimension": sv_dimension,
    "enrich_edges": lambda t: enriched_edges(t).select(*EDGE_COLUMNS),
    "exclude_isolated": lambda t: filters.exclude_isolated(scored_edges(t), t.isolated),
    "exclude_mutual": lambda t: filters.exclude_mutual(mapped_edges(t), t.separate),
    "mask_filter": lambda t: filters.in_neuropil(enriched_edges(t)).select(*EDGE_COLUMNS),
    "thr_score": lambda t: filters.within_scores(
        scored_edges(t), Bounds(0.1, 0.9, 0.5, 0.7, whole_numbers=False)
    ),
    "thr_body_tbars": _thresholds("body_tbars", Bounds(20, 90, 50, 70)),
    "thr_sv_tbars": _thresholds("sv_tbars", Bounds(2, 17, 8, 12)),
    "thr_body_size": _thresholds("body_size", Bounds(2e7, 9.5e7, 6e7, 8e7)),
    "thr_sv_size": _thresholds("sv_size", Bounds(1e6, 1.9e7, 5e6, 1.5e7)),
    "best_contact_per_pair": lambda t: ranking.best_contact_per_pair(scored_edges(t)),
    "dedup_raw_edges": lambda t: ranking.best_contact_per_pair(_stored_16(t)),
    "side_ranks": lambda t: ranking.side_ranks(_candidates_all_res(t)),
    "topn_per_body": lambda t: ranking.top_n_per_body(_candidates_all_res(t), 10),
    "best_per_body": lambda t: ranking.top_n_per_body(_candidates_32(t), 1),
    "edge_query_inter": lambda t: edge_query(t, NM8),
    "edge_query_intra": lambda t: edge_query(
        t, NM8, INTRA_CRITERIA, order_by=ordering.by_min_sv_tbars()
    ),
    "intra_all_res": lambda t: edge_query_resolutions(t, INTRA_CRITERIA),
    "edge_query_inter_split": lambda t: edge_query(t, NM8, skew=_split(t)),
    "best_edges_all_res": best_edges_all_res,
    "best_edges_all_res_split": lambda t: best_edges_all_res(t, skew=_split(t)),
    "best_edges_all_res_without_side_ranks": lambda t: best_edges_all_res(
        t, with_side_ranks=False
    ),
    "best_edges_all_res_mask_b_from_a": lambda t: best_edges_all_res(t, mask_b_from_a=True),
    "best_edges_one_res": best_edges_one_res,
    "best_edges_one_res_mask_b_from_a": lambda t: best_edges_one_res(
        t, mask_b_from_a=True, drop_ranked_body=True
    ),
    "sort_min_sv_tbars": lambda t: ranking.with_position(
        edge_query(t, NM8), ordering.by_min_sv_tbars()
    ),
    "sort_body_tbars": lambda t: ranking.with_position(
        edge_query(t, NM8), ordering.by_body_tbars()
    ),
    "adhoc_sql": lambda t: run_sql(
        t,
        "SELECT m.max_mask, count(*) AS n_edges, "
        "max(r.eval.from_a.segment_b_consistency) AS best_score_ab "
        "FROM {rsg8} r JOIN {mask} m ON m.obj_id = r.label_a GROUP BY m.max_mask",
    ),
}


def _split(tables: TableSet):
    """Hot keys as in a cluster of few tasks, where the suppliers are hubs."""
    return measure_skew(tables, tasks=SPLIT_TASKS, with_ends=True)


def extract_listed_pairs_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = pair_list(spark, sf_dir)
    hot = find_hot_keys(listed, "sv_a", "sv_b", tasks=SPLIT_TASKS)
    return extract_pairs(fixture_tables(spark, sf_dir), listed, hot=hot)


def match_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir)
    return pairs.match_pairs(_stored_16(tables), pair_list(spark, sf_dir))


def extract_listed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pairs(fixture_tables(spark, sf_dir), pair_list(spark, sf_dir))


def extract_pairs_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction from an edge table with a column the library does not know."""
    tables = fixture_tables(spark, sf_dir)
    area = F.col("eval.from_a.origin.x") * 3 + F.col("point.z")
    edges = tables.rsg[NM16].withColumn("contact area", area)
    wide = dataclasses.replace(tables, rsg={**tables.rsg, NM16: edges})
    found = extract_pairs(wide, pair_list(spark, sf_dir), all_columns=True)
    flat = [f"{field} AS {name}" for name, field in (E.SCORE_FIELDS | E.COORDINATE_FIELDS).items()]
    return found.selectExpr("* EXCEPT (eval, point, `contact area`)", "`contact area` AS contact_area", *flat)


def _exported(spark: SparkSession, sf_dir: str, format: str) -> DataFrame:
    df = edge_query(fixture_tables(spark, sf_dir), NM8, order_by=ordering.by_body_tbars())
    folder = shared_folder(spark)
    write_results(df, folder, format, parameters=EdgeCriteria().as_parameters())
    return read_results(spark, folder, df)


def export_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in a global order, as the stored files tell them."""
    df = edge_query(fixture_tables(spark, sf_dir), NM8, order_by=ordering.by_body_tbars())
    folder = shared_folder(spark)
    write_results(df, folder, in_order=True)
    return read_in_order(spark, folder, df)


def export_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of an ordered export, from the files that hold them."""
    df = edge_query(fixture_tables(spark, sf_dir), NM8, order_by=ordering.by_body_tbars())
    folder = shared_folder(spark)
    run = write_results(df, folder, in_order=True)
    return preview(spark, folder, df).withColumn("n_rows", F.lit(run.n_rows).cast("long"))


def export_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two results written to one folder."""
    tables = fixture_tables(spark, sf_dir)
    folder = shared_folder(spark)
    write_results(best_edges_one_res(tables), folder)
    df = edge_query(tables, NM8)
    write_results(df, folder, overwrite=True)
    return read_results(spark, folder, df)


def batch_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch wrote, one resolution in a first call and the others in a second."""
    tables = fixture_tables(spark, sf_dir)
    folder = shared_folder(spark)
    export_batch(tables, folder, INTRA_CRITERIA, [NM16])
    outputs = export_batch(tables, folder, INTRA_CRITERIA)
    like = edge_query(tables, NM8, INTRA_CRITERIA)
    per_res = [
        read_results(spark, output.folder, like).withColumns(
            {"res": F.lit(int(res)), "resumed": F.lit(output.skipped)}
        )
        for res, output in outputs.items()
    ]
    return reduce(DataFrame.unionByName, per_res)


def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = summarize(_exported(spark, sf_dir, "parquet"), ordering.by_body_tbars())
    return summary.first_rows.withColumn("n_rows", F.lit(summary.n_rows).cast("long"))


def export_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provenance record of an export over the given tables, read back from storage."""
    tables = fixture_tables(spark, sf_dir)
    df = edge_query_resolutions(tables, INTRA_CRITERIA)
    folder = shared_folder(spark)
    run = write_results(
        df, folder, partition_by=["res"], parameters=INTRA_CRITERIA.as_parameters()
    )
    record = read_provenance(spark, folder).select("parameters.*", "plan")
    # Plans hold generated ids and file paths: report only that one was stored.
    return record.selectExpr("* EXCEPT (plan)", "length(plan) > 0 AS plan", f"{run.n_rows}L AS n_rows")


def export_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table that an export read, as recorded beside its results."""
    tables = fixture_tables(spark, sf_dir)
    folder = shared_folder(spark)
    found = best_edges_one_res(tables)
    write_results(found, folder, inputs=input_identity(tables, [NM32]))
    inputs = read_inputs(spark, folder)
    # Paths differ from machine to machine: report the names of the files.
    names = "array_join(array_sort(transform(files, f -> element_at(split(f.path, '/'), -1))), ' ')"
    return inputs.selectExpr("table AS table_name", "n_rows", f"{names} AS files")


def queries() -> dict[str, Query]:
    def on_tables(build: Callable[[TableSet], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(fixture_tables(spark, sf_dir))

    return {
        **{name: on_tables(build) for name, build in _ON_TABLES.items()},
        "match_pairs": match_pairs,
        "extract_pairs": extract_listed_pairs,
        "extract_pairs_split": extract_listed_pairs_split,
        "export_roundtrip": lambda spark, sf_dir: _exported(spark, sf_dir, "parquet"),
        "export_csv_roundtrip": lambda spark, sf_dir: _exported(spark, sf_dir, "csv"),
        "extract_pairs_all_columns": extract_pairs_all_columns,
        "export_overwrite": export_overwrite,
        "export_in_order": export_in_order,
        "export_preview": export_preview,
        "batch_export": batch_export,
        "export_inputs": export_inputs,
        "export_summary": export_summary,
        "export_provenance": export_provenance,
    }
