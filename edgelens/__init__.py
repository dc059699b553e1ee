"""Find, rank and extract edges of a segmentation adjacency graph with Spark DataFrames."""

from edgelens.functions import Resolution, ScoreFn
from edgelens.parameters import EdgeCriteria, EdgeType, TableNames
from edgelens.plans import (
    EdgeQuery,
    SkewProfile,
    best_edges_all_res,
    best_edges_one_res,
    edge_query,
    edge_query_resolutions,
    export_batch,
    extract_pairs,
    load_skew,
    measure_skew,
    store_skew,
)
from edgelens.sources import TableSet, run_sql

__all__ = [
    "EdgeCriteria",
    "EdgeQuery",
    "EdgeType",
    "Resolution",
    "ScoreFn",
    "SkewProfile",
    "TableNames",
    "TableSet",
    "best_edges_all_res",
    "best_edges_one_res",
    "edge_query",
    "edge_query_resolutions",
    "export_batch",
    "extract_pairs",
    "load_skew",
    "measure_skew",
    "run_sql",
    "store_skew",
]
