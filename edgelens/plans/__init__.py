"""Whole queries."""

from edgelens.plans.batch import export_batch
from edgelens.plans.best_edges import best_edges_all_res, best_edges_one_res
from edgelens.plans.builder import EdgeQuery
from edgelens.plans.edge_query import edge_query, edge_query_resolutions
from edgelens.plans.extract import extract_pairs
from edgelens.plans.skew_profile import SkewProfile, load_skew, measure_skew, store_skew

__all__ = [
    "EdgeQuery",
    "SkewProfile",
    "best_edges_all_res",
    "best_edges_one_res",
    "edge_query",
    "edge_query_resolutions",
    "export_batch",
    "extract_pairs",
    "load_skew",
    "measure_skew",
    "store_skew",
]
