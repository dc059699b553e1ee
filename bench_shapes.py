"""Compare plan shapes: what the library does against the obvious alternative.

- ``dimension``: attributes gathered per supervoxel and joined twice, one-end criteria
  applied before the join; against ``per_table``: every lookup joined to the edges.
- ``one_stage``: both ends of an edge ranked in one window; against ``two_stages``: each
  side ranked and cut, then ranked again together.
"""

from __future__ import annotations

import json
import os
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bench import median_seconds, session, store_tables
from edgelens import EdgeCriteria, ScoreFn, TableSet, edge_query
from edgelens.operators import edges as E
from edgelens.operators import ranking
from edgelens.operators.dimensions import BODY_BOX, sv_boxes
from edgelens.operators.filters import all_criteria
from edgelens.plans.best_edges import inter_body_candidates
from edgelens.plans.edge_query import EDGE_COLUMNS


def per_table(tables: TableSet, res: int) -> DataFrame:
    edges = E.with_score(E.flatten_edges(tables.rsg[res], res), ScoreFn.OPTIMISTIC)
    edges = E.edges_inter(E.map_bodies(E.valid_edges(edges, tables.objinfo), tables.agglo))
    boxes = [f"{name.removeprefix('body_')} AS {name}" for name in BODY_BOX]
    lookups = {
        "sv": [
            sv_boxes(tables.objinfo).withColumnRenamed("sv", "_key"),
            tables.mask.selectExpr("obj_id AS _key", "max_mask AS sv_mask"),
            tables.sv_tbars.selectExpr("sv AS _key", "tbar_count AS sv_tbars"),
            tables.isolated.distinct().selectExpr("sv AS _key", "true AS is_isolated"),
        ],
        "body": [
            tables.body_sizes.selectExpr("body AS _key", "body_size", *boxes),
            tables.body_tbars.selectExpr("body AS _key", "tbar_count AS body_tbars"),
            tables.separate.distinct().selectExpr("body AS _key", "true AS is_separate"),
        ],
    }
    for side in ("a", "b"):
        for key, frames in lookups.items():
            for frame in frames:
                names = [c for c in frame.columns if c != "_key"]
                end = frame.selectExpr("_key", *(f"{c} AS {c}_{side}" for c in names))
                edges = edges.join(end, F.col(f"{key}_{side}") == end["_key"], "left").drop("_key")
    flags = [f"is_{name}_{side}" for name in ("isolated", "separate") for side in ("a", "b")]
    kept = edges.fillna(False, flags).where(all_criteria(EdgeCriteria()))
    return ranking.best_contact_per_pair(kept).select(*EDGE_COLUMNS, "rownum")


def candidates(tables: TableSet) -> DataFrame:
    return inter_body_candidates(tables, E.union_resolutions(tables.rsg), ScoreFn.PESSIMISTIC)


def two_stages(tables: TableSet, n: int) -> DataFrame:
    sides = ranking.side_ranks(candidates(tables))
    picked = [
        sides.where(f"rank_{s} <= {n}").withColumn("ranked_body", F.col(f"body_{s}")) for s in "ab"
    ]
    both = picked[0].unionAll(picked[1])
    ranked = ranking.rank_within(both, "ranked_body", ranking.best_first(both), "rank", True)
    return ranked.where(f"rank <= {n}")


def main() -> None:
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    tables, _ = store_tables(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    shapes = {
        "dimension": partial(edge_query, tables, 8),
        "per_table": partial(per_table, tables, 8),
        "one_stage": lambda: ranking.top_n_per_body(candidates(tables), 10),
        "two_stages": partial(two_stages, tables, 10),
    }
    counts = {name: build().count() for name, build in shapes.items()}
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    seconds = {name: round(median_seconds(build, runs), 3) for name, build in shapes.items()}
    print(json.dumps({"seconds": seconds, "rows": counts}))
    spark.stop()


if __name__ == "__main__":
    main()
