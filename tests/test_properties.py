"""Relations between results that hold whatever the data."""

import pytest
from compare import difference_between
from pyspark.sql import functions as F

from edgelens import EdgeCriteria, ScoreFn, edge_query
from edgelens.fixtures.registry import INTRA_CRITERIA
from edgelens.operators import edges as E
from edgelens.operators import ranking
from edgelens.operators.dimensions import enrich_edges, sv_dimension
from edgelens.operators.filters import all_criteria


@pytest.fixture(scope="module")
def mapped(tables):
    edges = E.with_score(E.flatten_edges(tables.rsg[8], 8), ScoreFn.OPTIMISTIC)
    return E.map_bodies(edges, tables.agglo).persist()


def test_every_edge_is_of_one_type_or_a_self_edge(mapped):
    parts = [E.edges_inter(mapped), E.edges_intra(mapped), mapped.where("sv_a = sv_b")]
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2])
    assert difference_between(whole, mapped) is None


def test_one_stage_ranking_equals_two_stages(mapped):
    inter = E.edges_inter(mapped)
    order = ranking.best_first(inter)
    for n in (1, 10):
        sides = ranking.side_ranks(inter)
        picked = sides.where(f"rank_a <= {n}").withColumn("ranked_body", F.col("body_a")).unionAll(
            sides.where(f"rank_b <= {n}").withColumn("ranked_body", F.col("body_b"))
        )
        again = ranking.rank_within(picked, "ranked_body", order, "rank")
        two_stages = again.where(f"rank <= {n}").drop("rank_a", "rank_b")
        assert difference_between(ranking.top_n_per_body(inter, n), two_stages) is None


def test_each_body_and_rank_occurs_once(mapped):
    top = ranking.top_n_per_body(E.edges_inter(mapped), 10)
    assert top.groupBy("ranked_body", "rank").count().where("count > 1").count() == 0
    assert top.agg(F.max("rank")).first()[0] == 10


def test_reversing_every_edge_swaps_the_sides(tables):
    swapped = tables.rsg[8].selectExpr(
        "label_b AS label_a",
        "label_a AS label_b",
        "struct(struct(eval.from_b.segment_a_consistency AS segment_b_consistency, "
        "eval.from_b.origin AS origin) AS from_a, "
        "struct(eval.from_a.segment_b_consistency AS segment_a_consistency, "
        "eval.from_a.origin AS origin) AS from_b) AS eval",
        "point",
    )
    dimension = sv_dimension(tables)
    there = enrich_edges(E.flatten_edges(tables.rsg[8], 8), dimension)
    back = enrich_edges(E.flatten_edges(swapped, 8), dimension)
    other = {"_a": "_b", "_b": "_a"}
    names = {"score_ab": "score_ba", "score_ba": "score_ab"}
    names |= {f"{axis}{s}": f"{axis}{o}" for axis in "xyz" for s, o in ("ab", "ba")}
    renamed = [
        F.col(c).alias(names.get(c) or (c[:-2] + other[c[-2:]] if c[-2:] in other else c))
        for c in back.columns
    ]
    assert difference_between(back.select(*renamed).select(*there.columns), there) is None


TIGHTER = [
    {"min_two_way_score": 0.3},
    {"max_two_way_score": 0.6},
    {"min_one_way_score": 0.9},
    {"max_one_way_score": 0.2},
    {"min_body_tbars_both": 30},
    {"max_body_tbars_either": 30},
    {"min_sv_tbars_either": 15},
    {"max_sv_tbars_both": 12},
    {"min_sv_size_both": 1e6},
    {"max_sv_size_either": 2e6},
    {"min_body_size_either": 9e7},
    {"max_body_size_both": 8e7},
]


def test_tighter_bounds_never_add_edges(tables):
    edges = E.with_score(E.flatten_edges(tables.rsg[8], 8), ScoreFn.OPTIMISTIC)
    enriched = enrich_edges(edges, sv_dimension(tables))
    loose = F.expr(all_criteria(EdgeCriteria()))
    checks = [F.expr(all_criteria(EdgeCriteria(**bounds))) for bounds in TIGHTER]
    counts = enriched.agg(
        F.count_if(loose).alias("loose"),
        *(F.count_if(tight).alias(f"t{i}") for i, tight in enumerate(checks)),
        *(F.count_if(tight & ~F.coalesce(loose, F.lit(False))).alias(f"added{i}")
          for i, tight in enumerate(checks)),
    ).first().asDict()
    for i, bounds in enumerate(TIGHTER):
        assert 0 < counts[f"t{i}"] < counts["loose"], bounds
        assert counts[f"added{i}"] == 0, bounds


def test_endpoint_filter_and_edge_filter_agree(tables):
    """The criteria split between dimension and edges select what the whole test selects."""
    criteria = EdgeCriteria(
        min_sv_size_both=1e6, min_body_size_either=5e7, min_body_tbars_both=2,
        max_sv_tbars_either=12, min_one_way_score=0.4,
    )
    edges = E.with_score(E.flatten_edges(tables.rsg[8], 8), ScoreFn.OPTIMISTIC)
    enriched = enrich_edges(edges, sv_dimension(tables)).where(all_criteria(criteria))
    whole = ranking.best_contact_per_pair(E.edges_inter(enriched))
    split = edge_query(tables, 8, criteria)
    assert difference_between(split, whole.select(*split.columns)) is None


def test_batch_of_resolutions_is_the_queries_one_by_one(tables):
    from edgelens import edge_query_resolutions

    batch = edge_query_resolutions(tables, INTRA_CRITERIA.replace(min_body_size_either=0))
    for res in (8, 16, 32):
        alone = edge_query(tables, res, INTRA_CRITERIA.replace(min_body_size_either=0))
        of_batch = batch.where(f"res = {res}").drop("res")
        a, b = sorted(map(tuple, alone.collect())), sorted(map(tuple, of_batch.collect()))
        assert a == b
