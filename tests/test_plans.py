"""The physical plans that carry the queries at scale."""

import re
import sys

import pytest

from edgelens import (
    EdgeCriteria,
    EdgeType,
    SkewProfile,
    best_edges_all_res,
    best_edges_one_res,
    edge_query,
    edge_query_resolutions,
    extract_pairs,
)
from edgelens.functions import ScoreFn
from edgelens.operators.dimensions import sv_bodies, sv_dimension
from edgelens.operators.filters import exclude_isolated
from edgelens.operators.edges import flatten_edges, with_score
from edgelens.operators.pairs import best_contact_of_wanted
from edgelens.operators.skew import HotKeys
from edgelens.sources.export import plan_text


def operators(df):
    """Names of the physical operators, as often as they occur."""
    return operators_in(plan_text(df))


def operators_in(text):
    tree = text.split("\n\n")[0]
    return re.findall(r"^[\s:|+*\-]*(?:\(\d+\) )?([A-Z]\w+)", tree.replace("* ", ""), re.MULTILINE)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


QUERIES = {
    "inter": lambda t: edge_query(t, 8),
    "all": lambda t: best_edges_all_res(t, with_side_ranks=False),
    "one": lambda t: best_edges_one_res(t),
    "pairs": lambda t: extract_pairs(t, t.rsg[16].selectExpr("label_a AS sv_a", "label_b AS sv_b")),
}


@pytest.mark.parametrize("name", QUERIES)
def test_no_products_and_no_python(tables, shuffled, name):
    found = operators(QUERIES[name](tables))
    assert found.count("SortMergeJoin") >= 2
    assert not {"CartesianProduct", "BroadcastNestedLoopJoin"} & set(found)
    assert not [o for o in found if "Python" in o or "Pandas" in o or "Arrow" in o]


@pytest.mark.parametrize("name", QUERIES)
def test_no_window_without_partitions(tables, shuffled, name):
    assert "SinglePartition" not in plan_text(QUERIES[name](tables))


def test_boxes_of_intra_body_edges_come_after_the_best_contact(tables, monkeypatch):
    module = sys.modules["edgelens.plans.edge_query"]
    seen, real = [], module.best_contact_per_pair
    monkeypatch.setattr(module, "best_contact_per_pair", lambda df: seen.append(df.columns) or real(df))
    edge_query(tables, 8, EdgeCriteria(edge_type=EdgeType.INTRA_BODY))
    assert not [c for c in seen[0] if "box" in c]


def test_no_plan_stores_anything_on_the_way(tables, monkeypatch):
    monkeypatch.setattr("edgelens.operators.ranking.freeze", lambda df: pytest.fail("stored"))
    best_edges_all_res(tables)
    best_edges_one_res(tables)
    edge_query(tables, 8)


def test_large_dimension_joins_shuffle_the_edges_once_per_side(tables, shuffled):
    text = plan_text(edge_query(tables, 8))
    edge_shuffles = re.findall(r"Arguments: hashpartitioning\((sv_[ab])#\d+L?, ", text)
    assert sorted(edge_shuffles) == ["sv_a", "sv_b"]
    # the pair window rides on the last of them
    assert "hashpartitioning(sv_a#" in text and "hashpartitioning(sv_a, sv_b" not in text


def test_hot_keys_give_the_pair_window_a_shuffle_of_its_own(tables, shuffled):
    hot = SkewProfile(HotKeys({1: 4}))
    found = operators(edge_query(tables, 8, skew=hot))
    assert found.count("WindowGroupLimit") == 2


def test_ranking_cuts_each_task_before_its_only_shuffle(tables, shuffled):
    text = plan_text(best_edges_all_res(tables, with_side_ranks=False))
    found = operators(best_edges_all_res(tables, with_side_ranks=False))
    assert found.count("WindowGroupLimit") == 2
    assert text.count("hashpartitioning(ranked_body") == 1


def test_dimension_shuffle_is_shared_by_both_sides(tables, shuffled):
    assert "ReusedExchange" in final_plan(edge_query(tables, 8))


def test_scores_and_endpoint_bounds_reach_the_scan(tables, shuffled):
    criteria = EdgeCriteria(min_two_way_score=0.2, min_sv_size_both=1e6, min_body_tbars_both=3)
    text = plan_text(edge_query(tables, 8, criteria))
    pushed = "\n".join(re.findall(r"PushedFilters: .*", text))
    for wanted in (
        "GreaterThanOrEqual(eval.from_a.segment_b_consistency,0.2)",
        "GreaterThanOrEqual(eval.from_b.segment_a_consistency,0.2)",
        "GreaterThanOrEqual(num_voxels,1000000)",
        "GreaterThanOrEqual(tbar_count,3)",
        "EqualTo(max_mask,5)",
    ):
        assert wanted in pushed


def test_best_edges_scan_only_scored_contacts(tables):
    text = plan_text(best_edges_one_res(tables))
    assert "IsNotNull(eval.from_a.segment_b_consistency)" in text


def test_nested_columns_are_pruned(tables):
    text = plan_text(flatten_edges(tables.rsg[8], 8).select("sv_a", "score_ab"))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert schema == (
        "struct<label_a:bigint,eval:struct<from_a:struct<segment_b_consistency:double>>>"
    )


def test_side_ranks_add_one_shuffle_of_the_edges(tables, shuffled):
    plain = plan_text(best_edges_all_res(tables, with_side_ranks=False))
    ranked = plan_text(best_edges_all_res(tables))
    assert ranked.count("Location: ") <= 40
    assert ranked.count("hashpartitioning(ranked_body") == 1
    assert len(re.findall(r"hashpartitioning\(_body#\d+L?, _side#\d+, \d+\)", ranked)) == 1
    assert plain.count("hashpartitioning(_body") == 0


def test_edges_of_both_uses_are_shuffled_to_their_bodies_once(tables, shuffled):
    """The ranking and the counting read the same shuffles of the edge tables."""
    df = best_edges_all_res(tables)
    text = final_plan(df)
    assert len(re.findall(r"Reused\w*Exchange|ReusedExchange", text)) >= 3


def test_resolutions_share_one_dimension(tables, shuffled):
    criteria = EdgeCriteria(edge_type=EdgeType.INTRA_BODY)
    one, three = (
        plan_text(edge_query(tables, 8, criteria)),
        plan_text(edge_query_resolutions(tables, criteria)),
    )
    assert three.count("Location: ") == one.count("Location: ") + 2
    assert operators_in(one).count("SortMergeJoin") == operators_in(three).count("SortMergeJoin")


def test_a_dimension_is_checked_without_gathering_its_columns(tables, shuffled):
    text = plan_text(edge_query(tables, 8))
    assert "first(" not in text


def test_unwanted_edges_are_dropped_before_their_shuffle(tables, shuffled):
    listed = tables.rsg[16].selectExpr("label_a AS sv_a", "label_b AS sv_b").limit(5)
    matched = best_contact_of_wanted(flatten_scored(tables), listed, 5)
    tree = plan_text(matched).split("\n\n")[0].splitlines()
    depth = {name: [i for i, line in enumerate(tree) if name in line] for name in ("WindowGroupLimit", "BroadcastHashJoin", "Exchange")}
    window, join = depth["WindowGroupLimit"][-1], depth["BroadcastHashJoin"][0]
    # from the scan up: the filter, the cut within the task, the shuffle, the choice
    assert window < join
    assert not [i for i in depth["Exchange"] if window < i < join]
    assert "PushedFilters: [IsNotNull(label_a), IsNotNull(label_b)" in plan_text(matched)


def flatten_scored(tables):
    return with_score(flatten_edges(tables.rsg[16], 16), ScoreFn.OPTIMISTIC)


def test_isolation_is_an_anti_join(tables, shuffled):
    text = plan_text(exclude_isolated(flatten_edges(tables.rsg[8], 8), tables.isolated))
    assert text.count("Join type: LeftAnti") == 2


def test_node_tables_do_not_pass_through_the_driver(tables):
    """Small files or not: only a whole dimension is broadcast, and only if all of it is small."""
    for df in (sv_dimension(tables), sv_bodies(tables)):
        assert "BroadcastExchange" not in operators(df)
    criteria = EdgeCriteria(edge_type=EdgeType.INTRA_BODY)
    sent = [x for x in operators(edge_query(tables, 8, criteria)) if x == "BroadcastExchange"]
    assert len(sent) <= 2
