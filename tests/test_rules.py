"""Hand-made cases for the rules that decide which edges are returned."""

import dataclasses

import pytest
from tiny import contact, frame, pairs_of, tiny_tables

from edgelens import (
    EdgeCriteria,
    best_edges_all_res,
    best_edges_one_res,
    edge_query,
    extract_pairs,
)
from edgelens.operators.edges import Coordinates, flatten_edges
from edgelens.operators.ordering import ordered
from edgelens.operators.pair_filter import MOST_BUCKETS, buckets_for, may_be_wanted
from edgelens.sources.schema import PAIR_LIST

NAN = float("nan")
INTRA = EdgeCriteria(edge_type="intra-body")


def test_default_query_keeps_a_good_edge(spark):
    assert pairs_of(edge_query(tiny_tables(spark, [contact(1, 2)]), 8)) == [(1, 2)]


def test_both_orientations_of_a_pair_stay_apart(spark):
    tables = tiny_tables(spark, [contact(1, 2), contact(2, 1)])
    assert pairs_of(edge_query(tables, 8)) == [(1, 2), (2, 1)]


def test_null_and_nan_scores_are_rejected(spark):
    contacts = [contact(1, 2, ab=None), contact(3, 4, ba=NAN), contact(5, 6)]
    assert pairs_of(edge_query(tiny_tables(spark, contacts), 8)) == [(5, 6)]
    unbounded = EdgeCriteria(max_two_way_score=float("inf"), max_one_way_score=float("inf"))
    assert pairs_of(edge_query(tiny_tables(spark, contacts), 8, unbounded)) == [(5, 6)]


def test_nan_score_is_flattened_to_null(spark):
    rsg = tiny_tables(spark, [contact(1, 2, ab=NAN)]).rsg[8]
    assert flatten_edges(rsg, 8).first().score_ab is None


def test_bounds_are_inclusive(spark):
    contacts = [contact(1, 2, 0.3, 0.7), contact(3, 4, 0.29, 0.7), contact(5, 6, 0.3, 0.71)]
    criteria = EdgeCriteria(min_two_way_score=0.3, max_two_way_score=0.7)
    assert pairs_of(edge_query(tiny_tables(spark, contacts), 8, criteria)) == [(1, 2)]


def test_one_way_bounds_may_hold_at_different_ends(spark):
    contacts = [contact(1, 2, 0.9, 0.1), contact(3, 4, 0.5, 0.5)]
    criteria = EdgeCriteria(min_one_way_score=0.8, max_one_way_score=0.2)
    assert pairs_of(edge_query(tiny_tables(spark, contacts), 8, criteria)) == [(1, 2)]


def test_default_criteria_need_every_attribute(spark):
    gaps = {1: "classes", 2: "sizes", 3: "sv_tbars", 4: "body_tbars", 5: "body_sizes"}
    contacts = [contact(sv, 9) for sv in gaps] + [contact(9, sv) for sv in gaps]
    missing = {table: {sv: None} for sv, table in gaps.items()}
    tables = tiny_tables(spark, [*contacts, contact(6, 9)], **missing)
    assert pairs_of(edge_query(tables, 8)) == [(6, 9)]


def test_both_ends_must_be_neuropil(spark):
    contacts = [contact(a, b) for sv in (1, 2, 3, 4) for a, b in ((sv, 9), (9, sv))]
    tables = tiny_tables(
        spark, [*contacts, contact(6, 9)], classes={sv: sv for sv in (1, 2, 3, 4)}
    )
    assert pairs_of(edge_query(tables, 8)) == [(6, 9)]


def test_isolated_supervoxels_have_no_edges(spark):
    tables = tiny_tables(spark, [contact(1, 2), contact(2, 1), contact(3, 4)], isolated=[1, 1])
    assert pairs_of(edge_query(tables, 8)) == [(3, 4)]


def test_only_edges_within_the_exclusive_set_are_dropped(spark):
    contacts = [contact(1, 2), contact(1, 3), contact(3, 4)]
    tables = tiny_tables(spark, contacts, separate=[1, 2, 2, 2])
    assert pairs_of(edge_query(tables, 8)) == [(1, 3), (3, 4)]


def test_exclusive_body_has_no_intra_body_edges(spark):
    tables = tiny_tables(
        spark, [contact(2, 3), contact(4, 5)], bodies={2: 1, 3: 1, 4: 6, 5: 6}, separate=[1]
    )
    assert pairs_of(edge_query(tables, 8, INTRA)) == [(4, 5)]


def test_edge_types(spark):
    # 1 is its own body, without a row in the map
    contacts = [contact(1, 2), contact(2, 3), contact(3, 3), contact(3, 4)]
    tables = tiny_tables(spark, contacts, bodies={2: 1, 3: 1})
    assert pairs_of(edge_query(tables, 8)) == [(3, 4)]
    assert pairs_of(edge_query(tables, 8, INTRA)) == [(1, 2), (2, 3)]


def test_best_contact_that_passes_represents_its_pair(spark):
    contacts = [contact(1, 2, 0.9, 0.9, at=1), contact(1, 2, 0.6, 0.4, at=2), contact(1, 2, at=3)]
    tables = tiny_tables(spark, contacts)
    assert edge_query(tables, 8).first().xa == 1.0
    criteria = EdgeCriteria(max_two_way_score=0.8)
    row = edge_query(tables, 8, criteria).first()
    assert (row.xa, row.score, row.rownum) == (2.0, 0.6, 1)


def test_equal_scores_are_settled_by_the_tie_break(spark):
    contacts = [contact(1, 2, at=at) for at in (7, 3, 5)]
    for order in (contacts, contacts[::-1]):
        assert edge_query(tiny_tables(spark, order), 8).first().xa == 3.0


def test_coordinates_by_resolution(spark):
    tables = tiny_tables(spark, {32: [contact(1, 2, at=3)], 16: [contact(1, 2, at=3)]})
    assert edge_query(tables, 32).first().xa == 12.0
    assert flatten_edges(tables.rsg[16], 16, Coordinates.INTEGER).first().xa == 6
    assert flatten_edges(tables.rsg[16], 16, Coordinates.STORED).first().xa == 3


def test_no_promotion_when_the_best_edge_fails(spark):
    # 2 is the best partner of 1 but not neuropil; its own best partner is 1 as well
    contacts = [contact(1, 2, 0.9, 0.9), contact(1, 3, 0.5, 0.5)]
    tables = tiny_tables(spark, {32: contacts}, classes={2: 3})
    rows = best_edges_one_res(tables).collect()
    assert [(r.ranked_body, r.sv_a, r.sv_b) for r in rows] == [(3, 1, 3)]


def test_edge_best_for_both_bodies_is_returned_for_each(spark):
    tables = tiny_tables(spark, {32: [contact(1, 2)]})
    assert sorted(r.ranked_body for r in best_edges_one_res(tables).collect()) == [1, 2]
    assert best_edges_one_res(tables, drop_ranked_body=True).count() == 2


def test_repeated_exclusive_bodies_do_not_multiply_edges(spark):
    tables = tiny_tables(spark, {32: [contact(1, 2)]}, separate=[1, 1, 1])
    assert best_edges_one_res(tables).count() == 2


def test_repeated_contacts_do_not_multiply_best_edges(spark):
    tables = tiny_tables(spark, {32: [contact(1, 2, at=1), contact(1, 2, 0.6, 0.7, at=2)]})
    rows = best_edges_one_res(tables).collect()
    assert [(r.score, r.score_ab, r.xa) for r in rows] == [(0.7, 0.6, 8.0)] * 2


def test_class_of_the_b_end(spark):
    tables = tiny_tables(spark, {32: [contact(1, 2), contact(4, 3)]}, classes={2: 3, 4: 3})
    assert best_edges_one_res(tables).count() == 0
    compatible = best_edges_one_res(tables, mask_b_from_a=True).collect()
    assert {(r.sv_a, r.sv_mask_a, r.sv_mask_b) for r in compatible} == {(1, 5, 5)}


def test_best_edges_use_lower_score_over_all_resolutions(spark):
    contacts = {
        32: [contact(1, 2, 1.0, 0.1)],
        16: [contact(1, 3, 0.6, 0.5)],
        8: [contact(1, 3, 0.4, 0.4, at=5)],
    }
    rows = best_edges_all_res(tiny_tables(spark, contacts), n=2).where("ranked_body = 1")
    found = [(r["rank"], r.res, r.sv_b, r.score) for r in rows.orderBy("rank").collect()]
    assert found == [(1, 16, 3, 0.5), (2, 8, 3, 0.4)]


def test_side_ranks_count_all_edges_of_a_side(spark):
    scores = {2: 0.9, 3: 0.8, 4: 0.7}
    contacts = [contact(1, b, s, s) for b, s in scores.items()] + [contact(5, 4, 0.95, 0.95)]
    rows = best_edges_all_res(tiny_tables(spark, {8: contacts}), n=1, resolutions=[8]).collect()
    ranks = {(r.ranked_body, r.sv_a, r.sv_b): (r["rank"], r.rank_a, r.rank_b) for r in rows}
    assert ranks == {
        (1, 1, 2): (1, 1, 1),
        (2, 1, 2): (1, 1, 1),
        (3, 1, 3): (1, 2, 1),
        (4, 5, 4): (1, 1, 1),
        (5, 5, 4): (1, 1, 1),
    }


def test_body_below_two_tbars_is_not_worth_a_review(spark):
    tables = tiny_tables(spark, {32: [contact(1, 2), contact(3, 4)]}, body_tbars={1: 1, 3: 2})
    assert {r.sv_a for r in best_edges_one_res(tables).collect()} == {3}


def listed(spark, *pairs):
    return frame(spark, pairs, PAIR_LIST)


def test_pairs_are_found_in_either_orientation(spark):
    contacts = {16: [contact(1, 2), contact(4, 3), contact(5, 6), contact(7, 7)]}
    found = extract_pairs(tiny_tables(spark, contacts), listed(spark, (1, 2), (3, 4), (7, 7)))
    assert pairs_of(found) == [(1, 2), (4, 3)]


def test_pair_listed_both_ways_is_returned_per_request(spark):
    tables = tiny_tables(spark, {16: [contact(1, 2), contact(2, 1)]})
    found = extract_pairs(tables, listed(spark, (1, 2), (2, 1)))
    assert pairs_of(found) == [(1, 2), (1, 2), (2, 1), (2, 1)]


def test_extracted_contact_is_the_best_of_its_pair(spark):
    contacts = [contact(1, 2, 0.2, 0.3, at=1), contact(1, 2, 0.9, 0.1, at=2)]
    row = extract_pairs(tiny_tables(spark, {16: contacts}), listed(spark, (1, 2))).first()
    assert (row.score, row.xa, row.rownum) == (0.9, 2, 1)


def test_extracted_supervoxels_exceed_the_size(spark):
    contacts = {16: [contact(1, 2), contact(3, 4)]}
    tables = tiny_tables(spark, contacts, sizes={1: 1_000_000, 3: 1_000_001})
    assert pairs_of(extract_pairs(tables, listed(spark, (1, 2), (3, 4)))) == [(3, 4)]


def test_extracted_contact_can_stay_nested(spark):
    tables = tiny_tables(spark, {16: [contact(1, 2, 0.2, None, at=4)]})
    row = extract_pairs(tables, listed(spark, (2, 1)), keep_structs=True).first()
    stored = tables.rsg[16].first()
    assert (row.label_a, row.label_b, row.eval, row.point) == tuple(stored)
    assert row.score is None


def test_stored_columns_are_passed_on_as_they_are(spark):
    tables = tiny_tables(spark, {16: [contact(1, 2, NAN, 0.3, at=4), contact(3, 4, 0.2, None)]})
    more = tables.rsg[16].selectExpr("*", "'x' AS `a.b`", "label_a * 2.5D AS score", "array(label_b) AS seen")
    wide = dataclasses.replace(tables, rsg={16: more})
    rows = {r.sv_a: r for r in extract_pairs(wide, listed(spark, (2, 1), (3, 4)), all_columns=True).collect()}
    stored = {r.label_a: r for r in more.collect()}
    for sv, row in rows.items():
        kept = (row.label_a, row.label_b, row.eval, row.point, row["a.b"], row.stored_score, row.seen)
        assert repr(kept) == repr(tuple(stored[sv]))
    assert repr(rows[1].eval.from_a.segment_b_consistency) == "nan"
    assert rows[1].score is None and rows[3].score is None
    assert "a.b" not in extract_pairs(wide, listed(spark, (1, 2)), keep_structs=True).columns


def test_pair_filter_lets_few_unasked_edges_pass(spark):
    edges = spark.range(200_000).selectExpr("id AS sv_a", "id * 7 % 100003 AS sv_b")
    pairs = edges.where("sv_a % 100 = 0")
    passed = may_be_wanted(edges, pairs, 2000)
    assert pairs.exceptAll(passed).isEmpty()
    assert passed.count() <= 2 * pairs.count()


def test_pair_filter_of_any_size_keeps_what_is_asked(spark):
    edges = spark.range(5000).selectExpr("id AS sv_a", "id * 3 AS sv_b")
    odd = spark.createDataFrame([(None, 1), (2, None)], "sv_a long, sv_b long")
    for n in (0, 1, 17, 5000):
        pairs = edges.where(f"sv_a < {n}").unionAll(odd)
        for told in (0, 1, n, 10**9):
            assert pairs.dropna().exceptAll(may_be_wanted(edges, pairs, told)).isEmpty()
    assert buckets_for(0) == 1 and buckets_for(257) == 2 and buckets_for(10**12) == MOST_BUCKETS


def test_order_as_text(spark):
    contacts = [contact(1, 2), contact(3, 4), contact(5, 6)]
    tables = tiny_tables(spark, contacts, sv_tbars={3: 90, 4: 80})
    text = "least(sv_tbars_a, sv_tbars_b) desc, body_a desc"
    assert [r.sv_a for r in edge_query(tables, 8, order_by=text).collect()] == [3, 5, 1]
    df = edge_query(tables, 8)
    assert ordered(df, "") is df


def test_pair_listed_very_often(spark, monkeypatch):
    monkeypatch.setattr("edgelens.operators.pairs.REQUESTS_PER_ROW", 4)
    tables = tiny_tables(spark, {16: [contact(1, 2), contact(3, 4)]})
    pair_list = listed(spark, *[(1, 2)] * 9, *[(4, 3)] * 4, *[(2, 1)] * 2)
    for order in ((), "sv_a desc", None):
        found = extract_pairs(tables, pair_list, order_by=order)
        assert pairs_of(found) == [(1, 2)] * 11 + [(3, 4)] * 4
    assert [r.sv_a for r in extract_pairs(tables, pair_list, order_by="sv_a desc").collect()] == (
        [3] * 4 + [1] * 11
    )


@pytest.mark.parametrize(
    "name", ["objinfo", "mask", "sv_tbars", "agglo", "body_sizes", "body_tbars"]
)
def test_a_repeated_lookup_key_is_an_error(spark, name):
    tables = tiny_tables(spark, [contact(1, 2)], bodies={1: 5, 2: 6})
    table = getattr(tables, name)
    doubled = dataclasses.replace(tables, **{name: table.unionAll(table)})
    with pytest.raises(Exception, match="repeats a key"):
        edge_query(doubled, 8).collect()
    with pytest.raises(ValueError, match=name):
        doubled.check_keys()
