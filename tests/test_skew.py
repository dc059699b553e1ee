"""Hot keys are split, and splitting them changes no result."""

import pytest
from compare import difference_between
from pyspark.sql import Window
from pyspark.sql import functions as F
from tiny import contact, tiny_tables

from edgelens import (
    SkewProfile,
    best_edges_all_res,
    edge_query,
    extract_pairs,
    load_skew,
    measure_skew,
    store_skew,
)
from edgelens.operators import ranking, skew
from edgelens.operators.edges import flatten_edges, map_bodies, valid_edges
from edgelens.operators.skew import HotKeys, deal_rows, find_hot_keys, lookup


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of all rows at key 7, all copies of each other; the rest spread out."""
    copies = spark.range(4000).selectExpr("7L AS k", "1L AS v")
    rest = spark.range(8000).selectExpr("100 + id % 2000 AS k", "id AS v")
    return copies.unionAll(rest)


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(3000).selectExpr("id AS _key", "id * 2 AS double_k")


def test_hot_key_is_found_and_sized(lopsided):
    hot = find_hot_keys(lopsided, "k", tasks=30)
    assert set(hot.parts) == {7}
    assert hot.parts[7] == 10


def test_no_hot_key_in_spread_out_keys(spark):
    assert not find_hot_keys(spark.range(5000).selectExpr("id % 1000 AS k"), "k", tasks=8)


def test_null_keys_are_not_hot_and_no_rows_are_fine(spark):
    nulls = spark.range(100).selectExpr("CAST(NULL AS BIGINT) AS k")
    assert not find_hot_keys(nulls, "k", tasks=8)
    assert not find_hot_keys(nulls.limit(0), "k", tasks=8)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_gives_the_same_rows(lopsided, names, how):
    right = names if how == "left" else names.where("_key < 1500")
    hot = HotKeys({7: 5, 150: 3, 99999: 2})
    plain = lookup(lopsided, right, "k", HotKeys(), how)
    split = lookup(deal_rows(lopsided, hot), right, "k", hot, how).drop(skew.DEAL)
    assert difference_between(split, plain) is None


def test_rows_of_a_hot_key_spread_over_its_parts(lopsided):
    hot = HotKeys({7: 8})
    parts = deal_rows(lopsided, hot).where("k = 7").groupBy(F.pmod(skew.DEAL, F.lit(8))).count()
    sizes = [row["count"] for row in parts.collect()]
    assert len(sizes) == 8
    assert max(sizes) < 2 * min(sizes)


def test_operators_accept_hot_keys(tables, shuffled):
    edges = flatten_edges(tables.rsg[8], 8)
    hot = HotKeys({3: 4, 8: 2})
    dealt = deal_rows(edges, hot)
    for operator, lookup_table in ((map_bodies, tables.agglo), (valid_edges, tables.objinfo)):
        split = operator(dealt, lookup_table, hot).drop(skew.DEAL)
        assert difference_between(split, operator(edges, lookup_table)) is None


# Labels 0 to 9 are the suppliers of the smallest data: each is on a tenth of all edges.
PROFILE = SkewProfile(
    HotKeys({sv: 3 for sv in range(10)}), HotKeys({0: 2, 8: 4}), HotKeys({0: 3, 7: 2})
)


@pytest.mark.parametrize("query", [edge_query, best_edges_all_res])
def test_queries_give_the_same_result_with_hot_keys(tables, shuffled, query):
    arguments = [8] if query is edge_query else []
    split = query(tables, *arguments, skew=PROFILE)
    assert difference_between(split, query(tables, *arguments, skew=SkewProfile())) is None


def test_extraction_gives_the_same_result_with_hot_keys(tables, shuffled):
    listed = tables.rsg[16].selectExpr("label_b AS sv_a", "label_a AS sv_b").distinct()
    split = extract_pairs(tables, listed, hot=PROFILE.supervoxels)
    assert difference_between(split, extract_pairs(tables, listed, hot=HotKeys())) is None


def test_skew_is_measured_when_asked_for(tables):
    # 4 tasks: no label and no body reaches a quarter of the rows
    assert measure_skew(tables, [8], tasks=4) == SkewProfile()
    # the ten suppliers are at one end of every edge
    assert set(measure_skew(tables, [8], tasks=40).supervoxels.parts) == set(range(10))


def test_more_tasks_than_can_be_tracked_are_refused(tables):
    with pytest.raises(ValueError, match="tasks"):
        measure_skew(tables, [8], tasks=200_000)


def test_hub_that_is_best_for_everyone(spark, shuffled):
    contacts = {32: [contact(sv, 1, 0.9, 0.9) for sv in range(2, 40)]}
    tables = tiny_tables(spark, contacts, svs=range(1, 40))
    profile = SkewProfile(HotKeys({1: 5}), HotKeys({1: 3}), HotKeys({1: 4}))
    split = best_edges_all_res(tables, n=2, resolutions=[32], skew=profile)
    plain = best_edges_all_res(tables, n=2, resolutions=[32], skew=SkewProfile())
    assert split.count() == 40
    assert difference_between(split, plain) is None


def _window_rank(df, group, order, name):
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def test_rank_of_a_group_larger_than_a_task(lopsided):
    sliced = ranking.rank_within(lopsided, "k", ["v"], "rank")
    assert difference_between(sliced, _window_rank(lopsided, "k", ["v"], "rank")) is None


def test_large_group_of_copies_spans_slices(spark, lopsided, monkeypatch):
    slices = []

    def spy(df):
        counted = df.where("k = 7").groupBy("_slice").count().collect()
        slices.extend(row["count"] for row in counted)
        return real(df)

    real = ranking.freeze
    monkeypatch.setattr(ranking, "freeze", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.rank_within(deal_rows(lopsided, True), "k", ["v"], "rank")
        ranks = sorted(row["rank"] for row in ranked.where("k = 7").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(slices) > 1
    assert ranks == list(range(1, 4001))


def _scored(tables):
    edges = map_bodies(flatten_edges(tables.rsg[8], 8), tables.agglo)
    return edges.withColumn("score", F.col("score_ab"))


def test_side_ranks_are_those_of_a_window(tables):
    edges = _scored(tables)
    expected = edges
    for side in ("a", "b"):
        order = ranking.best_first(edges)
        expected = _window_rank(expected, f"body_{side}", order, f"rank_{side}")
    assert difference_between(ranking.side_ranks(edges), expected) is None


@pytest.mark.parametrize("parts", [{}, {1: 5, 3: 2}])
def test_side_ranks_of_the_best_count_all_edges(tables, shuffled, parts):
    """Also where a third of all edges are at one body, and where edges are copies."""
    edges = _scored(tables)
    hub = edges.withColumn("body_a", F.expr("IF(pmod(xa, 3D) = 0, 1L, body_a)"))
    edges = hub.unionAll(hub.where("pmod(xa, 7D) = 0"))
    ranked = ranking.top_n_with_side_ranks(deal_rows(edges, bool(parts)), 5, HotKeys(parts))
    best = ranking.top_n_per_body(edges, 5)
    shown = ["ranked_body", "rank", *edges.columns]
    assert difference_between(ranked.select(shown), best.select(shown)) is None
    keys = edges.columns
    every = edges
    for side in ("a", "b"):
        every = _window_rank(every, f"body_{side}", ranking.best_first(edges), f"rank_{side}")
    # of equal edges the ranks follow on each other, whichever has which
    first = every.groupBy(*keys).agg(F.min("rank_a").alias("ra"), F.min("rank_b").alias("rb"))
    got = ranked.groupBy("ranked_body", *keys).agg(F.min("rank_a").alias("ra"), F.min("rank_b").alias("rb"))
    assert got.count() > 0
    assert got.select(*keys, "ra", "rb").distinct().subtract(first.select(*keys, "ra", "rb")).isEmpty()
    copies = ranked.groupBy("ranked_body", *keys).agg(
        F.count("*").alias("n"), F.countDistinct("rank_a").alias("na"), F.countDistinct("rank_b").alias("nb")
    )
    within = copies.where("body_a <> body_b")
    assert within.where("n > 1").count() > 0
    assert within.where("n <> na OR n <> nb").isEmpty()


def test_hot_body_at_one_score_is_spread_over_tasks(spark, shuffled):
    """All edges of a hub have one score, so that no order of scores could split them."""
    contacts = [contact(sv, 1, 0.5, 0.5) for sv in range(2, 402)]
    contacts += [contact(sv, sv + 1, 0.9, 0.9) for sv in range(2, 400, 2)]
    tables = tiny_tables(spark, {8: contacts}, svs=range(1, 402))
    profile = measure_skew(tables, [8], tasks=8, with_ends=True)
    assert set(profile.ends.parts) == {1} and profile.ends.parts[1] >= 4
    split = best_edges_all_res(tables, n=2, resolutions=[8], skew=profile)
    plain = best_edges_all_res(tables, n=2, resolutions=[8])
    assert split.where("rank_b > 300").count() > 0
    assert difference_between(split, plain) is None
    # the parts a window sees are those dealt by the scan
    edges = deal_rows(flatten_edges(tables.rsg[8], 8), True).where("sv_b = 1")
    parts = edges.groupBy(F.pmod(skew.DEAL, F.lit(profile.ends.parts[1]))).count().collect()
    assert max(row["count"] for row in parts) <= 2 * 400 / profile.ends.parts[1]


def test_positions_are_those_of_the_global_order(lopsided):
    placed = ranking.with_position(lopsided, ["k", "v"])
    rows = placed.orderBy("position").collect()
    assert [row.position for row in rows] == list(range(1, 12001))
    assert [(r.k, r.v) for r in rows] == sorted((r.k, r.v) for r in rows)


def test_stored_profile_reads_back(spark, tables):
    spark.sql("CREATE DATABASE edgelens_skew")
    try:
        store_skew(spark, PROFILE, "edgelens_skew.profile")
        assert load_skew(spark, "edgelens_skew.profile") == PROFILE
        store_skew(spark, SkewProfile(), "edgelens_skew.none")
        assert load_skew(spark, "edgelens_skew.none") == SkewProfile()
    finally:
        spark.sql("DROP DATABASE edgelens_skew CASCADE")
