import pytest

from edgelens import EdgeCriteria, EdgeQuery, EdgeType, Resolution, TableNames
from edgelens.functions import Bounds


def test_replace_accepts_both_spellings():
    changed = EdgeCriteria().replace(min_sv_size_both=1e6, __MAX_ONE_WAY_SCORE__=0.9)
    assert (changed.min_sv_size_both, changed.max_one_way_score) == (1e6, 0.9)


def test_unknown_names_and_values_are_refused():
    with pytest.raises(ValueError, match="unknown parameters"):
        EdgeCriteria().replace(min_size=1)
    with pytest.raises(ValueError):
        EdgeCriteria(edge_type="between")
    with pytest.raises(ValueError, match="must be a number"):
        EdgeCriteria(min_two_way_score=float("nan"))
    with pytest.raises(ValueError, match="must be a number"):
        EdgeCriteria(min_two_way_score="0.1")


def test_twenty_thresholds_and_their_defaults():
    values = EdgeCriteria().as_parameters()
    assert len(values) == 21
    assert values["edge_type"] == "inter-body"
    assert {v for k, v in values.items() if k.endswith("score")} == {0.0, 1.0}
    assert {v for k, v in values.items() if "tbars" in k} == {0, 1e6}
    assert {v for k, v in values.items() if "size" in k} == {0, 1e11}


@pytest.mark.parametrize("name, res, scale", [("rsg8", 8, 0), ("rsg16", 16, 1), ("rsg32", 32, 2)])
def test_scale_follows_the_edge_table(name, res, scale):
    names = TableNames("seg").replace(__RSG_TABLE__=name)
    assert names.res == Resolution(res)
    assert names.as_parameters()["scale"] == scale


@pytest.mark.parametrize("name", ["rsg4", "rsg24", "edges", "8"])
def test_other_edge_tables_are_refused(name):
    with pytest.raises(ValueError):
        TableNames("seg", rsg_table=name)


def test_query_builder_routes_parameters():
    query = EdgeQuery(TableNames("seg")).set(
        rsg_table="rsg16", edge_type="intra-body", __MIN_SV_SIZE_BOTH__=1e6, scale=1
    )
    assert query.names.rsg_table == "rsg16"
    assert query.criteria.edge_type is EdgeType.INTRA_BODY
    assert query.criteria.min_sv_size_both == 1e6
    with pytest.raises(ValueError, match="scale"):
        query.set(scale=2)
    with pytest.raises(ValueError, match="unknown"):
        query.set(tables="x")
    # 10 table names, the scale, the edge type, 20 thresholds and the order; the names of the edge
    # tables by resolution, of a stored dimension and of a skew profile
    assert len(query.parameters()) == 33 + 5


def test_bounds_leave_out_what_is_implied():
    assert Bounds(0, 1e6, 0, 1e6).across("a", "b") == []
    assert Bounds(2, 9, 3, 8).across("a", "b") == ["(a >= 3 OR b >= 3)", "(a <= 8 OR b <= 8)"]


def test_bounds_on_whole_numbers_are_whole():
    assert Bounds(1.5, 1e11, 0, 1e11).endpoint("n") == "n BETWEEN 2 AND 100000000000"
    assert Bounds(0, 2.5, 0, 2.5).endpoint("n") == "n BETWEEN 0 AND 2"
    assert Bounds(0.1, 1, 0, 1, whole_numbers=False).endpoint("s") == "s BETWEEN 0.1D AND 1.0D"


def test_unbounded_still_rejects_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "n long")
    assert df.where(Bounds(float("-inf"), float("inf"), 0, 0).endpoint("n")).count() == 1


@pytest.mark.parametrize("bound, end", [(1e19, 2**63 - 1), (1e40, 2**63 - 1), (-1e40, -(2**63) + 1)])
def test_bounds_beyond_bigint_are_its_ends(bound, end):
    assert Bounds(bound, bound, bound, bound).endpoint("n") == f"n BETWEEN {end} AND {end}"
