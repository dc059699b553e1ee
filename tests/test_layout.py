"""A stored dimension: same results, fewer shuffles."""

import dataclasses
import re

import pytest
from compare import difference_between
from test_skew import PROFILE

from edgelens import SkewProfile, best_edges_all_res, best_edges_one_res, edge_query
from edgelens.operators.layout import store_dimension
from edgelens.sources.export import plan_text


@pytest.fixture(scope="module")
def stored(spark, tables):
    spark.sql("CREATE DATABASE edgelens_layout")
    yield store_dimension(tables, "edgelens_layout.sv_dimension", 4)
    spark.sql("DROP DATABASE edgelens_layout CASCADE")


def test_stored_dimension_gives_the_same_results(tables, stored, shuffled):
    assert difference_between(edge_query(stored, 8), edge_query(tables, 8)) is None
    assert difference_between(best_edges_one_res(stored), best_edges_one_res(tables)) is None


def test_only_the_edges_are_shuffled(stored, shuffled):
    text = plan_text(edge_query(stored, 8))
    assert re.findall(r"Arguments: hashpartitioning\((\w+)#", text) == ["sv_a", "sv_b"]
    assert text.count("Bucketed: true") == 2


def test_a_checked_dimension_is_not_checked_again(stored, shuffled):
    for query in (edge_query(stored, 8), best_edges_all_res(stored)):
        text = plan_text(query)
        assert "raise_error" not in text and "Aggregate" not in text


def test_repeated_keys_are_named_when_a_dimension_is_stored(spark, tables):
    twice = dataclasses.replace(tables, sv_tbars=tables.sv_tbars.unionAll(tables.sv_tbars))
    with pytest.raises(ValueError, match="sv_tbars"):
        store_dimension(twice, "edgelens_layout.twice", 4)
    assert not spark.catalog.tableExists("edgelens_layout.twice")


def test_a_dimension_can_be_stored_again(spark, tables, stored):
    again = store_dimension(stored, "edgelens_layout.again", 4)
    again = store_dimension(again, "edgelens_layout.again", 2, overwrite=True)
    assert difference_between(again.dimension, stored.dimension) is None


def test_a_dimension_without_its_columns_is_refused(tables, stored):
    with pytest.raises(ValueError, match="dimension.*body_size is missing"):
        dataclasses.replace(tables, dimension=stored.dimension.drop("body_size"))


def test_hot_labels_are_split_all_the_same(stored, shuffled):
    split = edge_query(stored, 8, skew=PROFILE)
    assert difference_between(split, edge_query(stored, 8, skew=SkewProfile())) is None
