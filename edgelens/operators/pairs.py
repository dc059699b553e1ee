"""Looking up a given list of supervoxel pairs among the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelens.operators.edges import drop_self_edges
from edgelens.operators.pair_filter import may_be_wanted
from edgelens.operators.ranking import best_contact_per_pair


# Requests for one pair that a single row stands for until the very end.
REQUESTS_PER_ROW = 100_000


def both_orientations(pair_list: DataFrame) -> DataFrame:
    """Each listed pair as it is and reversed."""
    reverse = pair_list.selectExpr("sv_b AS sv_a", "sv_a AS sv_b")
    return pair_list.select("sv_a", "sv_b").unionAll(reverse)


def wanted_pairs(pair_list: DataFrame) -> DataFrame:
    """The ordered pairs a list asks for, with how often it asks for each.

    A listed pair asks for its own orientation and for the reverse. Counting the requests
    here keeps a pair that is listed very often from piling up in one task; a count too
    large for one row is spread over several, told apart by ``_chunk``.
    """
    counted = both_orientations(pair_list).groupBy("sv_a", "sv_b").agg(F.count("*").alias("n"))
    chunked = drop_self_edges(counted).selectExpr(
        "*", f"explode(sequence(0L, (n - 1L) div {REQUESTS_PER_ROW}L)) AS _chunk"
    )
    in_chunk = f"least({REQUESTS_PER_ROW}L, n - _chunk * {REQUESTS_PER_ROW}L) AS n_requests"
    return chunked.selectExpr("sv_a", "sv_b", "_chunk", in_chunk)


def best_contact_of_wanted(
    edges: DataFrame, pair_list: DataFrame, n_listed: int | None = None
) -> DataFrame:
    """The best contact of each wanted pair that has an edge, with ``n_requests`` and
    ``_chunk``.

    A Bloom filter of the list drops nearly all other edges at the scan, before the first
    shuffle. Of what is left each task first cuts its edges to one per pair; the list joins them
    on the partitioning that the choice of the best contact leaves. ``n_listed`` is the length of
    the list, which sizes the filter; it is counted here if it is not given, which for a stored
    list reads file footers only.
    """
    n_listed = pair_list.count() if n_listed is None else n_listed
    near = may_be_wanted(drop_self_edges(edges), both_orientations(pair_list), 2 * n_listed)
    return best_contact_per_pair(near).join(wanted_pairs(pair_list), ["sv_a", "sv_b"])


def once_per_request(matched: DataFrame) -> DataFrame:
    """Repeat each row as often as the list asks for it.

    The last step, also after a sort: copies are equal in any order.
    """
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_requests")))
    return matched.withColumn("_request", repeated).drop("_request", "_chunk", "n_requests")


def match_pairs(
    edges: DataFrame, pair_list: DataFrame, n_listed: int | None = None
) -> DataFrame:
    """The best contact of every listed pair in either orientation, one row per request."""
    return once_per_request(best_contact_of_wanted(edges, pair_list, n_listed))
