"""Whole queries against plain Python over small random graphs."""

import random
from collections import Counter, defaultdict

import pytest
from tiny import contact, frame, tiny_tables

from edgelens import EdgeCriteria, best_edges_all_res, edge_query, extract_pairs
from edgelens.sources.schema import PAIR_LIST

SVS = range(1, 25)


class Graph:
    def __init__(self, seed):
        rng = random.Random(seed)
        score = lambda: rng.choice([None, float("nan"), *(i / 10 for i in range(11))])
        ends = lambda: rng.choice([3, 4, 5, *range(1, 28)])  # noqa: E731 some ids do not exist
        self.contacts = {
            res: [contact(ends(), ends(), score(), score(), at) for at in range(500)]
            for res in (8, 16, 32)
        }
        maybe = lambda value: None if rng.random() < 0.1 else value()
        self.bodies = {sv: sv - sv % 3 for sv in SVS if sv % 3}
        known = sorted({self.body(sv) for sv in SVS})
        self.classes = {sv: maybe(lambda: rng.choice([5, 5, 5, 3])) for sv in SVS}
        self.sizes = {sv: maybe(lambda: rng.randrange(500_000, 3_000_000)) for sv in SVS}
        self.sv_tbars = {sv: maybe(lambda: rng.randrange(9)) for sv in SVS}
        self.body_tbars = {b: maybe(lambda: rng.randrange(30)) for b in known}
        self.body_sizes = {b: maybe(lambda: rng.randrange(10**7)) for b in known}
        self.separate = rng.sample(known, 3) * 2
        self.isolated = rng.sample(SVS, 2)
        self.pairs = [tuple(sorted(rng.sample(SVS, 2))[:: rng.choice([1, -1])]) for _ in range(90)]

    def body(self, sv):
        return self.bodies.get(sv, sv)

    def tables(self, spark):
        changes = {name: getattr(self, name) for name in
                   ("bodies", "classes", "sizes", "sv_tbars", "body_tbars", "body_sizes",
                    "separate", "isolated")}
        return tiny_tables(spark, self.contacts, svs=SVS, **changes)

    def edges(self, res, combine):
        """(a, b, score, ab, ba, at) of each stored contact; NaN is a missing score."""
        for a, b, ((ab, _), (ba, _)), (at, _, _) in self.contacts[res]:
            ab, ba = (None if s is None or s != s else s for s in (ab, ba))
            score = None if ab is None or ba is None else combine(ab, ba)
            yield a, b, score, ab, ba, at

    def qualifies(self, edge, c):
        a, b, _, ab, ba, _ = edge
        ends = [(sv, self.body(sv)) for sv in (a, b)]
        if {a, b} & set(self.isolated) or all(body in self.separate for _, body in ends):
            return False
        if any(self.classes.get(sv) != 5 for sv in (a, b)):
            return False
        families = {
            "two_way_score": (ab, ba),
            "body_tbars": [self.body_tbars.get(body) for _, body in ends],
            "sv_tbars": [self.sv_tbars.get(sv) for sv, _ in ends],
            "body_size": [self.body_sizes.get(body) for _, body in ends],
            "sv_size": [self.sizes.get(sv) for sv, _ in ends],
        }
        for name, values in families.items():
            if None in values:
                return False
            both, either = (
                (name, "one_way_score") if "score" in name else (f"{name}_both", f"{name}_either")
            )
            if not (
                all(getattr(c, f"min_{both}") <= v <= getattr(c, f"max_{both}") for v in values)
                and any(v >= getattr(c, f"min_{either}") for v in values)
                and any(v <= getattr(c, f"max_{either}") for v in values)
            ):
                return False
        return True

    def valid(self, edge):
        return all(self.sizes.get(sv) is not None for sv in edge[:2])


def best_first(edge):
    """Sorts the best edge first; ties as in the library, up to the position ``at``."""
    a, b, score, _, _, at, *res = edge
    return (score is None, -(score or 0), a, b, *res, at)


@pytest.mark.parametrize("seed", [11, 14])
@pytest.mark.parametrize("edge_type", ["inter-body", "intra-body"])
def test_edge_query(spark, seed, edge_type):
    graph = Graph(seed)
    criteria = EdgeCriteria(
        edge_type=edge_type, min_one_way_score=0.4, max_two_way_score=0.9, min_sv_tbars_either=3,
        max_body_tbars_either=20, min_sv_size_both=600_000, max_body_size_both=9e6,
    )
    best = {}
    for edge in sorted(graph.edges(8, max), key=best_first):
        a, b = edge[:2]
        same = graph.body(a) == graph.body(b)
        if a != b and same == (edge_type == "intra-body") and graph.qualifies(edge, criteria):
            best.setdefault((a, b), edge)
    got = edge_query(graph.tables(spark), 8, criteria).collect()
    assert best
    assert sorted((r.sv_a, r.sv_b, r.score, r.score_ab, r.score_ba, r.xa) for r in got) == sorted(
        best.values()
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_best_edges(spark, seed):
    graph = Graph(seed)
    n = 3
    per_body, sides = defaultdict(list), defaultdict(list)
    for res in (8, 16, 32):
        for a, b, score, ab, ba, at in graph.edges(res, min):
            edge = (a, b, score, ab, ba, at * res // 8, res)
            if graph.valid(edge) and graph.body(a) != graph.body(b):
                for side, sv in (("a", a), ("b", b)):
                    per_body[graph.body(sv)].append(edge)
                    sides[side, graph.body(sv)].append(edge)
    # at one resolution no two contacts have the same position
    tie = lambda e: (e[2] is None, -(e[2] or 0), e[0], e[1], e[6], e[5])
    criteria = EdgeCriteria(min_body_tbars_both=2, max_sv_tbars_either=6)
    expected = []
    for body, edges in per_body.items():
        for rank, edge in enumerate(sorted(edges, key=tie)[:n], 1):
            if graph.qualifies(edge[:6], criteria):
                side = [
                    1 + sum(tie(e) < tie(edge) for e in sides[s, graph.body(sv)])
                    for s, sv in (("a", edge[0]), ("b", edge[1]))
                ]
                expected.append((body, rank, *side, *edge))
    got = best_edges_all_res(graph.tables(spark), n, criteria).collect()
    assert expected
    assert sorted(expected) == sorted(
        (r.ranked_body, r["rank"], r.rank_a, r.rank_b,
         r.sv_a, r.sv_b, r.score, r.score_ab, r.score_ba, r.xa, r.res)
        for r in got
    )


def test_extract_pairs(spark):
    graph = Graph(5)
    best = {}
    for edge in sorted(graph.edges(16, max), key=best_first):
        best.setdefault(edge[:2], edge)
    expected = Counter()
    for a, b in graph.pairs:
        for pair in ((a, b), (b, a)):
            fits = [(graph.sizes[sv] or 0) > 1_000_000 and graph.classes[sv] == 5 for sv in pair]
            if pair in best and all(fits):
                edge = best[pair]
                expected[(*pair, graph.body(pair[0]), graph.body(pair[1]), edge[2], edge[5])] += 1
    got = extract_pairs(graph.tables(spark), frame(spark, graph.pairs, PAIR_LIST)).collect()
    assert expected
    assert Counter((r.sv_a, r.sv_b, r.body_a, r.body_b, r.score, r.xa) for r in got) == expected
