"""DuckDB SQL that gives the expected result of each registered query.

Written from the definition of each result, not from the Spark plans: one lookup per
attribute and side instead of a shared dimension, and rankings in two stages.
"""

from __future__ import annotations

_AXES = ("x", "y", "z")
_SIDES = ("a", "b")

# The derived tables, with nested columns flat. Scores and coordinates are as stored.
_TABLES = """
raw_lines AS (
    SELECT l_orderkey AS o, l_linenumber::BIGINT AS ln, l_quantity::BIGINT AS q,
           l_partkey AS pk, l_suppkey AS sk,
           l_orderkey * 7 + l_linenumber::BIGINT * 31 + l_quantity::BIGINT * 13
               + l_partkey * 3 AS h
    FROM lineitem
),
rsg AS (
    SELECT CASE WHEN ln <= 2 THEN 32 WHEN ln <= 4 THEN 16 ELSE 8 END AS res,
           CASE WHEN ln % 2 = 1 THEN pk ELSE sk END AS label_a,
           CASE WHEN ln % 2 = 1 THEN sk ELSE pk END AS label_b,
           CASE WHEN h % 41 <> 0 THEN (h % 101)::DOUBLE / 100::DOUBLE END AS score_ab,
           CASE WHEN h % 43 <> 0 THEN ((h * 3 + 17) % 101)::DOUBLE / 100::DOUBLE END AS score_ba,
           o % 1000 AS oax, q AS oay, ln * 10 AS oaz,
           o % 1000 + 1 AS obx, q + 2 AS oby, ln * 10 + 3 AS obz,
           o % 1000 + 5 AS px, q + 6 AS py, ln * 10 + 7 AS pz
    FROM raw_lines
),
parts AS (SELECT p_partkey AS sv, p_size::BIGINT AS n FROM part),
objinfo AS (
    SELECT sv AS id, (sv * 104729 + n * 65537) % 20000000 + 1 AS num_voxels,
           sv % 500 AS sx, n * 10 AS sy, sv % 37 AS sz, n + 1 AS wx, n + 2 AS wy, n + 3 AS wz
    FROM parts WHERE sv % 97 <> 96
),
obj_to_mask AS (
    SELECT sv AS obj_id, (CASE WHEN n % 5 = 0 THEN 1 + sv % 4 ELSE 5 END)::INTEGER AS max_mask
    FROM parts WHERE sv % 89 <> 88
),
agglo AS (SELECT sv AS id_a, sv - sv % 8 AS id_b FROM parts WHERE sv % 8 NOT IN (0, 7)),
sv_tbars AS (SELECT sv, n % 20 AS tbar_count FROM parts WHERE sv % 13 <> 12),
body_of AS (
    SELECT sv, coalesce(id_b, sv) AS body FROM parts LEFT JOIN agglo ON id_a = sv
),
body_tbars AS (
    SELECT body, sum(tbar_count)::BIGINT AS tbar_count
    FROM sv_tbars JOIN body_of USING (sv) GROUP BY body
),
body_sizes AS (
    SELECT body, sum(num_voxels)::BIGINT AS body_size,
           min(sx) AS x0, min(sy) AS y0, min(sz) AS z0,
           max(sx + wx) AS x1, max(sy + wy) AS y1, max(sz + wz) AS z1
    FROM objinfo JOIN body_of ON sv = id GROUP BY body
),
isolated AS (SELECT sv FROM parts WHERE sv % 101 IN (50, 6)),
separate AS (SELECT sv, body FROM body_of WHERE body % 24 = 0),
pair_list AS (
    SELECT DISTINCT label_a AS sv_a, label_b AS sv_b FROM rsg WHERE res = 32
)"""

_STORED = {
    "xa": "oax", "ya": "oay", "za": "oaz",
    "xb": "obx", "yb": "oby", "zb": "obz",
    "x_nearby": "px", "y_nearby": "py", "z_nearby": "pz",
}

_TIE_BREAK = "sv_a, sv_b, {res}" + ", ".join([*_STORED, "score_ab", "score_ba"])


def _coordinates(form: str) -> str:
    return ", ".join(f"{form.format(stored)} AS {name}" for name, stored in _STORED.items())


_FLOAT = _coordinates("(res // 8)::DOUBLE * {}")
_INTEGER = _coordinates("(res // 8)::BIGINT * {}")
_AS_STORED = _coordinates("{}")


def _score(fn: str) -> str:
    return (
        "CASE WHEN score_ab IS NOT NULL AND score_ba IS NOT NULL "
        f"THEN {fn}(score_ab, score_ba) END"
    )


def _edges(coordinates: str = _FLOAT, fn: str = "greatest", where: str = "TRUE") -> str:
    """Scored flat edges of some resolutions."""
    return (
        f"SELECT res, label_a AS sv_a, label_b AS sv_b, {_score(fn)} AS score, "
        f"score_ab, score_ba, {coordinates} FROM rsg WHERE {where}"
    )


def _best_first(res: str = "") -> str:
    tie_break = _TIE_BREAK.format(res=res and f"{res}, ").replace(",", " NULLS FIRST,")
    return f"score DESC NULLS LAST, {tie_break} NULLS FIRST"


def _with(*steps: tuple[str, str]) -> str:
    return "WITH" + _TABLES + "".join(f",\n{name} AS (\n{text}\n)" for name, text in steps)


def _query(*steps: tuple[str, str], final: str) -> str:
    return f"{_with(*steps)}\n{final}"


def _mapped(source: str) -> str:
    return (
        f"SELECT e.*, coalesce(ga.id_b, e.sv_a) AS body_a, coalesce(gb.id_b, e.sv_b) AS body_b "
        f"FROM {source} e LEFT JOIN agglo ga ON ga.id_a = e.sv_a "
        f"LEFT JOIN agglo gb ON gb.id_a = e.sv_b"
    )


_VALID = "sv_a IN (SELECT id FROM objinfo) AND sv_b IN (SELECT id FROM objinfo)"


def _attributes(side: str, mask_side: str) -> str:
    body_box = [f"z{side}.{axis}{c} AS body_box_{axis}{c}_{side}" for c in (0, 1) for axis in _AXES]
    sv_box = [f"o{side}.s{axis} AS sv_box_{axis}0_{side}" for axis in _AXES]
    sv_box += [f"o{side}.s{axis} + o{side}.w{axis} AS sv_box_{axis}1_{side}" for axis in _AXES]
    return ", ".join(
        [
            f"m{mask_side}.max_mask AS sv_mask_{side}",
            f"bt{side}.tbar_count AS body_tbars_{side}",
            f"st{side}.tbar_count AS sv_tbars_{side}",
            f"z{side}.body_size AS body_size_{side}",
            f"o{side}.num_voxels AS sv_size_{side}",
            *body_box,
            *sv_box,
            f"EXISTS (SELECT 1 FROM isolated i WHERE i.sv = e.sv_{side}) AS is_isolated_{side}",
            f"EXISTS (SELECT 1 FROM separate s WHERE s.body = e.body_{side}) AS is_separate_{side}",
        ]
    )


def _enriched(source: str, mask_b_from_a: bool = False) -> str:
    joins = " ".join(
        f"JOIN objinfo o{s} ON o{s}.id = e.sv_{s} "
        f"LEFT JOIN obj_to_mask m{s} ON m{s}.obj_id = e.sv_{s} "
        f"LEFT JOIN sv_tbars st{s} ON st{s}.sv = e.sv_{s} "
        f"LEFT JOIN body_sizes z{s} ON z{s}.body = e.body_{s} "
        f"LEFT JOIN body_tbars bt{s} ON bt{s}.body = e.body_{s}"
        for s in _SIDES
    )
    columns = [_attributes("a", "a"), _attributes("b", "a" if mask_b_from_a else "b")]
    return f"SELECT e.*, {', '.join(columns)} FROM {source} e {joins}"


def _bounds(a: str, b: str, both=(0, None), either=(None, None)) -> str:
    low, high = both
    clauses = [f"{a} >= {low} AND {b} >= {low}"]
    if high is not None:
        clauses.append(f"{a} <= {high} AND {b} <= {high}")
    if either[0] is not None:
        clauses.append(f"({a} >= {either[0]} OR {b} >= {either[0]})")
    if either[1] is not None:
        clauses.append(f"({a} <= {either[1]} OR {b} <= {either[1]})")
    return " AND ".join(clauses)


def _family(name: str, both=(0, None), either=(None, None)) -> str:
    return _bounds(f"{name}_a", f"{name}_b", both, either)


def _criteria(body_tbars=(0, 1000000), sv_size=(0, 100000000000), body_size_either=(None, None)):
    """All criteria with their defaults, but for the ones given."""
    return " AND ".join(
        [
            "NOT is_isolated_a AND NOT is_isolated_b",
            "NOT (is_separate_a AND is_separate_b)",
            "sv_mask_a = 5 AND sv_mask_b = 5",
            _bounds("score_ab", "score_ba", (0, 1)),
            _family("body_tbars", body_tbars),
            _family("sv_tbars", (0, 1000000)),
            _family("body_size", (0, 100000000000), body_size_either),
            _family("sv_size", sv_size),
        ]
    )


_INTER = "body_a <> body_b"
_INTRA = "body_a = body_b AND sv_a <> sv_b"


def _boxes(kind: str) -> list[str]:
    corners = [(c, axis) for c in (0, 1) for axis in _AXES]
    return [f"{kind}_box_{axis}{c}_{side}" for side in _SIDES for c, axis in corners]


_ENRICHED_COLUMNS = ", ".join(
    [
        "sv_a", "sv_b", "body_a", "body_b", "score", "score_ab", "score_ba",
        *(f"{n}_{s}" for n in ("sv_mask", "body_tbars", "sv_tbars") for s in _SIDES),
        *_STORED,
        "body_size_a", "body_size_b", *_boxes("body"),
        "sv_size_a", "sv_size_b", *_boxes("sv"),
    ]
)


def _edge_query_steps(edge_type: str, criteria: str, where: str) -> list[tuple[str, str]]:
    """Filter first, then the best contact of each pair and resolution."""
    numbered = (
        f"row_number() OVER (PARTITION BY res, sv_a, sv_b ORDER BY {_best_first()}) AS rownum"
    )
    return [
        ("edges", _edges(where=where)),
        ("mapped", _mapped("edges")),
        ("enriched", _enriched("mapped")),
        ("kept", f"SELECT * FROM enriched WHERE {edge_type} AND {criteria}"),
        ("ranked", f"SELECT *, {numbered} FROM kept"),
        ("best", f"SELECT res, {_ENRICHED_COLUMNS}, rownum FROM ranked WHERE rownum = 1"),
    ]


_INTRA_CRITERIA = _criteria(
    sv_size=(1000000, 100000000000), body_size_either=(50000000, None)
)
_BEST = f"SELECT {_ENRICHED_COLUMNS}, rownum FROM best"


def _top_n_steps(n: int, res: str = "") -> list[tuple[str, str]]:
    """The rank of an edge at a body is its place among all edges of that body, at whichever end;
    the rank of a side is its place among the edges with the same body at that side."""

    def place(body: str) -> str:
        return f"row_number() OVER (PARTITION BY {body} ORDER BY {_best_first(res)})"

    return [
        ("by_side", f"SELECT *, {place('body_a')} AS rank_a, {place('body_b')} AS rank_b FROM cand"),
        ("at_bodies", "SELECT *, unnest([body_a, body_b]) AS ranked_body FROM by_side"),
        ("top", f"SELECT *, {place('ranked_body')} AS rank FROM at_bodies QUALIFY rank <= {n}"),
    ]


def _candidates(coordinates: str, fn: str, where: str = "TRUE") -> list[tuple[str, str]]:
    return [
        ("edges", _edges(coordinates, fn, where)),
        ("mapped", _mapped("edges")),
        ("cand", f"SELECT * FROM mapped WHERE {_INTER} AND {_VALID}"),
    ]


def _best_edges(n, coordinates, fn, where, res, columns, mask_b_from_a=False) -> str:
    return _query(
        *_candidates(coordinates, fn, where),
        *_top_n_steps(n, res),
        ("enriched", _enriched("top", mask_b_from_a)),
        final=f"SELECT {columns} FROM enriched WHERE {_criteria(body_tbars=(2, 1000000))}",
    )


def _best_edges_all_res(mask_b_from_a: bool = False, ranks: str = "rank_a, rank_b, ") -> str:
    columns = f"res, ranked_body, rank, {ranks}{_ENRICHED_COLUMNS}"
    return _best_edges(10, _INTEGER, "least", "TRUE", "res", columns, mask_b_from_a)


def _best_edges_one_res(mask_b_from_a: bool = False, ranked_body: str = "ranked_body, ") -> str:
    columns = ranked_body + _ENRICHED_COLUMNS
    return _best_edges(1, _FLOAT, "greatest", "res = 32", "", columns, mask_b_from_a)


_BY_MIN_SV_TBARS = (
    "least(sv_tbars_a, sv_tbars_b) DESC, body_a, body_b, sv_a, sv_b"
)
_BY_BODY_TBARS = (
    "least(body_tbars_a, body_tbars_b) DESC, greatest(body_tbars_a, body_tbars_b), "
    "body_a, body_b, sv_a, sv_b"
)

_RES8 = "res = 8"
_FLAT = f"sv_a, sv_b, score_ab, score_ba, {', '.join(_STORED)}"
_SCORED = f"{_FLAT}, score"


def _on_enriched(where: str) -> str:
    """Enriched inter-body and intra-body edges at 8 nm that meet one condition."""
    return _query(
        ("edges", _edges(where=_RES8)),
        ("mapped", _mapped("edges")),
        ("enriched", _enriched("mapped")),
        final=f"SELECT {_ENRICHED_COLUMNS} FROM enriched WHERE {where}",
    )


def _on_mapped(where: str) -> str:
    return _query(
        ("edges", _edges(where=_RES8)),
        ("mapped", _mapped("edges")),
        final=f"SELECT {_SCORED}, body_a, body_b FROM mapped WHERE {where}",
    )


def _on_flat(where: str = "TRUE") -> str:
    return _query(
        ("edges", _edges(where=_RES8)), final=f"SELECT {_SCORED} FROM edges WHERE {where}"
    )


def _deduplicated(res: int) -> tuple[str, str]:
    rank = f"row_number() OVER (PARTITION BY sv_a, sv_b ORDER BY {_best_first()})"
    edges = _edges(_AS_STORED, where=f"res = {res}")
    return "unique_edges", f"SELECT *, {rank} AS rownum FROM ({edges}) QUALIFY rownum = 1"


_MATCHED = (
    "matched",
    "SELECT u.* FROM unique_edges u JOIN pair_list p ON u.sv_a = p.sv_a AND u.sv_b = p.sv_b "
    "WHERE u.sv_a <> u.sv_b UNION ALL "
    "SELECT u.* FROM unique_edges u JOIN pair_list p ON u.sv_a = p.sv_b AND u.sv_b = p.sv_a "
    "WHERE u.sv_a <> u.sv_b",
)

_ENDS = ("both", "either")
_BOX_COLUMNS = [f"box_{axis}{c}" for c in (0, 1) for axis in _AXES]


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    stored = ", ".join(_STORED.values())
    sql["scan_edges"] = _query(
        final=f"SELECT label_a, label_b, score_ab, score_ba, {stored} FROM rsg WHERE res = 8"
    )
    sql["scan_edges_all_res"] = _query(
        ("edges", _edges(_INTEGER, "least")), final=f"SELECT res, {_FLAT} FROM edges"
    )
    sql["flatten_edges"] = _query(
        ("edges", _edges(_AS_STORED, where=_RES8)), final=f"SELECT {_FLAT} FROM edges"
    )
    for key, coordinates in (("scale_coords_pow2", _FLOAT), ("scale_coords_res", _INTEGER)):
        sql[key] = _query(
            ("edges", _edges(coordinates)), final=f"SELECT res, {_FLAT} FROM edges"
        )
    for key, fn in (("score_greatest", "greatest"), ("score_least", "least")):
        sql[key] = _query(
            ("edges", _edges(fn=fn, where=_RES8)),
            final="SELECT sv_a, sv_b, score_ab, score_ba, score FROM edges",
        )
    sql["box_end"] = _query(
        final="SELECT id AS sv, num_voxels AS sv_size, "
        + ", ".join(f"s{a} AS sv_box_{a}0, s{a} + w{a} AS sv_box_{a}1" for a in _AXES)
        + " FROM objinfo"
    )
    sql["map_bodies"] = _on_mapped("TRUE")
    sql["valid_edges"] = _on_flat(_VALID)
    sql["drop_self_edges"] = _on_flat("sv_a <> sv_b")
    sql["edges_inter"] = _on_mapped(_INTER)
    sql["edges_intra"] = _on_mapped(_INTRA)

    sql["body_dimension"] = _query(
        (
            "known",
            "SELECT body FROM body_sizes UNION SELECT body FROM body_tbars "
            "UNION SELECT body FROM separate",
        ),
        final="SELECT k.body, body_size, "
        + ", ".join(f"z.{c.removeprefix('box_')} AS body_{c}" for c in _BOX_COLUMNS)
        + ", tbar_count AS body_tbars, k.body IN (SELECT body FROM separate) AS is_separate "
        "FROM known k LEFT JOIN body_sizes z USING (body) LEFT JOIN body_tbars USING (body)",
    )
    per_sv = ["body_tbars", "sv_tbars", "body_size", "sv_size", "sv_mask"]
    per_sv += [f"{kind}_{c}" for kind in ("body", "sv") for c in _BOX_COLUMNS]
    per_sv += ["is_isolated", "is_separate"]
    sql["sv_dimension"] = _query(
        ("loops", "SELECT id AS sv_a, id AS sv_b FROM objinfo"),
        ("mapped", _mapped("loops")),
        ("enriched", _enriched("mapped")),
        final="SELECT sv_a AS sv, body_a AS body, "
        + ", ".join(f"{c}_a AS {c}" for c in per_sv)
        + " FROM enriched",
    )
    sql["enrich_edges"] = _on_enriched("TRUE")

    sql["exclude_isolated"] = _on_flat(
        "sv_a NOT IN (SELECT sv FROM isolated) AND sv_b NOT IN (SELECT sv FROM isolated)"
    )
    sql["exclude_mutual"] = _on_mapped(
        "NOT (body_a IN (SELECT body FROM separate) AND body_b IN (SELECT body FROM separate))"
    )
    sql["mask_filter"] = _on_enriched("sv_mask_a = 5 AND sv_mask_b = 5")
    sql["thr_score"] = _on_flat(_bounds("score_ab", "score_ba", (0.1, 0.9), (0.5, 0.7)))
    sql["thr_body_tbars"] = _on_enriched(_family("body_tbars", (20, 90), (50, 70)))
    sql["thr_sv_tbars"] = _on_enriched(_family("sv_tbars", (2, 17), (8, 12)))
    sql["thr_body_size"] = _on_enriched(
        _family("body_size", (20000000, 95000000), (60000000, 80000000))
    )
    sql["thr_sv_size"] = _on_enriched(_family("sv_size", (1000000, 19000000), (5000000, 15000000)))

    sql["best_contact_per_pair"] = _query(
        ("edges", _edges(where=_RES8)),
        final=f"SELECT {_SCORED}, row_number() OVER (PARTITION BY sv_a, sv_b "
        f"ORDER BY {_best_first()}) AS rownum FROM edges QUALIFY rownum = 1",
    )
    sql["dedup_raw_edges"] = _query(
        _deduplicated(16), final=f"SELECT {_SCORED}, rownum FROM unique_edges"
    )
    sql["side_ranks"] = _query(
        *_candidates(_INTEGER, "least"),
        *_top_n_steps(10, "res"),
        final=f"SELECT res, {_SCORED}, body_a, body_b, rank_a, rank_b FROM by_side",
    )
    sql["topn_per_body"] = _query(
        *_candidates(_INTEGER, "least"),
        *_top_n_steps(10, "res"),
        final=f"SELECT res, {_SCORED}, body_a, body_b, ranked_body, rank FROM top",
    )
    sql["best_per_body"] = _query(
        *_candidates(_FLOAT, "greatest", "res = 32"),
        *_top_n_steps(1),
        final=f"SELECT {_SCORED}, body_a, body_b, ranked_body, rank FROM top",
    )
    sql["match_pairs"] = _query(
        _deduplicated(16), _MATCHED, final=f"SELECT {_SCORED}, rownum FROM matched"
    )

    inter = _edge_query_steps(_INTER, _criteria(), _RES8)
    intra = _edge_query_steps(_INTRA, _INTRA_CRITERIA, _RES8)
    sql["edge_query_inter"] = _query(*inter, final=_BEST)
    sql["edge_query_intra"] = _query(*intra, final=_BEST)
    sql["intra_all_res"] = _query(
        *_edge_query_steps(_INTRA, _INTRA_CRITERIA, "TRUE"),
        final=f"SELECT res, {_ENRICHED_COLUMNS}, rownum FROM best",
    )
    sql["best_edges_all_res"] = _best_edges_all_res()
    sql["best_edges_all_res_without_side_ranks"] = _best_edges_all_res(ranks="")
    sql["best_edges_all_res_mask_b_from_a"] = _best_edges_all_res(mask_b_from_a=True)
    sql["best_edges_one_res"] = _best_edges_one_res()
    sql["best_edges_one_res_mask_b_from_a"] = _best_edges_one_res(True, ranked_body="")
    def extracted(more: str = "") -> str:
        return _query(
            _deduplicated(16),
            _MATCHED,
            ("mapped", _mapped("matched")),
            final=f"SELECT {_SCORED}{more}, sv_a AS label_a, sv_b AS label_b, rownum, body_a, body_b, "
            "oa.num_voxels AS sv_voxels_a, ob.num_voxels AS sv_voxels_b, "
            "ma.max_mask AS max_mask_a, mb.max_mask AS max_mask_b FROM mapped e "
            "LEFT JOIN objinfo oa ON oa.id = sv_a LEFT JOIN objinfo ob ON ob.id = sv_b "
            "LEFT JOIN obj_to_mask ma ON ma.obj_id = sv_a LEFT JOIN obj_to_mask mb ON mb.obj_id = sv_b "
            "WHERE oa.num_voxels > 1000000 AND ob.num_voxels > 1000000 "
            "AND ma.max_mask = 5 AND mb.max_mask = 5",
        )

    sql["extract_pairs"] = extracted()
    sql["extract_pairs_all_columns"] = extracted(", xa * 3 + z_nearby AS contact_area")

    for name in ("edge_query_inter", "best_edges_all_res", "extract_pairs"):
        sql[f"{name}_split"] = sql[name]

    def positioned(order: str) -> str:
        return _query(
            *inter,
            final=f"SELECT {_ENRICHED_COLUMNS}, rownum, "
            f"row_number() OVER (ORDER BY {order}) AS position FROM best",
        )

    sql["sort_min_sv_tbars"] = positioned(_BY_MIN_SV_TBARS)
    sql["sort_body_tbars"] = positioned(_BY_BODY_TBARS)
    sql["export_in_order"] = positioned(_BY_BODY_TBARS)

    sql["adhoc_sql"] = _query(
        final="SELECT m.max_mask, count(*) AS n_edges, max(r.score_ab) AS best_score_ab "
        "FROM rsg r JOIN obj_to_mask m ON m.obj_id = r.label_a WHERE r.res = 8 GROUP BY m.max_mask"
    )
    sql["export_roundtrip"] = _query(*inter, final=_BEST)
    sql["export_csv_roundtrip"] = _query(*inter, final=_BEST)
    sql["export_summary"] = _query(
        *inter,
        final=f"SELECT {_ENRICHED_COLUMNS}, rownum, n_rows FROM (SELECT *, count(*) OVER () "
        f"AS n_rows, row_number() OVER (ORDER BY {_BY_BODY_TBARS}) AS place FROM best) "
        "WHERE place <= 5",
    )
    sql["export_preview"] = sql["export_summary"]
    sql["export_overwrite"] = _query(*inter, final=_BEST)
    sql["batch_export"] = _query(
        *_edge_query_steps(_INTRA, _INTRA_CRITERIA, "TRUE"),
        final=f"SELECT res, {_ENRICHED_COLUMNS}, rownum, res = 16 AS resumed FROM best",
    )
    of_part = ["objinfo", "sv_tbars", "agglo", "body_sizes", "body_tbars", "separate", "isolated"]
    read = [("mask", "obj_to_mask", "part"), *((name, name, "part") for name in of_part)]
    counted = [
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, '{file}.parquet' AS files FROM {table}"
        for name, table, file in read
    ]
    counted.append(
        "SELECT 'rsg32' AS table_name, count(*) AS n_rows, 'lineitem.parquet' AS files "
        "FROM rsg WHERE res = 32"
    )
    sql["export_inputs"] = _query(final=" UNION ALL ".join(counted))
    limits = [(f"{ways}_way_score", "0::DOUBLE", "1::DOUBLE") for ways in ("one", "two")]
    for family, most in (("tbars", "1e6"), ("size", "1e11")):
        for kind in ("body", "sv"):
            names = [f"{kind}_{family}_{ends}" for ends in _ENDS]
            limits += [(name, "0::BIGINT", f"{most}::DOUBLE") for name in names]
    given = {"min_sv_size_both": "1e6::DOUBLE", "min_body_size_either": "5e7::DOUBLE"}
    parameters = {f"min_{name}": least for name, least, _ in limits}
    parameters |= {f"max_{name}": most for name, _, most in limits} | given
    sql["export_provenance"] = _query(
        *_edge_query_steps(_INTRA, _INTRA_CRITERIA, "TRUE"),
        final="SELECT 'intra-body' AS edge_type, "
        + ", ".join(f"{value} AS {name}" for name, value in parameters.items())
        + ", TRUE AS plan, count(*) AS n_rows FROM best",
    )
    return sql
