"""Repair of conversations: the cheapest edits that leave user and assistant taking turns.

Repairing is a weighted deduction. An item says how many turns have been dealt with and what the
repaired conversation ends with; a deduction takes an item and the fact of the next turn (or an
inserted turn) to another item and adds to its weight, a cost and the edits so far. Every such
function is superior (it never lowers a weight) and, among derivations of one item, monotone, so
Knuth's algorithm applies: the agenda is popped by weight, each item is final when popped, and
the search ends when the goal item is.

Spark finds faults, numbers the turns and cuts conversations of any length into chunks; a task
derives the lightest way through a chunk from each state to each, and the chunks of a
conversation are deductions of the same kind. Texts are shuffled once, to be hashed or returned
in order, and streamed: no task holds a conversation.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelens.llm.crc32_sql import CRC_TABLE, crc32
from edgelens.llm.scratch import Scratch
from edgelens.operators.ranking import rank_within

#: Costs of the edits, by initial: keep, rerole, delete, insert; and of a truncated turn that stays.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
#: Where the repaired conversation may stand: nothing yet, after a system, user, assistant turn;
#: what an initial leads to; and where it may end.
START, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
STATES = (START, SYSTEM, USER, ASSISTANT)
STEPS = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
#: A turn as one character: its initial (x: any other), as a capital if truncated, as a digit if it
#: has to go.
SOUND, CUT, GOES = "suax", "SUAX", "0123"
#: Turns of one conversation that a task derives at a time.
CHUNK = 1024
SPACE = r"[\x20\x09-\x0D]"

Weight = tuple[int, str]


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _turn_deductions(state: str, code: str) -> Iterator[tuple[str, str, int]]:
    """(head state, edit, cost) for the fact of one turn."""
    yield state, "D", COSTS["D"]
    if code in GOES:
        return
    more = TRUNCATED if code in CUT else 0
    initial = code.lower()
    if initial in STEPS[state]:
        yield initial, "K", COSTS["K"] + more
    yield _answer(state), "R", COSTS["R"] + more


def _answer(state: str) -> str:
    """The role, of user and assistant, that may come next."""
    return ASSISTANT if state == USER else USER


@lru_cache(maxsize=65536)
def lightest(codes: str, start: str, goals: tuple[str, ...]) -> tuple[tuple[str, Weight], ...]:
    """The lightest derivations of each goal state behind all turns, from ``start`` before them.

    An item is (turns dealt with, state).
    """
    wanted = {(len(codes), state) for state in goals}
    agenda: list[tuple[Weight, tuple[int, str]]] = [((0, ""), (0, start))]
    final: dict[tuple[int, str], Weight] = {}
    while agenda and not wanted <= final.keys():
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        (cost, audit), (at, state) = weight, item
        heads = [(at, _answer(state), "I", COSTS["I"])]
        if at < len(codes):
            heads += [(at + 1, head, edit, more) for head, edit, more in _turn_deductions(state, codes[at])]
        for place, head, edit, more in heads:
            if (place, head) not in final:
                heapq.heappush(agenda, ((cost + more, audit + edit), (place, head)))
    return tuple((state, final[len(codes), state]) for state in goals if (len(codes), state) in final)


def through_chunks(chunks: Iterable[list[tuple[str, str, int, str]]]) -> Weight:
    """The lightest derivation of a whole conversation from (from, to, cost, audit) per chunk."""
    final: dict[str, Weight] = {START: (0, "")}
    for paths in chunks:
        agenda = [((final[a][0] + cost, final[a][1] + audit), b) for a, b, cost, audit in paths if a in final]
        heapq.heapify(agenda)
        reached: dict[str, Weight] = {}
        while agenda:
            weight, state = heapq.heappop(agenda)
            reached.setdefault(state, weight)
        final = reached
    return min(final[state] for state in ENDS if state in final)


def illegal(initials: str) -> int:
    """Neighbours that are none of su, ua, au."""
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


_INITIAL = str.maketrans(CUT + GOES, SOUND * 2)
_PATHS = "array<struct<head: string, tail: string, cost: bigint, audit: string>>"


def _chunk_batches(size: int):
    """Per chunk of ``size`` turns: its ways through, illegal neighbours, first and last initial."""
    way = pa.struct([("head", pa.string()), ("tail", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks, codes = batch.column("chunk").to_pylist(), batch.column("codes").to_pylist()
            paths, wrong, ends = [], [], []
            for chunk, code in zip(chunks, codes, strict=True):
                whole = chunk == 0 and len(code) < size
                starts, goals = ((START,), ENDS) if whole else (STATES, STATES)
                paths.append([
                    {"head": a, "tail": b, "cost": cost, "audit": audit}
                    for a in starts for b, (cost, audit) in lightest(code, a, goals)
                ])
                initials = code.translate(_INITIAL)
                wrong.append(illegal(initials))
                ends.append(initials[0] + initials[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("chunk"), pa.array(paths, pa.list_(way)), pa.array(wrong, pa.int64()), pa.array(ends, pa.string())],
                ["conv", "chunk", "paths", "illegal", "ends"],
            )

    return run


def _whole_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: illegal neighbours, cost and audit."""
    for batch in batches:
        wrong, costs, audits = [], [], []
        for chunks in batch.column("chunks").to_pylist():
            ways = ([(p["head"], p["tail"], p["cost"], p["audit"]) for p in c["paths"]] for c in chunks)
            cost, audit = through_chunks(ways)
            seams = "".join(c["ends"] for c in chunks)[1:-1]
            seams = sum(illegal(seams[i : i + 2]) for i in range(0, len(seams), 2))
            wrong.append(seams + sum(c["illegal"] for c in chunks))
            costs.append(cost)
            audits.append(audit)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(wrong, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["conv", "illegal", "cost", "audit"],
        )


class _Applied:
    """Applies an audit to the turns of a conversation as they come by."""

    def __init__(self, audit: str):
        self.edits = iter(audit)
        self.last = START

    def _out(self, role: str, text: str, edit: str) -> tuple[str, str, str]:
        self.last = role[:1]
        return role, text, edit

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of the turns inserted before this one, and of what it becomes."""
        for edit in self.edits:
            if edit == "I":
                yield self._out(ROLES[_answer(self.last)], "", edit)
                continue
            if edit == "K":
                yield self._out(role, text, edit)
            elif edit == "R":
                yield self._out(ROLES[_answer(self.last)], text, edit)
            return

    def rest(self) -> Iterator[tuple[str, str, str]]:
        for edit in self.edits:
            yield self._out(ROLES[_answer(self.last)], "", edit)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]], bool]]:
    """(conversation, repaired turns, whether it ends) of sorted rows, each conversation's audit first."""
    now, conv = None, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text"))
        for key, audit, role, text in zip(*columns, strict=True):
            if audit is None:
                yield conv, now.turn(role, text), False
                continue
            if now:
                yield conv, now.rest(), True
            now, conv = _Applied(audit), key
    if now:
        yield conv, now.rest(), True


def _hash_batches(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, digests, digest, first = [], [], hashlib.sha256(), True

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(digests, pa.string())], ["conv", "sha256"])

        for conv, turns, ends in _applied(batches):
            for role, text, _ in turns:
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
            if ends:
                convs.append(conv)
                digests.append(digest.hexdigest())
                digest, first = hashlib.sha256(), True
                if len(convs) == 10000:
                    yield flushed()
                    convs, digests = [], []
        yield flushed()

    return run


def _turn_batches(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, place = [], 0, 0
        names = ("conv", "place", "role", "text", "edit")
        kinds = (kind, pa.int64(), pa.string(), pa.string(), pa.string())

        def flushed() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

        for conv, turns, ends in _applied(batches):
            for role, text, edit in turns:
                place += 1
                rows.append((conv, place, role, text, edit))
                size += len(text)
            place = 0 if ends else place
            if len(rows) >= 10000 or size > 1 << 22:
                yield flushed()
                rows, size = [], 0
        yield flushed()

    return run


class Repairs:
    """Conversations to repair, as a table of turns.

    Turns are taken in the order of ``turn``, nulls first; rows of one turn by role, then by the
    SHA-256 of their text. Null roles and texts count as one space. Rows with a null conversation
    are one conversation. Repeated rows are turns like any other (all but one are duplicates).
    Columns of other names are not read; an empty table gives empty results.
    """

    def __init__(
        self, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
        text_col: str = "text", scratch: Scratch | None = None,
    ):
        self.scratch = scratch or Scratch(turns.sparkSession, "repair")
        self.conv_col = conv_col
        self.turns = turns.select(
            _named(conv_col).alias("conv"),
            _named(turn_col).cast("long").alias("turn"),
            F.coalesce(_named(role_col).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(_named(text_col).cast("string"), F.lit(" ")).alias("text"),
        )
        self.faults = self.scratch.keep(self._faults(), "faults")
        self.whole = self.scratch.keep(self._whole(), "whole")

    def _faults(self) -> DataFrame:
        """A narrow row per turn: its place in order, and its fault."""
        looked = self.turns.select(
            "conv", "turn", "role", F.sha2("text", 256).alias("digest"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
            (~F.col("text").rlike(rf"[.!?]{SPACE}*\z")).alias("truncated"),
        )
        same = ["conv", "turn", "role", "digest"]
        distinct = self.scratch.keep(
            looked.groupBy(*same).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")),
            "distinct",
        )
        # where a text is first said; only those said in several turns are joined
        order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
        first = distinct.groupBy("conv", "role", "digest").agg(F.min(order).alias("first"), F.count("*").alias("times"))
        first = first.where("times > 1").select(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
        match = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
        told = distinct.join(first, match, "left").withColumn("again", F.coalesce(F.col("first") < order, F.lit(False)))
        copies = told.withColumn("copy", F.explode(F.expr("sequence(1L, n)")))
        fault = F.when(F.col("blank"), "blank").when(F.col("again") | (F.col("copy") > 1), "duplicate").when(F.col("truncated"), "truncated")
        return copies.select("conv", "turn", "role", "digest", "copy", fault.alias("fault"))

    def _whole(self) -> DataFrame:
        """(conv, illegal, cost, audit) of each conversation."""
        ranked = rank_within(self.faults, "conv", ["turn", "role", "digest", "copy"], "place")
        initial = F.substring("role", 1, 1)
        initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
        code = F.when(F.col("fault") == "truncated", F.upper(initial)).when(
            F.col("fault").isNotNull(), F.translate(initial, SOUND, GOES)
        ).otherwise(initial)
        at = (F.col("place") - 1).alias("at")
        chunks = ranked.groupBy("conv", F.expr(f"(place - 1) div {CHUNK}L").alias("chunk")).agg(
            F.sort_array(F.collect_list(F.struct(at, code.alias("code")))).alias("turns")
        )
        chunks = chunks.select("conv", "chunk", F.expr("array_join(turns.code, '')").alias("codes"))
        conv = self.turns.schema["conv"].dataType.simpleString()
        ways = chunks.mapInArrow(_chunk_batches(CHUNK), f"conv {conv}, chunk bigint, paths {_PATHS}, illegal bigint, ends string")
        whole = ways.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "ends", "illegal", "paths"))).alias("chunks"))
        return whole.mapInArrow(_whole_batches, f"conv {conv}, illegal bigint, cost bigint, audit string")

    def _in_order(self) -> DataFrame:
        """Each conversation's audit, then its turns, sorted in one task."""
        audits = self.whole.selectExpr("conv", "false AS later", "CAST(NULL AS bigint) AS turn", "'' AS role", "'' AS digest", "'' AS text", "audit")
        turns = self.turns.select("conv", F.lit(True).alias("later"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
        rows = audits.unionByName(turns.withColumn("audit", F.lit(None).cast("string")))
        return rows.repartition("conv").sortWithinPartitions("conv", "later", "turn", "role", "digest").select("conv", "audit", "role", "text")

    def _conv_type(self) -> tuple[str, pa.DataType]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = self.turns.schema["conv"].dataType
        return kind.simpleString(), to_arrow_type(kind)

    def repaired(self) -> DataFrame:
        """The repaired turns: (conversation, place from 1, role, text, edit K, R or I)."""
        name, kind = self._conv_type()
        schema = f"conv {name}, place bigint, role string, text string, edit string"
        return self._in_order().mapInArrow(_turn_batches(kind), schema).withColumnRenamed("conv", self.conv_col)

    def report(self) -> DataFrame:
        """One row per conversation: gaps in its turn numbers, faults by kind, illegal neighbours,
        the cost and audit of its repair, and the SHA-256 of the repaired ``role:text`` lines."""
        of_fault = {x: F.sum((F.col("fault") == x).cast("long")) for x in ("blank", "duplicate", "truncated")}
        per_turn = self.faults.groupBy("conv", "turn").agg(*(F.coalesce(s, F.lit(0)).alias(x) for x, s in of_fault.items()))
        gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
        counts = per_turn.groupBy("conv").agg(gaps.alias("gaps"), *(F.sum(x).alias(x) for x in of_fault))
        name, kind = self._conv_type()
        hashes = self._in_order().mapInArrow(_hash_batches(kind), f"conv {name}, sha256 string")
        columns = ("gaps", *of_fault, "illegal", "cost", "audit")
        found = counts.select(F.col("conv").alias("_conv"), "gaps", *of_fault)
        found = found.join(self.whole, F.col("_conv").eqNullSafe(F.col("conv"))).select("conv", *columns)
        hashes = hashes.select(F.col("conv").alias("_conv"), F.col("sha256").alias("repaired_sha256"))
        found = found.join(hashes, F.col("_conv").eqNullSafe(F.col("conv"))).select("conv", *columns, "repaired_sha256")
        return found.withColumnRenamed("conv", self.conv_col)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with known damage, by the CRC-32 of ``conv_id:turn`` modulo
    20: 0 is dropped, 1 loses its text, 2 its ``.!?``, 3 is there twice, 4 becomes the user's."""
    def known(name: str) -> Column:
        return F.coalesce(_named(name).cast("string"), F.lit(" "))

    turns = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), (
        F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    ).alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.expr("explode(if(_kind = 3, array(1, 2), array(1)))")
    return turns.where("_kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The repair of the damaged ``conversations``, a row for every original one; those of which
    nothing is left have zeros, no edits and the hash of nothing."""
    report = Repairs(damaged(conversations)).report().withColumnRenamed("conv_id", "_conv")
    originals = conversations.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return originals.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


_NO_WAY = "{'c': 1000000000, 'a': ''}"


def _sql_step(ways: list[tuple[str, str, str]]) -> str:
    """The least of some weights, each (weight, cost added, edits added)."""
    return "list_min([" + ", ".join(f"{{'c': {w}.c + {cost}, 'a': {w}.a || '{edits}'}}" for w, cost, edits in ways) + "])"


def _sql_given(condition: str, ways: list[tuple[str, str, str]]) -> str:
    return f"CASE WHEN {condition} THEN {_sql_step(ways)} ELSE {_NO_WAY} END"


_OPEN = ("e0", "e1", "e3")  # weights of the states that a user's turn may follow
#: The query's rows: a weight per state, carried from turn to turn by plain dynamic programming.
ORACLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
hashed AS (
    SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
    FROM conversations, crc_table
),
turns AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE kind <> 0
),
placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place
    FROM turns
),
told AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault,
           coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1] NOT IN ('su', 'ua', 'au'), FALSE) AS wrong
    FROM placed
),
counts AS (
    SELECT conv_id, max(place) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
    FROM told GROUP BY conv_id
),
steps AS (
    SELECT conv_id, 0::BIGINT AS place, {{'c': 0, 'a': ''}} AS s0, {_NO_WAY} AS s1, {_NO_WAY} AS s2, {_NO_WAY} AS s3 FROM counts
    UNION ALL
    SELECT conv_id, place,
           {_sql_step([("e0", "3", "D")])},
           list_min([{_sql_step([("e1", "3", "D")])}, {_sql_given("keeps AND i = 's'", [("e0", "t", "K")])}]),
           list_min([{_sql_step([("e2", "3", "D")])},
                     {_sql_given("keeps AND i = 'u'", [(e, "t", "K") for e in _OPEN])},
                     {_sql_given("keeps", [(e, "2 + t", "R") for e in _OPEN])}]),
           list_min([{_sql_step([("e3", "3", "D")])},
                     {_sql_given("keeps AND i = 'a'", [("e2", "t", "K")])}, {_sql_given("keeps", [("e2", "2 + t", "R")])}])
    FROM (
        SELECT s.conv_id, t.place, s0 AS e0, s1 AS e1,
               {_sql_step([("s2", "0", ""), ("s0", "2", "I"), ("s1", "2", "I"), ("s3", "2", "I")])} AS e2,
               {_sql_step([("s3", "0", ""), ("s2", "2", "I"), ("s0", "4", "II"), ("s1", "4", "II")])} AS e3,
               t.role[1] AS i, t.fault IS NULL OR t.fault = 'truncated' AS keeps,
               CASE WHEN t.fault = 'truncated' THEN 1 ELSE 0 END AS t
        FROM steps s JOIN told t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.place = s.place + 1
    )
),
audits AS (
    SELECT s.conv_id, {_sql_step([("s0", "0", ""), ("s3", "0", ""), ("s2", "2", "I"), ("s1", "4", "II")])} AS best
    FROM steps s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.place = c.n
),
edits AS (
    SELECT conv_id, i, best.a[i] AS edit, length(replace(best.a[:i], 'I', '')) AS place,
           length(replace(best.a[:i], 'D', '')) AS out
    FROM (SELECT *, unnest(range(1, length(best.a) + 1)) AS i FROM audits)
),
edited AS (
    SELECT e.*, t.role, CASE WHEN edit = 'I' THEN '' ELSE t.text END AS text,
           coalesce(bool_or(edit = 'K' AND out = 1 AND t.role[1] = 's') OVER (PARTITION BY e.conv_id), FALSE) AS led
    FROM edits e LEFT JOIN told t ON edit <> 'I' AND t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.place = e.place
),
lines AS (
    SELECT conv_id, i, text,
           CASE WHEN edit = 'K' THEN role WHEN (out + led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END AS role
    FROM edited WHERE edit <> 'D'
),
repaired AS (SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY i) AS body FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
