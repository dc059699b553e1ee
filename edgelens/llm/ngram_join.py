"""Self-join of documents on the Jaccard similarity of their word shingles.

Method: prefixes of token combinations. All shingles have one global order: rare ones first,
then by frequency class, then by hash. A document indexes a prefix of its shingles: rare ones
alone (k = 1), frequent ones as pairs (k = 2), very frequent ones as triples (k = 3) within
small hash classes. A prefix ends where ``sum over classes of (tokens - k + 1)`` exceeds the
tokens in which a similar document may differ. Of two similar documents, whichever prefix ends
first has a class of which k tokens lie in both prefixes, so they share an index entry. Every
candidate pair is then verified on its full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm import golomb
from edgelens.llm.components import connected_components
from edgelens.llm.filters import MAX_BITS, HashFilter, bits_for, build_filter
from edgelens.llm.scratch import Scratch
from edgelens.llm.words import mix, shingles, words_of

#: Similarity is at least NEED / OF.
NEED, OF = 4, 5
#: Documents that make a shingle frequent, and how many times that make it very frequent. The
#: first is doubled until the frequent ones fit their filter of fixed size.
FREQUENT, VERY = 32, 32
#: Shingles that a task gathers before it sends their counts.
SEND = 2_000_000
#: Distinct sets that a task remembers to index copies once; beyond it starts afresh.
REMEMBER = 200_000
#: Words of 64 bits of a set's sketch: parities of its shingles by hash bucket.
SKETCH = [f"s{i}" for i in range(8)]
#: Rounds that compare the classes of an entry with one of its documents only.
PIVOT_ROUNDS = 2


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of 5-word shingles have a similarity of 0.8 or more.

    Returns one row per row of ``docs``: the id, ``n_shingles`` (size of its set) and
    ``component_id`` (smallest id reachable by links, itself included).

    Words are runs of characters outside 0x20 and 0x09-0x0D, with A-Z lower-cased. Fewer than
    five words count as one shingle. Texts that are null, empty or blank have no shingles and
    link with nothing. Repeated rows and repeated ids each keep their row. A null id is
    returned as it is and is never the smallest. Further columns of ``docs`` are ignored.
    Shingles are compared by 48-bit hashes.

    Documents with equal sets are one node. Candidates of an index entry are compared with
    one of its nodes first; nodes that this leaves in different components are compared with
    other pivots and at last with each other, so large groups of near copies cost about one
    comparison a copy, and no link between components is missed.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    stats = scratch.keep(_statistics(docs), "statistics")
    members = stats.where("token IS NULL").select("id", "node", "n", *SKETCH)
    second, third = _frequent_filters(stats.where("token IS NOT NULL").select("token", "df"))
    hits = scratch.keep(_shared_entries(_index(docs, second, third)), "shared-entries")
    edges = _links(docs, hits, members, scratch)
    labels = connected_components(edges, scratch)

    nodes = members.join(labels, "node", "left").select(
        "id", "n", F.coalesce("component", "node").alias("root")
    )
    smallest = scratch.keep(
        nodes.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("smallest")), "smallest"
    )
    return nodes.join(smallest, "root", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("smallest", "id").alias("component_id"),
    )


# ------------------------------------------------------------------ sets and their frequencies


def _node(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) >> 1


def _sketch(tokens: np.ndarray) -> np.ndarray:
    odd = np.bincount((tokens & np.uint64(64 * len(SKETCH) - 1)).astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class _Seen(set):
    """Remembers a bounded number of values."""

    def new(self, value: int) -> bool:
        if value in self:
            return False
        if len(self) >= REMEMBER:
            self.clear()
        self.add(value)
        return True


def _statistics(docs: DataFrame) -> DataFrame:
    """Rows (id, node, n, sketch) of all documents, and rows (token, df) of all frequent shingles.

    Each task sends its sorted shingles, Golomb-coded, to the owners of their hash ranges,
    which count them. Repeats of a set within a task are counted once.
    """
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["id"].dataType
    schema = T.StructType([
        T.StructField("owner", T.IntegerType()), T.StructField("sent", T.BinaryType()),
        T.StructField("id", id_type), T.StructField("node", T.LongType()), T.StructField("n", T.IntegerType()),
        *(T.StructField(x, T.LongType()) for x in SKETCH),
    ])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kept, size, at = _Seen(), [], 0, 0

        def flush() -> pa.RecordBatch:
            tokens = np.sort(np.concatenate(kept)) if kept else np.empty(0, np.uint64)
            bounds = np.searchsorted(tokens, [(o << 48) // owners for o in range(owners + 1)])
            parts = [(o, golomb.encode(tokens[a:b])) for o, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
            return pa.RecordBatch.from_arrays(
                [pa.array([o for o, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary()), pa.nulls(len(parts), id_arrow),
                 pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int32()), *[pa.nulls(len(parts), pa.int64())] * len(SKETCH)],
                schema.names)

        for batch in batches:
            ids, nodes, counts, sketches = batch.column("id"), [], [], []
            id_arrow = ids.type
            for words in words_of(batch.column("text")):
                tokens = shingles(words)
                counts.append(len(tokens))
                sketches.append(_sketch(tokens))
                nodes.append(_node(tokens) if len(tokens) else None)
                if len(tokens) and seen.new(nodes[-1]):
                    kept.append(tokens)
                    size += len(tokens)
                    if size >= SEND:
                        yield flush()
                        kept, size = [], 0
            n = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.arange(at, at + n) * 7919 % owners).astype(np.int32)), pa.nulls(n, pa.binary()), ids,
                 pa.array(nodes, pa.int64()), pa.array(counts, pa.int32()), *(pa.array(x) for x in np.reshape(np.array(sketches, np.int64), (n, -1)).T)],
                schema.names)
            at += n
        if kept:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        received: dict[int, list[bytes]] = {}
        for batch in batches:
            rows = batch.filter(batch.column("sent").is_null())
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), *rows.drop_columns(["owner", "sent"]).columns], out.names)
            id_arrow = rows.column("id").type
            for owner, sent in zip(batch.column("owner").to_pylist(), batch.column("sent").to_pylist(), strict=True):
                if sent is not None:
                    received.setdefault(owner, []).append(sent)
        while received:
            tokens = np.sort(np.concatenate([golomb.decode(x) for x in received.popitem()[1]]))
            first = np.flatnonzero(np.diff(tokens, prepend=tokens[0] + np.uint64(1)))
            df = np.diff(first, append=len(tokens))
            first, df = first[df >= FREQUENT], df[df >= FREQUENT]
            n = len(df)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[first].astype(np.int64)), pa.array(df.astype(np.int32)), pa.nulls(n, id_arrow), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
                 *[pa.nulls(n, pa.int64())] * len(SKETCH)], out.names)

    out = T.StructType([T.StructField("token", T.LongType()), T.StructField("df", T.IntegerType()), *schema.fields[2:]])
    return docs.mapInArrow(send, schema).repartition(owners, "owner").mapInArrow(count, out)


def _frequent_filters(frequent: DataFrame) -> tuple[HashFilter, HashFilter]:
    """Bitmaps of the frequent and of the very frequent shingles."""
    levels = {r["level"]: r["count"] for r in frequent.groupBy(F.floor(F.log2("df")).alias("level")).count().collect()}
    least = FREQUENT
    size = lambda: sum(n for level, n in levels.items() if 2**level >= least)
    while size() > (1 << MAX_BITS) // 16:
        least *= 2
    bits = bits_for(size())
    return tuple(build_filter(frequent.where(F.col("df") >= x), "token", bits) for x in (least, least * VERY))


# ------------------------------------------------------------------------------- index entries


def _bands(n: int) -> list[int]:
    """Lower ends of the size bands in which a set of n tokens is indexed: its own, and the
    next one if a similar set can lie there. Hash classes are the same within a band."""
    low = 4
    while 2 * low <= n:
        low *= 2
    return [low, 2 * low] if OF * n >= NEED * 2 * low else [low]


def entries(tokens: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set, and for each how many tokens a set lacks at least with which it is
    the first one shared: ``tokens`` sorted, ``level`` 0 (rare), 1 or 2 for each."""
    n = len(tokens)
    if n <= 3:  # similar only to an equal set
        return mix(tokens.sum(keepdims=True, dtype=np.uint64) + np.uint64(n)), np.zeros(1, np.int32)
    differ = n - (NEED * n + OF - 1) // OF
    order = np.argsort(level, kind="stable")
    tokens, level = tokens[order], level[order]
    rare = min(differ + 1, int(np.count_nonzero(level == 0)))
    if rare == differ + 1:
        return tokens[:rare], np.arange(rare, dtype=np.int32)
    found, before = [tokens[:rare]], [np.arange(rare)]
    for low in _bands(n):
        classes = np.uint64(max(1, low // 10))
        group = np.where(level == 0, np.arange(n), n + level * int(classes) + (tokens % classes).astype(np.int64))
        by_group = np.argsort(group, kind="stable")
        sizes = np.unique(group, return_counts=True)[1]
        rank = np.empty(n, np.int64)
        rank[by_group] = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        reached = np.cumsum(rank >= level)
        end = int(np.searchsorted(reached, differ + 1)) + 1
        members: dict[int, list[int]] = {}
        for i in np.flatnonzero(level[:end]):
            members.setdefault(int(group[i]), []).append(i)
        for own in members.values():
            own = sorted(own, key=lambda i: tokens[i])
            chosen = np.array(list(combinations(own, int(level[own[0]]) + 1)), dtype=np.int64)
            if len(chosen):
                mixed = np.full(len(chosen), low, np.uint64)
                for column in chosen.T:
                    mixed = mix(mixed + tokens[column] * np.uint64(0x9E3779B97F4A7C15))
                last = chosen.max(axis=1)
                found.append(mixed)
                before.append(reached[last] - (rank >= level)[last])
    return np.concatenate(found), np.concatenate(before).astype(np.int32)


def _index(docs: DataFrame, second: HashFilter, third: HashFilter) -> DataFrame:
    """Rows (entry, node, n, before) of the index."""
    filters = docs.sparkSession.sparkContext.broadcast((second, third))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, (second, third) = _Seen(), filters.value
        for batch in batches:
            found, nodes, sizes = [], [], []
            for words in words_of(batch.column("text")):
                tokens = shingles(words)
                if len(tokens) and seen.new(node := _node(tokens)):
                    frequent = second(tokens)
                    level = frequent.astype(np.int64)
                    level[frequent] += third(tokens[frequent])
                    found.append(entries(tokens, level))
                    nodes.append(node)
                    sizes.append(len(tokens))
            if found:
                each = [len(x) for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x for x, _ in found]).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), each)),
                     pa.array(np.repeat(np.array(sizes, np.int32), each)), pa.array(np.concatenate([x for _, x in found]))],
                    ["entry", "node", "n", "before"])

    return docs.select("text").mapInArrow(index, "entry long, node long, n int, before int")


#: Two sets can be similar and this entry the first that they share. A pair that fails this
#: at one entry and is similar passes it at its first one.
_MAY_LINK = f"{NEED + OF} * LEAST(n - before, other_n - other_before) >= {NEED} * (n + other_n)"


#: Sets differ in as many shingles at least as their sketches in bits.
_FEW_DIFFER = f"{NEED + OF} * ({' + '.join(f'bit_count({c} ^ other_{c})' for c in SKETCH)}) <= {OF - NEED} * (n + other_n)"


def _beside(pivot: str, *columns: str) -> list:
    """The columns of a node, and those of a struct column under the names of the other node."""
    return [*columns, *(F.col(f"{pivot}.{c}").alias(f"other_{c}" if c != "node" else "other") for c in columns)]


def _shared_entries(index: DataFrame) -> DataFrame:
    """Every node of an entry but its first, beside that first one."""
    columns = ("node", "n", "before")
    first = F.first(F.struct(*columns)).over(Window.partitionBy("entry").orderBy("node"))
    return index.withColumn("first", first).where("first.node <> node").select("entry", *_beside("first", *columns))


# ------------------------------------------------------------------------------- verification


def _pack(tokens: np.ndarray) -> bytes:
    return tokens.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tokens) of ``nodes``, and of few besides."""
    wanted = docs.sparkSession.sparkContext.broadcast(build_filter(nodes, "node", bits_for(nodes.count())))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, wants = _Seen(), wanted.value
        for batch in batches:
            nodes, sets = [], []
            for words in words_of(batch.column("text")):
                tokens = shingles(words)
                if len(tokens) and seen.new(node := _node(tokens)) and wants(np.array([node], np.uint64))[0]:
                    nodes.append(node)
                    sets.append(_pack(tokens))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "tokens"])

    found = docs.select("text").mapInArrow(collect, "node long, tokens binary")
    return found.groupBy("node").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough."""
    sets = scratch.keep(_sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column("tokens_a"), batch.column("tokens_b"), strict=True)):
                x, y = _unpack(x.as_buffer()), _unpack(y.as_buffer())
                both = np.sort(np.concatenate([x, y]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = OF * shared >= NEED * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    for side in ("a", "b"):
        named = sets.select(F.col("node").alias(side), F.col("tokens").alias(f"tokens_{side}"))
        pairs = pairs.join(named, side)
    links = scratch.keep(pairs.select("a", "b", "tokens_a", "tokens_b").mapInArrow(verify, "a long, b long"), "links")
    scratch.drop(sets)
    return links


def _links(docs: DataFrame, hits: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """Verified links (a, b) with the same components as all links have."""
    ordered = (F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    tested = scratch.keep(hits.where(_MAY_LINK).select(*ordered).distinct(), "pairs")
    edges = _verified(tested, docs, scratch)
    columns = ("node", "n", "before")
    nodes = hits.select("entry", *columns).union(hits.select("entry", "other", "other_n", "other_before").distinct())
    at_entry = Window.partitionBy("entry")
    size = F.count("*").over(at_entry)
    left = nodes.withColumn("size", size).where("size > 2").drop("size")  # a pair has been tested
    for step in range(PIVOT_ROUNDS + 1):
        labels = connected_components(edges, scratch)
        ends = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
        left = (
            left.select("entry", *columns).join(labels.join(ends, "node"), "node", "left")
            .select("entry", *columns, F.coalesce("component", "node").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree"))
            .withColumn("mixed", F.min("component").over(at_entry) != F.max("component").over(at_entry))
            .where("mixed").drop("mixed")
        )
        left = scratch.keep(left, "left")
        if left.isEmpty():
            return edges
        bound = _MAY_LINK
        if step < PIVOT_ROUNDS:  # the node with most links first, then another at each entry
            by_turn = at_entry.orderBy(F.desc("degree") if step == 0 else F.xxhash64("node", "entry"), "node")
            pivots = left.withColumn("p", F.first(F.struct(*columns, "component")).over(by_turn))
            pairs = pivots.select("entry", *_beside("p", *columns, "component"))
        else:
            sketches = members.groupBy("node").agg(*(F.first(c).alias(c) for c in SKETCH))
            left = scratch.keep(left.join(sketches, "node"), "sketched")
            others = left.select("entry", *(F.col(c).alias(f"other_{c}" if c != "node" else "other") for c in (*columns, "component", *SKETCH)))
            pairs = left.join(others, "entry").where("node < other")
            bound += f" AND {_FEW_DIFFER}"
        pairs = pairs.where(f"component <> other_component AND {bound}").select(*ordered).distinct()
        pairs = scratch.keep(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            edges = edges.union(_verified(pairs, docs, scratch))
        tested = tested.union(pairs)
    return edges
