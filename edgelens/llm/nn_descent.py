"""Near-duplicate embeddings by NN-descent.

A neighbour graph starts from vectors that are adjacent when sorted by sign signatures, and is
refined by joining each vector's neighbours with each other. Links are the pairs found with the
threshold's cosine or more. A vector whose list holds nothing but links is saturated: its list
becomes its whole component, which is compared in tiles that return counts, not pairs. An audit
against all rows measures the recall and adds signatures while it is too low.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm.components import connected_components
from edgelens.llm.scratch import Scratch

THRESHOLD = 0.98
#: Length of a neighbour list, signature tables of one start, neighbours taken after each vector
#: in a sorted table, and rounds of refinement.
NEIGHBOURS, TABLES, REACH, ROUNDS = 16, 6, 8, 3
#: Vectors of a tile's side.
TILE = 2048
#: Vectors of the audit, the recall that it asks for, and starts until it gives up.
AUDIT, RECALL, STARTS = 256, 0.97, 4
SEED = 23
#: Bytes of the vectors that a task compares at once.
_CHUNK = 16_000_000


def embedding_near_duplicates(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """Links and components of vectors with one label and a cosine of ``threshold`` or more.

    Returns one row per row: the id, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable by links, itself included) and ``kept`` (whether the
    two are equal; true for a null id). Cosines are in double precision. Vectors that are null,
    empty, zero, or hold null or non-finite components, and those with a null label, link with
    nothing; vectors of different lengths never link. Rows with equal label and vector are one
    node and link with each other; repeated ids keep their rows. Further columns are ignored; an
    empty table gives an empty result. No pair below the threshold is linked; pairs may be
    missed, by how many ``audit_recall`` tells.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "nn-descent")
    is_vector = f"""label IS NOT NULL AND vector IS NOT NULL AND exists(vector, x -> x <> 0)
        AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"""
    rows = embeddings.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    ).withColumn("node", F.expr(f"IF(coalesce({is_vector}, false), xxhash64(label, vector), NULL)"))
    nodes = scratch.keep(_nodes(rows), "nodes")

    links = None
    for start in range(STARTS):
        found = _descend(nodes, threshold, start, scratch)
        links = found if links is None else scratch.keep(links.union(found).distinct(), "links")
        labels = connected_components(links.select("a", "b"), scratch)
        counts = scratch.keep(_counts(nodes, links, labels, threshold), "counts")
        if audit_recall(nodes, counts, threshold) >= RECALL:
            break

    members = rows.select("id", "node").join(counts, "node", "left").join(labels, "node", "left").select(
        "id", "n_links", F.coalesce("component", "node").alias("root")
    )
    smallest = scratch.keep(members.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("smallest")), "smallest")
    return members.join(smallest, "root", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("smallest", "id").alias("component_id"),
        F.expr("id <=> coalesce(smallest, id) OR id IS NULL").alias("kept"),
    )


def _nodes(rows: DataFrame) -> DataFrame:
    """(node, label hash, dim, copies, vec): distinct vectors at unit length as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = []
            for vector in batch.column("vector"):
                vector = np.asarray(vector.values, np.float64)
                vector = vector / np.abs(vector).max()
                vecs.append((vector / np.linalg.norm(vector)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("group"), pa.array(vecs, pa.binary())], ["node", "group", "vec"])

    group = F.xxhash64("label", F.size("vector")).alias("group")
    packed = rows.where("node IS NOT NULL").select("node", group, "vector").mapInArrow(pack, "node long, group long, vec binary")
    return packed.groupBy("node").agg(F.first("group").alias("group"), F.count("*").alias("copies"), F.first("vec").alias("vec"))


def _matrix(vecs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in vecs), np.float64).reshape(len(vecs), -1)


_PAIRS = "a long, b long, cosine double"


def _pair_batch(a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cosine)], ["a", "b", "cosine"])


def _adjacent(nodes: DataFrame, floor: float, start: int) -> DataFrame:
    """Pairs of vectors near each other when sorted by sign signatures, with their cosines."""
    spark = nodes.sparkSession
    bits = min(62, max(8, nodes.count().bit_length() + 1))
    schema = "turn int, group long, signature long, node long, vec binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, dims = batch.column("vec"), batch.column("vec").to_pandas().str.len().to_numpy() // 8
            signatures = np.zeros((TABLES, len(batch)), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                planes = np.random.default_rng([SEED, start, int(dim)]).standard_normal((int(dim), TABLES * bits))
                side = (_matrix(vecs.take(pa.array(at))) @ planes > 0).reshape(len(at), TABLES, bits)
                signatures[:, at] = (side @ (1 << np.arange(bits, dtype=np.int64))).T
            for turn in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), turn, np.int32)), batch.column("group"), pa.array(signatures[turn]), batch.column("node"), vecs],
                    ["turn", "group", "signature", "node", "vec"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            batch = pa.Table.from_batches([batch])
            if tail is not None:
                batch = pa.concat_tables([tail, batch])
            if len(batch) < 2:
                tail = batch
                continue
            node, group, turn = (batch.column(c).to_numpy() for c in ("node", "group", "turn"))
            vecs = batch.column("vec").combine_chunks()
            dims = batch.column("vec").to_pandas().str.len().to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                unit = _matrix(vecs.take(pa.array(at)))
                for step in range(1, min(REACH, len(at) - 1) + 1):
                    x, y = at[:-step], at[step:]
                    cosine = np.einsum("ij,ij->i", unit[:-step], unit[step:])
                    near = (group[x] == group[y]) & (turn[x] == turn[y]) & (cosine >= floor) & (node[x] != node[y])
                    yield _pair_batch(node[x][near], node[y][near], cosine[near])
            tail = batch.slice(max(0, len(batch) - REACH))

    order = ("turn", "group", "signature", "node")
    sorted_rows = (
        nodes.select("node", "group", "vec").mapInArrow(sign, schema)
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    )
    return sorted_rows.mapInArrow(compare, _PAIRS)


def _join_neighbours(lists: DataFrame, nodes: DataFrame, floor: float) -> DataFrame:
    """Pairs of vectors that are in one list, with their cosines."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(table: pa.Table) -> Iterator[pa.RecordBatch]:
            owner, node = table.column("owner").to_numpy(), table.column("node").to_numpy()
            vecs = table.column("vec").combine_chunks()
            bounds = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1, append=owner[-1] + 1))
            found = []
            for x, y in zip(bounds[:-1], bounds[1:], strict=True):
                if y - x > 1:
                    unit = _matrix(vecs.slice(x, y - x))
                    i, j = np.triu_indices(y - x, 1)
                    cosine = (unit @ unit.T)[i, j]
                    near = cosine >= floor
                    found.append((node[x:y][i[near]], node[x:y][j[near]], cosine[near]))
            if found:
                yield _pair_batch(*(np.concatenate(x) for x in zip(*found, strict=True)))

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            owner = table.column("owner").to_numpy()
            cut = int(np.searchsorted(owner, owner[-1])) if len(owner) else 0
            if cut:
                yield from of(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and len(rest):
            yield from of(rest)

    vectors = lists.select("owner", F.col("other").alias("node")).join(nodes.select("node", "vec"), "node")
    own = nodes.select(F.col("node").alias("owner"), "node", "vec").join(lists.select("owner").distinct(), "owner", "left_semi")
    rows = vectors.select("owner", "node", "vec").union(own.select("owner", "node", "vec"))
    return rows.repartition("owner").sortWithinPartitions("owner").mapInArrow(compare, _PAIRS)


def _descend(nodes: DataFrame, threshold: float, start: int, scratch: Scratch) -> DataFrame:
    """Links (a, b, cosine) after refining one start's graph.

    Only neighbours that could share a linked neighbour are listed: two vectors linked to one
    vector are at most twice the threshold's angle apart.
    """
    floor = 2 * threshold**2 - 1
    best = Window.partitionBy("owner").orderBy(F.desc("cosine"), "other")
    pairs = scratch.keep(_adjacent(nodes, floor, start).distinct(), "pairs")
    links = pairs.where(F.col("cosine") >= threshold).select("a", "b").distinct()
    before = links.count()
    for _ in range(ROUNDS):
        both = pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
        both = both.select(F.col("a").alias("owner"), F.col("b").alias("other"), "cosine").union(both.select("b", "a", "cosine"))
        lists = both.withColumn("at", F.row_number().over(best)).where(F.col("at") <= NEIGHBOURS).select("owner", "other", "cosine")
        lists = scratch.keep(lists, "lists")
        joined = scratch.keep(_join_neighbours(lists, nodes, floor).groupBy("a", "b").agg(F.max("cosine").alias("cosine")), "joined")
        links = scratch.keep(links.union(joined.where(F.col("cosine") >= threshold).select("a", "b")).distinct(), "links")
        pairs = joined.union(lists.select(F.least("owner", "other"), F.greatest("owner", "other"), "cosine"))
        after = links.count()
        if after <= before * 1.001:
            break
        before = after
    return links


def _counts(nodes: DataFrame, links: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(node, n_links) of all nodes.

    Components without a saturated vector count their links. In the others every vector is
    compared with its whole component: its vectors are dealt over blocks, and each pair of
    blocks is a tile of bounded size.
    """
    copies = nodes.select("node", "copies")
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    degrees = both.join(copies.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(
        F.count("*").alias("degree"), F.sum("copies").alias("linked")
    )
    saturated = degrees.where(F.col("degree") >= NEIGHBOURS).join(labels, "node").select("component").distinct()
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    dense = labels.join(sizes.join(saturated, "component"), "component").join(nodes, "node")
    side = F.ceil(F.col("size") / TILE).cast("int")
    tiles = (
        dense.withColumn("sides", side).withColumn("own", F.pmod(F.hash("node", F.lit(1)), F.col("sides")))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .select("component", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "node", "copies", "vec")
    )

    def tile(table: pa.Table) -> pa.Table:
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        node, copies, unit = table.column("node").to_numpy(), table.column("copies").to_numpy(), _matrix(table.column("vec").combine_chunks())
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = np.zeros(len(node), np.int64)
        step = max(1, _CHUNK // (8 * max(1, len(right))))
        for at in range(0, len(left), step):
            rows = left[at : at + step]
            near = unit[rows] @ unit[right].T >= threshold
            if i[0] == j[0]:
                near &= node[rows][:, None] != node[right][None, :]
            found[rows] += near @ copies[right]
            if i[0] != j[0]:
                found[right] += copies[rows] @ near
        return pa.table({"node": node, "linked": found})

    exact = tiles.groupBy("component", "i", "j").applyInArrow(tile, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("exact"))
    return (
        copies.join(degrees.select("node", "linked"), "node", "left").join(exact, "node", "left")
        .select("node", (F.coalesce("exact", "linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )


def audit_recall(nodes: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT) -> float:
    """Share of the true links of ``queries`` vectors (those with the smallest hash) that
    ``counts`` has; all rows are compared with them."""
    picked = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(queries).join(counts, "node").select("node", "group", "vec", "n_links").collect()
    if not picked:
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast([(r.node, r.group, bytes(r.vec)) for r in picked])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list[tuple[int, bytes]]] = {}
        for node, group, vec in shared.value:
            own.setdefault(group, []).append((node, vec))
        for batch in batches:
            group = batch.column("group").to_numpy()
            found: dict[int, int] = {}
            for key, asked in own.items():
                at = np.flatnonzero(group == key)
                if len(at):
                    unit = _matrix(batch.column("vec").take(pa.array(at)))
                    near = np.stack([np.frombuffer(v, np.float64) for _, v in asked]) @ unit.T >= threshold
                    found |= dict(zip([n for n, _ in asked], (near @ batch.column("copies").to_numpy()[at]).tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["node", "linked"])

    true = nodes.mapInArrow(compare, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("linked")).collect()
    expected = sum(r.linked - 1 for r in true)
    return min(1.0, sum(r.n_links for r in picked) / expected) if expected else 1.0
