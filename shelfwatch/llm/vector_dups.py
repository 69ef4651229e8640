"""Near-duplicate vectors from a neighbour graph that is refined by descent.

Every distinct vector is a node with a short list of its nearest known nodes. The lists start
from a few random orders of the vectors, cut into blocks. Then a round joins each node's
neighbours with each other: what is near to both ends of an edge is often near itself. Only
pairs with an edge that is new in this round are compared, and a pair is passed on only if it
beats the last entry of a list. A list whose every entry may be a link is saturated and grows;
nodes that are saturated at the greatest length stand in dense groups and are counted there
exactly, without lists.

Lists are ranked by dot products of 8-bit copies of the vectors, which are whole numbers and so
alike in every task. Each copy knows how far it is from its vector, so a pair that may reach the
threshold is never ranked out by rounding; the exact cosine of the original vectors decides.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, stored, wide_batches
from .graph import components

THRESHOLD = 0.95
#: Entries of a list at first and at most; random orders to start from and nodes of a block in them.
SHORT, LONGEST, ORDERS, BLOCK = 8, 32, 8, 32
#: Rounds at least and at most after a start; what the audit asks for, its sampled vectors and repeats.
LEAST_ROUNDS, MOST_ROUNDS, RECALL, SAMPLE, AUDITS = 2, 8, 0.99, 1024, 3
#: Vectors of a dense group that are compared at once; classes of equal vectors that may be broadcast.
DENSE_BLOCK, CLASSES = 512, 500_000
_LEVELS = 127

_NODE = "node long, code binary, scale float, gap float"
_EDGE = "node long, other long, near float, hot boolean"


def _key(vector: np.ndarray) -> bytes:
    return hashlib.blake2b(vector.tobytes(), digest_size=16).digest()


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, key, vector): vectors in double precision, both null where one takes no part."""
    for batch in batches:
        lists = batch.column(1)
        ids, keys, vectors = batch.column(0).to_pylist(), [], []
        flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
        bounds = lists.offsets.to_numpy()
        for row in range(len(lists)):
            # Adding 0 makes -0 and 0 alike.
            v = flat[bounds[row] : bounds[row + 1]] + 0.0
            good = lists[row].is_valid and ids[row] is not None and len(v) and np.isfinite(v).all() and v.any()
            keys.append(_key(v) if good else None)
            vectors.append(v if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.list_(pa.float64()))],
            names=["vec_id", "key", "vector"],
        )


def _unit(vector: np.ndarray) -> np.ndarray:
    # Scaling by a power of two is exact and keeps squares from running over.
    v = np.ldexp(vector, -int(np.frexp(np.abs(vector).max())[1]))
    return v / np.sqrt((v * v).sum())


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 8-bit copy of each node's unit vector, its scale, and its distance from the vector."""
    for batch in batches:
        codes, scales, gaps = [], [], []
        for vector in batch.column(1):
            u = _unit(vector.values.to_numpy())
            scale = np.float32(np.abs(u).max() / _LEVELS)
            code = np.clip(np.rint(u / scale), -_LEVELS, _LEVELS).astype(np.int8)
            codes.append(code.tobytes())
            scales.append(scale)
            # A little more than the distance, so that rounding to 32 bits stays on the safe side.
            gaps.append(np.float32(np.linalg.norm(u - code * np.float64(scale)) * 1.0001 + 1e-6))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(codes, pa.binary()), pa.array(scales, pa.float32()), pa.array(gaps, pa.float32())],
            names=["node", "code", "scale", "gap"],
        )


def _matrix(codes: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    # Whole numbers: 32-bit products are exact up to a thousand components.
    return rows.astype(np.float32 if rows.shape[1] <= 1024 else np.float64)


def _nearness(codes: list[bytes], scale: np.ndarray, gap: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(near, may be a link) of every two nodes of a block."""
    rows = _matrix(codes)
    near = (rows @ rows.T).astype(np.float64) * (scale[:, None].astype(np.float64) * scale)
    slack = gap[:, None].astype(np.float64) + gap + gap[:, None].astype(np.float64) * gap
    return near, near + slack >= threshold


def _edges(node: np.ndarray, other: np.ndarray, near: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(other), pa.array(near.astype(np.float32)), pa.array(hot)],
        names=["node", "other", "near", "hot"],
    )


def _ordered(orders: range):
    """Each node once for every random order, with its place there: the signs of random projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            n = len(batch)
            codes = batch.column(1).to_pylist()
            sizes = np.array([len(c) for c in codes])
            places = np.zeros((len(orders), n), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                if size not in planes:
                    draw = [np.random.default_rng([7, t, int(size)]).standard_normal((size, 62)) for t in orders]
                    planes[size] = np.concatenate(draw, axis=1).astype(np.float32)
                signs = _matrix([codes[r] for r in rows]).astype(np.float32) @ planes[size] > 0
                bits = np.int64(1) << np.arange(61, -1, -1, dtype=np.int64)
                places[:, rows] = (signs.reshape(len(rows), len(orders), 62) * bits).sum(axis=2).T
            take = pa.array(np.tile(np.arange(n), len(orders)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(orders.start, orders.stop, dtype=np.int32), n)),
                    pa.array(np.tile(sizes, len(orders)).astype(np.int32)),
                    pa.array(places.ravel()),
                    *[c.take(take) for c in batch.columns],
                ],
                names=["turn", "size", "place", "node", "code", "scale", "gap"],
            )

    return run


def _blocks(keep: int, threshold: float):
    """The nearest nodes of each node in its block of a sorted partition."""

    def block(rows: pa.RecordBatch) -> pa.RecordBatch:
        node = rows.column(3).to_numpy()
        near, hot = _nearness(rows.column(4).to_pylist(), rows.column(5).to_numpy(), rows.column(6).to_numpy(), threshold)
        np.fill_diagonal(near, -np.inf)
        k = min(keep, len(node) - 1)
        best = np.argsort(-near, axis=1, kind="stable")[:, :k]
        row = np.repeat(np.arange(len(node)), k)
        best = best.ravel()
        return _edges(node[row], node[best], near[row, best], hot[row, best])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            turn, size = (held.column(c).to_numpy() for c in (0, 1))
            cuts = np.flatnonzero((np.diff(turn) != 0) | (np.diff(size) != 0)) + 1
            at = 0
            while True:
                cut = cuts[cuts > at]
                border = int(cut[0]) if len(cut) else len(held)
                # The last block of an order is not left short; one that may go on is held back.
                if border - at >= 2 * BLOCK:
                    yield block(held.slice(at, BLOCK))
                    at += BLOCK
                elif len(cut):
                    if border - at > 1:
                        yield block(held.slice(at, border - at))
                    at = border
                else:
                    break
            held = held.slice(at)
        if held is not None and len(held) > 1:
            yield block(held)

    return run


def _joined(threshold: float):
    """Pairs within the neighbours of each centre that beat the last entry of a list."""

    def group(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        node, fresh = rows.column(1).to_numpy(), rows.column(2).to_numpy(zero_copy_only=False)
        node, first = np.unique(node, return_index=True)
        # Sorted with new edges first: a neighbour in both directions is new if one of them is.
        fresh = fresh[first]
        if len(node) < 2 or not fresh.any():
            return None
        rows = rows.take(pa.array(first))
        near, hot = _nearness(rows.column(3).to_pylist(), rows.column(4).to_numpy(), rows.column(5).to_numpy(), threshold)
        last = rows.column(6).to_numpy()
        gain = (near.astype(np.float32) > last[:, None]) & (fresh[:, None] | fresh)
        np.fill_diagonal(gain, False)
        a, b = np.nonzero(gain)
        edges = _edges(node[a], node[b], near[a, b], hot[a, b])
        return edges.append_column("length", rows.column(7).take(pa.array(a)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            centre = held.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(centre)) + 1]) if len(centre) else np.zeros(1, np.int64)
            found = [group(held.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:])]
            found = [f for f in found if f is not None]
            if sum(map(len, found)):
                yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
            held = held.slice(int(cuts[-1]))
        if held is not None and len(held):
            found = group(held)
            if found is not None:
                yield found

    return run


_LIST = ["node", "other", "near", "hot", "length", "fresh", "rank", "last", "saturated", "moved"]


def _lists(edges: DataFrame) -> DataFrame:
    """The best ``length`` entries of each node of edges (node, other, near, hot, length, fresh).

    Spark cuts to the longest list before its shuffle. Each row also has what concerns its whole
    list: ``last``, the nearness that a new entry must beat, whether all entries of a full list
    may be links (``saturated``), and whether one of them is new (``moved``).
    """
    best = Window.partitionBy("node").orderBy(F.col("near").desc(), "other")
    whole = Window.partitionBy("node")
    ranked = edges.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= LONGEST)
    kept = ranked.filter("rank <= length")
    full = F.count(F.lit(1)).over(whole) >= F.col("length")
    return kept.withColumns(
        {
            "last": F.when(full, F.min("near").over(whole)).otherwise(F.lit(-2.0).cast("float")),
            "saturated": full & F.min("hot").over(whole),
            "moved": F.max("fresh").over(whole),
        }
    ).select(*_LIST)


def _start(nodes: DataFrame, orders: range, threshold: float) -> DataFrame:
    turns = "turn int, size int, place long, " + _NODE
    with wide_batches(nodes.sparkSession):
        placed = nodes.mapInArrow(_ordered(orders), turns)
        placed = placed.repartitionByRange("turn", "size", "place").sortWithinPartitions("turn", "size", "place", "node")
        # A node brings as many entries as there are orders times SHORT, so nodes are no hot keys here.
        return stored(placed.mapInArrow(_blocks(SHORT, threshold), _EDGE).repartition("node").distinct(), "vector-blocks")


def _round(graph: DataFrame, nodes: DataFrame, turn: int, threshold: float) -> DataFrame:
    """One round of neighbours' neighbours: every two neighbours of a node meet if one of them is new to it.

    A node looks from all its own list and, of the lists that it stands in, from about as many
    as its own list is long, drawn by a hash: a hub that stands in very many is no hot group.
    """
    spark = graph.sparkSession
    heads = graph.filter("rank = 1").select(F.col("node").alias("centre"), "length", "last", "moved")
    incoming = graph.groupBy(F.col("other").alias("centre")).agg(F.count(F.lit(1)).alias("lists"), F.max("fresh").alias("found"))
    centres = heads.join(incoming, "centre", "left").filter(F.col("moved") | F.coalesce("found", F.lit(False)))
    centres = bounded_broadcast(stored(centres.select("centre", "length", F.coalesce("lists", F.lit(0)).alias("lists")), "centres"))
    draw = F.pmod(F.xxhash64("node", "other", F.lit(turn)), F.lit(1 << 20)) * F.col("lists") < F.col("length") * (1 << 20)
    forward = graph.select(F.col("node").alias("centre"), F.col("other").alias("node"), "fresh").join(centres.select("centre"), "centre")
    back = graph.select(F.col("other").alias("centre"), "node", "other", "fresh").join(centres, "centre").filter(draw)
    known = nodes.join(graph.filter("rank = 1").select("node", "last", "length"), "node")
    members = (
        forward.union(back.select("centre", "node", "fresh"))
        .join(known, "node")
        .select("centre", "node", "fresh", "code", "scale", "gap", "last", "length")
        .repartition("centre")
        .sortWithinPartitions("centre", "node", F.col("fresh").desc())
    )
    with wide_batches(spark, 4_096):
        new = members.mapInArrow(_joined(threshold), _EDGE + ", length int").withColumn("fresh", F.lit(True))
        both = graph.select(*new.columns[:5], F.lit(False).alias("fresh")).union(new).groupBy("node", "other")
        merged = both.agg(
            F.max("near").alias("near"), F.max("hot").alias("hot"), F.max("length").alias("length"), F.min("fresh").alias("fresh")
        )
        return stored(_lists(merged), "neighbour-lists")


def _grown(graph: DataFrame) -> DataFrame | None:
    """The graph with saturated lists twice as long and only their edges new again, None if none can grow."""
    grows = F.col("saturated") & (F.col("length") < LONGEST)
    if graph.filter(grows).isEmpty():
        return None
    return graph.select(
        "node", "other", "near", "hot",
        F.when(grows, F.least(F.col("length") * 2, F.lit(LONGEST))).otherwise(F.col("length")).alias("length"),
        grows.alias("fresh"),
        "rank",
        F.when(grows, F.lit(-2.0).cast("float")).otherwise(F.col("last")).alias("last"),
        (F.col("saturated") & ~grows).alias("saturated"),
        grows.alias("moved"),
    )


def neighbour_graph(nodes: DataFrame, threshold: float, orders: range, known: DataFrame | None = None) -> DataFrame:
    """Rows (node, other, near, hot, ...) of the lists after descent from new random orders.

    Rounds end when one finds hardly any possible link outside saturated lists: a thousandth of
    those known. Then saturated lists grow, and rounds go on until none can.
    """
    start = _start(nodes, orders, threshold)
    first = start.select(*start.columns, F.lit(SHORT).alias("length"), F.lit(True).alias("fresh"))
    if known is not None:
        # A node keeps the length that its list has grown to.
        grown = known.filter("rank = 1").select("node", F.col("length").alias("grown"))
        first = first.join(grown, "node", "left").withColumn("length", F.coalesce("grown", "length")).drop("grown")
        first = known.select(*first.columns[:5], F.lit(False).alias("fresh")).union(first).groupBy("node", "other").agg(
            F.max("near").alias("near"), F.max("hot").alias("hot"), F.max("length").alias("length"), F.min("fresh").alias("fresh")
        )
    graph = stored(_lists(first), "neighbour-lists")
    rounds = 0
    while True:
        graph = _round(graph, nodes, rounds, threshold)
        rounds += 1
        links, new = graph.filter("not saturated and hot").agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if rounds < LEAST_ROUNDS or (1000 * new > links and rounds % MOST_ROUNDS):
            continue
        longer = _grown(graph)
        if longer is None:
            return graph
        graph = longer


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, cosine) with one fixed order of additions for each pair."""
    for batch in batches:
        out = np.zeros(len(batch))
        for row, (u, v) in enumerate(zip(batch.column(2), batch.column(3))):
            out[row] = (_unit(u.values.to_numpy()) * _unit(v.values.to_numpy())).sum()
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out)], names=["a", "b", "cosine"])


def _confirmed(graph: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Rows (a, b) of the pairs of the lists whose exact cosine reaches the threshold, a < b."""
    pairs = graph.filter("hot").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    pairs = stored(pairs, "maybe-links")
    ends = bounded_broadcast(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    vectors = vectors.select("node", "vector").join(ends, "node", "left_semi")
    left = vectors.select(F.col("node").alias("a"), F.col("vector").alias("u"))
    right = vectors.select(F.col("node").alias("b"), F.col("vector").alias("v"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "u", "v")
    with wide_batches(graph.sparkSession, 2_048):
        exact = rows.mapInArrow(_cosines, "a long, b long, cosine double")
        return stored(exact.filter(F.col("cosine") >= threshold).select("a", "b"), "vector-links")


def _dense_counts(threshold: float):
    """How many vectors of the other side each vector of a block pair is linked with, by copies and by nodes."""

    def group(rows: pa.RecordBatch) -> pa.RecordBatch:
        node, side = rows.column(4).to_numpy(), rows.column(3).to_numpy()
        vectors = np.stack([_unit(v.values.to_numpy()) for v in rows.column(5)])
        copies = rows.column(6).to_numpy()
        own, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        near = vectors[own] @ vectors[other].T
        linked = near >= threshold
        # A block product may differ in its last bits; pairs that near the threshold are summed again in fixed order.
        for i, j in zip(*np.nonzero(np.abs(near - threshold) < 1e-9)):
            linked[i, j] = (vectors[own[i]] * vectors[other[j]]).sum() >= threshold
        linked &= node[own][:, None] != node[other]
        counted = (linked * copies[other]).sum(axis=1), linked.sum(axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[own]), *[pa.array(c.astype(np.int64)) for c in counted]], names=["node", "links", "nodes"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            change = np.zeros(max(len(held) - 1, 0), bool)
            for c in range(3):
                change |= np.diff(held.column(c).to_numpy()) != 0
            cuts = np.concatenate([[0], np.flatnonzero(change) + 1])
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield group(held.slice(a, b - a))
            held = held.slice(int(cuts[-1]))
        if held is not None and len(held):
            yield group(held)

    return run


def _dense(dense: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, links, nodes) of dense nodes (root, node, vector, copies, least): links with other dense nodes of the root.

    The node with the nearest list is the group's pivot. All within half of the threshold's angle
    of it are linked with each other, which needs no comparing. The others, the shell, are compared
    with all nodes of the group in blocks that come out as counts, never as pairs.
    """
    spark = dense.sparkSession
    pivots = dense.groupBy("root").agg(F.max_by("vector", F.struct("least", "node")).alias("pivot"))
    with wide_batches(spark, 2_048):
        near = dense.join(pivots, "root").select(F.col("root").alias("a"), F.col("node").alias("b"), "vector", "pivot")
        near = near.mapInArrow(_cosines, "a long, b long, cosine double")
        half = math.cos(math.acos(threshold) / 2) + 1e-9
        inner = stored(near.select(F.col("b").alias("node"), (F.col("cosine") >= half).alias("core")), "dense-core")
    rows = dense.join(inner, "node").select("root", "node", "vector", "copies", "core")
    sizes = rows.groupBy("root").agg(
        F.count(F.lit(1)).alias("size"), F.count_if("core").alias("core_nodes"), F.sum(F.when(F.col("core"), F.col("copies"))).alias("core_copies")
    )
    rows = rows.join(sizes, "root")
    among = rows.filter("core").select(
        "node", (F.col("core_copies") - F.col("copies")).alias("links"), (F.col("core_nodes") - 1).alias("nodes")
    )
    parts = F.ceil(F.col("size") / DENSE_BLOCK).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    every = F.sequence(F.lit(0), parts - 1)
    one = rows.select("root", part.alias("i"), F.explode(every).alias("j"), F.lit(0).alias("side"), "node", "vector", "copies", "core")
    two = rows.select("root", F.explode(every).alias("i"), part.alias("j"), F.lit(1).alias("side"), "node", "vector", "copies", "core")

    # Shell against all gives a shell node its links; all against shell gives a core node its links with the shell.
    def counted(own: DataFrame, other: DataFrame) -> DataFrame:
        met = own.drop("core").union(other.drop("core")).repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "side")
        with wide_batches(spark, 1_024):
            return stored(met.mapInArrow(_dense_counts(threshold), "node long, links long, nodes long"), "dense-counts")

    shell_all = counted(one.filter("not core"), two)
    core_shell = counted(one.filter("core"), two.filter("not core"))
    return among.union(shell_all).union(core_shell).groupBy("node").agg(F.sum("links").alias("links"), F.sum("nodes").alias("nodes"))


def _linked_nodes(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, links, nodes, root) of every node with a link to another: copies and nodes linked with, and its component."""
    links = _confirmed(graph, nodes, threshold)
    roots = components(links)
    # The root of a component is its smallest node and stands for itself.
    roots = stored(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "vector-roots")
    full = graph.filter((F.col("rank") == 1) & (F.col("length") >= LONGEST) & F.col("saturated"))
    full = full.select("node", F.col("last").alias("least"))
    dense = full.join(roots, "node").join(nodes.select("node", "vector", "copies"), "node")
    dense = stored(dense.select("root", "node", "vector", "copies", "least"), "dense-nodes")
    ways = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))
    seen = links.select(F.inline(ways))
    is_dense = bounded_broadcast(dense.select("node").withColumn("dense", F.lit(True)))
    # Two dense nodes are counted in their group; an open list has all links of its node.
    seen = seen.join(is_dense, "node", "left").join(
        is_dense.withColumnsRenamed({"node": "other", "dense": "other_dense"}), "other", "left"
    )
    seen = seen.filter("dense is null or other_dense is null").join(
        nodes.select(F.col("node").alias("other"), F.col("copies")), "other"
    )
    counts = seen.groupBy("node").agg(F.sum("copies").alias("links"), F.count(F.lit(1)).alias("nodes"))
    if not dense.isEmpty():
        counts = counts.union(_dense(dense, threshold)).groupBy("node").agg(F.sum("links").alias("links"), F.sum("nodes").alias("nodes"))
    return stored(counts.join(roots, "node"), "linked-vectors")


def _matches(sample: dict[int, np.ndarray], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array(sorted(sample), np.int64)
        by_size: dict[int, np.ndarray] = {}
        for i in ids:
            by_size.setdefault(len(sample[i]), []).append(i)
        for batch in batches:
            counts = dict.fromkeys(ids.tolist(), 0)
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            node = batch.column(0).to_numpy()
            for size, members in by_size.items():
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    block = np.stack([_unit(lists[int(r)].values.to_numpy()) for r in rows])
                    linked = np.stack([sample[i] for i in members]) @ block.T >= threshold
                    linked &= np.array(members)[:, None] != node[rows]
                    for i, n in zip(members, linked.sum(axis=1)):
                        counts[int(i)] += int(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["node", "true_nodes"]
            )

    return run


def audit(linked: DataFrame, nodes: DataFrame, threshold: float, sample: int = SAMPLE) -> float:
    """Share of the links of sampled nodes, as brute force over all nodes finds them, that ``linked`` has.

    The sample is ``sample`` nodes by their hash, or as many as 8 million numbers hold.
    """
    size = nodes.agg(F.max(F.size("vector"))).first()[0] or 1
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(11)), "node").limit(max(1, min(sample, 8_000_000 // size)))
    chosen = {r["node"]: _unit(np.array(r["vector"])) for r in drawn.select("node", "vector").collect()}
    with wide_batches(nodes.sparkSession, 4_096):
        true = nodes.select("node", "vector").mapInArrow(_matches(chosen, threshold), "node long, true_nodes long")
        true = true.groupBy("node").agg(F.sum("true_nodes").alias("true_nodes"))
        both = true.join(linked.select("node", "nodes"), "node", "left")
        have, want = both.agg(F.sum(F.least(F.coalesce("nodes", F.lit(0)), "true_nodes")), F.sum("true_nodes")).first()
    return 1.0 if not want else have / want


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each distinct (id, vector).

    Two vectors are linked when their cosine in double precision is ``threshold`` or more.
    ``n_links`` counts the other vectors linked directly, equal ones too; a component is named
    by its smallest vec_id, and that vector is kept. Equal vectors are one node of the graph,
    whatever their number.

    No link below the threshold is returned. Links may be missed: an audit compares a sample of
    vectors with all, and while less than ``recall`` of their links were found, lists are refined
    again from further random orders, ``AUDITS`` times at most.

    A vector that is null, empty, zero, or holds a null or non-finite component links with
    nothing, as does one with a null id; its component is its own id and it is kept. Vectors of
    different lengths are not linked. Different vectors of one id are different vectors; rows
    that repeat both are one. No rows give no rows, and other columns play no part.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    # NaN stands for a missing component: neither links.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.coalesce(x, F.lit(float("nan")))))
    with wide_batches(spark, 4_096):
        base = stored(rows.mapInArrow(_clean, "vec_id long, key binary, vector array<double>"), "vectors")
    ids = stored(base.groupBy("vec_id", "key").agg(F.count(F.lit(1)).alias("times")), "vector-ids")
    sizes = ids.filter("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.sum("times").alias("times")
    )
    good, repeated = base.filter("key is not null"), bounded_broadcast(sizes.filter("times > 1").drop("times"), CLASSES)
    alone = good.join(repeated, "key", "left_anti").select("key", F.col("vec_id").alias("first"), F.lit(1).cast("long").alias("copies"), "vector")
    shared = good.join(repeated, "key").filter("vec_id = first").groupBy("key", "first", "copies").agg(F.any_value("vector").alias("vector"))
    plain = alone.union(shared).select(F.monotonically_increasing_id().alias("node"), "key", "first", "copies", "vector")
    plain = stored(plain, "classes")
    with wide_batches(spark, 4_096):
        coded = plain.select("node", "vector").mapInArrow(_coded, _NODE)
        coded = stored(coded, "coded-vectors")
    graph, linked = None, None
    for turn in range(AUDITS):
        graph = neighbour_graph(coded, threshold, range(turn * ORDERS, (turn + 1) * ORDERS), graph)
        linked = _linked_nodes(graph, plain, threshold)
        if audit(linked, plain, threshold) >= recall:
            break
    heads = linked.join(plain.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("component"))
    found = linked.join(bounded_broadcast(heads), "root").select("node", "links", "component")
    known = plain.join(found, "node", "left").filter("copies > 1 or links is not null").select(
        "key",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "first").alias("component"),
    )
    known = bounded_broadcast(stored(known, "linked-classes"), CLASSES)
    component = F.coalesce("component", "vec_id")
    return ids.join(known, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
