"""Nearest neighbours by largest inner product, over balanced posting lists.

Centroids of equal-sized clusters are fitted on a bounded sample and held in memory by every
task, with a neighbour graph over them. Every vector is written to the list of its nearest
centroid and, when it lies near a boundary, to a few more; a query reads the lists whose
distance is within a ratio of the nearest one's. The ratio is chosen on the sample, so that
enough of the true neighbours are found. Lists are compared with their queries in blocks, so a
list that holds a third of all vectors is many tasks.

Inner products become distances by one more component, which makes all vectors as long as the
longest; queries have 0 there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Vectors to fit on at most, and bytes of them at most.
SAMPLE_ROWS, SAMPLE_BYTES = 12_000, 64 << 20
#: Lists at least and at most; a vector's lists at most; how much farther a further list may be.
FEWEST, MOST, COPIES, CLOSURE = 8, 4_096, 3, 1.15
#: Lists that a query reads at least.
FEWEST_READ = 4
#: Neighbours of a centroid in the graph, and centroids a search keeps in view at least.
DEGREE, BEAM = 24, 48
#: Share of the true neighbours to find on the sample, queries to measure it with.
WANTED, PROBES = 0.97, 256
#: Vectors and queries of a block.
BLOCK_VECTORS, BLOCK_QUERIES = 8_192, 2_048
ITERATIONS = 8
#: Components of the pairs that are scored at once.
PAIR_VALUES = 1 << 20


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def balanced_assignment(distances: np.ndarray, capacity: int) -> np.ndarray:
    """A cluster for each row, near ones first, with at most ``capacity`` rows in each."""
    rows, lists = distances.shape
    order = np.argsort(distances, axis=1)
    out, room, turn = np.full(rows, -1), np.full(lists, capacity), np.zeros(rows, np.int64)
    left = np.arange(rows)
    while len(left):
        bid = order[left, turn[left]]
        ranked = np.lexsort((distances[left, bid], bid))
        place = np.arange(len(ranked)) - np.searchsorted(bid[ranked], bid[ranked])
        won = ranked[place < room[bid[ranked]]]
        out[left[won]] = bid[won]
        room -= np.bincount(bid[won], minlength=lists)
        left = left[out[left] < 0]
        while len(left) and (full := room[order[left, np.minimum(turn[left], lists - 1)]] <= 0).any():
            turn[left[full]] += 1
    return out


@dataclass
class ListIndex:
    """Centroids, the graph over them, and the ratio within which lists are read."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    longest: float
    ratio: float = 1.0
    width: int = BEAM

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors * vectors).sum(1), 0)
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)

    def nearest(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances), nearest first: a best-first walk of the graph for many points at once.

        Every point holds the ``width`` nearest centroids it has seen and opens the nearest
        one not opened yet, until all it holds are open.
        """
        n, lists = len(points), len(self.centroids)
        width = min(width, lists)
        seen = np.zeros((n, lists), bool)
        start = np.broadcast_to(self.entries, (n, len(self.entries)))
        seen[:, self.entries] = True
        held, far = start.copy(), _distances(points, self.centroids[self.entries])
        opened = np.zeros(held.shape, bool)
        squares, active = (self.centroids**2).sum(1), np.arange(n)
        own = (points * points).sum(1)
        while len(active):
            todo = np.where(opened[active], np.inf, far[active])
            best = todo.argmin(1)
            some = np.isfinite(todo[np.arange(len(active)), best])
            active, best = active[some], best[some]
            if not len(active):
                break
            opened[active, best] = True
            near = self.graph[held[active, best]]
            d = own[active, None] + squares[near] - 2 * np.einsum("nd,ngd->ng", points[active], self.centroids[near])
            d = np.where(seen[active[:, None], near], np.inf, np.sqrt(np.maximum(d, 0)))
            seen[active[:, None], near] = True
            held_all = np.concatenate([held[active], near], 1)
            far_all = np.concatenate([far[active], d], 1)
            open_all = np.concatenate([opened[active], np.zeros(near.shape, bool)], 1)
            if held.shape[1] < width:
                grow = width - held.shape[1]
                held = np.pad(held, ((0, 0), (0, grow)))
                far = np.pad(far, ((0, 0), (0, grow)), constant_values=np.inf)
                opened = np.pad(opened, ((0, 0), (0, grow)))
            keep = np.argsort(far_all, axis=1, kind="stable")[:, : held.shape[1]]
            short = held.shape[1] - keep.shape[1]
            for target, source, fill in ((held, held_all, 0), (far, far_all, np.inf), (opened, open_all, False)):
                rows = np.take_along_axis(source, keep, 1)
                target[active] = np.pad(rows, ((0, 0), (0, short)), constant_values=fill) if short else rows
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(held, order, 1), np.take_along_axis(far, order, 1)

    def home_lists(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every copy: the nearest list, and others nearly as near.

        A further list is left out when its centroid is nearer to one already taken than to
        the vector, because the queries that read it will mostly read that one too.
        """
        near, far = self.nearest(self.lifted(vectors), max(BEAM, 4 * COPIES))
        taken, close = near[:, :1], np.ones(len(vectors), np.int64)
        rows, lists = [np.arange(len(vectors))], [near[:, 0]]
        chosen = np.full((len(vectors), COPIES), -1)
        chosen[:, 0] = taken[:, 0]
        for k in range(1, min(4 * COPIES, near.shape[1])):
            candidate = near[:, k]
            fits = np.isfinite(far[:, k]) & (far[:, k] <= CLOSURE * far[:, 0]) & (close < COPIES)
            for j in range(COPIES):
                has = chosen[:, j] >= 0
                gap = np.linalg.norm(self.centroids[candidate] - self.centroids[np.maximum(chosen[:, j], 0)], axis=1)
                fits &= ~has | (gap >= far[:, k] * 0.8)
            at = np.flatnonzero(fits)
            chosen[at, close[at]] = candidate[at]
            close[at] += 1
            rows.append(at)
            lists.append(candidate[at])
        return np.concatenate(rows), np.concatenate(lists)

    def read_lists(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list a query reads: those within the ratio of the nearest one."""
        points = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        near, far = self.nearest(points, self.width)
        read = (far <= self.ratio * far[:, :1] + 1e-12) | (np.arange(far.shape[1]) < FEWEST_READ) & np.isfinite(far)
        return np.nonzero(read)[0], near[read]


def fit_lists(sample: np.ndarray, rows: int, longest: float, k: int, seed: int = 3) -> ListIndex:
    """Balanced centroids, their graph, and the reading ratio, from sample vectors.

    The number of lists grows with the rows to the power 0.4, between ``FEWEST`` and ``MOST``.
    """
    rng = np.random.default_rng(seed)
    lists = int(np.clip(2.2 * max(rows, 1) ** 0.4, FEWEST, MOST))
    lists = max(1, min(lists, len(sample) // 8 or 1))
    index = ListIndex(np.zeros((1, 1)), np.zeros((1, 1), int), np.zeros(1, int), longest)
    points = index.lifted(sample)
    centroids = points[rng.choice(len(points), lists, replace=False)]
    capacity = -(-len(points) * 5 // (lists * 4))
    for _ in range(ITERATIONS):
        of = balanced_assignment(_distances(points, centroids), capacity)
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, points)
        size = np.bincount(of, minlength=lists)
        centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centroids)
    gaps = _distances(centroids, centroids)
    np.fill_diagonal(gaps, np.inf)
    degree = max(1, min(DEGREE, lists - 1))
    graph = np.argsort(gaps, axis=1, kind="stable")[:, :degree]
    # A ring through all centroids keeps the graph in one piece.
    graph = np.concatenate([graph, ((np.arange(lists) + 1) % lists)[:, None]], axis=1)
    entries = np.unique(np.linspace(0, lists - 1, min(8, lists)).astype(int))
    index.centroids, index.graph, index.entries = centroids, graph, entries
    index.width = lists
    index.ratio, most = _reading_ratio(index, sample, k, rng)
    index.width = min(lists, max(BEAM, 2 * most))
    return index


def _reading_ratio(index: ListIndex, sample: np.ndarray, k: int, rng) -> tuple[float, int]:
    """The ratio that finds ``WANTED`` of the sample's true neighbours, and the most lists read with it."""
    probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
    queries = sample[probes]
    row, home = index.home_lists(sample)
    far = _distances(np.concatenate([queries, np.zeros((len(queries), 1))], 1), index.centroids)
    far = far / np.maximum(far.min(axis=1, keepdims=True), 1e-12)
    score = queries @ sample.T
    score[np.arange(len(probes)), probes] = -np.inf
    true = np.argsort(-score, axis=1)[:, : min(k, max(1, len(sample) - 1))]
    order = np.argsort(row, kind="stable")
    row, home = row[order], home[order]
    begin = np.searchsorted(row, np.arange(len(sample) + 1))
    needed = np.array(
        [[far[q, home[begin[v] : begin[v + 1]]].min() for v in true[q]] for q in range(len(probes))]
    )
    ratio = float(np.quantile(needed, WANTED)) if needed.size else 1.0
    return ratio, int((far <= ratio).sum(axis=1).max()) if far.size else 1


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec): vectors that take part, as doubles."""
    vec = F.col(vector_col).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & F.forall("vec", fine)).filter(
        F.exists("vec", lambda x: x != 0)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _listed(shared, reading: bool):
    """Rows (list, vec_id, vec) of all lists a vector stands in, or a query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                vectors = _matrix(part.column(1))
                rows, lists = index.read_lists(vectors) if reading else index.home_lists(vectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), *[c.take(pa.array(rows)) for c in part.columns]],
                    names=["list", "vec_id", "vec"],
                )

    return run


def pair_scores(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (q, v) of rows, added in an order that depends on the length only.

    A matrix product rounds by the shape of its block; here a pair has the same bits in every
    block. Pairs are taken some megabytes at a time.
    """
    out, step = np.empty(len(q)), max(1, PAIR_VALUES // queries.shape[1])
    for at in range(0, len(q), step):
        terms = queries[q[at : at + step]] * vectors[v[at : at + step]]
        while (width := terms.shape[1]) > 1:
            half = width // 2
            added = terms[:, :half] + terms[:, half : 2 * half]
            terms = np.concatenate([added, terms[:, 2 * half :]], axis=1) if width % 2 else added
        out[at : at + step] = terms[:, 0]
    return out + 0.0


def _few_copies(matrix: np.ndarray, most: int) -> np.ndarray:
    """Rows without those that ``most`` earlier rows equal."""
    same = np.ascontiguousarray(matrix).view(f"V{matrix.shape[1] * matrix.itemsize}").ravel()
    _, group = np.unique(same, return_inverse=True)
    order = np.argsort(group, kind="stable")
    place = np.arange(len(order)) - np.searchsorted(group[order], group[order])
    return np.sort(order[place < most])


def _compared(k: int):
    """The best candidates of every query of a block among the vectors of a block."""

    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        vectors = vectors.sort_values("vec_id", kind="stable").drop_duplicates("vec_id")
        ids, matrix = vectors["vec_id"].to_numpy(), np.stack(vectors["vec"].to_numpy())
        # Of equal vectors the k smallest ids come first, one more if the query is among them.
        fewer = _few_copies(matrix, k + 1)
        ids, matrix = ids[fewer], matrix[fewer]
        longest, out = np.sqrt((matrix * matrix).sum(1).max()), []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            q = part["vec_id"].to_numpy()
            wanted = np.stack(part["vec"].to_numpy())
            scores = wanted @ matrix.T
            scores[ids[None] == q[:, None]] = -np.inf
            reach = np.isfinite(scores)
            if k < len(ids):
                # All that may reach the k-th score, however the product was rounded.
                least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
                slack = 4 * matrix.shape[1] * np.finfo(float).eps * np.sqrt((wanted * wanted).sum(1)) * longest
                reach &= scores >= (least - slack)[:, None]
            row, col = np.nonzero(reach)
            exact = pair_scores(wanted, matrix, row, col)
            order = np.lexsort((ids[col], -exact, row))
            row, col, exact = row[order], col[order], exact[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, col, exact = row[best], col[best], exact[best]
            out.append(pd.DataFrame({"query_id": q[row], "vec_id": ids[col], "score": exact}))
        return pd.concat(out)

    return run


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query.

    ``score`` is the inner product of the vectors as they are, in double precision; rank 1 is the largest,
    ties go to the smaller id. A query's own id is no candidate. All lists that a query reads
    are compared whole. With fewer than ``k`` candidates in them, a query gets what they hold;
    with few vectors in all there is one list, so all are found.

    Vectors that are null, empty, zero, of another length than most, or hold a null or
    non-finite component take no part, nor do null ids. Rows that repeat an id count as one
    candidate with the first of their vectors, by value; a repeated query is one query. Without
    vectors or queries there are no rows.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, id_col, vector_col)
    lengths = usable.groupBy(F.size("vec").alias("size")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("most")
    )
    top = lengths.orderBy(F.desc("rows"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if top is None:
        return spark.createDataFrame([], schema)
    size, rows, longest = top["size"], top["rows"], float(np.sqrt(top["most"]))
    usable = stored(usable.filter(F.size("vec") == size).groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
    wanted = _usable(queries, id_col, vector_col).filter(F.size("vec") == size)
    wanted = stored(wanted.groupBy("vec_id").agg(F.min("vec").alias("vec")), "queries")
    budget = max(64, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    every = max(1, rows // (2 * budget))
    sample = usable.filter(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(every)) == 0).limit(budget).select("vec_id", "vec")
    found = sample.toPandas().sort_values("vec_id")
    index = fit_lists(np.stack(found["vec"].to_numpy()), rows, longest, k)
    shared = spark.sparkContext.broadcast(index)
    kind = "list int, vec_id long, vec array<double>"
    home = stored(usable.mapInArrow(_listed(shared, False), kind), "lists")
    read = stored(wanted.mapInArrow(_listed(shared, True), kind), "reads")
    held = home.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    asked = read.groupBy("list").agg(F.count(F.lit(1)).alias("n"))

    def dealt(df: DataFrame, own: DataFrame, other: DataFrame, mine: str, its: str, block: int, others: int) -> DataFrame:
        """Each row with its own block number, once for every block of the other side; a row per list is broadcast."""
        blocks = own.select("list", F.ceil(F.col("n") / block).alias("o")).join(
            other.select("list", F.ceil(F.col("n") / others).alias("t")), "list"
        )
        return df.join(F.broadcast(blocks), "list").select(
            "list",
            F.pmod(F.xxhash64("vec_id"), F.col("o")).alias(mine),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("t") - 1)).alias(its),
            "vec_id",
            "vec",
        )

    cells = ["list", "vector_block", "query_block"]
    left = dealt(home, held, asked, "vector_block", "query_block", BLOCK_VECTORS, BLOCK_QUERIES).groupBy(*cells)
    right = dealt(read, asked, held, "query_block", "vector_block", BLOCK_QUERIES, BLOCK_VECTORS).groupBy(*cells)
    best = left.cogroup(right).applyInPandas(_compared(k), "query_id long, vec_id long, score double")
    # A copy in another list has the same score, bit by bit, so the set holds it once; the k best of each query are kept in an array.
    lists = best.groupBy("query_id").agg(F.collect_set(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("all"))
    ranked = lists.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("at", "c"))
    return ranked.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("c.vec_id").alias("vec_id"),
        (-F.col("c.s")).alias("score"),
    )
