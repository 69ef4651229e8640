"""Near-duplicate documents by circulant MinHash, banding and an exact check.

Two fixed permutations make a whole signature: the first scatters the shingles over a circle
of 2**32 places, the second ranks the places, and coordinate k ranks the circle turned by k.
A band is a few coordinates; documents that agree on a band are candidates, and a link stands
only when the full shingle sets confirm it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, bounded_broadcast, documents_of, list_array, mix, shingle_sets, slices, stored, text_column
from .graph import components

#: 32 bands of 4 coordinates miss a pair at 0.8 about once in 20 million.
BANDS, ROWS = 32, 4
#: Buckets of up to so many documents are compared pair by pair.
SMALL = 64
#: Further pivots that each node of a larger bucket is compared with, before rare shingles are searched.
PIVOTS = 8
#: Shingles at most whose place in the order is broadcast.
COMMON = 1 << 16
_CHUNK = 1 << 15


def signatures(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One row of band keys for each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    place = (mix(flat ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), np.uint64(band + 1), np.uint64)
        for k in range(band * rows, band * rows + rows):
            x = place - np.uint32(k)
            x ^= x >> np.uint32(16)
            x *= np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(13)
            x *= np.uint32(0xC2B2AE35)
            x ^= x >> np.uint32(16)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(x, starts))
        out[:, band] = key
    return out


def _signed(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for start, end, data, offsets in slices(text_column(batch.column(1))):
                sets = shingle_sets(Words(data, offsets, lower=True), words)
                sizes = np.array([len(s) for s in sets], np.int64)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                full = np.flatnonzero(sizes)
                keys, at = np.empty((len(full), bands), np.uint64), 0
                while at < len(full):
                    stop = max(at + 1, int(np.searchsorted(np.cumsum(sizes[full[at:]]), _CHUNK)) + at)
                    keys[at:stop] = signatures([sets[i] for i in full[at:stop]], bands, rows)
                    at = stop
                lengths = np.where(sizes > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, end - start),
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        list_array(keys.ravel().view(np.int64), lengths, pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for start, end, data, offsets in slices(text_column(batch.column(1))):
                sets = shingle_sets(Words(data, offsets, lower=True), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, end - start),
                        list_array(
                            np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]), pa.int64()
                        ),
                    ],
                    names=["node", "shingles"],
                )

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    # Sizes alone rule many pairs out before the sets are compared.
    na, nb = F.size("sa"), F.size("sb")
    both = both.filter((F.least(na, nb) * 100 >= F.greatest(na, nb) * percent))
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared * 100 >= (na + nb - shared) * percent).select("a", "b").distinct()


def _labelled(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with each row's component."""
    rows = buckets.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("label"))
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    return stored(rows.join(mixed.select("key"), "key"), "open-buckets")


def _by_chance(buckets: DataFrame) -> DataFrame:
    """``PIVOTS`` pairs for each node of a large bucket: with members that a hash picks.

    Every bucket has a few pivots, and a node takes each of them from one of its buckets, so
    the pairs grow with the nodes, whatever the size of the buckets.
    """
    large = buckets.filter(F.col("n") > SMALL).select("key", "node")
    turns = range(PIVOTS)
    pivots = large.groupBy("key").agg(*[F.min(F.struct(F.xxhash64("node", F.lit(t)), "node")).alias(f"p{t}") for t in turns])
    chosen = (
        large.join(pivots, "key")
        .groupBy("node")
        .agg(*[F.min(F.struct(F.xxhash64("key", F.lit(t)), F.col(f"p{t}.node").alias("p"))).alias(f"c{t}") for t in turns])
    )
    pairs = chosen.select("node", F.explode(F.array_distinct(F.array(*[F.col(f"c{t}.p") for t in turns]))).alias("p"))
    return pairs.filter("node <> p").select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"))


def _parted(shared, percent: int):
    """Each node's shingles that are not common, and of the common ones, in order, those still in its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.argsort(shared.value)
        known = shared.value[place]
        for batch in batches:
            column = batch.column(2)
            sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
            flat = column.flatten().to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
            is_common = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            rare = np.bincount(of[~is_common], minlength=len(sizes))
            late_of, late_place = of[is_common], place[at[is_common]]
            order = np.lexsort((late_place, late_of))
            late_of, late = late_of[order], flat[is_common][order]
            commons = sizes - rare
            within = np.arange(len(late)) - np.repeat(np.cumsum(commons) - commons, commons)
            room = sizes - -(-sizes * percent // 100) + 1 - rare
            kept = within < room[late_of]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes),
                    list_array(flat[~is_common], rare, pa.int64()),
                    list_array(late[kept], np.bincount(late_of[kept], minlength=len(sizes)), pa.int64()),
                ],
                names=["node", "label", "n", "rare", "late"],
            )

    return run


def _by_rare_shingles(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of large buckets that may be alike, found without pairing the whole bucket.

    Of two nodes that share a bucket and are in different components, one at least is outside
    the bucket's commonest component. In one order of all shingles, rare ones first, two sets
    that are alike enough have their first shared shingle so early that enough shingles are
    left behind it; so the first shingles of the nodes outside are looked up among all nodes.
    How often a shingle occurs is taken from those nodes and an eighth of the others: it
    makes the order good, any order makes the search complete. The commonest shingles come
    last by a broadcast list of at most ``COMMON``, so that no shuffle is dealt by them; the
    counts of the others are joined.
    """
    per_label = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    main = per_label.groupBy("key").agg(F.max_by("label", F.struct("k", "label")).alias("main"))
    outside = rows.join(main, "key").groupBy("node", "label").agg(F.max(F.col("label") != F.col("main")).alias("outside"))
    nodes = stored(outside.join(sets, "node"), "open-sets").withColumn("n", F.size("shingles"))
    looked_at = nodes.filter(F.col("outside") | (F.pmod(F.xxhash64("node"), F.lit(8)) == 0))
    often = looked_at.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    # A shingle with one in COMMON of all rows or more is common, so there are at most COMMON of them.
    often = stored(often, "shingle-counts")
    total = often.agg(F.coalesce(F.sum("often"), F.lit(0))).first()[0]
    common = often.filter(F.col("often") * COMMON >= total).orderBy("often", "shingle").toPandas()
    shared = rows.sparkSession.sparkContext.broadcast(common["shingle"].to_numpy(np.int64))
    schema = "node long, label long, n long, rare array<long>, late array<long>"
    asking = stored(nodes.filter("outside").select("node", "label", "shingles").mapInArrow(_parted(shared, percent), schema), "asking")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("often", "shingle"))
    first = (
        asking.select("node", "label", "n", F.explode("rare").alias("shingle"))
        .join(often, "shingle")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
        .select("node", "label", "n", "shingle", "rank")
    )
    late = asking.select("node", "label", "n", F.size("rare").alias("before"), F.posexplode("late").alias("at", "shingle"))
    late = late.select("node", "label", "n", "shingle", (F.col("before") + F.col("at") + 1).alias("rank"))
    prefix = stored(first.unionByName(late), "rare-shingles")
    # One bit for each of 2**16 classes of shingles keeps what nobody asks for from being unpacked.
    place = F.shiftright("shingle", 6).bitwiseAND(F.lit(1023)).cast("int")
    bits = prefix.groupBy(place.alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shingle & 63 as int))")).alias("w"))
    words = dict(bits.collect())  # at most 1,024 rows
    asked = F.array(*[F.lit(words.get(k, 0)).cast("bigint") for k in range(1024)])

    def wanted(s):
        word = F.get(asked, F.shiftright(s, 6).bitwiseAND(F.lit(1023)).cast("int"))
        return F.call_function("shiftright", word, s.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    other = nodes.select(
        F.col("node").alias("b"),
        F.col("label").alias("lb"),
        F.col("n").alias("nb"),
        F.explode(F.filter("shingles", wanted)).alias("shingle"),
    )
    needed = F.ceil((F.col("n") + F.col("nb")) * percent / (100 + percent))
    enough = (F.col("n") - F.col("rank") + 1 >= needed) & (F.col("nb") >= needed)
    pairs = prefix.join(other, "shingle").filter((F.col("label") != F.col("lb")) & enough)
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``.

    Documents are linked when ``100 * shared >= percent * union`` of their distinct shingles
    of ``words`` lower-cased words; a shorter text's whole sequence is one shingle. A component
    is named by its smallest doc_id, and that document is kept.

    Documents with equal sets are one node, whatever their number. In a bucket every node is
    compared with the smallest one first, in large buckets with a few more. What that leaves
    apart is compared pair by pair in buckets of up to ``SMALL`` nodes; larger ones are joined
    on rare shingles, which loses no pair and pairs no whole bucket.

    Null or blank texts have no shingles and are linked with nothing. A row with a null id has
    a null component and is kept. Rows that repeat an id are one document: it is linked when
    one of its texts is, and all its rows stay or go. No rows give no rows.
    """
    texts = documents_of(docs, id_col, text_col)
    schema = "doc_id long, n_shingles long, set_key binary, bands array<long>"
    base = stored(texts.mapInArrow(_signed(words, bands, rows), schema), "signatures")
    classes = base.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("node"))
    members = stored(
        base.join(classes, "set_key", "left").select(
            "doc_id",
            "n_shingles",
            F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node")).alias("node"),
            F.when(F.col("doc_id") == F.col("node"), F.col("bands")).alias("bands"),
        ),
        "members",
    )
    nodes = members.filter("doc_id = node")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
        .filter("pivot < last")
        .drop("last")
    )
    buckets = stored(keyed.join(shared, "key"), "buckets")
    candidates = stored(buckets.select(F.col("node").alias("doc_id")).distinct(), "candidates")
    wanted = texts.join(bounded_broadcast(candidates), "doc_id", "left_semi")
    sets = stored(wanted.mapInArrow(_sets(words), "node long, shingles array<long>"), "shingle-sets")

    pairs = buckets.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    repeated_ids = (
        members.filter("node <> doc_id")
        .join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        .select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    )
    pairs = pairs.union(_by_chance(buckets)).distinct()
    links = stored(_confirmed(pairs, sets, percent).union(repeated_ids), "confirmed")
    roots = components(links)
    apart = _labelled(buckets, roots)
    if not apart.isEmpty():
        small = apart.filter(F.col("n") <= SMALL).select("key", "node", "label")
        other = small.select("key", F.col("node").alias("b"), F.col("label").alias("lb"))
        pairs = small.join(other, "key").filter("node < b and label <> lb").select(F.col("node").alias("a"), "b")
        large = apart.filter(F.col("n") > SMALL)
        if not large.isEmpty():
            pairs = pairs.union(_by_rare_shingles(large, sets, percent))
        found = stored(_confirmed(pairs.distinct(), sets, percent), "confirmed")
        if not found.isEmpty():
            roots = components(links.union(found))
    return members.join(roots, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("root", "node", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("root", "node", "doc_id"), F.lit(True)).alias("kept"),
    )
