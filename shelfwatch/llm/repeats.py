"""Repeated passages found with sparse suffix arrays and cut out of all but their first place.

Of every run of ``min_words`` words one position is chosen by content alone: the smallest hash
of a few words among those near the run's start. Only the suffixes at these positions are kept.
They are sorted by the hash of their first words, so that equal ones are neighbours; a suffix
without an equal neighbour starts no repeat. Around those that remain, matches are extended to
the left and the right: every whole run that chose the suffix is hashed and sorted in turn,
and adjoining repeated runs make one passage. Equal runs choose the same position, so no
repeat of ``min_words`` words is lost.

A sort spreads equal keys over as many tasks as their number needs: a passage that a third of
all documents share is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, StructField, StructType

from .common import Words, bounded_broadcast, documents_of, list_array, narrow_batches, range_hashes, slices, stored, text_column, wide_batches

#: Words of a passage at least; words of an anchor; anchors of which the smallest is chosen.
MIN_WORDS, ANCHOR, CHOICE = 50, 5, 20
#: Documents with cuts that may be broadcast, at some hundred bytes each.
BROADCAST_CUTS = 200_000
_SECOND = 0xA24BAED4963EE407

_SPAN = "array<struct<start:int,stop:int,cut:boolean>>"


def chosen_positions(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, chosen position) of every run of ``min_words`` words that lies in one document."""
    h, n = words.hashes, len(words.hashes)
    none = np.zeros(0, np.int64)
    if n < min_words:
        return none, none
    starts = np.arange(n - ANCHOR + 1)
    least, at = range_hashes(h, starts, starts + ANCHOR), starts
    choice, have = min(CHOICE, min_words - ANCHOR + 1), 1
    while have < choice:
        step = min(have, choice - have)
        left, right = least[: len(least) - step], least[step:]
        smaller = right < left
        least = np.where(smaller, right, left)
        at = np.where(smaller, at[step:], at[: len(at) - step])
        have += step
    runs = np.flatnonzero(words.doc[: n - min_words + 1] == words.doc[min_words - 1 :])
    return runs, at[runs]


def _digest(words: Words, doc: int) -> bytes:
    return hashlib.blake2b(words.hashes[words.first[doc] : words.first[doc + 1]].tobytes(), digest_size=16).digest()


def _suffixes(min_words: int):
    reach = min_words - min(CHOICE, min_words - ANCHOR + 1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in slices(text_column(batch.column(1))):
                words = Words(data, offsets, lower=False)
                _, chosen = chosen_positions(words, min_words)
                chosen = np.unique(chosen)
                keys = range_hashes(words.hashes, chosen, chosen + reach).view(np.int64)
                lengths = np.bincount(words.doc[chosen], minlength=words.docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([_digest(words, d) for d in range(words.docs)], pa.binary()),
                        pa.array(words.counts.astype(np.int32)),
                        list_array(keys, lengths, pa.int64()),
                        list_array((chosen - words.first[words.doc[chosen]]).astype(np.int32), lengths, pa.int32()),
                    ],
                    names=["doc_id", "digest", "n_words", "keys", "places"],
                )

    return run


def _steps_back(of: np.ndarray, places: np.ndarray, key: np.ndarray, key2: np.ndarray, most: int) -> np.ndarray:
    """How far before each run the first equal run of its document begins, ``most`` at most."""
    order = np.lexsort((places, key2, key, of))
    fresh = np.ones(len(order), bool)
    for v in (of, key, key2):
        fresh[1:] &= v[order[1:]] == v[order[:-1]]
    fresh[1:] = ~fresh[1:]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    back = np.empty(len(order), np.int64)
    back[order] = places[order] - places[order[begin]]
    return np.minimum(back, most).astype(np.int32)


def _runs(min_words: int):
    """Hashes of the whole runs whose chosen suffix has an equal one somewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            for start, end, data, offsets in slices(text_column(batch.column(1))):
                words = Words(data, offsets, lower=False)
                runs, chosen = chosen_positions(words, min_words)
                wanted = np.zeros(len(words.hashes), bool)
                for d in range(words.docs):
                    own = places[start + d].values.to_numpy() + words.first[d]
                    wanted[own[own < words.first[d + 1]]] = True
                runs = runs[wanted[chosen]]
                of, places_in = words.doc[runs], runs - words.first[words.doc[runs]]
                key = range_hashes(words.hashes, runs, runs + min_words)
                key2 = range_hashes(words.hashes, runs, runs + min_words, _SECOND)
                digests = pa.array([_digest(words, d) for d in range(words.docs)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(key2.view(np.int64)),
                        batch.column(0).slice(start, end - start).take(pa.array(of)),
                        digests.take(pa.array(of)),
                        pa.array(places_in.astype(np.int32)),
                        pa.array(_steps_back(of, places_in, key, key2, min_words)),
                    ],
                    names=["key", "key2", "doc_id", "digest", "place", "back"],
                )

    return run


def _compare(keys: list[str]):
    """Within a sorted partition: whether the row before and the row after have the same key.

    Rows without an equal neighbour are left out, but for the partition's first and last.
    """

    def flags(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        n = len(rows)
        same = np.ones(n - 1, bool)
        for k in keys:
            v = rows.column(k).to_numpy()
            same &= v[1:] == v[:-1]
        twin = same.copy()
        for k in rows.schema.names:
            if k not in keys:
                a, b = rows.column(k).slice(0, n - 1), rows.column(k).slice(1)
                twin &= pa.compute.equal(a, b).to_numpy(zero_copy_only=False)
        return same, twin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, edge = None, False, 1

        def marked(rows: pa.RecordBatch, before: np.ndarray, after: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            names = [*rows.schema.names, "before", "after", "edge"]
            rows = pa.RecordBatch.from_arrays([*rows.columns, pa.array(before), pa.array(after), pa.array(edge)], names=names)
            return rows.filter(pa.array(before | after | (edge > 0)))

        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            same, twin = flags(rows)
            # A row that repeats the whole row before it is the same place, read twice.
            if twin.any():
                rows = rows.filter(pa.array(np.concatenate([[True], ~twin])))
                same = same[~twin]
            n = len(rows)
            edges = np.zeros(n, np.int8)
            edges[0] = edge
            befores = np.concatenate([[before], same])
            if n > 1:
                yield marked(rows.slice(0, n - 1), befores[:-1], same, edges[:-1])
                edge = 0
            held, before = rows.slice(n - 1), bool(befores[-1])
        if held is not None:
            yield marked(held, np.array([before]), np.array([False]), np.array([edge | 2], np.int8))

    return run


def equal_neighbours(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows whose keys occur in another row too, with flags ``before`` and ``after``.

    One global sort by keys and order. A key may go over several tasks: what lies on their
    borders, two rows a task, is compared in a second, tiny step.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    flags = [StructField("before", BooleanType()), StructField("after", BooleanType()), StructField("edge", ByteType())]
    schema = StructType([*df.schema.fields, *flags])
    with wide_batches(spark):
        marked = stored(ranged.mapInArrow(_compare(keys), schema), "neighbours")
    at_edge = marked.filter("edge > 0")
    ends = at_edge.groupBy(*keys).agg(F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"))
    place = F.struct(*order)
    mended = (
        at_edge.join(ends, keys)
        .withColumn("before", F.col("before") | (F.col("edge").bitwiseAND(1) > 0) & (place > F.col("lo")))
        .withColumn("after", F.col("after") | (F.col("edge").bitwiseAND(2) > 0) & (place < F.col("hi")))
        .select(*marked.columns)
    )
    return marked.filter("edge = 0").unionByName(mended).filter("before or after").drop("edge")


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps)[:-1] > 0


def _spans(min_words: int):
    """What is cut: words of a run seen before, but for the part in which a run overlaps its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first, again, back in zip(batch.column(2), batch.column(3), batch.column(4)):
                first, again, back = (v.values.to_numpy() for v in (first, again, back))
                n = int(max(first.max(initial=0), again.max(initial=0))) + min_words
                own = (back > 0) & (back < min_words) & np.isin(again - back, first)
                seen = _covered(again[~own], min_words, n)
                kept = _covered(first, min_words, n) & ~seen
                state = np.where(kept, 1, np.where(seen | _covered(again[own], min_words, n), 2, 0))
                turns = np.flatnonzero(np.diff(state, prepend=-1, append=-1))
                out.append(
                    [
                        {"start": int(a), "stop": int(b), "cut": bool(state[a] == 2)}
                        for a, b in zip(turns[:-1], turns[1:])
                        if state[a]
                    ]
                )
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cut", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, kind)], names=["doc_id", "digest", "spans"]
            )

    return run


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, digest, spans) of every document that holds a repeated passage.

    A run of ``min_words`` words that occurs at several places, in one document or more, is
    kept where it stands first, by doc_id and then by position. Every word that a later
    occurrence covers has ``cut``, even where a run that itself stands first reaches into it.
    Only where a later occurrence overlaps the first one, in a text that repeats itself, do the
    first one's words stay. Words are compared byte by byte and white space does not count.
    ``digest`` stands for the row's words.

    Documents with the same words are found first, by their digest: all but the first are cut
    whole, or not at all if they are shorter than ``min_words``, and play no further part. Null and blank texts and rows with a
    null id have no passages. Rows that repeat an id and a text are one document; different
    texts of one id are different documents. No rows give no rows.
    """
    texts = documents_of(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    schema = "doc_id long, digest binary, n_words int, keys array<long>, places array<int>"
    base = stored(texts.mapInArrow(_suffixes(min_words), schema), "suffixes")
    suffixes = base.select("doc_id", F.explode(F.arrays_zip("keys", "places")).alias("s")).select(
        F.col("s.keys").alias("key"), "doc_id", F.col("s.places").alias("place")
    )
    matched = equal_neighbours(suffixes, ["key"], ["doc_id", "place"])
    long_docs = base.filter(F.col("n_words") >= min_words).select("doc_id", "digest", "n_words")
    classes = long_docs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = stored(
        long_docs.join(classes.filter("first < last"), "digest").filter("doc_id > first").distinct(), "copies"
    )
    places = stored(matched.groupBy("doc_id").agg(F.collect_set("place").alias("places")), "places")
    only_copies = copies.select("doc_id").distinct()
    # An id all of whose texts are copies needs no second look; others are looked at whole.
    other = long_docs.join(copies.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti").select("doc_id")
    places = places.join(only_copies.join(other, "doc_id", "left_anti"), "doc_id", "left_anti")
    wanted = texts.join(bounded_broadcast(places.select("doc_id")), "doc_id", "left_semi").join(places, "doc_id")
    runs = wanted.select("doc_id", "text", "places").mapInArrow(
        _runs(min_words), "key long, key2 long, doc_id long, digest binary, place int, back int"
    )
    runs = equal_neighbours(stored(runs, "runs"), ["key", "key2"], ["doc_id", "digest", "place"])
    per_doc = runs.groupBy("doc_id", "digest").agg(
        F.collect_list(F.when(~F.col("before"), F.col("place"))).alias("first"),
        F.collect_list(F.when(F.col("before"), F.struct("place", "back"))).alias("again"),
    ).select("doc_id", "digest", "first", F.col("again.place").alias("again"), F.col("again.back").alias("back"))
    found = per_doc.mapInArrow(_spans(min_words), f"doc_id long, digest binary, spans {_SPAN}")
    whole = copies.select(
        "doc_id",
        "digest",
        F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("stop"), F.lit(True).alias("cut")))
        .cast(_SPAN)
        .alias("spans"),
    )
    marks = copies.select("digest", "first").distinct()
    # The first of a group of copies is a first occurrence as a whole.
    origin = (
        long_docs.join(marks, "digest")
        .filter(F.col("doc_id") == F.col("first"))
        .select("doc_id", "digest", "n_words")
        .distinct()
    )
    return stored(_with_copies(found, whole, origin), "passages")


def _with_copies(found: DataFrame, whole: DataFrame, origin: DataFrame) -> DataFrame:
    """The spans found, those of whole copies, and the originals of copies that have no span yet."""
    found = found.join(whole.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti")
    plain = origin.join(found.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti").select(
        "doc_id",
        "digest",
        F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("stop"), F.lit(False).alias("cut")))
        .cast(_SPAN)
        .alias("spans"),
    )
    return found.unionByName(whole).unionByName(plain)


def _without(text: bytes, words: Words, spans: list[dict]) -> bytes:
    """The text without the words of the spans and the white space after them."""
    out, at, n = [], 0, len(words.starts)
    for span in spans:
        out.append(text[at : words.starts[span["start"]]])
        at = int(words.starts[span["stop"]]) if span["stop"] < n else len(text)
    out.append(text[at:])
    return b"".join(out)


def cut_repeats(
    docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars"
) -> DataFrame:
    """``docs`` without the passages that :func:`repeated_passages` says to cut.

    Columns stay as they are; ``size_col``, where there is such a column, gets the new number
    of characters. Documents without a cut pass unchanged; a document of which no word is left
    goes.
    """
    cuts = passages.select("doc_id", "digest", F.filter("spans", lambda s: s["cut"]).alias("spans")).filter(
        F.size("spans") > 0
    )
    narrow_batches(docs.sparkSession)
    name = "__cuts"
    while name in docs.columns:
        name += "_"
    cuts = cuts.groupBy(F.col("doc_id").alias(f"{name}id")).agg(
        F.collect_list(F.struct("digest", "spans")).alias(name)
    )
    cuts = bounded_broadcast(stored(cuts, "cuts"), BROADCAST_CUTS)
    key = docs[f"`{id_col}`"].cast("long") == cuts[f"{name}id"]
    untouched = docs.join(cuts, key, "left_anti")
    at, columns, kinds = docs.columns.index(text_col), docs.columns, dict(docs.dtypes)
    sized = columns.index(size_col) if size_col in columns and kinds[size_col] in ("int", "bigint") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), []
            for row, entries in enumerate(batch.column(len(columns))):
                data = (texts[row] or "").encode()
                words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=False)
                digest = _digest(words, 0)
                spans = next((e["spans"] for e in entries.as_py() if e["digest"] == digest), [])
                if spans:
                    texts[row] = _without(data, words, spans).decode()
                    if not texts[row].strip(" \t\n\v\f\r"):
                        continue
                keep.append(row)
            arrays = list(batch.columns[: len(columns)])
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            if sized is not None:
                old = arrays[sized].to_pylist()
                touched = [len(t) if t != b else o for t, b, o in zip(texts, batch.column(at).to_pylist(), old)]
                arrays[sized] = pa.array(touched, batch.schema.field(sized).type)
            rows = pa.RecordBatch.from_arrays(arrays, names=columns)
            yield rows.take(pa.array(keep, pa.int64()))

    cut = docs.join(cuts, key).select(*[docs[f"`{c}`"] for c in columns], name)
    return untouched.union(cut.mapInArrow(run, docs.schema))
