"""Periodic runs of words: stretches that repeat a phrase over and over.

A diagonal is a lag ``q``: it grows by one with every word that equals the word ``q`` before
it, and ends at the first that does not. A diagonal that ends long enough is a run. Following
every earlier occurrence of every word would be quadratic in a text of few words, so the table
is sparse. The words from a place on are looked up at the scales 1, 2, 4, ..., and at scale
``m`` only the nearest earlier occurrence of the ``m`` words may lengthen a diagonal, and only
with a lag above ``m / 2`` and up to ``m``. That loses no run: inside a run with smallest period
``q <= m`` the same ``m`` words cannot stand less than ``q`` before, else the run would have a
smaller period. So a place feeds one diagonal a scale at most, and what is looked up shrinks
with every scale to the places whose words repeat at all.

Phrases get exact numbers, by pairs of numbers of the scale below; nothing is hashed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import documents_of, is_space, slices, text_column

#: A run is this long, and so many periods long, at least.
MIN_WORDS, MIN_PERIODS = 6, 4


def word_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of a slice of documents one after the other, and how many each document has."""
    space = is_space(data)
    first = ~space
    if len(data):
        first[1:] &= space[:-1]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        first[cuts] = ~space[cuts]
    letters = np.flatnonzero(~space)
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets)).astype(np.int64)
    ends = np.append(np.searchsorted(letters, starts), len(letters)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[letters]))]
    )
    return words, counts


def looped(ids: list[int | None], counts: np.ndarray) -> np.ndarray | None:
    """For each word of a slice the word that stands there, or None if all stay as they are.

    Of every ten documents, by the checksum of their id, one is made periodic from a place on.
    A document without an id stays as it is.
    """
    places, first = None, np.concatenate([[0], np.cumsum(counts)])
    for row, (doc_id, n) in enumerate(zip(ids, counts.tolist())):
        if doc_id is None or not n:
            continue
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if places is None:
            places = np.arange(first[-1])
        places[first[row] + a : first[row + 1]] = first[row] + a + np.arange(n - a) % p
    return places


def _numbers(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers, equal for equal pairs."""
    pairs = first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second
    return np.unique(pairs, return_inverse=True)[1]


def find_runs(
    ids: np.ndarray, counts: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and period.

    ``ids`` are numbers of the words of all documents, ``counts`` the words of each. A run has
    its smallest period ``q``, is ``max(min_words, min_periods * q)`` words long at least, and
    goes on as far as the words do. ``min_periods`` must be 3 or more.
    """
    doc = np.repeat(np.arange(len(counts)), counts)
    end = np.cumsum(counts)[doc] if len(ids) else np.zeros(0, np.int64)
    begin = end - counts[doc] if len(ids) else end
    found: list[tuple[np.ndarray, ...]] = []
    number = np.full(len(ids), -1, np.int64)
    at = np.arange(len(ids))
    # Words of different documents never meet.
    number[at] = _numbers(doc, ids) if len(ids) else 0
    m = 1
    while len(at):
        # The nearest earlier place with the same number names the diagonal that a place lengthens.
        key = number[at]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same, at[order[1:]] - at[order[:-1]], 0)
        repeated = np.zeros(len(at), bool)
        repeated[order[1:]] |= same
        repeated[order[:-1]] |= same
        on = (lag > m // 2) & (lag <= m)
        places, q = at[on], lag[on]
        if len(places):
            # A diagonal goes on while the next place has the same lag; the last place ends it.
            fresh = np.ones(len(places), bool)
            fresh[1:] = (np.diff(places) != 1) | (np.diff(q) != 0)
            opened = np.flatnonzero(fresh)
            matched = np.diff(np.append(opened, len(places))) + m - 1
            places, q = places[opened], q[opened]
            length = matched + q
            long_enough = length >= np.maximum(min_words, min_periods * q)
            places, q, length = places[long_enough], q[long_enough], length[long_enough]
            of = doc[places]
            found.append((of, places - q - begin[places], length, q))
        # Only phrases that repeat can repeat in a longer one; a run of the next scale has lags above m.
        wide = repeated & (at + 2 * m <= end[at]) & (end[at] - begin[at] >= min_periods * (m + 1))
        left = at[wide]
        both = number[left + m] >= 0
        left = left[both]
        longer = _numbers(number[left], number[left + m]) if len(left) else left
        number[:] = -1
        number[left] = longer
        at, m = left, 2 * m
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    of, start, length, period = (np.concatenate(v) for v in zip(*found))
    order = np.lexsort((period, start, of))
    return of[order], start[order], length[order], period[order]


def _sweep(loops: bool, min_words: int, min_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in slices(text_column(batch.column(1))):
                own = batch.column(0).slice(row, stop - row)
                words, counts = word_array(data, offsets)
                places = looped(own.to_pylist(), counts) if loops else None
                if places is not None:
                    words = words.take(pa.array(places))
                ids = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int64)
                of, start, length, period = find_runs(ids, counts, min_words, min_periods)
                first = np.concatenate([[0], np.cumsum(counts)])
                # A word goes if some run holds it after that run's first period.
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, first[of] + start + period, 1)
                np.add.at(steps, first[of] + start + length, -1)
                kept = np.cumsum(steps)[:-1] == 0
                lasting = np.add.reduceat(np.append(kept, False).astype(np.int64), first[:-1]) * (counts > 0)
                if len(of):
                    words = words.filter(pa.array(kept))
                bounds = pa.array(np.concatenate([[0], np.cumsum(lasting)]))
                collapsed = pc.binary_join(pa.LargeListArray.from_arrays(bounds, words), pa.scalar(b" ", pa.large_binary()))
                runs = np.searchsorted(of, np.arange(len(counts) + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays(
                    [pa.array(v.astype(np.int64)) for v in (start, length, period)], names=["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [own, pa.ListArray.from_arrays(pa.array(runs), spans), collapsed.view(pa.large_string()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    docs: DataFrame,
    loops: bool = False,
    min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, runs, collapsed), one for each row of ``docs``.

    ``runs`` holds (start, length, period) of every periodic run, by start and then period, in
    word numbers from 0. ``collapsed`` is the text with one period left of each run, words
    joined by single spaces. Words are compared byte by byte. ``loops`` first makes one of ten
    documents periodic, as :func:`looped` says.

    A null, empty or blank text has no runs and collapses to an empty one. A row with a null id
    keeps it, and is never made periodic. Repeated rows each give a row; no rows give none; other
    columns play no part. A task holds about 30 bytes for each byte of its longest text.
    """
    texts = documents_of(docs, id_col, text_col)
    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return texts.mapInArrow(_sweep(loops, min_words, min_periods), schema)
