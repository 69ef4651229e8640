"""What the operators share: scratch tables, bounded broadcasts, words and hashes of Arrow text columns.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z where an operator
says so. A text column is worked on in slices of a few megabytes, all documents of a slice
at once, so a task's memory depends on the slice and on its longest document only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text worked on at once in a task.
SLICE_BYTES = 512 << 10
#: Rows of texts that go to a Python worker at once.
TEXT_ROWS = 512
#: Bytes and rows of texts that are put together where words are looked up once for all of them.
CHUNK_BYTES, CHUNK_ROWS = 16 << 20, 16_384
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of ids that may be broadcast: 32 MB of longs.
BROADCAST_ROWS = 4_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the cluster's shared scratch folder and read again.

    Cuts the lineage: a lost executor costs only the tasks that it ran.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def narrow_batches(spark: SparkSession) -> None:
    """Sends texts to Python in small batches, from now on: a batch is bounded in rows only."""
    spark.conf.set(_BATCH_ROWS, str(TEXT_ROWS))


@contextmanager
def wide_batches(spark: SparkSession, rows: int = 10_000):
    """Larger batches for rows of a few numbers, while something is written."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): what other columns are called does not matter."""
    narrow_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes stand between words."""
    return _SPACE[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n-1 of an odd base and of its inverse, modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, np.uint64(b), np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        have = _powers[base] = (pair[0], pair[1])
    return have[0][:n], have[1][:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """One hash for each range of ``values``, alike for equal ranges wherever they stand."""
    power, inverse = powers(len(values) + 1, base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def text_column(column: pa.Array) -> pa.Array:
    """Texts with 64-bit offsets, null as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them), a slice of documents at a time."""
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, row + 4096, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def chunks(batches: Iterator[pa.RecordBatch], column: int, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in batches of at most ``limit`` bytes of the text column; a longer text is alone."""
    limit = limit or CHUNK_BYTES

    def together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held, size, rows = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        at, done = 0, 0
        while at < len(batch):
            end = int(np.searchsorted(ends, done + limit - size, side="right"))
            end = min(max(end, at if held else at + 1), at + CHUNK_ROWS - rows)
            if end > at:
                held.append(batch.slice(at, end - at))
                size, rows, done, at = size + int(ends[end - 1]) - done, rows + end - at, int(ends[end - 1]), end
            if at < len(batch):
                yield together(held)
                held, size, rows = [], 0, 0
    if held:
        yield together(held)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets into them) of a column with 64-bit offsets and no nulls."""
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a slice of documents: where they are, whose they are, their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.docs = len(offsets) - 1
        space = _SPACE[data]
        first = ~space
        last = first.copy()
        if len(data):
            edges = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
            keep = first[edges]
            first[1:] &= space[:-1]
            first[edges] = keep
            keep = last[edges - 1]
            last[:-1] &= space[1:]
            last[edges - 1] = keep
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        values = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
        self.hashes = range_hashes(values, self.starts, self.ends)


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of ``k`` words; a shorter document's whole sequence is one."""
    h, n = words.hashes, len(words.hashes)
    out, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= k:
        out = h[: n - k + 1].copy()
        for j in range(1, k):
            out = mix(out * _ODD + h[j : n - k + 1 + j])
        whole = words.doc[: n - k + 1] == words.doc[k - 1 :]
        out, of = out[whole], words.doc[: n - k + 1][whole]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        at, count = words.first[short], words.counts[short]
        s = h[at].copy()
        for j in range(1, k - 1):
            more = count > j
            s[more] = mix(s[more] * _ODD + h[at[more] + j])
        out = np.concatenate([out, mix(s + count.astype(np.uint64))])
        of = np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    hashes, of = shingle_hashes(words, k)
    cuts = np.searchsorted(of, np.arange(words.docs + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
