"""Pack sequences into batches: optimal length buckets, then a token budget per batch.

The histogram of all lengths is small, because documents are cut into pieces of a bounded
length first; dynamic programming over it chooses the bucket ceilings with the least padding.
Inside a bucket, batches are consecutive pieces in a hashed order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import stored, wide_batches
from .mixing import word_count

#: Words of a piece at most, buckets, padded words of a batch at most.
MAX_LENGTH, BUCKETS, BUDGET = 2_048, 16, 32_768


def best_ceilings(lengths: Sequence[int], counts: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """The at most ``buckets`` ceilings, each a length that occurs, with the least padding.

    Exact: the cheapest way to cover the first j lengths with b buckets, for all j and b.
    """
    order = np.argsort(lengths)
    x, c = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    if not len(x):
        return []
    n = len(x)
    rows = np.concatenate([[0], np.cumsum(c)]).astype(np.float64)
    # Padded words of one bucket over lengths i..j-1: x[j-1] times their rows. The words
    # themselves are the same for all choices.
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    back = []
    for _ in range(min(buckets, n)):
        ways = cost[None, :n] + x[:, None] * (rows[1:, None] - rows[None, :n])
        ways[np.triu_indices(n, 1)] = np.inf
        came = ways.argmin(axis=1)
        fresh = np.concatenate([[0.0], ways[np.arange(n), came]])
        back.append(came)
        cost = fresh
    out, j = [], n
    for came in reversed(back):
        if j == 0:
            break
        out.append(int(x[j - 1]))
        j = int(came[j - 1])
    return sorted(out)


def pieces(
    docs: DataFrame, max_length: int = MAX_LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, piece, first_word, n_words): documents cut into at most ``max_length`` words."""
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("size"))
    last = F.floor((F.col("size") - 1) / max_length)
    # No filter on the size: it would be pushed below and count the words twice.
    places = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last))
    cut = sized.select("doc_id", "size", F.explode(places).alias("piece"))
    first = F.col("piece") * max_length
    return cut.select(
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        first.alias("first_word"),
        F.least(F.lit(max_length).cast("long"), F.col("size") - first).alias("n_words"),
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition, and the row's number within its bucket and partition; rows come sorted by bucket."""
    from pyspark import TaskContext

    part, bucket, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        b = batch.column(0).to_numpy()
        turns = np.flatnonzero(np.diff(b, prepend=b[0] if len(b) else 0))
        starts = np.concatenate([[0], turns])
        numbers = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
        if len(b):
            if bucket == b[0]:
                head = turns[0] if len(turns) else len(b)
                numbers[:head] += seen
            bucket, seen = b[-1], int(numbers[-1]) + 1
        parts = pa.array(np.full(len(b), part, np.int32))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, parts, pa.array(numbers.astype(np.int64))], names=[*batch.schema.names, "part", "number"]
        )


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, piece, first_word, n_words, bucket_words, batch_id, slot): where each piece goes.

    A piece is padded to ``bucket_words``, its bucket's ceiling. A batch is ``batch_id`` of its
    bucket and holds up to ``budget / bucket_words`` pieces (one at least), so that its padded
    words keep the budget; only a bucket's last batch is not full. Pieces are in the order of a
    hash of seed, id and piece, so reruns agree.

    Every word of every text is in one piece. Null and blank texts have none. Rows that repeat
    an id are packed each on their own; a null id is packed like any other. One bucket may
    hold all rows: they are numbered by a sort and the row counts of its tasks.
    """
    cut = stored(pieces(docs, max_length, id_col, text_col), "pieces")
    histogram = cut.groupBy("n_words").count().collect()  # at most max_length rows
    ceilings = best_ceilings([r[0] for r in histogram], [r[1] for r in histogram], buckets)
    if not ceilings:
        ceilings = [max_length]
    ceiling = F.lit(ceilings[-1])
    for c in reversed(ceilings[:-1]):
        ceiling = F.when(F.col("n_words") <= c, F.lit(c)).otherwise(ceiling)
    hashed = cut.select(
        ceiling.cast("int").alias("bucket_words"),
        F.xxhash64(F.lit(seed), "doc_id", "piece").alias("at"),
        "doc_id",
        "piece",
        "first_word",
        "n_words",
    )
    order = ["bucket_words", "at", "doc_id", "piece"]
    ranged = hashed.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType([*hashed.schema.fields, StructField("part", IntegerType()), StructField("number", LongType())])
    with wide_batches(docs.sparkSession):
        numbered = stored(ranged.mapInArrow(_numbered, schema), "numbered")
    # One row for each task and bucket in it: tasks are in the order of the sort.
    counts = numbered.groupBy("bucket_words", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("bucket_words").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    place = F.col("number") + F.col("offset")
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_words")))
    return numbered.join(F.broadcast(offsets), ["bucket_words", "part"]).select(
        "doc_id",
        "piece",
        "first_word",
        "n_words",
        "bucket_words",
        F.floor(place / per_batch).alias("batch_id"),
        (place % per_batch).cast("int").alias("slot"),
    )
