"""Document quality by a vote of the nearest labelled documents in a latent-semantic space.

Terms are hashed byte trigrams, and the place of a word in a run of equal words. A bounded sample of labelled documents gives the term weights
and the leading directions of its weighted term matrix; every document is projected on them,
compared with all labelled vectors in exact blocked cosine products, and scored by the labels
of its nearest ones, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Words, documents_of, narrow_batches, slices, text_column

#: Labelled documents that take part at most, chosen by a hash of their id.
SAMPLE_ROWS = 4_096
#: Term buckets, of which the last ones count runs; latent dimensions, voters, documents compared at once.
TERMS, RUN_TERMS, DIMENSIONS, NEIGHBOURS, BLOCK = 4_096, 16, 48, 15, 256
#: Documents that score less are rejected.
PASS_SCORE = 0.3


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each term occurs, a row per document; no term crosses documents."""
    docs, grams = len(offsets) - 1, TERMS - RUN_TERMS
    places = np.zeros(0, np.int64)
    if len(data) >= 3:
        b = data.astype(np.uint32)
        term = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)
        term ^= term >> np.uint32(15)
        term = (term * np.uint32(0x27D4EB2F)) >> np.uint32(8)
        of = np.repeat(np.arange(docs), np.diff(offsets))
        inside = of[:-2] == of[2:]
        places = of[:-2][inside] * TERMS + term[inside] % np.uint32(grams)
    words = Words(data, offsets, lower=False)
    at = np.arange(len(words.doc))
    again = np.zeros(len(at), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    run = at - np.maximum.accumulate(np.where(again, 0, at)) if len(at) else at
    runs = words.doc[again] * TERMS + grams + np.minimum(run[again], RUN_TERMS) - 1
    counts = np.bincount(np.concatenate([places, runs]), minlength=docs * TERMS)
    return counts.reshape(docs, TERMS).astype(np.float32)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse term counts of labelled documents."""
    for batch in batches:
        for start, end, data, offsets in slices(text_column(batch.column(1))):
            for row in range(start, end):
                a, b = offsets[row - start], offsets[row - start + 1]
                counts = term_counts(data[a:b], np.array([0, b - a]))[0]
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, 1),
                        batch.column(2).slice(row, 1),
                        pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                        pa.array([counts[at].astype(np.float32).tobytes()], pa.binary()),
                    ],
                    names=["doc_id", "label", "terms", "counts"],
                )


@dataclass
class VoteModel:
    """Term weights, latent directions, and the unit vectors and labels of the voters."""

    weights: np.ndarray
    directions: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        rows = np.log1p(counts) * self.weights
        rows = rows @ self.directions
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Shares of label 1 among the nearest voters; rows without terms get the prior."""
        out = np.full(len(counts), self.prior)
        k = min(self.neighbours, len(self.labels))
        if not k:
            return out
        for at in range(0, len(counts), BLOCK):
            rows = self.vectors(counts[at : at + BLOCK])
            near = rows @ self.voters.T
            if k < near.shape[1]:
                nearest = np.argpartition(-near, k - 1, axis=1)[:, :k]
                near, labels = np.take_along_axis(near, nearest, axis=1), self.labels[nearest]
            else:
                labels = np.broadcast_to(self.labels, near.shape)
            weight = np.maximum(near, 0.0).astype(np.float64) ** 2
            total = weight.sum(axis=1)
            voted = total > 0
            out[at : at + BLOCK][voted] = (weight * labels).sum(axis=1)[voted] / total[voted]
        # How a block is summed depends on its other rows; rounding keeps equal texts alike.
        return np.clip(np.round(out, 4), 0.0, 1.0)


def training_fold(id_col: str = "doc_id"):
    """Whether a row may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def fit_votes(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    dimensions: int = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> VoteModel:
    """A model from at most ``sample_rows`` labelled rows of the training fold.

    Rows are chosen by a hash of the id, so the choice repeats. Labels other than 0 and 1,
    and labels of unknown documents, are left out; a document with several labels has the
    largest. Without labelled rows every score is 0.5.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & training_fold("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = documents_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    found = sample.mapInArrow(_counted, "doc_id long, label int, terms binary, counts binary").toPandas()
    found = found.sort_values(["doc_id", "terms", "counts"]).drop_duplicates("doc_id").reset_index(drop=True)
    rows = len(found)
    if not rows:
        empty = np.zeros((0, dimensions), np.float32)
        return VoteModel(np.ones(TERMS, np.float32), np.zeros((TERMS, dimensions), np.float32), empty, np.zeros(0), 0.5)
    counts = np.zeros((rows, TERMS), np.float32)
    for row, (terms, values) in enumerate(zip(found["terms"], found["counts"])):
        counts[row, np.frombuffer(terms, np.uint16)] = np.frombuffer(values, np.float32)
    weights = (np.log((1 + rows) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
    matrix = np.log1p(counts) * weights
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    directions = leading_directions(matrix, dimensions)
    model = VoteModel(weights, directions, np.zeros((0, 0)), np.zeros(0), float(found["label"].mean()))
    vectors = model.vectors(counts)
    real = np.linalg.norm(vectors, axis=1) > 0
    model.voters, model.labels = vectors[real], found["label"].to_numpy(np.float64)[real]
    return model


def leading_directions(matrix: np.ndarray, dimensions: int, passes: int = 4) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    size = min(dimensions + 8, *matrix.shape)
    basis = np.random.default_rng(5).standard_normal((matrix.shape[1], size)).astype(np.float32)
    for _ in range(passes):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, rotation = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ rotation.T)[:, :dimensions])


def score_quality(
    docs: DataFrame, model: VoteModel, id_col: str = "doc_id", text_col: str = "text", score_col: str = "quality_score"
) -> DataFrame:
    """The columns of ``docs`` and ``score_col`` from 0 to 1, in place of a column of that name.

    Whole texts are scored, each row by its own text alone, so equal texts score alike. Null,
    empty and very short texts score the share of label 1 among the voters. Text is the only
    input. The model is broadcast: its size is bounded by the sample. No rows give no rows.
    """
    narrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c.lower() != score_col.lower()]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch.column(at))
            scores = np.zeros(len(texts))
            for start, end, data, offsets in slices(texts):
                for a in range(start, end, BLOCK):
                    b = min(a + BLOCK, end)
                    part = offsets[a - start : b - start + 1]
                    counts = term_counts(data[part[0] : part[-1]], part - part[0])
                    scores[a:b] = shared.value.scores(counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])

    schema = StructType([*rows.schema.fields, StructField(score_col, DoubleType())])
    return rows.mapInArrow(run, schema)
