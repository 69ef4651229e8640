"""From raw documents to packed training batches, in five stages.

Each stage takes what the one before kept: it is written as Parquet and read again. All but
the last return the columns of ``documents``. SQL expresses neither the trained classifier nor
the suffix sort, so there is no SQL for the whole; tests hold each stage against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import mixing, near_dups, packing, quality, repeats
from shelfwatch.llm.common import bounded_broadcast, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score passes; the classifier learns from the labelled training fold."""
    model = quality.fit_votes(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "__score"
    while score in docs.columns:
        score += "_"
    scored = quality.score_quality(docs, model, score_col=score)
    return scored.filter(F.col(score) >= quality.PASS_SCORE).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    found = near_dups.near_duplicates(docs, words=5, percent=80)
    going = stored(found.filter("not kept").select(F.col("doc_id").alias("__going")).distinct(), "near-copies")
    return docs.join(bounded_broadcast(going), docs["doc_id"] == going["__going"], "left_anti")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that stand earlier in the corpus."""
    return repeats.cut_repeats(docs, repeats.repeated_passages(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    return mixing.mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes: bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("minhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
