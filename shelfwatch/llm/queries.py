"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    divergence,
    fingerprints,
    lm_scores,
    mixing,
    near_dups,
    packing,
    periodic,
    quality,
    repeats,
    token_counts,
    token_shards,
    vector_dups,
    vector_search,
)
from ..session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the box that runs the tasks has them too."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vector_search.nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards and reads them back: one row per record, in the files' own numbers."""
    path = scratch_path(spark, "shards")
    token_shards.write_shards(
        _table(spark, sf_dir, "documents"), path, _vocabulary("byte_bpe_50k.tiktoken"), _byte_pattern()
    )
    return token_shards.read_shards(spark, path)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.mixed_sizes(_table(spark, sf_dir, "documents"))
    return sizes.select("doc_id", "size", "source_size", "target", "taken")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage: where it stands, and whether it is a later occurrence, to be cut."""
    found = repeats.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.explode("spans").alias("s")).select(
        "doc_id",
        F.col("s.start").alias("first_word"),
        (F.col("s.stop") - F.col("s.start")).alias("n_words"),
        F.col("s.cut").alias("cut"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score_documents(
        _table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), _byte_pattern()
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_votes(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (~quality.training_fold()).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.PASS_SCORE).cast("int").alias("predicted"),
    )


def op11_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dups.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_table(spark, sf_dir, "documents"), loops=True)
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.expr("1000 * longest.n div -longest.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_pack": op2_pack,
    "op3_near_dups": op3_near_dups,
    "op4_shards": op4_shards,
    "op5_mix": op5_mix,
    "op6_repeats": op6_repeats,
    "op7_token_counts": op7_token_counts,
    "op8_fingerprints": op8_fingerprints,
    "op9_lm_scores": op9_lm_scores,
    "op10_quality": op10_quality,
    "op11_vector_dups": op11_vector_dups,
    "op12_runs": op12_runs,
    "op13_divergence": op13_divergence,
}

ORACLES = {"op5_mix": mixing.MIXED_SIZES_SQL, "op13_divergence": divergence.DIVERGENCE_SQL}
