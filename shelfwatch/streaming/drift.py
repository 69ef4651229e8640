"""Stability index of each closed window of a stream against a fixed reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQuery

from ..functions import drift_band
from ..operators.drift import EPSILON, N_BINS, bin_of, column_kinds, histogram_counts, long_form, quantile_edges
from .tables import batch_folder, checkpoint_beside

OTHER = "\u0000other"


def reference_bins(ref: DataFrame, cols: Sequence[str], n_bins: int = N_BINS) -> DataFrame:
    """Rows (feature, bin, ref_n, ref_rows, edges): what a window is compared with.

    A numeric column has its quantile bins, empty ones included, and their edges; a
    categorical column has one bin per value and no edges.
    """
    numeric, categorical = column_kinds(ref, cols)
    parts = []
    if numeric:
        edges = quantile_edges(ref, numeric, n_bins)
        counts = histogram_counts(long_form(ref, numeric, "double"), edges, n_bins)
        every_bin = edges.filter(F.size("edges") > 1).withColumn(
            "bin", F.explode(F.sequence(F.lit(0), F.size("edges") - 2))
        )
        parts.append(
            every_bin.join(counts, ["feature", "bin"], "left").select(
                "feature", F.col("bin").cast("string"), F.coalesce("n", F.lit(0)).cast("long").alias("ref_n"), "edges"
            )
        )
    if categorical:
        counts = long_form(ref, categorical, "string").groupBy("feature", F.col("v").alias("bin"))
        parts.append(
            counts.agg(F.count(F.lit(1)).alias("ref_n")).withColumn("edges", F.lit(None).cast("array<double>"))
        )
    bins = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    totals = bins.groupBy("feature").agg(F.sum("ref_n").alias("ref_rows"))
    return bins.join(F.broadcast(totals), "feature").select("feature", "bin", "ref_n", "ref_rows", "edges")


def window_bin_counts(
    log: DataFrame,
    bins: DataFrame,
    cols: Sequence[str],
    length: str = "5 minutes",
    slide: str | None = None,
    watermark: str | None = None,
    ts: str = "ts",
    n_bins: int = N_BINS,
) -> DataFrame:
    """Rows (w, feature, bin, cur_n) of a batch or a stream.

    The state of a stream is bounded by the reference: a value the reference lacks counts
    under one common bin.
    """
    numeric, categorical = column_kinds(log, cols)
    if watermark is not None:
        log = log.withWatermark(ts, watermark)
    parts = []
    if numeric:
        edges = bins.filter(F.col("edges").isNotNull()).groupBy("feature").agg(F.first("edges").alias("edges"))
        rows = _long_with_time(log, numeric, "double", ts).join(F.broadcast(edges), "feature")
        rows = rows.withColumn("bin", bin_of("v", "edges", n_bins)).filter(F.col("bin").isNotNull())
        parts.append(rows.select("feature", F.col("bin").cast("string"), ts))
    if categorical:
        known = bins.filter(F.col("edges").isNull()).select("feature", F.col("bin").alias("v"), F.lit(True).alias("__known"))
        rows = _long_with_time(log, categorical, "string", ts).join(known, ["feature", "v"], "left")
        parts.append(rows.select("feature", F.when(F.col("__known"), F.col("v")).otherwise(OTHER).alias("bin"), ts))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy(F.window(ts, length, slide or length).alias("w"), "feature", "bin").agg(
        F.count(F.lit(1)).alias("cur_n")
    )


def _long_with_time(log: DataFrame, cols: Sequence[str], kind: str, ts: str) -> DataFrame:
    rows = log.select(F.col(ts), *[F.col(c).cast(kind).alias(c) for c in cols if c != ts])
    rows = rows.unpivot([ts], list(cols), "feature", "v").filter(F.col("v").isNotNull())
    return rows.filter(~F.isnan("v")) if kind == "double" else rows


def window_psi(counts: DataFrame, bins: DataFrame, eps: float = EPSILON) -> DataFrame:
    """Rows (window_start, window_end, feature, psi, band) from the bin counts of whole windows."""
    def term(cur_share):
        return (cur_share - F.col("ref_share")) * F.log(cur_share / F.col("ref_share"))

    # The index of a window without rows, once per column; each bin that a window has rows in
    # then changes its own term. So the work grows with the bins seen, not with all of them.
    ref_share = (F.col("ref_n") / F.col("ref_rows") + eps).alias("ref_share")
    terms = bins.select("feature", "bin", ref_share).withColumn("empty", term(F.lit(eps)))
    base = terms.groupBy("feature").agg(F.sum("empty").alias("base"))
    totals = counts.groupBy("w", "feature").agg(F.sum("cur_n").alias("cur_rows"))
    seen = counts.join(totals, ["w", "feature"]).join(terms, ["feature", "bin"], "left")
    change = F.coalesce(term(F.col("cur_n") / F.col("cur_rows") + eps) - F.col("empty"), F.lit(0.0))
    return (
        seen.groupBy("w", "feature")
        .agg(F.sum(change).alias("change"))
        .join(F.broadcast(base), "feature")
        .withColumn("psi", F.round(F.col("base") + F.col("change"), 6))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "feature",
            "psi",
            drift_band(F.col("psi")).alias("band"),
        )
    )


def psi_stream(
    stream: DataFrame,
    ref: DataFrame,
    cols: Sequence[str],
    path: str,
    length: str = "5 minutes",
    slide: str | None = None,
    watermark: str = "10 minutes",
    n_bins: int = N_BINS,
    checkpoint: str | None = None,
    once: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Append the index of every window once it is closed, one folder per batch.

    The reference is binned once, beside the checkpoint, and a restart goes on with the same
    bins; the checkpoint stands beside ``path`` unless one is named. Batches read the bins' table.
    All rows of a window leave the state in one batch, so each window is compared whole.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or checkpoint_beside(path)
    table = f"{checkpoint.rstrip('/')}_bins"
    try:
        bins = spark.read.parquet(table)
    except AnalysisException:
        reference_bins(ref, cols, n_bins).write.mode("overwrite").parquet(table)
        bins = spark.read.parquet(table)
    counts = window_bin_counts(stream, bins, cols, length, slide, watermark, n_bins=n_bins)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            window_psi(batch, bins).write.mode("overwrite").parquet(batch_folder(path, batch_id))
        finally:
            batch.unpersist()

    writer = (
        counts.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
