"""Request counts, rates and latency quantiles; every function takes a batch or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the latency buckets in seconds; the last bucket is open.
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.2, 0.5, 1.0, 2.5, 5.0)


def request_counts(log: DataFrame) -> DataFrame:
    """Rows (status, requests)."""
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("requests"))


def bucket_label(bound: float | None) -> str:
    return "+Inf" if bound is None else repr(float(bound))


def _bucket_counts(latency: str, bounds: Sequence[float]) -> list[Column]:
    """Cumulative counts per bound, bounds included, then the count of all."""
    counts = [F.count_if(F.col(latency) <= b).alias(f"__le{i}") for i, b in enumerate(bounds)]
    return [*counts, F.count(latency).alias("__all"), F.sum(latency).alias("__sum")]


def latency_buckets(
    log: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS, by: Sequence[str] = (), latency: str = "latency_s"
) -> DataFrame:
    """Rows (*by, le, requests): requests that took at most ``le`` seconds."""
    counted = log.groupBy(*by).agg(*_bucket_counts(latency, bounds))
    pairs = [
        F.struct(F.lit(bucket_label(b)).alias("le"), F.col(f"__le{i}").alias("requests")) for i, b in enumerate(bounds)
    ]
    pairs.append(F.struct(F.lit(bucket_label(None)).alias("le"), F.col("__all").alias("requests")))
    return counted.select(*by, F.inline(F.array(*pairs)))


def bucket_quantile(q: float, counts: Sequence[Column], total: Column, bounds: Sequence[float]) -> Column:
    """Quantile from cumulative counts: linear inside its bucket, the first one from 0.

    In the open bucket it is the highest finite bound; without observations it is null.
    """
    rank = F.lit(float(q)) * total
    found = F.when(total == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        lower = 0.0 if i == 0 else bounds[i - 1]
        before = F.lit(0) if i == 0 else counts[i - 1]
        share = F.coalesce(F.try_divide(rank - before, counts[i] - before), F.lit(0.0))
        found = found.when(counts[i] >= rank, F.lit(lower) + (bound - lower) * share)
    return found.otherwise(F.lit(float(bounds[-1])))


def _windows(log: DataFrame, length: str, slide: str, watermark: str | None) -> tuple[DataFrame, Column]:
    if watermark is not None:
        log = log.withWatermark("ts", watermark)
    return log, F.window("ts", length, slide)


def _seconds(length: str) -> float:
    import pandas as pd

    return pd.Timedelta(length).total_seconds()


def request_rate_5m(
    log: DataFrame, length: str = "5 minutes", slide: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """Rows (window_start, window_end, status, requests, per_second)."""
    log, window = _windows(log, length, slide, watermark)
    return (
        log.groupBy(window.alias("w"), "status")
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "status",
            "requests",
            (F.col("requests") / F.lit(_seconds(length))).alias("per_second"),
        )
    )


def latency_quantiles_5m(
    log: DataFrame,
    qs: Sequence[float] = (0.5, 0.95),
    length: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str | None = None,
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """Rows (window_start, window_end, requests, p50, p95) from bucket counts."""
    log, window = _windows(log, length, slide, watermark)
    counted = log.groupBy(window.alias("w")).agg(*_bucket_counts("latency_s", bounds))
    counts = [F.col(f"__le{i}") for i in range(len(bounds))]
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.col("__all").alias("requests"),
        *[bucket_quantile(q, counts, F.col("__all"), bounds).alias(f"p{q * 100:g}") for q in qs],
    )
