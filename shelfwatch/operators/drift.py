"""Population stability index between a reference and a current frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType
from pyspark.sql.window import Window

from ..functions import drift_band
from .ordered import count_reached, interpolated_quantiles, ranks_near

EPSILON = 1e-6
N_BINS = 10
RETRAIN_THRESHOLD = 0.2
# Sketches of this size are off by about a thousandth of the rows; five times that is kept on each side.
SKETCH_K, SKETCH_MARGIN = 4096, 0.005


def common_columns(ref: DataFrame, cur: DataFrame) -> list[str]:
    """Columns of both frames, in the order of the reference."""
    return [c for c in ref.columns if c in cur.columns]


def column_kinds(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split columns into (numeric, categorical) by type."""
    numeric, categorical = [], []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, NumericType):
            numeric.append(c)
        elif isinstance(kind, (StringType, BooleanType)):
            categorical.append(c)
        else:
            raise TypeError(f"column {c} of type {kind.simpleString()} is neither numeric nor categorical")
    return numeric, categorical


def long_form(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """Rows (feature, v) of the named columns without missing values, column by column."""
    rows = df.select(*[F.col(c).cast(kind).alias(c) for c in cols])
    rows = rows.unpivot([], list(cols), "feature", "v").filter(F.col("v").isNotNull())
    return rows.filter(~F.isnan("v")) if kind == "double" else rows


def value_counts(ref: DataFrame, cur: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """Rows (feature, v, ref_n, cur_n): how often each value occurs on each side.

    Counted before the shuffle, so a value that fills a third of a column costs one row per
    task. The last filter is always true; it keeps both counts in every branch of a plan, so
    that all branches read the same exchange.
    """
    both = (
        long_form(ref, cols, kind).withColumn("__ref", F.lit(1)).unionByName(
            long_form(cur, cols, kind).withColumn("__ref", F.lit(0))
        )
    )
    return (
        both.groupBy("feature", "v")
        .agg(F.sum("__ref").alias("ref_n"), F.sum(1 - F.col("__ref")).alias("cur_n"))
        .filter(F.col("ref_n") + F.col("cur_n") > 0)
    )


def value_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (feature, value, n, share): share of each value among a column's non-missing rows."""
    counts = long_form(df, cols, "string").groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    # One row per column of the table, so the broadcast side is bounded by its width.
    totals = counts.groupBy("feature").agg(F.sum("n").alias("__total"))
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", F.col("v").alias("value"), "n", (F.col("n") / F.col("__total")).alias("share")
    )


def _reference_ranks(ref: DataFrame, cols: Sequence[str], n_bins: int, sketches: DataFrame | None = None) -> DataFrame:
    fractions = [i / n_bins for i in range(1, n_bins)]
    probes = sketch_probes(sketches.filter(F.col("feature").isin(list(cols))), fractions) if sketches is not None else None
    return ranks_near(long_form(ref, cols, "double"), "feature", "v", fractions, probes)


def daily_sketches(df: DataFrame, cols: Sequence[str], date: str = "date") -> DataFrame:
    """Rows (day, feature, sketch, n, least, greatest): a mergeable quantile sketch of each numeric column and day.

    Kept as a table and added to day by day, they spare ``quantile_edges`` and ``psi_numeric``
    the read that finds out where the quantiles lie, for any window of days.
    """
    rows = df.select(F.to_date(F.col(date)).alias("day"), *[F.col(c).cast("double").alias(c) for c in cols if c != date])
    long = rows.unpivot(["day"], list(cols), "feature", "v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return long.groupBy("day", "feature").agg(
        F.kll_sketch_agg_double("v", F.lit(SKETCH_K)).alias("sketch"),
        F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"),
    )


def sketch_probes(sketches: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """Rows (feature, __probes, __ends, total) of merged sketches: two values around each fraction, beyond their error."""
    at = [min(max(f + side * SKETCH_MARGIN, 0.0), 1.0) for f in fractions for side in (-1, 1)]
    merged = sketches.groupBy("feature").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest")
    )
    probes = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for p in at])
    found = merged.select("feature", probes.alias("__probes"), F.array("least", "greatest").alias("__ends"), "total")
    # Merging draws at random, and all parts of a plan must see the same values: one row per column is fetched.
    return sketches.sparkSession.createDataFrame(found.collect(), found.schema)


def quantile_edges(
    ref: DataFrame,
    cols: Sequence[str],
    n_bins: int = N_BINS,
    round_to: int | None = None,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Rows (feature, edges): exact, distinct quantiles of each numeric column.

    ``sketches`` are the ``daily_sketches`` of the same rows; with them the reference is read
    once and not twice, and the edges are the same. A sketch that missed its error bound, or
    stands for other rows, makes the query fail.
    """
    edges = interpolated_quantiles(_reference_ranks(ref, cols, n_bins, sketches), "feature", n_bins)
    if round_to is None:
        return edges
    rounded = F.transform("edges", lambda edge: F.round(edge, round_to))
    return edges.withColumn("edges", F.array_distinct(rounded))


def bin_of(value: str, edges: str, n_bins: int = N_BINS) -> Column:
    """Bin of a value column: half-open bins, the last one closed, null outside all of them.

    ``edges`` names an array column of at most ``n_bins + 1`` edges.
    """
    reached = count_reached(f"`{value}`", f"`{edges}`", n_bins + 1)
    return F.expr(
        f"""CASE WHEN size(`{edges}`) > 1 AND `{value}` >= get(`{edges}`, 0) AND `{value}` <= get(`{edges}`, size(`{edges}`) - 1)
            THEN least({reached}, size(`{edges}`) - 1) - 1 END"""
    )


def histogram_counts(long: DataFrame, edges: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Rows (feature, bin, n) of long-form values within the edges; values outside are dropped.

    ``edges`` is one row per column of the table, so small enough to broadcast.
    """
    placed = long.join(F.broadcast(edges), "feature").select("feature", bin_of("v", "edges", n_bins).alias("bin"))
    return placed.filter(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def _psi_term(eps: float) -> Column:
    ref_share = F.coalesce(F.try_divide(F.col("ref_n"), F.col("ref_rows")), F.lit(0.0)) + eps
    cur_share = F.coalesce(F.try_divide(F.col("cur_n"), F.col("cur_rows")), F.lit(0.0)) + eps
    return (cur_share - ref_share) * F.log(cur_share / ref_share)


def _all_features(result: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per asked column, also for columns without any value.

    The result has one row per column of the table, so it can be broadcast.
    """
    spark = result.sparkSession
    names = spark.range(1, numPartitions=1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))
    return names.join(F.broadcast(result), "feature", "left")


def psi_categorical(ref: DataFrame, cur: DataFrame, cols: Sequence[str], eps: float = EPSILON) -> DataFrame:
    """Rows (feature, psi, status) over the categories of the reference.

    Shares are of all non-missing rows, so a category only the current frame has adds no
    term but lowers the shares of the others.
    """
    counts = value_counts(ref, cur, cols, "string")
    # One row per column of the table.
    totals = counts.groupBy("feature").agg(F.sum("ref_n").alias("ref_rows"), F.sum("cur_n").alias("cur_rows"))
    result = (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(
            F.round(F.sum(F.when(F.col("ref_n") > 0, _psi_term(eps))), 6).alias("psi"),
            ((F.max("ref_rows") > 0) & (F.max("cur_rows") > 0)).alias("filled"),
        )
    )
    status = F.when(F.col("filled"), "ok").otherwise("no_data")
    return _all_features(result, cols).select(
        "feature", F.coalesce("psi", F.lit(0.0)).alias("psi"), status.alias("status")
    )


def psi_numeric(
    ref: DataFrame,
    cur: DataFrame,
    cols: Sequence[str],
    n_bins: int = N_BINS,
    eps: float = EPSILON,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Rows (feature, psi, status) over quantile bins of the reference.

    Shares are of the rows inside the bins. A column with fewer than two distinct edges has
    index 0; one without values on either side has none.

    The current frame is read once and combined before its shuffle. The reference's bins are
    summed from the ranks its edges came from: an edge never lies inside a stretch of ranks,
    so a stretch is in one bin as a whole. ``sketches`` are as for ``quantile_edges``.
    """
    ranks = _reference_ranks(ref, cols, n_bins, sketches)
    edges = interpolated_quantiles(ranks, "feature", n_bins)
    flat = F.size("edges") < 2

    def bins(rows: DataFrame, value: str, ref_n: Column, cur_n: Column) -> DataFrame:
        placed = rows.join(F.broadcast(edges), "feature").select(
            "feature",
            F.when(flat, F.lit(-1)).otherwise(bin_of(value, "edges", n_bins)).alias("bin"),
            ref_n.alias("ref_n"),
            cur_n.alias("cur_n"),
        )
        return placed.filter(F.col("bin").isNotNull())

    none = F.lit(0).cast("long")
    both = bins(ranks, "low", F.col("n"), none).unionByName(
        bins(long_form(cur, cols, "double"), "v", none, F.lit(1).cast("long"))
    )
    counts = both.groupBy("feature", "bin").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
    # At most n_bins rows per column from here on.
    whole = Window.partitionBy("feature")
    result = (
        counts.withColumn("ref_rows", F.sum("ref_n").over(whole))
        .withColumn("cur_rows", F.sum("cur_n").over(whole))
        .groupBy("feature")
        .agg(
            F.when(F.max("bin") == -1, F.lit(0.0))
            .when((F.max("ref_rows") > 0) & (F.max("cur_rows") > 0), F.round(F.sum(_psi_term(eps)), 6))
            .alias("psi")
        )
    )
    return _all_features(result, cols).withColumn("status", F.when(F.col("psi").isNull(), "no_data").otherwise("ok"))


def psi_report(
    ref: DataFrame,
    cur: DataFrame,
    cols: Sequence[str] | None = None,
    n_bins: int = N_BINS,
    eps: float = EPSILON,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Rows (feature, psi, band, status) for all columns the frames share; ``sketches`` as for ``quantile_edges``."""
    cols = list(cols) if cols is not None else common_columns(ref, cur)
    numeric, categorical = column_kinds(ref, cols)
    parts = []
    if numeric:
        parts.append(psi_numeric(ref, cur, numeric, n_bins, eps, sketches))
    if categorical:
        parts.append(psi_categorical(ref, cur, categorical, eps))
    if not parts:
        raise ValueError("the frames share no columns")
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.select("feature", "psi", drift_band(F.col("psi")).alias("band"), "status")


def window_sizes(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """One row (ref_rows, cur_rows)."""
    sides = ref.select(F.lit(1).alias("__ref")).unionByName(cur.select(F.lit(0).alias("__ref")))
    return sides.agg(
        F.count_if(F.col("__ref") == 1).alias("ref_rows"), F.count_if(F.col("__ref") == 0).alias("cur_rows")
    )


def retrain_decision(psi: DataFrame, threshold: float = RETRAIN_THRESHOLD) -> DataFrame:
    """One row (retrain, max_psi, max_feature): retrain when any index is above the threshold."""
    return psi.agg(
        F.coalesce(F.bool_or(F.col("psi") > threshold), F.lit(False)).alias("retrain"),
        F.max("psi").alias("max_psi"),
        F.max_by("feature", F.struct("psi", "feature")).alias("max_feature"),
    )
