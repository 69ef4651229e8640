"""Ordered computations that never put a whole series, or a whole column, into one task.

Three building blocks:

* ``with_history``: rows are split by series *and* stretch of time, and each stretch gets the
  few rows before it as history, so a row-based window over one stretch is exact.
* ``ranked_values``: distinct values are split into ranges of about equal size, and running
  counts continue from one range to the next, so ranks are exact without a global sort.
* ``ranks_near``: exact ranks, but only of the values around a few fractions of the rows;
  everything between them is counted in bulk, so hardly anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType
from pyspark.sql.window import Window

from ..session import scratch_path

CHUNK_DAYS = 256
CHUNK = "__chunk"
HISTORY = "__history"
PART = "__part"
# Rows that one task may sort, and parts that a larger stretch is cut into at a time.
HOT_ROWS = 1_000_000
N_PARTS = 32


def time_chunk(time: Column, chunk_days: int) -> Column:
    """Number of the stretch of ``chunk_days`` days that a date or timestamp lies in."""
    if chunk_days < 1:
        raise ValueError("chunk_days must be at least 1")
    return F.floor(F.unix_date(F.to_date(time)) / F.lit(chunk_days)).cast("long")


def _oldest_first(a: Column, b: Column) -> Column:
    return b["__back"] - a["__back"]


def with_history(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    n_rows: int,
    tie_cols: Sequence[str] = (),
    chunk_days: int = CHUNK_DAYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of ``df`` by series and stretch, plus the ``n_rows`` rows before each stretch.

    Adds ``__chunk``, ``__part`` where chunks are cut, and the flag ``__history``. The result
    is hash-partitioned by series and stretch, so a window on them needs no further shuffle.
    ``time`` and ``tie_cols`` together order the rows of a series.

    A series of dates without ``tie_cols`` has one row a day, so a chunk of it is no longer
    than its days. In any other series a chunk with more than ``hot_rows`` rows is cut into
    parts first, by time and ``tie_cols``.

    The full rows are shuffled once: the tails read the same exchange as the main branch
    (which is why they carry every column), and what they shuffle themselves is at most
    ``n_rows`` rows per stretch. A series adds one summary row per stretch, so its summary is
    as long as the calendar is, not as its rows are.
    """
    keys = list(keys)
    columns = df.columns
    order = [time, *tie_cols]
    placed = df.withColumn(CHUNK, time_chunk(F.col(time), chunk_days))
    if tie_cols or not isinstance(df.schema[time].dataType, DateType):
        placed = cut_hot_stretches(placed, keys, order, hot_rows)
    parts = stretch_of(placed)
    placed = placed.repartition(*keys, *parts)

    newest_first = chunk_window(placed, keys, [F.desc_nulls_last(c) for c in order])
    payload = [c for c in columns if c not in keys]
    tails = (
        placed.withColumn("__back", F.row_number().over(newest_first))
        .filter(F.col("__back") <= n_rows)
        .groupBy(*keys, *parts)
        .agg(F.array_sort(F.collect_list(F.struct("__back", *payload)), _oldest_first).alias("__tail"))
    )
    # Every stretch holds at least one row, so the n_rows stretches before it are enough.
    before = Window.partitionBy(*keys).orderBy(*parts).rowsBetween(-n_rows, -1)
    history = (
        tails.withColumn("__tail", F.flatten(F.collect_list("__tail").over(before)))
        .withColumn("__row", F.explode(F.slice("__tail", F.greatest(F.size("__tail") - n_rows + 1, F.lit(1)), n_rows)))
        .select(*keys, *[F.col("__row")[c].alias(c) for c in payload], *parts)
        .select(*columns, *parts, F.lit(True).alias(HISTORY))
        .repartition(*keys, *parts)
    )
    return placed.withColumn(HISTORY, F.lit(False)).unionByName(history)


def cut_hot_stretches(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """Add ``__part`` where stretches have more than ``hot_rows`` rows; parts follow ``order``.

    A hot stretch is cut at the least value, the greatest and some that a hash picks, and so
    are its parts until none is hot, whatever the number of rows and of hot stretches. Only
    rows that are equal in ``order`` stay together. One aggregate says whether there is
    anything to cut; cuts are written to the shared folder. Without hot stretches there is no
    such column: a constant in a partitioning would hide from the planner that the rows are
    already where a window needs them.
    """
    at = F.struct(*order)
    while True:
        cell = [*keys, *stretch_of(df)]
        hot = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
        if hot.isEmpty():
            return df
        hot = hot.select(*[F.col(c).alias(f"__hot_{c}") for c in cell])
        picked = [F.min_by(at, F.xxhash64(*order, F.lit(turn))) for turn in range(N_PARTS - 3)]
        cuts = (
            df.join(hot, _same(cell), "left_semi")
            .groupBy(*[F.col(c).alias(f"__hot_{c}") for c in cell])
            .agg(F.array_sort(F.array_distinct(F.array(F.min(at), F.max(at), *picked))).alias("__cuts"))
            .filter(F.size("__cuts") > 1)
        )
        path = scratch_path(df.sparkSession, "cuts")
        cuts.write.parquet(path)
        cuts = df.sparkSession.read.schema(cuts.schema).parquet(path)
        if cuts.isEmpty():
            return df
        part = F.when(F.col("__cuts").isNull(), 0).otherwise(F.expr(count_reached("__clock", "__cuts", N_PARTS - 1)))
        before = F.col(PART) * N_PARTS if PART in df.columns else F.lit(0)
        kept = [c for c in df.columns if c != PART]
        df = (
            df.withColumn("__clock", at)
            .join(cuts, _same(cell), "left")
            .select(*kept, (before + part).cast("long").alias(PART))
        )


def _same(cell: Sequence[str]) -> Column:
    """Whether a row lies in a hot stretch; missing keys are a series too."""
    found = F.lit(True)
    for c in cell:
        found = found & F.col(c).eqNullSafe(F.col(f"__hot_{c}"))
    return found


def stretch_of(df: DataFrame) -> list[str]:
    """Columns that tell the stretches of a series apart, in order of time."""
    return [c for c in (CHUNK, PART) if c in df.columns]


def chunk_window(df: DataFrame, keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, *stretch_of(df)).orderBy(*order)


def without_history(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HISTORY)).drop(CHUNK, PART, HISTORY)


def default_ranges(df: DataFrame) -> int:
    """One range per shuffle partition, within what one row per group can hold."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(partitions, 512))


def ranked_values(
    counts: DataFrame,
    group: str,
    value: str,
    count_cols: Sequence[str],
    n_ranges: int | None = None,
) -> DataFrame:
    """Running totals of ``count_cols`` in order of ``value`` within ``group``.

    ``counts`` holds one row per distinct (group, value). For each count column ``c`` the
    result has ``c_upto`` (this value included) and ``c_total``. Ranges of values are cut at
    approximate quantiles of the distinct values; the cuts only balance the work, the totals
    are exact whatever the cuts are. What is broadcast is one row per group, and one per
    (group, range): groups are columns of a table, so both are bounded by
    columns x ranges.
    """
    n_ranges = n_ranges or default_ranges(counts)
    fractions = [i / n_ranges for i in range(1, n_ranges)]
    cuts = counts.groupBy(group).agg(
        F.array_distinct(F.percentile_approx(value, fractions, 50 * n_ranges)).alias("__cuts"),
        *[F.sum(c).alias(f"{c}_total") for c in count_cols],
    )
    cut_of = F.col(value)
    ranged = counts.join(F.broadcast(cuts), group).withColumn(
        "__range", F.size(F.filter("__cuts", lambda cut: cut < cut_of))
    ).drop("__cuts")

    ranged = ranged.repartition(group, "__range")
    earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "__range")
        .agg(*[F.sum(c).alias(f"__{c}") for c in count_cols])
        .select(
            group,
            "__range",
            *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}_before") for c in count_cols],
        )
    )
    within = Window.partitionBy(group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.select("*", *[F.sum(c).over(within).alias(f"__{c}_within") for c in count_cols])
    return (
        running.join(F.broadcast(offsets), [group, "__range"])
        .select(
            *counts.columns,
            *[(F.col(f"__{c}_before") + F.col(f"__{c}_within")).alias(f"{c}_upto") for c in count_cols],
            *[f"{c}_total" for c in count_cols],
        )
    )


# Sketches are off by at most one in SKETCH_ACCURACY rows; twice that is kept on each side.
SKETCH_ACCURACY = 50_000
# Groups up to this size keep every distinct value: a margin of 2 / SKETCH_ACCURACY would
# there be less than a few rows wide.
KEEP_ALL_ROWS = 200_000


def count_reached(value: str, cuts: str, n_cuts: int) -> str:
    """SQL: how many of up to ``n_cuts`` ascending cuts the value has reached.

    A binary search in nested CASE, which stays in generated code; a higher-order function
    would not. Cuts the array does not have are null and so never reached.
    """

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high + 1) // 2
        above, below = search(middle, high), search(low, middle - 1)
        return f"CASE WHEN {value} >= get({cuts}, {middle - 1}) THEN {above} ELSE {below} END"

    return search(0, n_cuts)


def ranks_near(
    long: DataFrame, group: str, value: str, fractions: Sequence[float], probes: DataFrame | None = None
) -> DataFrame:
    """Rows (group, low, high, n, start, upto, total): values with the ranks they take up.

    A row stands for the ``n`` rows of a group with ranks ``start`` to ``upto - 1``, counted
    from 0, whose values go from ``low`` to ``high``. Around each fraction of the rows, and
    at the least and greatest value, a row is one distinct value; the stretches between are
    one row each. So ranks and values at the fractions are exact.

    The input is read twice, once for a sketch that says where the fractions lie and once to
    count; both combine before their shuffle. Of N rows about
    ``4 * len(fractions) * N / SKETCH_ACCURACY`` are shuffled one by one, fewer where values
    repeat. What is broadcast is one row per group and one per (group, stretch).

    ``probes`` spares the first read: rows (group, __probes, __ends, total) from sketches kept
    earlier, with two values around each fraction, the least and greatest value, and the rows.
    Ranks still come from the count, so older sketches can make the search fail, never wrong.
    """
    n_cuts = 2 * len(fractions) + 2
    # A stretch is numbered by the cuts below it; it is open when it lies within one fraction's probes.
    sketch = (
        (_probes(long, group, value, fractions) if probes is None else probes)
        .withColumn("__cuts", F.expr("array_sort(array_distinct(concat(__ends, __probes)))"))
        .withColumn(
            "__open",
            F.expr(
                f"""transform(sequence(0, {n_cuts}), i -> total <= {KEEP_ALL_ROWS} OR coalesce(exists(
                    sequence(0, {2 * len(fractions) - 2}, 2),
                    j -> get(__probes, j) <= get(__cuts, i - 1) AND get(__probes, j + 1) >= get(__cuts, i)), false))"""
            ),
        )
        .select(group, "total", "__cuts", "__open")
    )
    reached = F.expr(count_reached(f"`{value}`", "__cuts", n_cuts))
    on_cut = F.expr(f"get(__cuts, __reached - 1) <=> `{value}`")
    placed = (
        long.join(F.broadcast(sketch), group).withColumn("__reached", reached).withColumn("__on_cut", on_cut)
    )
    counted = placed.groupBy(
        group,
        (2 * F.col("__reached") - F.col("__on_cut").cast("int")).alias("__slot"),
        F.when(F.col("__on_cut") | F.get("__open", F.col("__reached")), F.col(value)).alias("__v"),
    ).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"), F.max("total").alias("total"))
    # Always true; it keeps all columns in every branch, so that all read the same exchange.
    counted = counted.filter((F.col("high") >= F.col("low")) & (F.col("total") >= F.col("n")))

    earlier = Window.partitionBy(group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy(group, "__slot")
        .agg(F.sum("n").alias("__n"))
        .select(
            group, "__slot", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
            F.sum("__n").over(Window.partitionBy(group)).alias("__counted"),
        )
    )
    total = F.col("total") if probes is None else F.col("__counted")
    within = Window.partitionBy(group, "__slot").orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("__before") + F.col("__within")
    return (
        counted.withColumn("__within", F.sum("n").over(within))
        .join(F.broadcast(offsets), [group, "__slot"])
        .select(group, "low", "high", "n", (upto - F.col("n")).alias("start"), upto.alias("upto"), total.alias("total"))
    )


def _probes(long: DataFrame, group: str, value: str, fractions: Sequence[float]) -> DataFrame:
    margin = 2.0 / SKETCH_ACCURACY
    at = [min(max(f + side * margin, 0.0), 1.0) for f in fractions for side in (-1, 1)]
    return long.groupBy(group).agg(
        F.percentile_approx(value, at, SKETCH_ACCURACY).alias("__probes"),
        F.array(F.min(value), F.max(value)).alias("__ends"),
        F.count(value).alias("total"),
    )


def interpolated_quantiles(ranks: DataFrame, group: str, n_parts: int) -> DataFrame:
    """Rows (group, edges): the distinct quantiles 0, 1/n, ..., 1 from ``ranks_near``.

    The i-th lies at position (total - 1) * i / n_parts, counted from 0, with linear
    interpolation. It is worked out in the floating-point steps numpy takes, from the nearer
    of both neighbours, because a value may equal a quantile to the last bit.
    """
    step = repr(1.0 / n_parts)
    positions = f"transform(sequence(0, {n_parts}), i -> (total - 1) * IF(i = {n_parts}, 1D, i * {step}D))"
    neighbours = f"flatten(transform({positions}, p -> array(floor(p), least(floor(p) + 1, total - 1))))"
    wanted = f"filter(array_distinct({neighbours}), r -> r >= start AND r < upto)"
    found = F.expr(
        """CASE WHEN low = high OR rank = start THEN low WHEN rank = upto - 1 THEN high
           ELSE CAST(raise_error('a sketch missed its error bound') AS DOUBLE) END"""
    )
    # At most two ranks per quantile are left of a group.
    values = ranks.withColumn("rank", F.explode(F.expr(wanted))).select(group, "total", "rank", found.alias("__v"))
    ends = f"""transform({positions}, p -> named_struct(
        'a', at[floor(p)], 'b', at[least(floor(p) + 1, total - 1)], 't', p - floor(p)))"""
    edges = f"""array_sort(array_distinct(transform({ends},
        x -> IF(x.t < 0.5D, x.a + (x.b - x.a) * x.t, x.b - (x.b - x.a) * (1D - x.t)))))"""
    return (
        values.groupBy(group, "total")
        .agg(F.map_from_entries(F.collect_list(F.struct("rank", "__v"))).alias("at"))
        .select(group, F.expr(edges).alias("edges"))
    )
