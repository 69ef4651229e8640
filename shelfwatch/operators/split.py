"""Chronological split and exact seeded sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

TRAIN_RATIO = 0.8
_MISSING = "\u0000missing"
# Values fetched at most while a boundary is looked for, and cuts made when there are more.
MAX_VALUES = 10_000
N_PIVOTS = 128

# The columns that a drift check compares.
WINDOW_COLUMNS = ("store_nbr", "family", "onpromotion", "day_of_week", "month", "year")


def _before(col: str, value: object, literal: Column) -> Column:
    return F.lit(False) if value is None else F.col(col).isNull() | (F.col(col) < literal)


def _sort_key(value: object) -> tuple:
    return (value is not None, value)


def _cut_value(rows: DataFrame, col: str, wanted: int, limit: int = MAX_VALUES) -> tuple[object, int, int]:
    """(value, rows before it, rows with it) of the value that holds the ``wanted``-th row by ``col``.

    Rows are counted per value, combined before the shuffle. Up to ``limit`` values are
    fetched with their counts. Of more values an even sample, picked by hash, cuts them into
    stretches; rows are counted per stretch, and the search goes on in the one that matters.
    """
    skipped = 0
    while True:
        counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
        found = counts.orderBy(F.xxhash64(col), col).limit(limit).collect()
        values = sorted(((r[0], r[1]) for r in found), key=lambda pair: _sort_key(pair[0]))
        if len(values) < limit:
            upto = skipped
            for value, n in values:
                if upto + n >= wanted:
                    return value, upto, n
                upto += n
            raise ValueError("the rows changed while they were split")
        known = [value for value, _ in values if value is not None]
        pivots = known[:: max(1, len(known) // N_PIVOTS)]
        upto = skipped
        for stretch, n in sorted(counts.groupBy(_stretch_of(col, pivots).alias("s")).agg(F.sum("__n")).collect()):
            if upto + n >= wanted:
                skipped = upto
                break
            upto += n
        # Plain bounds, which reach the scan of a file.
        if stretch == 0:
            rows = rows.filter(F.col(col).isNull() | (F.col(col) < F.lit(pivots[0])))
        else:
            rows = rows.filter(F.col(col) >= F.lit(pivots[stretch - 1]))
            if stretch < len(pivots):
                rows = rows.filter(F.col(col) < F.lit(pivots[stretch]))


def _stretch_of(col: str, pivots: Sequence) -> Column:
    """How many of the ascending pivots a value has reached; 0 for a missing value."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        reached = F.col(col) >= F.lit(pivots[middle - 1])
        return F.when(reached, search(middle, high)).otherwise(search(low, middle - 1))

    return search(0, len(pivots))


def split_boundary(
    df: DataFrame, date: str, tie_cols: Sequence[str], ratio: float = TRAIN_RATIO
) -> Column:
    """Predicate that holds for exactly the first ``int(rows * ratio)`` rows by date and ties.

    Found level by level: the date in which the boundary lies, then within it the value of
    the first tie column, and so on. Missing values come first.
    """
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must lie between 0 and 1")
    levels = [date, *tie_cols]
    # Timestamps go through the driver as microseconds: a local time may name two instants.
    stamps = [c for c in levels if isinstance(df.schema[c].dataType, TimestampType)]
    inside = df.select(*[F.unix_micros(c).alias(c) if c in stamps else F.col(c) for c in levels])
    taken: Column = F.lit(False)
    same: Column = F.lit(True)
    wanted = int(df.count() * ratio)
    n = 0
    for level in levels:
        if wanted == 0:
            return taken
        value, before, n = _cut_value(inside, level, wanted)
        literal = F.timestamp_micros(F.lit(value)) if level in stamps and value is not None else F.lit(value)
        taken = taken | (same & _before(level, value, literal))
        same = same & F.col(level).eqNullSafe(literal)
        inside = inside.filter(F.col(level).eqNullSafe(F.lit(value)))
        wanted -= before
        if wanted == n:
            return taken | same
    if wanted:
        raise ValueError(
            f"{n} rows are equal in {levels} at the boundary and {wanted} of them belong to the "
            "first part: name more tie columns"
        )
    return taken


def chrono_split(
    df: DataFrame, date: str = "date", tie_cols: Sequence[str] = ("store_nbr", "family"), ratio: float = TRAIN_RATIO
) -> DataFrame:
    """Add ``split``: ``train`` for the first ``int(rows * ratio)`` rows by date, else ``valid``.

    The rows themselves are neither sorted nor shuffled: the boundary is a predicate.
    """
    first = split_boundary(df, date, tie_cols, ratio)
    return df.withColumn("split", F.when(first, "train").otherwise("valid"))


def split_boundaries(
    df: DataFrame, date: str, tie_cols: Sequence[str], ratios: Sequence[float], limit: int = MAX_VALUES
) -> list[Column]:
    """One predicate for each ratio, as ``split_boundary`` finds it, from one counting pass a level for all of them.

    A level counts its values once, within the values that the boundaries have reached on the
    levels before. With more than ``limit`` values there each boundary is searched on its own.
    """
    if any(not 0 <= r <= 1 for r in ratios):
        raise ValueError("ratios must lie between 0 and 1")
    levels = [date, *tie_cols]
    stamps = [c for c in levels if isinstance(df.schema[c].dataType, TimestampType)]
    inside = df.select(*[F.unix_micros(c).alias(c) if c in stamps else F.col(c) for c in levels])
    total = df.count()
    # What a boundary has reached: values of the levels so far, rows that it still lacks, its predicate so far.
    reached: list[tuple] = [()] * len(ratios)
    wanted = [int(total * r) for r in ratios]
    taken: list[Column] = [F.lit(False)] * len(ratios)
    same: list[Column] = [F.lit(True)] * len(ratios)
    open_ = [i for i, n in enumerate(wanted) if n]
    left = dict.fromkeys(open_, 0)
    for depth, level in enumerate(levels):
        if not open_:
            break
        prefixes = list(dict.fromkeys(reached[i] for i in open_))

        def within(prefix: tuple) -> Column:
            found = F.lit(True)
            for c, v in zip(levels, prefix):
                found = found & F.col(c).eqNullSafe(F.lit(v))
            return found

        group = F.coalesce(*[F.when(within(p), F.lit(n)) for n, p in enumerate(prefixes)])
        counts = inside.select(group.alias("__g"), level).filter("__g is not null").groupBy("__g", level).agg(F.count(F.lit(1)).alias("__n"))
        rows = counts.limit(limit).collect()
        by_prefix: dict[int, list] = {n: [] for n in range(len(prefixes))}
        for r in rows:
            by_prefix[r["__g"]].append((r[level], r["__n"]))
        going = []
        for i in open_:
            if len(rows) < limit:
                value, before, n = _find(sorted(by_prefix[prefixes.index(reached[i])], key=lambda pair: _sort_key(pair[0])), wanted[i])
            else:
                value, before, n = _cut_value(inside.filter(within(reached[i])), level, wanted[i], limit)
            literal = F.timestamp_micros(F.lit(value)) if level in stamps and value is not None else F.lit(value)
            taken[i] = taken[i] | (same[i] & _before(level, value, literal))
            same[i] = same[i] & F.col(level).eqNullSafe(literal)
            reached[i] = (*reached[i], value)
            wanted[i] -= before
            left[i] = n
            if wanted[i] == n:
                taken[i] = taken[i] | same[i]
            elif wanted[i]:
                going.append(i)
        open_ = going
    if open_:
        raise ValueError(
            f"{max(left[i] for i in open_)} rows are equal in {levels} at a boundary that parts them: name more tie columns"
        )
    return taken


def _find(values: Sequence[tuple], wanted: int) -> tuple[object, int, int]:
    upto = 0
    for value, n in values:
        if upto + n >= wanted:
            return value, upto, n
        upto += n
    raise ValueError("the rows changed while they were split")


def chrono_parts(
    df: DataFrame,
    parts: dict[str, float],
    date: str = "date",
    tie_cols: Sequence[str] = ("store_nbr", "family"),
) -> DataFrame:
    """Add ``split``: the name of each row's part, in the order of ``parts`` by date, with these shares of the rows.

    ``chrono_parts(df, {"train": 0.7, "valid": 0.15, "test": 0.15})`` ends the first part after
    ``int(rows * 0.7)`` rows. The shares add up to 1.
    """
    names, ends, upto = list(parts), [], 0.0
    for share in list(parts.values())[:-1]:
        upto += share
        ends.append(min(1.0, round(upto, 12)))
    if not names or abs(upto + parts[names[-1]] - 1) > 1e-9 or min(parts.values()) < 0:
        raise ValueError("the shares of the parts must add up to 1")
    name = F.lit(names[-1])
    for part, first in reversed(list(zip(names, split_boundaries(df, date, tie_cols, ends)))):
        name = F.when(first, part).otherwise(name)
    return df.withColumn("split", name)


def rolling_origins(
    df: DataFrame,
    folds: int,
    first: float = 0.5,
    date: str = "date",
    tie_cols: Sequence[str] = ("store_nbr", "family"),
) -> DataFrame:
    """Add ``block``: 0 for the first share of the rows by date, then 1 to ``folds`` for equal stretches of the rest.

    Fold k of a back-test learns from the blocks before k and is judged on block k, see ``fold``;
    so no row is copied however many folds there are.
    """
    if folds < 1 or not 0 <= first < 1:
        raise ValueError("there must be a fold, and rows left for it")
    ends = [first + (1 - first) * k / folds for k in range(folds)]
    block = F.lit(0)
    for before in split_boundaries(df, date, tie_cols, ends):
        block = block + F.when(before, 0).otherwise(1)
    return df.withColumn("block", block)


def fold(df: DataFrame, k: int, block: str = "block") -> tuple[DataFrame, DataFrame]:
    """(rows to learn from, rows to judge on) of fold ``k``, counted from 1, of ``rolling_origins``."""
    return df.filter(F.col(block) < k), df.filter(F.col(block) == k)


def sample_exact(df: DataFrame, keys: Sequence[str], n: int = 5000, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones for the same keys and seed.

    Rows are ordered by a hash of their keys. The row count says below which hash the sample
    lies, so of all tasks together little more than ``n`` rows are sorted; should that be too
    few, the bound is doubled.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit(_MISSING)) for k in keys]
    place = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    total, wanted = df.count(), n + 8 * n**0.5 + 16
    rows = df
    while wanted < total:
        rows = df.filter(place < F.lit(f"{int(wanted / total * 2**32):08x}"))
        if rows.count() >= n:
            break
        rows, wanted = df, 2 * wanted
    return rows.orderBy(place, *keys).limit(n)


def drift_window(df: DataFrame) -> DataFrame:
    """The six columns a drift check compares, whole numbers as 64-bit."""
    return df.select(*[F.col(c) if c == "family" else F.col(c).cast("long").alias(c) for c in WINDOW_COLUMNS])
