"""Calendar, lag, rolling and one-hot features over daily sales series."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ..functions import days_to_holiday
from .ordered import CHUNK_DAYS, HOT_ROWS, chunk_window, with_history, without_history

SERIES_KEYS = ("store_nbr", "family")
#: Categories that become columns of a table at most.
MAX_CATEGORIES = 2_000


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """``day_of_week`` (Monday 0), ``month``, ``year`` and ``days_to_holiday``.

    A frame without the date column gets the fixed stand-ins 0, 1, 2017 and 0.
    """
    if date not in df.columns:
        values = {"day_of_week": F.lit(0), "month": F.lit(1), "year": F.lit(2017), "days_to_holiday": F.lit(0)}
    else:
        day = F.to_date(F.col(date))
        values = {
            "day_of_week": F.weekday(day),
            "month": F.month(day),
            "year": F.year(day),
            "days_to_holiday": days_to_holiday(day),
        }
    return df.withColumns({name: value.cast("long") for name, value in values.items()})


def _number(value: str) -> Column:
    """Not-a-number counts as missing."""
    number = F.col(value).cast("double")
    return F.when(~F.isnan(number), number)


def series_features(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "date",
    value: str = "sales",
    lags: Sequence[int] = (7, 14),
    n: int | None = 7,
    exclude_current: bool = False,
    tie_cols: Sequence[str] = (),
    chunk_days: int = CHUNK_DAYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Row lags and the rolling mean of each series, all from one shuffle.

    ``n=None`` leaves the rolling mean out. Missing history counts as 0. Without the value
    column every feature is 0. ``order`` and ``tie_cols`` must order the rows of a series.
    """
    if any(lag < 1 for lag in lags) or (n is not None and n < 1):
        raise ValueError("lags and window length must be at least 1")
    names = [f"lag_{lag}" for lag in lags] + ([f"rolling_mean_{n}"] if n else [])
    if value not in df.columns:
        return df.withColumns({name: F.lit(0.0) for name in names})

    reach = max([*lags, n or 1])
    rows = with_history(df, keys, order, reach, tie_cols, chunk_days, hot_rows)
    window = chunk_window(rows, keys, [order, *tie_cols])
    features = {f"lag_{lag}": F.lag(_number(value), lag).over(window) for lag in lags}
    if n:
        frame = (-n, -1) if exclude_current else (1 - n, 0)
        features[f"rolling_mean_{n}"] = F.avg(_number(value)).over(window.rowsBetween(*frame))
    return without_history(
        rows.select("*", *[F.coalesce(column, F.lit(0.0)).alias(name) for name, column in features.items()])
    )


def lag_features(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "date",
    value: str = "sales",
    lags: Sequence[int] = (7, 14),
    tie_cols: Sequence[str] = (),
    chunk_days: int = CHUNK_DAYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``lag_k``: the value k rows earlier in the same series, 0 where there is none."""
    return series_features(df, keys, order, value, lags, None, False, tie_cols, chunk_days, hot_rows)


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "date",
    value: str = "sales",
    n: int = 7,
    exclude_current: bool = False,
    tie_cols: Sequence[str] = (),
    chunk_days: int = CHUNK_DAYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mean of the current and the n-1 rows before, or of the n rows before the current one."""
    return series_features(df, keys, order, value, (), n, exclude_current, tie_cols, chunk_days, hot_rows)


def calendar_lag(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    date: str = "date",
    value: str = "sales",
    days: Sequence[int] = (7, 14),
) -> DataFrame:
    """``day_lag_k``: the value k calendar days earlier, 0 where the series has no such day.

    Values are added up per series and day before their shuffle, and each sum is sent to the
    days that look back at it; the rows then join on series and day, where adaptive execution
    can split a hot day. Rows without a date get 0.
    """
    if not days or min(days) < 1:
        raise ValueError("days must be at least 1")
    day = F.unix_date(F.to_date(F.col(date))).cast("long")
    names = [f"__key_{i}" for i in range(len(keys))]
    sums = (
        df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], day.alias("__day"), _number(value).alias("__v"))
        .filter(F.col("__day").isNotNull() & F.col("__v").isNotNull())
        .groupBy(*names, "__day")
        .agg(F.sum("__v").alias("__v"))
    )
    seen = (
        sums.withColumn("__back", F.explode(F.array(*[F.lit(k) for k in sorted(set(days))])))
        .groupBy(*names, (F.col("__day") + F.col("__back")).alias("__to"))
        .agg(*[F.sum(F.when(F.col("__back") == k, F.col("__v"))).alias(f"__lag_{k}") for k in sorted(set(days))])
    )
    same = F.col("__day") == F.col("__to")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    joined = df.withColumn("__day", day).join(seen, same, "left")
    return joined.select(*df.columns, *[F.coalesce(f"__lag_{k}", F.lit(0.0)).alias(f"day_lag_{k}") for k in days])


def fitted_categories(df: DataFrame, col: str = "family", limit: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct values, each of which becomes a column; more than ``limit`` of them fail."""
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    rows = values.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has {values.count()} categories, more than the limit of {limit}")
    return sorted(row[0] for row in rows)


def category_column(col: str, category: object) -> str:
    """Column name of a category: all but letters, digits and underscore become underscores."""
    return re.sub(r"\W", "_", f"{col}_{category}")


def one_hot_family(
    df: DataFrame,
    col: str = "family",
    categories: Sequence[str] | None = None,
    fit: bool = True,
    limit: int = MAX_CATEGORIES,
) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per fitted category in place of ``col``; unseen values are all zeros.

    Fitting fails beyond ``limit`` categories.
    """
    if col not in df.columns:
        return df, list(categories or [])
    if categories is None:
        if not fit:
            raise ValueError("categories must be given when fit is false")
        categories = fitted_categories(df, col, limit)
    names: dict[str, str] = {}
    for category in categories:
        name = category_column(col, category)
        if name in names:
            raise ValueError(f"categories {names[name]!r} and {category!r} both become column {name}")
        names[name] = category
    kept = [c for c in df.columns if c != col]
    flags = [F.coalesce((F.col(col) == c).cast("double"), F.lit(0.0)).alias(n) for n, c in names.items()]
    return df.select(*kept, *flags), list(categories)


def event_timestamp(df: DataFrame, date: str = "date") -> DataFrame:
    """Rename the date to ``event_timestamp`` and give it the timestamp type."""
    if isinstance(df.schema[date].dataType, (DateType, TimestampNTZType, TimestampType)):
        stamp = F.col(date).cast("timestamp")
    else:
        stamp = F.to_timestamp(F.col(date))
    return df.select(*[stamp.alias("event_timestamp") if c == date else F.col(c) for c in df.columns])


def demand_features(
    df: DataFrame, keys: Sequence[str] = SERIES_KEYS, exclude_current: bool = False, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Calendar, lag and rolling features of daily sales, as stored in the feature table."""
    rows = series_features(df, keys, exclude_current=exclude_current, chunk_days=chunk_days)
    return calendar_features(rows)
