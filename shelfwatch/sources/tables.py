"""Sales files, tables by extension, and the feature table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.features import SERIES_KEYS, demand_features, event_timestamp
from ..operators.split import drift_window
from ..session import scratch_path

#: Rows of a series that its features look back at, and days among which they are looked for first.
HISTORY_ROWS, HISTORY_DAYS = 14, 60
#: Series with new sales whose days may be broadcast.
SERIES = 500_000

# The columns of sales files and of the feature table.
SALES_TYPES = {
    "date": "date",
    "store_nbr": "long",
    "family": "string",
    "onpromotion": "long",
    "sales": "double",
}

FEATURE_COLUMNS = (
    "store_nbr",
    "event_timestamp",
    "family",
    "onpromotion",
    "day_of_week",
    "month",
    "year",
    "days_to_holiday",
    "lag_7",
    "lag_14",
    "rolling_mean_7",
    "sales",
)


def scan_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily sales with typed columns; other columns stay as text.

    Only the header is read ahead. Fails listing the required columns it lacks.
    """
    header = spark.read.csv(path, header=True, inferSchema=False)
    missing = sorted(set(SALES_TYPES) - set(header.columns))
    if missing:
        raise ValueError(f"the sales file lacks {', '.join(missing)}")
    schema = StructType()
    for name in header.columns:
        schema.add(name, SALES_TYPES.get(name, StringType()))
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def scan_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV by its extension, else Parquet. A path that does not exist raises."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if path.lower().endswith(".csv"):
        return reader.csv(path, header=True, inferSchema=schema is None)
    return reader.parquet(path)


def feature_table(df: DataFrame) -> DataFrame:
    """The twelve columns of the feature table, from features of daily sales."""
    return event_timestamp(df).select(*FEATURE_COLUMNS)


def write_feature_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",)) -> None:
    """Write the feature table.

    Rows are brought together by partition value before the write, so a task writes few
    files; the adaptive planner splits a value that holds many rows and joins small ones.
    """
    table = feature_table(df) if "event_timestamp" not in df.columns else df.select(*FEATURE_COLUMNS)
    if partition_by:
        table = table.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = table.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _nearest(rows: DataFrame, keys: Sequence[str], time: Column) -> DataFrame:
    """The ``HISTORY_ROWS`` first rows of each series by ``time``; Spark cuts to them before its shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(time))
    return rows.withColumn("__place", place).filter(F.col("__place") <= HISTORY_ROWS).drop("__place")


def changed_features(
    stored: DataFrame, sales: DataFrame, keys: Sequence[str] = SERIES_KEYS, exclude_current: bool = False
) -> DataFrame:
    """The feature rows that new daily sales add or change in a stored feature table.

    Only series with new sales are looked at, and of them the stretch from the first new day to
    the last, the rows after it whose history has changed, and the rows before it that it looks
    back at: among the last ``HISTORY_DAYS`` days first, and further back only for the series
    that have too few rows there. A new row takes the place of a stored one of its day.
    """
    own = ["event_timestamp", *keys, "onpromotion", "sales"]
    new = event_timestamp(sales).select(*own)
    spans = new.groupBy(*keys).agg(F.min("event_timestamp").alias("__from"), F.max("event_timestamp").alias("__to"))
    rows = stored.select(*own).join(F.broadcast(spans) if spans.limit(SERIES + 1).count() <= SERIES else spans, list(keys))
    at, first, last = F.col("event_timestamp"), F.col("__from"), F.col("__to")
    near = first - F.expr(f"INTERVAL {HISTORY_DAYS} DAYS")
    recent = _nearest(rows.filter((at < first) & (at >= near)), keys, at.desc())
    full = recent.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= HISTORY_ROWS).select(*keys)
    older = _nearest(rows.filter(at < near).join(full, list(keys), "left_anti"), keys, at.desc())
    before = _nearest(recent.unionByName(older), keys, at.desc()).select(*own)
    inside = rows.filter((at >= first) & (at <= last)).select(*own).join(new, ["event_timestamp", *keys], "left_anti")
    after = _nearest(rows.filter(at > last), keys, at.asc()).select(*own)
    base = reduce(DataFrame.unionByName, (before, inside, new, after)).withColumn("date", F.to_date("event_timestamp"))
    made = feature_table(demand_features(base.drop("event_timestamp"), keys, exclude_current))
    return made.join(spans.select(*keys, "__from"), list(keys)).filter(at >= first).select(*FEATURE_COLUMNS)


def update_feature_table(
    sales: DataFrame,
    path: str,
    keys: Sequence[str] = SERIES_KEYS,
    partition_by: Sequence[str] = ("year",),
    exclude_current: bool = False,
) -> list[tuple]:
    """Add daily sales to a stored feature table; returns the partitions that were written again.

    The table then holds what a full rebuild from all sales would, in whatever order days come
    in. Only partitions with changed rows are overwritten, from a copy in the shared folder, so
    a run that breaks off can be repeated. Sales need a key and a date, one row a day and series.
    """
    spark = sales.sparkSession
    columns = [F.col(c) for c in partition_by]
    stored = spark.read.parquet(path).select(*FEATURE_COLUMNS)
    changed_path, table_path = scratch_path(spark, "changed-features"), scratch_path(spark, "feature-partitions")
    changed_features(stored, sales, keys, exclude_current).write.parquet(changed_path)
    changed = spark.read.parquet(changed_path)
    touched = [tuple(r) for r in changed.select(*partition_by).distinct().collect()]
    if not touched:
        return []
    # Plain values, so that only these partitions are read.
    inside = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [c == v for c, v in zip(columns, p)]) for p in touched])
    kept = stored.filter(inside).join(changed, ["event_timestamp", *keys], "left_anti").select(*FEATURE_COLUMNS)
    kept.unionByName(changed).write.parquet(table_path)
    whole = spark.read.parquet(table_path).hint("rebalance", *columns)
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return sorted(touched)


def write_drift_window(df: DataFrame, path: str) -> None:
    """Write the six columns a drift check compares."""
    drift_window(df).write.mode("overwrite").parquet(path)
