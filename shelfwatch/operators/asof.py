"""Point-in-time lookup and newest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType
from pyspark.sql.window import Window

from .ordered import CHUNK, CHUNK_DAYS, HOT_ROWS, cut_hot_stretches, stretch_of, time_chunk


def pit_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    time_col: str = "event_timestamp",
    ttl_days: int = 3650,
    tie_cols: Sequence[str] = (),
    chunk_days: int = CHUNK_DAYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For each entity row the newest feature row of its key at or before its time.

    Features older than ``ttl_days`` give nulls, as does a key without earlier features, and
    a missing key or time. Of feature rows with the same key and time the greatest by ``tie_cols`` is taken (the
    greatest by all columns when none are named).

    Lookups are made once per distinct (key, time), so any number of copies of one entity is
    a join matter, where a hot key can be split. They are made by key and stretch of time,
    and a stretch with more than ``hot_rows`` times is cut into parts. What a stretch or part
    inherits from earlier ones is one feature row, found on a summary of one row for each.
    """
    keys = list(keys)
    values = [c for c in features.columns if c not in keys and c != time_col]
    clash = [c for c in values if c in entities.columns]
    if clash:
        raise ValueError(f"columns are in both frames: {clash}")
    at = "__at"

    present = F.col(time_col).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    features, lookups = features.filter(present), entities.filter(present)

    # At one time the feature row (side 0) goes before the lookup (side 1).
    order = [*tie_cols, *[c for c in values if c not in tie_cols]]
    known = (
        features.groupBy(*keys, F.col(time_col).alias(at))
        .agg(F.max(F.struct(*order)).alias("__v"))
        .select(*keys, at, F.struct(F.col(at).alias("__known_at"), "__v").alias("__f"), F.lit(0).alias("__side"))
    )
    asked = lookups.select(*keys, F.col(time_col).alias(at)).distinct().withColumn("__side", F.lit(1))
    sides = known.unionByName(asked, allowMissingColumns=True).withColumn(CHUNK, time_chunk(F.col(at), chunk_days))
    # A stretch of dates has no more of them than days; one of timestamps may have any number.
    if not isinstance(sides.schema[at].dataType, DateType):
        sides = cut_hot_stretches(sides, keys, [at, "__side"], hot_rows)
    parts = stretch_of(sides)
    stretch = [*keys, *parts]
    sides = sides.repartition(*stretch)

    summary = sides.groupBy(*stretch).agg(F.max_by("__f", F.when(F.col("__side") == 0, F.col(at))).alias("__f"))
    earlier = Window.partitionBy(*keys).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    inherited = (
        summary.withColumn("__f", F.last("__f", ignorenulls=True).over(earlier))
        .filter(F.col("__f").isNotNull())
        .select(*keys, F.col("__f.__known_at").alias(at), "__f", F.lit(0).alias("__side"), *parts)
        .repartition(*stretch)
    )

    upto = Window.partitionBy(*stretch).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    oldest = F.col(at).cast("timestamp") - F.expr(f"INTERVAL '{int(ttl_days)}' DAY")
    found = (
        sides.unionByName(inherited)
        .withColumn("__f", F.last("__f", ignorenulls=True).over(upto))
        .filter(F.col("__side") == 1)
        .filter(F.col("__f.__known_at").cast("timestamp") >= oldest)
        .select(*keys, F.col(at).alias(time_col), *[F.col("__f.__v")[c].alias(c) for c in values])
    )
    return entities.join(found, [*keys, time_col], "left").select(*entities.columns, *values)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key, by ``ts`` and then ``tie_cols`` (else all other columns)."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    order = [ts, *tie_cols, *[c for c in payload if c != ts and c not in tie_cols]]
    newest = df.filter(F.col(ts).isNotNull()).groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("__row")
    )
    return newest.select(*keys, *[F.col("__row")[c].alias(c) for c in payload]).select(*df.columns)
