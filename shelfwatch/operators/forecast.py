"""Requests, horizons, forecasts and their errors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StringType

from ..functions import clip_forecast
from .asof import pit_join
from .features import calendar_features
from .models import input_columns

# What a request that leaves a field out is taken to ask for.
DEFAULT_STORE = 1
DEFAULT_FAMILY = "GROCERY I"
DEFAULT_ONPROMOTION = 0
DEFAULT_HORIZON = 30
# A horizon is an array of days in one row: this many at most unless a caller wants more.
MAX_HORIZON = 100_000
MODEL_VERSION = "1.0.0"

REQUEST_PARAMS = ("store_nbr", "family", "onpromotion", "base_date", "days_ahead")


def _whole_number(df: DataFrame, col: str, kind: str) -> Column:
    """The column as a whole number; null where it is none (text, a fraction, out of range)."""
    value = F.col(col)
    if isinstance(df.schema[col].dataType, StringType):
        return F.trim(value).try_cast(kind)
    if isinstance(df.schema[col].dataType, FractionalType):
        return F.when(value == F.floor(value), value.try_cast(kind))
    return value.try_cast(kind)


def check_requests(
    df: DataFrame,
    default_horizon: int = DEFAULT_HORIZON,
    base_date: str | None = None,
    max_horizon: int = MAX_HORIZON,
) -> DataFrame:
    """Typed request columns, ``raw`` and ``reason``; works on batches and streams.

    A missing value takes its default. A value of the wrong type makes ``reason`` name its
    fields; it is null for good rows. A horizon beyond ``max_horizon`` days is such a value.
    """
    today = F.to_date(F.lit(base_date)) if base_date else F.current_date()
    given = {c: (F.col(c) if c in df.columns else F.lit(None)) for c in REQUEST_PARAMS}
    whole = {
        "store_nbr": ("bigint", DEFAULT_STORE),
        "onpromotion": ("bigint", DEFAULT_ONPROMOTION),
        "days_ahead": ("int", default_horizon),
    }
    typed, bad = {}, []
    for col, (kind, default) in whole.items():
        parsed = _whole_number(df, col, kind) if col in df.columns else F.lit(None).cast(kind)
        bad.append(F.when(given[col].isNotNull() & parsed.isNull(), col))
        typed[col] = F.coalesce(parsed, F.lit(default).cast(kind))
    date = given["base_date"].try_cast("date")
    bad.append(F.when(given["base_date"].isNotNull() & date.isNull(), "base_date"))
    bad.append(F.when(typed["days_ahead"] > max_horizon, "days_ahead"))
    typed["base_date"] = F.coalesce(date, today)
    typed["family"] = F.coalesce(given["family"].cast("string"), F.lit(DEFAULT_FAMILY))

    fields = F.array_compact(F.array(*bad))
    reason = F.when(F.size(fields) > 0, F.concat(F.lit("invalid: "), F.concat_ws(", ", fields)))
    carried = [c for c in df.columns if c not in REQUEST_PARAMS]
    return df.select(
        *carried,
        *[typed[c].alias(c) for c in REQUEST_PARAMS],
        F.to_json(F.struct(*df.columns)).alias("raw"),
        reason.alias("reason"),
    )


def split_checked(checked: DataFrame, source: str = "requests") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine rows of source, raw, reason) of ``check_requests``."""
    good = checked.filter(F.col("reason").isNull()).drop("raw", "reason")
    bad = checked.filter(F.col("reason").isNotNull()).select(F.lit(source).alias("source"), "raw", "reason")
    return good, bad


def validate_requests(
    df: DataFrame,
    default_horizon: int = DEFAULT_HORIZON,
    base_date: str | None = None,
    max_horizon: int = MAX_HORIZON,
) -> tuple[DataFrame, DataFrame]:
    """(valid requests, quarantine)."""
    return split_checked(check_requests(df, default_horizon, base_date, max_horizon))


def expand_horizon(
    requests: DataFrame, sales_hint: float | Column = 0.0, calendar: bool = True, max_horizon: int = MAX_HORIZON
) -> DataFrame:
    """One row per request and day, step 0 on the base date, with the model's feature columns.

    The history a request stands for is the hint repeated, so a lag is 0 until the step
    reaches it and the hint from then on, and the rolling mean is the hint. A horizon of 0
    or less gives no rows; one beyond ``max_horizon`` fails, as validation would have set it aside.
    """
    hint = (sales_hint if isinstance(sales_hint, Column) else F.lit(float(sales_hint))).cast("double")
    too_far = F.raise_error(F.concat(F.lit(f"a horizon is beyond {max_horizon} days: "), F.col("days_ahead").cast("string")))
    steps = F.when(F.col("days_ahead") > max_horizon, too_far).otherwise(F.sequence(F.lit(0), F.col("days_ahead") - 1))
    rows = requests.filter(F.col("days_ahead") > 0).withColumn("__hint", hint).withColumn("step", F.explode(steps))
    rows = rows.select(
        *requests.columns,
        "step",
        F.date_add("base_date", F.col("step")).alias("date"),
        F.col("__hint").alias("sales"),
        *[F.when(F.col("step") >= k, F.col("__hint")).otherwise(0.0).alias(f"lag_{k}") for k in (7, 14)],
        F.col("__hint").alias("rolling_mean_7"),
    )
    return calendar_features(rows) if calendar else rows


def align_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Exactly the expected columns in their order; absent ones are 0, others are dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in expected])


def score_table(model: Transformer, df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Add ``yhat``: the model's non-negative prediction, with absent inputs taken as 0."""
    ready = df.withColumns({c: F.lit(0.0) for c in input_columns(model) if c not in df.columns})
    scored = model.transform(ready)
    return scored.select(*df.columns, clip_forecast(F.col(prediction)).alias("yhat"))


def baseline_forecast(df: DataFrame) -> DataFrame:
    """Add ``yhat`` by a plain rule: the mean of lag 7 and the rolling mean, not below 0."""
    return df.withColumn("yhat", clip_forecast((F.col("lag_7") + F.col("rolling_mean_7")) / 2))


def forecast_requests(
    requests: DataFrame,
    model: Transformer | Callable[[DataFrame], DataFrame] | None = None,
    version: str = MODEL_VERSION,
    request_id: str = "request_id",
    sales_hint: float | str = 0.0,
) -> DataFrame:
    """Rows (request_id, forecast, model_version, prediction_id, status).

    ``sales_hint`` is the recent sale that a request's history repeats: one number for all
    requests, or the column that holds each request's own; a missing one counts as 0.

    ``model`` is a fitted pipeline, or a function that adds ``yhat`` to feature rows. Without
    one the forecast is zeros and the status ``no_model``.

    A forecast depends on the request's parameters only, so each distinct set of them is
    scored once, however many requests repeat it, and joined back. What is collected into
    one array is one horizon.
    """
    answer = [
        F.lit(version).alias("model_version"),
        F.sha2(F.concat_ws("|", F.col(request_id).cast("string"), F.lit(version)), 256).alias("prediction_id"),
    ]
    horizon = F.greatest(F.col("days_ahead"), F.lit(0))
    if model is None:
        zeros = F.array_repeat(F.lit(0.0), horizon)
        return requests.select(request_id, zeros.alias("forecast"), *answer, F.lit("no_model").alias("status"))

    params = list(REQUEST_PARAMS)
    if isinstance(sales_hint, str):
        params.append(sales_hint)
        sales_hint = F.coalesce(F.col(sales_hint).cast("double"), F.lit(0.0))
    rows = expand_horizon(requests.select(*params).distinct(), sales_hint)
    scored = score_table(model, rows) if isinstance(model, Transformer) else model(rows)
    forecasts = (
        scored.groupBy(*params)
        .agg(F.array_sort(F.collect_list(F.struct("step", "yhat"))).alias("__steps"))
        .select(*params, F.col("__steps.yhat").alias("forecast"))
    )
    asked = requests.select(request_id, *params)
    # Null-safe, so that a request with a null parameter finds its forecast.
    same = [asked[p].eqNullSafe(forecasts[p]) for p in params]
    joined = asked.join(forecasts, same, "left").select(request_id, "forecast")
    empty = F.array().cast("array<double>")
    return joined.select(
        request_id, F.coalesce("forecast", empty).alias("forecast"), *answer, F.lit("ok").alias("status")
    )


def history_hints(
    requests: DataFrame,
    features: DataFrame,
    keys: Sequence[str] = ("store_nbr", "family"),
    hint: str = "sales_hint",
    value: str = "rolling_mean_7",
    ttl_days: int = 3650,
) -> DataFrame:
    """Requests with the column ``hint``: the recent sales of their series on their base date.

    It is ``value`` of the newest row of the feature table at or before the base date, looked
    up point in time, so nothing later is seen. A series without history, or with a missing
    key or date, has a null hint; ``forecast_requests`` counts it as 0.
    """
    known = features.select(*keys, F.col("event_timestamp").cast("timestamp").alias("event_timestamp"), F.col(value).alias(hint))
    asked = requests.withColumn("event_timestamp", F.col("base_date").cast("timestamp"))
    return pit_join(asked, known, keys, ttl_days=ttl_days).drop("event_timestamp")


def live_prediction_id() -> Column:
    """A random identifier, for live use; batch runs use the repeatable one."""
    return F.uuid()


def rmse(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, n, rmse)."""
    error = F.col(y) - F.col(yhat)
    return df.groupBy(*by).agg(F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"))


def rmsle(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, n, rmsle): error of the logarithms of 1 + value."""
    error = F.log1p(F.col(y)) - F.log1p(F.col(yhat))
    return df.groupBy(*by).agg(F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmsle"))


def compare_models(predictions: DataFrame, candidate: str, production: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, candidate_rmse, production_rmse, delta); production is null when it is absent."""
    error = F.col("y") - F.col("yhat")

    def of(version: str) -> Column:
        return F.sqrt(F.avg(F.when(F.col("model_version") == version, error * error)))

    return (
        predictions.filter(F.col("model_version").isin(candidate, production))
        .groupBy(*by)
        .agg(of(candidate).alias("candidate_rmse"), of(production).alias("production_rmse"))
        .withColumn("delta", F.col("candidate_rmse") - F.col("production_rmse"))
    )


def must_beat_production(comparison: DataFrame) -> DataFrame:
    """Add ``promote``: the candidate's error is below production's, or there is no production."""
    better = F.col("candidate_rmse") < F.col("production_rmse")
    first = F.col("candidate_rmse").isNotNull() & F.col("production_rmse").isNull()
    return comparison.withColumn("promote", F.coalesce(better, first))


def ground_truth_join(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = ("store_nbr", "family", "date")) -> DataFrame:
    """Stored predictions beside the actual values that came in later."""
    return predictions.join(actuals.select(*keys, F.col("sales").alias("y")), list(keys))
