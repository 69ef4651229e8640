"""End-to-end jobs. Each takes paths and settings, writes tables, and returns what it decided."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.asof import pit_join
from ..operators.drift import psi_report, retrain_decision, window_sizes
from ..operators.evaluate import eval_gate, require_pass, score_answers
from ..operators.features import SERIES_KEYS, demand_features, event_timestamp
from ..operators.forecast import MODEL_VERSION, forecast_requests, history_hints, rmse, score_table, validate_requests
from ..operators.models import load_model, save_model, search_params, train_regressor
from ..operators.split import chrono_split
from ..session import scratch_path
from ..sources import scan_eval_jsonl, scan_sales_csv, scan_table, write_feature_table, write_gauge_file


def feature_job(spark: SparkSession, sales_path: str, out_path: str, exclude_current: bool = False) -> None:
    """Sales CSV to feature table."""
    write_feature_table(demand_features(scan_sales_csv(spark, sales_path), exclude_current=exclude_current), out_path)


def drift_job(
    spark: SparkSession,
    reference_path: str,
    current_path: str,
    out_path: str,
    gauge_path: str | None = None,
    cols: Sequence[str] | None = None,
    schema: StructType | str | None = None,
    history_path: str | None = None,
    scored_on: str | None = None,
) -> dict:
    """Compare two windows, write the scores, and say whether to retrain.

    With ``history_path`` the scores are also appended to that table, with the day
    ``scored_on`` (today if it is not given); ``latest_per_key`` reads the newest from it.
    CSV windows need a ``schema``, or their types are inferred by another pass.
    """
    ref, cur = scan_table(spark, reference_path, schema), scan_table(spark, current_path, schema)
    psi_report(ref, cur, cols).write.mode("overwrite").parquet(out_path)
    scores = spark.read.parquet(out_path)
    if history_path:
        day = F.to_date(F.lit(scored_on)) if scored_on else F.current_date()
        scores.withColumn("scored_on", day).write.mode("append").parquet(history_path)
    if gauge_path:
        write_gauge_file(scores, gauge_path)
    return {**retrain_decision(scores).first().asDict(), **window_sizes(ref, cur).first().asDict()}


def stored_features(sales: DataFrame, feature_path: str, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Features of each sales row looked up point in time in the feature table."""
    entities = event_timestamp(sales.select(*keys, "date"))
    features = sales.sparkSession.read.parquet(feature_path)
    return pit_join(entities, features, keys).withColumn("date", F.to_date("event_timestamp"))


def training_job(
    spark: SparkSession,
    sales_path: str,
    model_path: str,
    feature_path: str | None = None,
    n_trials: int = 0,
    params: dict | None = None,
    seed: int = 42,
) -> dict:
    """Features, chronological split, optional search, fit, save; returns errors and settings.

    With ``feature_path`` the features come from the stored table. The feature rows are
    written once to the shared folder: the split and every boosting round read that table.
    """
    sales = scan_sales_csv(spark, sales_path)
    rows = stored_features(sales, feature_path) if feature_path else demand_features(sales)
    table = scratch_path(spark, "training-rows")
    rows.write.parquet(table)
    split = chrono_split(spark.read.parquet(table), "date", SERIES_KEYS)
    train, valid = (split.filter(F.col("split") == part) for part in ("train", "valid"))
    settings = dict(params or {})
    if n_trials:
        best, _ = search_params(train, valid, n_trials, seed)
        settings.update(best)
    model = train_regressor(train, valid, params=settings)
    save_model(model, model_path)
    errors = rmse(score_table(model, split), "sales", "yhat", ["split"]).collect()
    return {**{f"{row['split']}_rmse": row["rmse"] for row in errors}, "rounds": model.stages[-1].getNumTrees}


def forecast_job(
    spark: SparkSession,
    requests_path: str,
    out_path: str,
    quarantine_path: str,
    model_path: str | None = None,
    version: str = MODEL_VERSION,
    base_date: str | None = None,
    feature_path: str | None = None,
    schema: StructType | str | None = None,
) -> None:
    """Requests table to forecasts and quarantine.

    With ``feature_path`` a request's history is the recent sales of its series in that feature table.
    """
    valid, bad = validate_requests(scan_table(spark, requests_path, schema), base_date=base_date)
    model: PipelineModel | None = load_model(spark, model_path) if model_path else None
    hint: float | str = 0.0
    if feature_path:
        hint = "sales_hint"
        valid = history_hints(valid.drop(hint), spark.read.parquet(feature_path), hint=hint)
    forecast_requests(valid, model, version, sales_hint=hint).write.mode("overwrite").parquet(out_path)
    bad.write.mode("overwrite").parquet(quarantine_path)


def gate_job(
    spark: SparkSession,
    path: str,
    scorer_factory: Callable,
    embedder_factory: Callable,
    threshold: float = 0.7,
    scores_path: str | None = None,
) -> dict:
    """Score an answer set and raise when a mean is below the threshold."""
    good, _ = scan_eval_jsonl(spark, path, strict=True)
    scores = score_answers(good, scorer_factory, embedder_factory)
    if scores_path:
        scores.write.mode("overwrite").parquet(scores_path)
        scores = spark.read.parquet(scores_path)
    return require_pass(eval_gate(scores, threshold))


__all__ = [
    "drift_job",
    "feature_job",
    "forecast_job",
    "gate_job",
    "stored_features",
    "training_job",
]
