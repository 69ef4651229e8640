import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import forecast

RAW = "request_id string, store_nbr string, family string, onpromotion string, days_ahead string"
TYPED = "request_id string, store_nbr bigint, family string, onpromotion bigint, days_ahead int, base_date date"
DAY = dt.date(2017, 8, 16)


def valid(spark, data):
    return spark.createDataFrame([(*r, DAY) for r in data], TYPED)


def test_defaults_and_quarantine(spark):
    df = spark.createDataFrame(
        [
            ("ok", "3", "DAIRY", "1", "7"),
            ("defaults", None, None, None, None),
            ("spaces", " 4 ", "DAIRY", "0", "2"),
            ("text", "not-an-int", "DAIRY", "0", "7"),
            ("two", "x", "DAIRY", "1.5", "7"),
            ("far", "1", "DAIRY", "0", "99999"),
            ("negative", "1", "DAIRY", "0", "-4"),
        ],
        RAW,
    )
    assert forecast.validate_requests(df)[0].filter("days_ahead = 99999").count() == 1
    good, bad = forecast.validate_requests(df, base_date="2017-08-16", max_horizon=3650)
    got = {r["request_id"]: tuple(r)[1:] for r in good.collect()}
    assert got == {
        "ok": (3, "DAIRY", 1, DAY, 7),
        "defaults": (1, "GROCERY I", 0, DAY, 30),
        "spaces": (4, "DAIRY", 0, DAY, 2),
        "negative": (1, "DAIRY", 0, DAY, -4),
    }
    reasons = {r["raw"].split('"request_id":"')[1].split('"')[0]: r["reason"] for r in bad.collect()}
    assert reasons == {"text": "invalid: store_nbr", "two": "invalid: store_nbr, onpromotion", "far": "invalid: days_ahead"}


def test_numbers_with_a_fraction_and_absent_columns(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 2.5)], "request_id string, store_nbr double")
    good, bad = forecast.validate_requests(df)
    row = good.first()
    assert (row["request_id"], row["store_nbr"], row["days_ahead"]) == ("a", 2, 30)
    assert row["base_date"] == spark.sql("select current_date()").first()[0]
    assert bad.first()["reason"] == "invalid: store_nbr"


def loop_rows(hint, days):
    """History of 14 hints, each step appending the mean of the last seven, as features see it."""
    sales = [hint] * days
    return [
        (
            sales[i - 7] if i >= 7 else 0.0,
            sales[i - 14] if i >= 14 else 0.0,
            sum(sales[max(0, i - 6) : i + 1]) / len(sales[max(0, i - 6) : i + 1]),
        )
        for i in range(days)
    ]


def test_expand_horizon(spark):
    rows = forecast.expand_horizon(valid(spark, [("r", 1, "A", 0, 20)]), 2.5).orderBy("step").collect()
    assert [r["date"] for r in rows] == [DAY + dt.timedelta(days=i) for i in range(20)]
    assert [(r["lag_7"], r["lag_14"], r["rolling_mean_7"]) for r in rows] == loop_rows(2.5, 20)
    assert rows[0]["day_of_week"] == 2 and rows[0]["month"] == 8


def test_forecasts_without_a_model(spark):
    got = forecast.forecast_requests(valid(spark, [("a", 1, "A", 0, 3), ("b", 1, "A", 0, 0), ("c", 1, "A", 0, -5)]))
    rows = {r["request_id"]: r for r in got.collect()}
    assert rows["a"]["forecast"] == [0.0, 0.0, 0.0] and rows["a"]["status"] == "no_model"
    assert rows["b"]["forecast"] == [] and rows["c"]["forecast"] == []


def test_forecasts_by_a_rule(spark):
    requests = valid(spark, [("a", 1, "A", 0, 9), ("same", 1, "A", 0, 9), ("b", 2, "B", 1, 2), ("none", 1, "A", 0, 0)])
    got = forecast.forecast_requests(requests, forecast.baseline_forecast, "rule", sales_hint=10.0)
    rows = {r["request_id"]: r for r in got.collect()}
    assert rows["a"]["forecast"] == [5.0] * 7 + [10.0] * 2 == rows["same"]["forecast"]
    assert rows["b"]["forecast"] == [5.0, 5.0] and rows["none"]["forecast"] == []
    assert rows["a"]["prediction_id"] != rows["same"]["prediction_id"]
    assert {r["status"] for r in rows.values()} == {"ok"} and rows["a"]["model_version"] == "rule"


def test_horizon_order_survives_long_horizons(spark):
    by_step = lambda df: df.withColumn("yhat", F.col("step").cast("double"))
    got = forecast.forecast_requests(valid(spark, [("a", 1, "A", 0, 300)]), by_step).first()
    assert got["forecast"] == [float(i) for i in range(300)]


def test_live_prediction_ids_differ(spark):
    ids = [r[0] for r in spark.range(50).select(forecast.live_prediction_id()).collect()]
    assert len(set(ids)) == 50 and all(len(i) == 36 for i in ids)


def test_errors(spark):
    df = spark.createDataFrame([("v", 3.0, 1.0), ("v", 0.0, 0.0), ("w", 1.0, 2.0), ("w", None, 2.0)], "model_version string, y double, yhat double")
    assert forecast.rmse(df).first()["rmse"] == pytest.approx((5 / 3) ** 0.5)
    by = {r["model_version"]: (r["n"], r["rmse"]) for r in forecast.rmse(df, by=["model_version"]).collect()}
    assert by == {"v": (2, pytest.approx(2**0.5)), "w": (1, 1.0)}
    both = forecast.must_beat_production(forecast.compare_models(df, "w", "v")).first()
    assert both["delta"] == pytest.approx(1 - 2**0.5) and both["promote"] is True
    first = forecast.must_beat_production(forecast.compare_models(df, "w", "absent")).first()
    assert first["production_rmse"] is None and first["delta"] is None and first["promote"] is True
    none = forecast.must_beat_production(forecast.compare_models(df, "absent", "v")).first()
    assert none["promote"] is False
    assert forecast.rmsle(df.limit(1)).first()["rmsle"] == pytest.approx(0.6931471805599453)


def test_each_request_may_have_its_own_hint(spark):
    rows = [("a", 1, "A", 0, 2, 10.0), ("b", 1, "A", 0, 2, 30.0), ("c", 1, "A", 0, 2, None)]
    df = spark.createDataFrame(rows, "request_id string, store_nbr long, family string, onpromotion long, days_ahead int, hint double")
    df = df.withColumn("base_date", F.lit("2017-08-16").cast("date"))
    got = forecast.forecast_requests(df, forecast.baseline_forecast, sales_hint="hint").collect()
    assert {r["request_id"]: r["forecast"] for r in got} == {"a": [5.0, 5.0], "b": [15.0, 15.0], "c": [0.0, 0.0]}


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2)], "extra int, kept int")
    assert tuple(forecast.align_columns(df, ["absent", "kept"]).first()) == (0.0, 2)


def test_a_horizon_beyond_the_default_bound(spark):
    df = spark.createDataFrame([("a", "100000"), ("b", "2000000000")], "request_id string, days_ahead string")
    good, bad = forecast.validate_requests(df, base_date="2017-08-16")
    assert [r["request_id"] for r in good.collect()] == ["a"] and bad.first()["reason"] == "invalid: days_ahead"
    with pytest.raises(Exception, match="beyond 100000 days: 2000000000"):
        forecast.expand_horizon(valid(spark, [("b", 1, "A", 0, 2_000_000_000)])).count()
    assert forecast.expand_horizon(valid(spark, [("b", 1, "A", 0, 3)]), max_horizon=3).count() == 3
