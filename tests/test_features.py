import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import features

SCHEMA = "date date, store_nbr bigint, family string, sales double"


def gappy_sales(seed=1, n_days=90, keep=0.6):
    """Three series with missing days, a short one, and some missing values."""
    draw = random.Random(seed)
    start = dt.date(2016, 12, 1)
    data = []
    for store, family, days in ((1, "A", n_days), (1, "B", n_days), (2, "A", n_days), (3, "C", 5)):
        for i in range(days):
            if draw.random() < keep or days == 5:
                value = None if draw.random() < 0.1 else float(draw.randint(0, 50))
                data.append((start + dt.timedelta(days=i), store, family, value))
    draw.shuffle(data)
    return data


def expected_series(data, n=7, exclude_current=False):
    out = {}
    frame = pd.DataFrame(data, columns=["date", "store_nbr", "family", "sales"]).sort_values("date")
    for (store, family), g in frame.groupby(["store_nbr", "family"]):
        s = g["sales"].astype(float)
        base = s.shift(1) if exclude_current else s
        mean = base.rolling(n, min_periods=1).mean().fillna(0.0)
        for i, d in enumerate(g["date"]):
            out[(d, store, family)] = (
                s.shift(7).fillna(0.0).iloc[i], s.shift(14).fillna(0.0).iloc[i], mean.iloc[i]
            )
    return out


@pytest.mark.parametrize("chunk_days", [1, 5, 16, 400])
@pytest.mark.parametrize("exclude_current", [False, True])
def test_series_features_at_any_chunk_size(spark, chunk_days, exclude_current):
    data = gappy_sales()
    df = spark.createDataFrame(data, SCHEMA)
    got = features.series_features(df, exclude_current=exclude_current, chunk_days=chunk_days)
    assert got.columns == ["date", "store_nbr", "family", "sales", "lag_7", "lag_14", "rolling_mean_7"]
    expected = expected_series(data, exclude_current=exclude_current)
    result = got.collect()
    assert len(result) == len(data)
    for r in result:
        assert (r["lag_7"], r["lag_14"], r["rolling_mean_7"]) == pytest.approx(
            expected[(r["date"], r["store_nbr"], r["family"])]
        )


def test_a_series_before_1970_and_across_it(spark):
    data = [(dt.date(1969, 12, 20) + dt.timedelta(days=i), 1, "A", float(i)) for i in range(30)]
    got = features.lag_features(spark.createDataFrame(data, SCHEMA), chunk_days=8).orderBy("date").collect()
    assert [r["lag_7"] for r in got] == [0.0] * 7 + [float(i) for i in range(23)]


def test_a_hot_series_of_timestamps_is_cut_into_parts(spark):
    n = 2000
    df = spark.range(n).select(
        F.timestamp_seconds(F.col("id") * F.col("id")).alias("at"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("long").alias("store_nbr"),
        F.lit("A").alias("family"),
        (F.col("id") % 17).cast("double").alias("sales"),
    )
    plain = features.series_features(df, order="at", chunk_days=100_000, hot_rows=n)
    cut = features.series_features(df, order="at", chunk_days=100_000, hot_rows=100)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    from shelfwatch.operators import ordered

    rows = ordered.with_history(df, ["store_nbr", "family"], "at", 14, chunk_days=100_000, hot_rows=100)
    sizes = rows.groupBy("store_nbr", ordered.CHUNK, ordered.PART).count()
    assert sizes.agg(F.max("count")).first()[0] <= 100 + 14


def test_a_hot_day_with_ties_is_cut_too(spark):
    n = 2000
    df = spark.range(n).select(
        F.lit("2020-03-01").cast("date").alias("date"),
        F.col("id").cast("string").alias("ticket"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(2).cast("long").alias("store_nbr"),
        F.lit("A").alias("family"),
        (F.col("id") % 17).cast("double").alias("sales"),
    )
    plain = features.series_features(df, tie_cols=["ticket"], hot_rows=n)
    cut = features.series_features(df, tie_cols=["ticket"], hot_rows=100)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))


def test_nan_sales_count_as_missing(spark):
    data = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), 1, "A", v) for i, v in enumerate([math.nan, 4.0, math.nan, 8.0])]
    got = features.rolling_mean(spark.createDataFrame(data, SCHEMA)).orderBy("date").collect()
    assert [r["rolling_mean_7"] for r in got] == [0.0, 4.0, 4.0, 6.0]


def test_without_sales_all_history_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1, "A")], "date date, store_nbr bigint, family string")
    row = features.series_features(df).first()
    assert (row["lag_7"], row["lag_14"], row["rolling_mean_7"]) == (0.0, 0.0, 0.0)


def test_calendar_lag_follows_days_not_rows(spark):
    data = gappy_sales(seed=5)
    got = features.calendar_lag(spark.createDataFrame(data, SCHEMA)).collect()
    by_day = {(d, s, f): v for d, s, f, v in data}
    assert len(got) == len(data)
    for r in got:
        for k in (7, 14):
            before = by_day.get((r["date"] - dt.timedelta(days=k), r["store_nbr"], r["family"]))
            assert r[f"day_lag_{k}"] == (before or 0.0)


def test_calendar_lag_adds_up_a_day_and_takes_nulls(spark):
    day = dt.date(2020, 1, 1)
    data = [(day, 1, None, 2.0), (day, 1, None, 3.0), (day + dt.timedelta(days=400), 1, None, None), (None, 1, None, 7.0)]
    got = features.calendar_lag(spark.createDataFrame(data, SCHEMA), days=(400, 1)).collect()
    assert sorted((str(r["date"]), r["day_lag_400"], r["day_lag_1"]) for r in got) == [
        ("2020-01-01", 0.0, 0.0), ("2020-01-01", 0.0, 0.0), ("2021-02-04", 5.0, 0.0), ("None", 0.0, 0.0),
    ]
    with pytest.raises(ValueError):
        features.calendar_lag(spark.createDataFrame(data, SCHEMA), days=(0, 7))


def test_calendar_features(spark):
    days = ["2024-02-29", "2023-12-31", "2024-01-02", "2024-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "date string").withColumn("date", F.to_date("date"))
    got = {str(r["date"]): tuple(r)[1:] for r in features.calendar_features(df).collect()}
    assert got["2024-02-29"] == (3, 2, 2024, 62)
    assert got["2023-12-31"] == (6, 12, 2023, 0)
    assert got["2024-01-02"] == (1, 1, 2024, 120)
    assert got["2024-01-01"] == (0, 1, 2024, 0)


def test_calendar_features_without_a_date(spark):
    row = features.calendar_features(spark.range(1)).first()
    assert tuple(row)[1:] == (0, 1, 2017, 0)


def test_one_hot_family(spark):
    df = spark.createDataFrame([(1, "BREAD/BAKERY"), (2, "DAIRY"), (3, None), (4, "DAIRY")], "id int, family string")
    encoded, categories = features.one_hot_family(df)
    assert categories == ["BREAD/BAKERY", "DAIRY"]
    assert encoded.columns == ["id", "family_BREAD_BAKERY", "family_DAIRY"]
    assert [tuple(r) for r in encoded.orderBy("id").collect()] == [
        (1, 1.0, 0.0), (2, 0.0, 1.0), (3, 0.0, 0.0), (4, 0.0, 1.0)
    ]
    unseen, _ = features.one_hot_family(spark.createDataFrame([("NEW",)], "family string"), categories=categories)
    assert tuple(unseen.first()) == (0.0, 0.0)


def test_one_hot_family_errors_and_pass_through(spark):
    clash = spark.createDataFrame([("A/B",), ("A,B",)], "family string")
    with pytest.raises(ValueError, match="A,B.*A/B|A/B.*A,B"):
        features.one_hot_family(clash)
    with pytest.raises(ValueError):
        features.one_hot_family(clash, fit=False)
    same, categories = features.one_hot_family(spark.range(2))
    assert same.columns == ["id"] and categories == []
    with pytest.raises(ValueError):
        features.fitted_categories(clash, limit=1)


def test_the_default_limit_of_categories(spark):
    many = spark.range(features.MAX_CATEGORIES + 1).select(F.concat(F.lit("f"), "id").alias("family"))
    with pytest.raises(ValueError, match=f"family has {features.MAX_CATEGORIES + 1} categories, more than the limit of {features.MAX_CATEGORIES}"):
        features.one_hot_family(many)
