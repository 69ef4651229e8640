import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import split

SCHEMA = "date date, store_nbr bigint, family string"


def sales_keys(n, n_days, seed=0):
    draw = random.Random(seed)
    keys = [(dt.date(2020, 1, 1) + dt.timedelta(days=d), s, f) for d in range(n_days) for s in range(1, 6) for f in "ABC"]
    draw.shuffle(keys)
    return keys[:n]


@pytest.mark.parametrize("n,n_days", [(101, 10), (60, 4), (13, 1), (15, 1), (1, 1), (2, 2)])
@pytest.mark.parametrize("ratio", [0.8, 0.5, 0.0, 1.0])
def test_first_rows_by_date_and_ties(spark, n, n_days, ratio):
    keys = sales_keys(n, n_days)
    got = split.chrono_split(spark.createDataFrame(keys, SCHEMA), ratio=ratio).collect()
    train = sorted(tuple(r)[:3] for r in got if r["split"] == "train")
    assert train == sorted(keys)[: int(n * ratio)]
    assert len(got) == n


@pytest.mark.parametrize("kind", ["date", "text", "number"])
def test_boundary_among_more_values_than_are_fetched(spark, monkeypatch, kind):
    monkeypatch.setattr(split, "N_PIVOTS", 5)
    df = spark.range(3000).select(
        F.date_from_unix_date((F.col("id") % 900).cast("int")).alias("date"),
        F.concat(F.lit("k"), F.col("id") % 777).alias("text"),
        (F.col("id") * 7 % 1201).alias("number"),
    )
    values = sorted(r[0] for r in df.select(kind).collect())
    for wanted in (1, 2, 1500, 2999, 3000):
        value, before, n = split._cut_value(df, kind, wanted, limit=20)
        assert value == values[wanted - 1]
        assert (before, n) == (values.index(value), values.count(value))


def test_missing_values_come_first(spark):
    keys = [(None, 1, "A"), (dt.date(2020, 1, 1), None, "A"), (dt.date(2020, 1, 1), 1, None), (dt.date(2020, 1, 1), 1, "B")]
    got = split.chrono_split(spark.createDataFrame(keys, SCHEMA), ratio=0.75).collect()
    assert [tuple(r)[:3] for r in got if r["split"] == "valid"] == [keys[3]]


def test_rows_that_cannot_be_told_apart(spark):
    same = spark.createDataFrame([(dt.date(2020, 1, 1), 1, "A")] * 10, SCHEMA)
    with pytest.raises(ValueError, match="tie columns"):
        split.chrono_split(same)
    assert split.chrono_split(same, ratio=1.0).filter(F.col("split") == "train").count() == 10


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_around_a_change_of_the_clock(spark, zone):
    # 2020-11-01 05:30 UTC and on: the local hour from one to two happens twice in New York.
    df = spark.range(90).select(F.timestamp_seconds(1604208600 + 120 * F.col("id")).alias("at"), "id")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for ratio in (0.1, 0.35, 0.5, 0.8):
            got = split.chrono_split(df, "at", ["id"], ratio).filter("split = 'train'").select("id").collect()
            assert sorted(r["id"] for r in got) == list(range(int(90 * ratio)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_split_is_a_predicate(spark):
    df = split.chrono_split(spark.createDataFrame(sales_keys(50, 5), SCHEMA))
    assert "Exchange" not in df._jdf.queryExecution().toString()


def test_sample_exact(spark, rows):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    first = rows(split.sample_exact(df, ["id"], 50, seed=1))
    assert len(set(first)) == 50
    assert first == rows(split.sample_exact(df.repartition(5), ["id"], 50, seed=1))
    assert first != rows(split.sample_exact(df, ["id"], 50, seed=2))
    assert split.sample_exact(df, ["id"], 5000).count() == 1000
    assert split.sample_exact(df, ["id"], 1000).count() == 1000
    copies = df.withColumn("id", F.when(F.col("id") < 900, 1).otherwise(F.col("id")))
    assert split.sample_exact(copies, ["id"], 50).count() == 50


def test_drift_window(spark):
    df = spark.createDataFrame([(1, "A", 2, 3, 4, 2020, 9.0)], "store_nbr int, family string, onpromotion int, day_of_week int, month int, year int, sales double")
    got = split.drift_window(df)
    assert dict(got.dtypes) == {
        "store_nbr": "bigint", "family": "string", "onpromotion": "bigint", "day_of_week": "bigint", "month": "bigint", "year": "bigint"
    }


@pytest.mark.parametrize("limit", [10_000, 4])
def test_several_boundaries_equal_one_by_one(spark, monkeypatch, limit):
    monkeypatch.setattr(split, "N_PIVOTS", 3)
    keys = sales_keys(140, 11) + [(None, 1, "A"), (None, None, "B")]
    df = spark.createDataFrame(keys, SCHEMA)
    order = sorted(keys, key=lambda k: tuple((v is not None, v) for v in k))
    ratios = [0.0, 0.01, 0.3, 0.31, 0.311, 0.5, 0.999, 1.0]
    found = split.split_boundaries(df, "date", ["store_nbr", "family"], ratios, limit=limit)
    for ratio, first in zip(ratios, found):
        rows = [tuple(r) for r in df.filter(first).collect()]
        assert sorted(rows, key=str) == sorted(order[: int(len(keys) * ratio)], key=str)


def test_three_parts(spark):
    keys = sales_keys(97, 9)
    rows = split.chrono_parts(spark.createDataFrame(keys, SCHEMA), {"train": 0.7, "valid": 0.15, "test": 0.15}).collect()
    ends = [0, int(97 * 0.7), int(97 * 0.85), 97]
    for part, a, b in zip(("train", "valid", "test"), ends, ends[1:]):
        assert sorted(tuple(r)[:3] for r in rows if r["split"] == part) == sorted(keys)[a:b]
    with pytest.raises(ValueError, match="add up to 1"):
        split.chrono_parts(spark.createDataFrame(keys, SCHEMA), {"train": 0.7, "valid": 0.2})


def test_folds_move_on_in_time(spark):
    keys = sales_keys(100, 9)
    rows = split.rolling_origins(spark.createDataFrame(keys, SCHEMA), 4, first=0.6)
    ordered = sorted(keys)
    for k in range(1, 5):
        learn, judge = (sorted(tuple(r)[:3] for r in part.collect()) for part in split.fold(rows, k))
        assert learn == ordered[: 50 + 10 * k] and judge == ordered[50 + 10 * k : 60 + 10 * k]
    with pytest.raises(ValueError):
        split.rolling_origins(rows, 0)


def test_ties_and_no_rows_among_several_boundaries(spark):
    same = spark.createDataFrame([(dt.date(2020, 1, 1), 1, "A")] * 4, SCHEMA)
    with pytest.raises(ValueError, match="4 rows are equal"):
        split.split_boundaries(same, "date", ["store_nbr"], [0.5, 1.0])
    empty = spark.createDataFrame([], SCHEMA)
    assert split.chrono_parts(empty, {"a": 0.5, "b": 0.5}).collect() == []


def test_boundaries_of_timestamps(spark):
    df = spark.range(50).select(F.timestamp_seconds(F.col("id") * 3601).alias("date"), "id")
    rows = split.rolling_origins(df, 5, tie_cols=["id"]).groupBy("block").count().orderBy("block").collect()
    assert [tuple(r) for r in rows] == [(0, 25), *[(k, 5) for k in range(1, 6)]]
