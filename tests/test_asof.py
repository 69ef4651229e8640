import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import asof

E_SCHEMA = "id int, store_nbr bigint, family string, event_timestamp timestamp"
F_SCHEMA = "store_nbr bigint, family string, event_timestamp timestamp, v double, note string"
START = dt.datetime(2020, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def brute(entities, features, ttl_days):
    out = {}
    for i, store, family, ts in entities:
        best = None
        for s, f, fts, v, note in features:
            if s == store and s is not None and f == family and ts is not None and fts is not None and fts <= ts and fts >= ts - dt.timedelta(days=ttl_days):
                if best is None or (fts, v, note) > best:
                    best = (fts, v, note)
        out[i] = best[1:] if best else (None, None)
    return out


@pytest.mark.parametrize("chunk_days,hot_rows", [(1, 1000), (3, 1000), (256, 1000), (256, 10), (7, 3)])
def test_against_brute_force(spark, chunk_days, hot_rows):
    draw = random.Random(3)
    entities = [(i, draw.choice([1, 2, 3]), draw.choice("AB"), at(draw.randint(0, 24 * 40))) for i in range(300)]
    entities += [(300, 1, "A", None), (301, 9, "A", at(5)), (302, None, "A", at(5))]
    features = [
        (draw.choice([1, 2]), draw.choice("AB"), at(draw.randint(0, 24 * 40)), float(draw.randint(0, 9)), draw.choice("xyz"))
        for _ in range(60)
    ]
    features += [(None, "A", at(1), 7.0, "null key"), (1, "A", None, 1.0, "no time")]
    got = asof.pit_join(
        spark.createDataFrame(entities, E_SCHEMA),
        spark.createDataFrame(features, F_SCHEMA),
        ["store_nbr", "family"],
        ttl_days=6,
        tie_cols=["v", "note"],
        chunk_days=chunk_days,
        hot_rows=hot_rows,
    )
    assert got.columns == ["id", "store_nbr", "family", "event_timestamp", "v", "note"]
    expected = brute(entities, features, 6)
    result = got.collect()
    assert len(result) == len(entities)
    assert {r["id"]: (r["v"], r["note"]) for r in result} == expected


def test_bounds_and_ties(spark):
    entities = spark.createDataFrame([(1, 1, "A", at(0)), (2, 1, "A", at(24 * 10)), (3, 1, "A", at(24 * 10 + 1))], E_SCHEMA)
    features = spark.createDataFrame([(1, "A", at(0), 1.0, "b"), (1, "A", at(0), 2.0, "a")], F_SCHEMA)
    got = asof.pit_join(entities, features, ["store_nbr", "family"], ttl_days=10, tie_cols=["note"])
    # Equal times count, the age limit itself counts, and the greater note wins.
    assert {r["id"]: r["v"] for r in got.collect()} == {1: 1.0, 2: 1.0, 3: None}


def test_copies_of_an_entity_all_stay(spark):
    entities = spark.createDataFrame([(7, 1, "A", at(30))] * 50, E_SCHEMA)
    features = spark.createDataFrame([(1, "A", at(2), 4.0, "n")], F_SCHEMA)
    got = asof.pit_join(entities, features, ["store_nbr", "family"])
    assert got.filter(F.col("v") == 4.0).count() == 50


def test_shared_column_names_are_refused(spark):
    entities = spark.createDataFrame([(1, 1, "A", at(0))], E_SCHEMA).withColumn("v", F.lit(0.0))
    with pytest.raises(ValueError):
        asof.pit_join(entities, spark.createDataFrame([], F_SCHEMA), ["store_nbr", "family"])


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 1, "m")], "k string, ts int, v string")
    assert rows(asof.latest_per_key(df, ["k"], "ts")) == [("a", 2, "z"), ("b", 1, "m")]


def test_dates_as_times(spark):
    entities = spark.createDataFrame([(1, dt.date(2020, 1, 5)), (1, dt.date(2020, 1, 1))], "k int, day date")
    features = spark.createDataFrame([(1, dt.date(2020, 1, 2), 3.0)], "k int, day date, v double")
    got = {r["day"].day: r["v"] for r in asof.pit_join(entities, features, ["k"], "day").collect()}
    assert got == {5: 3.0, 1: None}


@pytest.mark.parametrize("scale", [1, 10])
def test_no_part_of_a_hot_stretch_is_larger_than_allowed(spark, scale):
    from shelfwatch.operators import ordered

    df = spark.range(3000 * scale).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("2020-01-01").cast("date"))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 7).cast("int")))
        .alias("t"),
        F.col("id").cast("string").alias("tie"),
    )
    df = df.withColumn(ordered.CHUNK, ordered.time_chunk(F.col("t"), 256))
    got = ordered.cut_hot_stretches(df, ["k"], ["t", "tie"], 100)
    assert got.count() == 3000 * scale
    sizes = got.groupBy("k", ordered.CHUNK, ordered.PART).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "tie")).alias("lo"), F.max(F.struct("t", "tie")).alias("hi")
    )
    assert sizes.agg(F.max("n")).first()[0] <= 100
    for missing in (True, False):
        rows = sizes.filter(F.col("k").isNull() if missing else F.col("k") == "hot").orderBy(ordered.CHUNK, ordered.PART).collect()
        assert len(rows) >= 10 * scale
        assert all(x["hi"] < y["lo"] for x, y in zip(rows, rows[1:]))
    assert ordered.PART not in ordered.cut_hot_stretches(df, ["k"], ["t", "tie"], 100_000).columns


def test_rows_that_cannot_be_told_apart_stay_together(spark):
    from shelfwatch.operators import ordered

    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("2020-01-01").cast("date").alias("t"))
    df = df.withColumn(ordered.CHUNK, ordered.time_chunk(F.col("t"), 256))
    assert ordered.cut_hot_stretches(df, ["k"], ["t"], 100).count() == 500
