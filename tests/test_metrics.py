import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import metrics

SCHEMA = "ts timestamp, status string, latency_s double"
T0 = dt.datetime(2024, 1, 1, 12, 0)


def log(spark, data):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), st, lat) for s, st, lat in data], SCHEMA)


def test_request_counts(spark, rows):
    df = log(spark, [(0, "success", 0.1), (1, "error", 0.1), (2, "success", 0.1)])
    assert rows(metrics.request_counts(df)) == [("error", 1), ("success", 2)]


def test_latency_buckets_include_their_bound(spark):
    df = log(spark, [(0, "s", 0.01), (1, "s", 0.0100001), (2, "s", 5.0), (3, "s", 7.0)])
    got = {r["le"]: r["requests"] for r in metrics.latency_buckets(df).collect()}
    assert got == {"0.01": 1, "0.025": 2, "0.05": 2, "0.1": 2, "0.2": 2, "0.5": 2, "1.0": 2, "2.5": 2, "5.0": 3, "+Inf": 4}


def test_rate_over_sliding_windows(spark):
    df = log(spark, [(0, "s", 0.1), (299, "s", 0.1), (300, "s", 0.1)])
    got = {r["window_start"]: (r["requests"], r["per_second"]) for r in metrics.request_rate_5m(df).collect()}
    # A window holds its start and not its end.
    assert got[T0] == (2, pytest.approx(2 / 300))
    assert got[T0 + dt.timedelta(minutes=1)][0] == 2
    assert got[T0 + dt.timedelta(minutes=5)][0] == 1
    assert T0 + dt.timedelta(minutes=6) not in got and len(got) == 10


def quantile(q, latencies, bounds=metrics.LATENCY_BOUNDS):
    """The rule spelled out, for one set of latencies."""
    cum = [sum(x <= b for x in latencies) for b in bounds]
    rank = q * len(latencies)
    for i, c in enumerate(cum):
        if c >= rank:
            low, before = (bounds[i - 1], cum[i - 1]) if i else (0.0, 0)
            return low + (bounds[i] - low) * ((rank - before) / (c - before) if c > before else 0.0)
    return bounds[-1]


@pytest.mark.parametrize(
    "latencies",
    [[0.005], [0.03, 0.03, 0.2, 0.4], [9.0, 9.0], [0.01] * 19 + [9.0], [0.05, 0.3, 0.3, 0.3, 2.0, 4.9]],
)
def test_quantiles_from_buckets(spark, latencies):
    df = log(spark, [(i, "s", x) for i, x in enumerate(latencies)])
    row = metrics.latency_quantiles_5m(df, (0.0, 0.5, 0.95, 1.0), slide="5 minutes").first()
    assert row["requests"] == len(latencies)
    for q in (0.0, 0.5, 0.95, 1.0):
        assert row[f"p{q * 100:g}"] == pytest.approx(quantile(q, latencies))


def test_quantile_without_observations(spark):
    row = metrics.latency_quantiles_5m(log(spark, [(0, "s", None)]), slide="5 minutes").first()
    assert row["p50"] is None


def test_latency_buckets_by_status(spark):
    df = log(spark, [(0, "a", 0.1), (1, "b", 9.0)])
    got = metrics.latency_buckets(df, by=["status"]).filter(F.col("le") == "+Inf").collect()
    assert {(r["status"], r["requests"]) for r in got} == {("a", 1), ("b", 1)}
