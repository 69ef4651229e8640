import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwatch.functions import tails
from shelfwatch.operators import checks, drift, ordered


def numpy_psi(ref, cur, n_bins=10, eps=1e-6):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, n_bins + 1)))
    if len(edges) < 2:
        return 0.0
    r, _ = np.histogram(ref, bins=edges)
    c, _ = np.histogram(cur, bins=edges)
    r, c = r / r.sum() + eps, c / c.sum() + eps
    return round(float(np.sum((c - r) * np.log(c / r))), 6)


def category_psi(ref, cur, eps=1e-6):
    r = pd.Series(ref).value_counts(normalize=True)
    c = pd.Series(cur).value_counts(normalize=True).reindex(r.index, fill_value=0.0)
    r, c = r + eps, c + eps
    return round(float(((c - r) * np.log(c / r)).sum()), 6)


def number_frames():
    rng = np.random.default_rng(7)
    n, m = 3000, 1700
    ref = pd.DataFrame(
        {
            "normal": rng.normal(0, 1, n),
            "skewed": np.exp(rng.normal(0, 3, n)),
            "hot": np.where(rng.random(n) < 0.4, 5.0, rng.integers(0, 1000, n)),
            "few": rng.integers(0, 4, n).astype(float),
            "tiny": rng.random(n) * 1e-12,
            "money": np.round(rng.random(n) * 1e5, 2),
            "flat": np.full(n, 3.0),
            "whole": rng.integers(-50, 50, n),
        }
    )
    cur = pd.DataFrame(
        {
            "normal": rng.normal(0.4, 1.3, m),
            "skewed": np.exp(rng.normal(0.2, 3, m)),
            "hot": np.where(rng.random(m) < 0.2, 5.0, rng.integers(0, 1200, m)),
            "few": rng.integers(0, 6, m).astype(float),
            "tiny": rng.random(m) * 1.5e-12,
            "money": np.round(rng.random(m) * 1e5, 2),
            "flat": np.full(m, 4.0),
            "whole": rng.integers(-20, 80, m),
        }
    )
    return ref, cur


def by_feature(df, col="psi"):
    return {r["feature"]: r[col] for r in df.collect()}


@pytest.mark.parametrize("keep_all", [True, False])
def test_numeric_index_equals_numpy(spark, monkeypatch, keep_all):
    if not keep_all:
        # The path of large columns: values only around the quantiles, the rest in bulk.
        monkeypatch.setattr(ordered, "KEEP_ALL_ROWS", 100)
        monkeypatch.setattr(ordered, "SKETCH_ACCURACY", 500)
    ref, cur = number_frames()
    got = by_feature(drift.psi_numeric(spark.createDataFrame(ref), spark.createDataFrame(cur), list(ref.columns)))
    assert got == {c: numpy_psi(ref[c], cur[c]) for c in ref.columns}
    edges = by_feature(drift.quantile_edges(spark.createDataFrame(ref), list(ref.columns)), "edges")
    for c in ref.columns:
        assert edges[c] == np.unique(np.quantile(ref[c].astype(float), np.linspace(0, 1, 11))).tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 11, 12, 101])
def test_edges_of_small_columns(spark, n):
    values = np.random.default_rng(n).random(n)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for bins in (1, 4, 10):
        edges = by_feature(drift.quantile_edges(df, ["v"], bins), "edges")["v"]
        assert edges == np.unique(np.quantile(values, np.linspace(0, 1, bins + 1))).tolist()


def test_large_column_keeps_little_in_detail(spark):
    n = 400_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, -1.0).otherwise((F.col("id") * 7919) % n + 0.5).alias("v"))
    ranks = ordered.ranks_near(drift.long_form(df, ["v"], "double"), "feature", "v", [i / 10 for i in range(1, 10)])
    assert ranks.count() < n / 50
    assert ranks.agg(F.sum("n")).first()[0] == n
    values = np.array([r[0] for r in df.collect()])
    assert by_feature(drift.quantile_edges(df, ["v"]), "edges")["v"] == np.unique(np.quantile(values, np.linspace(0, 1, 11))).tolist()


def test_categorical_index(spark):
    ref = ["a"] * 50 + ["b"] * 30 + ["only ref"] * 20
    cur = ["a"] * 10 + ["b"] * 60 + ["only cur"] * 30
    frames = [spark.createDataFrame([(v,) for v in side] + [(None,)] * 5, "c string") for side in (ref, cur)]
    assert by_feature(drift.psi_categorical(*frames, ["c"])) == {"c": category_psi(ref, cur)}


def test_a_frame_against_itself_is_zero(spark):
    ref, _ = number_frames()
    df = spark.createDataFrame(ref).withColumn("text", F.col("few").cast("string")).withColumn("flag", F.col("few") > 1)
    report = drift.psi_report(df, df).collect()
    assert [r["feature"] for r in report] and {r["psi"] for r in report} == {0.0}
    assert {r["band"] for r in report} == {"stable"} and {r["status"] for r in report} == {"ok"}


def test_missing_values_go_column_by_column(spark):
    data = [(1.0, None), (2.0, "x"), (None, "y"), (math.nan, "x"), (4.0, "x")]
    df = spark.createDataFrame(data, "n double, c string")
    clean = df.select("n").filter("n is not null and not isnan(n)")
    assert by_feature(drift.quantile_edges(df, ["n"]), "edges") == by_feature(drift.quantile_edges(clean, ["n"]), "edges")
    shares = {(r["feature"], r["value"]): r["share"] for r in drift.value_share(df, ["c"]).collect()}
    assert shares == {("c", "x"): 0.75, ("c", "y"): 0.25}


def test_frames_without_data(spark):
    full = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "n double, c string")
    empty = full.limit(0)
    report = {r["feature"]: r for r in drift.psi_report(full, empty).collect()}
    assert (report["n"]["psi"], report["n"]["status"], report["n"]["band"]) == (None, "no_data", None)
    assert report["c"]["status"] == "no_data" and report["c"]["psi"] > 1
    report = {r["feature"]: r for r in drift.psi_report(empty, full).collect()}
    assert (report["n"]["psi"], report["n"]["status"]) == (None, "no_data")
    assert (report["c"]["psi"], report["c"]["status"]) == (0.0, "no_data")


def test_values_outside_the_reference(spark):
    ref, cur = np.arange(100.0), np.concatenate([np.arange(50.0), [1e9, -1e9, 99.0]])
    frames = [spark.createDataFrame([(float(v),) for v in side], "v double") for side in (ref, cur)]
    assert by_feature(drift.psi_numeric(*frames, ["v"])) == {"v": numpy_psi(ref, cur)}


def test_common_columns_and_types(spark):
    left = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    right = spark.createDataFrame([(1.0, "a", 3)], "z double, y string, w int")
    assert drift.common_columns(left, right) == ["y", "z"]
    with pytest.raises(TypeError):
        drift.column_kinds(spark.range(1).select(F.array(F.lit(1)).alias("a")), ["a"])
    with pytest.raises(ValueError):
        drift.psi_report(left.select("x"), right.select("w"))


def test_a_shifted_window_calls_for_retraining(spark):
    base = spark.range(5000).select(
        (F.col("id") % 54).alias("store_nbr"),
        F.concat(F.lit("F"), F.col("id") % 33).alias("family"),
        F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("onpromotion"),
    )
    shifted = base.withColumn("family", F.when(F.hash("store_nbr", "family") % 10 < 6, "GROCERY I").otherwise(F.col("family")))
    calm = drift.retrain_decision(drift.psi_report(base, base)).first()
    assert calm["retrain"] is False and calm["max_psi"] == 0.0
    alarm = drift.retrain_decision(drift.psi_report(base, shifted)).first()
    assert alarm["retrain"] is True and alarm["max_feature"] == "family" and alarm["max_psi"] > 0.2


def test_exactly_the_threshold_does_not_retrain(spark):
    scores = spark.createDataFrame([("a", 0.2), ("b", None)], "feature string, psi double")
    assert drift.retrain_decision(scores).first()["retrain"] is False
    assert drift.retrain_decision(scores.limit(0)).first()["retrain"] is False


def test_ks_and_chi2(spark):
    ref, cur = number_frames()
    cols = ["normal", "hot", "few"]
    got = by_feature(checks.ks_statistic(spark.createDataFrame(ref[cols]), spark.createDataFrame(cur[cols]), cols), "ks")
    for c in cols:
        points = np.unique(np.concatenate([ref[c], cur[c]]))
        gap = np.abs(
            np.searchsorted(np.sort(ref[c]), points, "right") / len(ref) - np.searchsorted(np.sort(cur[c]), points, "right") / len(cur)
        ).max()
        assert got[c] == pytest.approx(gap)
    frames = [spark.createDataFrame([(v,) for v in "aab" * 10 + "c"], "c string"), spark.createDataFrame([(v,) for v in "abb" * 7], "c string")]
    row = checks.chi2_test(*frames, ["c"]).first()
    table = np.array([[20, 10, 1], [7, 14, 0]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert row["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum()) and row["degrees"] == 2


def test_ranked_values_over_many_ranges(spark):
    rng = np.random.default_rng(1)
    data = [("f", float(v), int(n), 1) for v, n in zip(rng.permutation(500), rng.integers(1, 9, 500))]
    counts = spark.createDataFrame(data, "feature string, v double, a bigint, b bigint")
    got = ordered.ranked_values(counts, "feature", "v", ["a", "b"], n_ranges=9).orderBy("v").toPandas()
    assert got["a_upto"].tolist() == got["a"].cumsum().tolist()
    assert got["b_upto"].tolist() == list(range(1, 501))
    assert set(got["a_total"]) == {got["a"].sum()}


def poisson_tail(x, a):
    """Q(a, x) of a whole ``a``: the chance of fewer than ``a`` events."""
    return sum(math.exp(-x + k * math.log(x) - math.lgamma(k + 1)) for k in range(a))


def test_chi_squared_tail(spark):
    cases = [(0.5, 2), (3.0, 2), (9.5, 4), (40.0, 20), (15.0, 20), (1000.0, 1000), (900.0, 1000), (2300.0, 2000), (60000.0, 60000), (0.0, 4), (5.0, 0)]
    odd = [(x, 1) for x in (0.001, 0.5, 3.84, 30.0)]
    df = spark.createDataFrame([(float(x), d) for x, d in cases + odd], "x double, d long")
    got = {(r["x"], r["d"]): r["p"] for r in df.select("x", "d", tails.chi2_tail(F.col("x"), F.col("d")).alias("p")).collect()}
    for x, d in cases:
        expected = 1.0 if x == 0 or d == 0 else poisson_tail(x / 2, d // 2)
        assert got[x, d] == pytest.approx(expected, abs=1e-9)
    for x, d in odd:
        assert got[x, d] == pytest.approx(math.erfc(math.sqrt(x / 2)), abs=1e-12)
        three = math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        row = spark.createDataFrame([(x,)], "x double").select(tails.chi2_tail(F.col("x"), F.lit(3)).alias("p")).first()
        assert row["p"] == pytest.approx(three, abs=1e-12)


def test_kolmogorov_tail(spark):
    points = [0.01, 0.2, 0.5, 0.8276, 0.99, 1.0, 1.01, 1.3581, 1.6276, 3.0, 8.0]
    df = spark.createDataFrame([(x / math.sqrt(500.0),) for x in points], "gap double")
    rows = df.select("gap", tails.kolmogorov_tail(F.col("gap"), F.lit(1000), F.lit(1000)).alias("p")).collect()
    for r, x in zip(sorted(rows), points):
        series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 4000))
        assert r["p"] == pytest.approx(min(1.0, series), abs=1e-9)
    assert [r["p"] for r in sorted(rows)][7] == pytest.approx(0.05, abs=1e-4)


def test_drift_tests(spark):
    rng = np.random.default_rng(3)
    ref = spark.createDataFrame([(float(a), float(a), "ab"[int(b > 0.5)], None) for a, b in zip(rng.normal(size=800), rng.random(800))], "same double, moved double, kind string, none double")
    cur = spark.createDataFrame([(float(a), float(a) + 0.3, "ab"[int(b > 0.3)], 1.0) for a, b in zip(rng.normal(size=600), rng.random(600))], "same double, moved double, kind string, none double")
    got = {r["feature"]: r for r in checks.drift_tests(ref, cur).collect()}
    assert {f: (r["test"], r["drift"]) for f, r in got.items()} == {
        "same": ("ks", False), "moved": ("ks", True), "kind": ("chi2", True), "none": ("ks", False)
    }
    assert got["none"]["p_value"] is None and got["kind"]["degrees"] == 1 and 0.05 < got["same"]["p_value"] <= 1
    with pytest.raises(ValueError, match="share no columns"):
        checks.drift_tests(ref.select("same"), cur.select("kind"))


def test_edges_from_kept_sketches(spark, monkeypatch):
    monkeypatch.setattr(ordered, "KEEP_ALL_ROWS", 100)
    df = spark.range(60_000).select(
        F.date_from_unix_date((F.col("id") % 40).cast("int")).alias("date"),
        ((F.col("id") * 7919) % 59_999 / 7).alias("wide"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 11).cast("double").alias("few"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.pow(F.lit(1.0002), "id")).alias("steep"),
    )
    cols = ["wide", "few", "steep"]
    kept = drift.daily_sketches(df, cols).persist()
    assert kept.count() == 120
    window = df.filter("date < '1970-01-21'")
    of_window = kept.filter("day < '1970-01-21'")
    plain = by_feature(drift.quantile_edges(window, cols), "edges")
    assert by_feature(drift.quantile_edges(window, cols, sketches=of_window), "edges") == plain
    current = df.filter("date >= '1970-01-21'")
    assert by_feature(drift.psi_report(window, current, cols, sketches=of_window), "psi") == by_feature(drift.psi_report(window, current, cols), "psi")


def test_sketches_of_other_rows_fail_or_agree(spark, monkeypatch):
    monkeypatch.setattr(ordered, "KEEP_ALL_ROWS", 100)
    df = spark.range(20_000).select(F.date_from_unix_date(F.lit(0)).alias("date"), F.col("id").cast("double").alias("v"))
    other = drift.daily_sketches(df.withColumn("v", F.col("v") + 9_000), ["v"])
    with pytest.raises(Exception, match="missed its error bound"):
        drift.quantile_edges(df, ["v"], sketches=other).collect()
