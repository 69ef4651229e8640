import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import features, forecast, models, split
from shelfwatch.plans.jobs import forecast_job, training_job

PARAMS = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.3}


def sales(n_days=120):
    draw = random.Random(0)
    start = dt.date(2016, 6, 1)
    data = []
    for store in (1, 2, 3):
        for family, level in (("A", 20.0), ("B/C", 60.0)):
            for i in range(n_days):
                promo = draw.randint(0, 1)
                data.append((start + dt.timedelta(days=i), store, family, promo, level * store + 15 * promo + draw.random()))
    return data


SCHEMA = "date date, store_nbr bigint, family string, onpromotion bigint, sales double"


@pytest.fixture(scope="module")
def parts(spark):
    rows = split.chrono_split(features.demand_features(spark.createDataFrame(sales(), SCHEMA), exclude_current=True))
    rows = rows.persist()
    return rows.filter("split = 'train'"), rows.filter("split = 'valid'")


@pytest.fixture(scope="module")
def model(parts):
    return models.train_regressor(*parts, params=PARAMS)


def validation_error(model, valid):
    return forecast.rmse(forecast.score_table(model, valid), "sales", "yhat").first()["rmse"]


def test_beats_the_training_mean(parts, model):
    train, valid = parts
    mean = train.agg(F.avg("sales")).first()[0]
    plain = forecast.rmse(valid.withColumn("yhat", F.lit(mean)), "sales", "yhat").first()["rmse"]
    assert validation_error(model, valid) < plain / 2


def test_the_fit_repeats(parts, model):
    train, valid = parts
    again = models.train_regressor(train, valid, params=PARAMS)
    assert validation_error(again, valid) == validation_error(model, valid)


def test_unseen_family_and_absent_columns(spark, model):
    rows = spark.createDataFrame([(1, "NEVER SEEN", 0)], "store_nbr bigint, family string, onpromotion bigint")
    scored = forecast.score_table(model, rows)
    assert scored.columns == ["store_nbr", "family", "onpromotion", "yhat"]
    assert scored.first()["yhat"] >= 0.0


def test_save_and_load(spark, parts, model, tmp_path):
    models.save_model(model, str(tmp_path / "model"))
    models.save_model(model, str(tmp_path / "model"))
    loaded = models.load_model(spark, str(tmp_path / "model"))
    assert validation_error(loaded, parts[1]) == validation_error(model, parts[1])
    assert models.load_model(spark, str(tmp_path / "absent")) is None


def test_best_round():
    assert models.best_round([5, 4, 3, 3.5, 3.2, 2.9, 4]) == 6
    assert models.best_round([5, 4, 3, 3.5, 3.2, 2.9, 4], patience=2) == 3
    assert models.best_round([1, 2, 3], patience=1) == 1
    assert models.best_round([3.0, 3.0, 3.0]) == 1
    assert models.best_round([]) == 0


def test_early_stop_keeps_fewer_trees_when_the_rest_overfit(spark):
    draw = random.Random(1)
    data = [(draw.random(), draw.random()) for _ in range(300)]
    noise = spark.createDataFrame(data, "x double, sales double")
    train, valid = noise.limit(200).persist(), noise.subtract(noise.limit(200)).persist()
    fitted = models.train_regressor(train, valid, ["x"], params={"maxIter": 12, "maxDepth": 5}, category=None)
    assert fitted.stages[-1].getNumTrees < 12


def stump_rows(spark):
    draw = random.Random(7)
    data = [(draw.randint(0, 9), draw.randint(0, 4), draw.random() * 10) for _ in range(600)]
    return spark.createDataFrame([(float(a), float(b), 3.0 * a + 10 * (b > 2) + e) for a, b, e in data], "a double, b double, sales double")


def test_stages_go_on_where_they_stopped(spark):
    """Stages of one round, of four, and one long stage fit the trees that a single fit of Spark ML has."""
    rows = stump_rows(spark).persist()
    params = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.3, "seed": 1}
    whole = models.train_regressor(rows, None, ["a", "b"], params=params, category=None)
    wanted = {tuple(r)[:3]: r["prediction"] for r in whole.transform(rows).collect()}
    for stage in (1, 4, 8):
        model, losses = models.fit_stages(rows, rows, ["a", "b"], params=params, category=None, stage_rounds=stage)
        assert len(losses) == 8 and losses == sorted(losses, reverse=True) and model.stages[-1].getNumTrees == 8
        got = {tuple(r)[:3]: r["prediction"] for r in model.transform(rows).collect()}
        assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in got)


def test_patience_ends_the_fit_and_kept_rounds_follow_the_losses(spark):
    draw = random.Random(1)
    noise = [(i, draw.random(), draw.random()) for i in range(300)]
    rows = spark.createDataFrame(noise, "i int, x double, sales double").persist()
    train, valid = rows.filter("i < 200"), rows.filter("i >= 200")
    params = {"maxIter": 60, "maxDepth": 5, "seed": 3}
    model, losses = models.fit_stages(train, valid, ["x"], params=params, category=None, patience=4, stage_rounds=3)
    kept = model.stages[-1].getNumTrees
    assert kept + 4 <= len(losses) <= kept + 6 and len(losses) % 3 == 0
    table = models.loss_rows(spark, {5: losses})
    assert models.kept_rounds(table, patience=4).first().asDict() == {"trial": 5, "kept": kept}
    error = valid.join(model.transform(valid).select("i", "prediction"), "i").selectExpr("avg(pow(sales - prediction, 2))").first()[0]
    assert error == pytest.approx(losses[kept - 1])


def test_no_validation_rows(spark, parts):
    with pytest.raises(ValueError, match="no validation rows"):
        models.fit_stages(parts[0], parts[1].filter("false"), params=PARAMS)


def test_search_by_rungs(spark, parts):
    train, valid = parts
    best, trials = models.search_params(train, valid, n_trials=7, seed=3, rounds=(5, 9), rungs=2, keep=3, patience=3, stage_rounds=2)
    rows = [r.asDict() for r in trials.collect()]
    rungs = {n: [r for r in rows if r["rung"] == n] for n in (0, 1)}
    assert len(rungs[0]) == 7 and len(rungs[1]) == 3
    first = sorted(rungs[0], key=lambda r: (r["val_rmse"], r["trial"]))
    assert {r["trial"] for r in first[:3]} == {r["trial"] for r in rungs[1]} == {r["trial"] for r in rungs[0] if r["goes_on"]}
    drawn = models.trial_params(7, 3, (5, 9))
    for r in rows:
        full = drawn[r["trial"]]["maxIter"]
        assert r["rounds"] <= models.rung_rounds(full, 2, 3)[r["rung"]] and 1 <= r["maxIter"] <= r["rounds"]
    later = {r["trial"]: r for r in rungs[1]}
    assert all(later[t]["val_rmse"] <= r["val_rmse"] for r in rungs[0] for t in [r["trial"]] if t in later)
    least = min(rows, key=lambda r: (r["val_rmse"], r["trial"], -r["rung"]))
    assert best == {k: least[k] for k in ("maxDepth", "stepSize", "maxIter")}
    alone = models.fit_stages(train, valid, params={**best, "seed": 3}, patience=3, stage_rounds=2)[0]
    assert validation_error(alone, valid) == pytest.approx(least["val_rmse"], rel=0.05)


def test_rung_rounds():
    assert models.rung_rounds(90) == [10, 30, 90] and models.rung_rounds(2) == [1, 1, 2] and models.rung_rounds(5, 1) == [5]


def test_survivors_of_ties_and_missing_losses(spark):
    rows = spark.createDataFrame([(0, 3, 1.0), (0, 1, 1.0), (0, 2, None), (0, 4, 0.5), (1, 1, None)], "rung int, trial int, val_rmse double")
    got = {(r["rung"], r["trial"]): r["goes_on"] for r in models.survivors(rows, keep=2).collect()}
    assert got == {(0, 4): True, (0, 1): True, (0, 3): False, (0, 2): False, (1, 1): True}


def walked(nodes, x):
    total = 0.0
    for tree in {n["tree"] for n in nodes}:
        by_id = {n["node"]: n for n in nodes if n["tree"] == tree}
        n = by_id[0]
        while n["feature"] is not None:
            v = x[n["feature"]]
            below = v in n["members"] if n["members"] is not None else v <= n["threshold"]
            n = by_id[n["below"] if below else n["above"]]
        total += n["value"] * n["weight"]
    return total


def test_exported_trees_score_like_the_model(spark, parts, model):
    nodes = [r.asDict() for r in models.tree_rows(spark, model).collect()]
    assert {n["tree"] for n in nodes} == set(range(model.stages[-1].getNumTrees))
    assert any(n["members"] for n in nodes)
    for r in model.transform(parts[1]).limit(80).collect():
        assert walked(nodes, r["features"].toArray()) == pytest.approx(r["prediction"])


def test_trials_repeat_and_stay_in_range():
    trials = models.trial_params(20, 42)
    assert trials == models.trial_params(20, 42) != models.trial_params(20, 43)
    assert all(3 <= t["maxDepth"] <= 6 and 0.01 <= t["stepSize"] <= 0.3 and 100 <= t["maxIter"] <= 800 for t in trials)


def test_training_and_forecast_jobs(spark, tmp_path):
    path = tmp_path / "sales.csv"
    spark.createDataFrame(sales(60), SCHEMA).coalesce(1).write.csv(str(path), header=True)
    direct = training_job(spark, str(path), str(tmp_path / "model"), params=PARAMS)
    assert direct["valid_rmse"] > 0 and 1 <= direct["rounds"] <= 8
    from shelfwatch.plans.jobs import feature_job

    feature_job(spark, str(path), str(tmp_path / "features"))
    stored = training_job(spark, str(path), str(tmp_path / "stored"), str(tmp_path / "features"), params=PARAMS)
    assert stored["valid_rmse"] == pytest.approx(direct["valid_rmse"])

    requests = spark.createDataFrame([("a", "1", "A", "0", "5"), ("b", "x", "A", "0", "5")], "request_id string, store_nbr string, family string, onpromotion string, days_ahead string")
    requests.write.parquet(str(tmp_path / "requests"))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    forecast_job(spark, str(tmp_path / "requests"), out, bad, str(tmp_path / "model"), base_date="2017-01-01")
    rows = spark.read.parquet(out).collect()
    assert [r["request_id"] for r in rows] == ["a"] and len(rows[0]["forecast"]) == 5 and min(rows[0]["forecast"]) >= 0
    assert spark.read.parquet(bad).count() == 1
    forecast_job(spark, str(tmp_path / "requests"), out, bad, str(tmp_path / "no model"), base_date="2017-01-01")
    assert spark.read.parquet(out).first()["status"] == "no_model"


def test_kept_rounds_equal_the_rule(spark):
    draw = random.Random(5)
    fits = {k: [draw.choice([1.0, 2.0, 3.0, 4.0, 5.0]) for _ in range(draw.randint(1, 30))] for k in range(60)}
    data = [(k, i, loss) for k, losses in fits.items() for i, loss in enumerate(losses, start=1)]
    table = spark.createDataFrame(data, "trial int, round int, loss double")
    for patience in (1, 3, 50):
        found = dict(models.kept_rounds(table, patience=patience).collect())
        assert found == {k: models.best_round(losses, patience) for k, losses in fits.items()}


def test_history_hints(spark):
    stored = spark.createDataFrame(
        [(1, "A", dt.datetime(2017, 1, 1), 5.0), (1, "A", dt.datetime(2017, 1, 9), 7.0)],
        "store_nbr bigint, family string, event_timestamp timestamp, rolling_mean_7 double",
    )
    day = dt.date(2017, 1, 5)
    asked = spark.createDataFrame(
        [("a", 1, "A", 0, day, 9), ("b", 1, "A", 0, dt.date(2016, 1, 1), 9), ("c", None, "A", 0, day, 9)],
        "request_id string, store_nbr bigint, family string, onpromotion bigint, base_date date, days_ahead int",
    )
    hinted = forecast.history_hints(asked, stored)
    assert {r["request_id"]: r["sales_hint"] for r in hinted.collect()} == {"a": 5.0, "b": None, "c": None}
    made = forecast.forecast_requests(hinted, forecast.baseline_forecast, sales_hint="sales_hint")
    totals = {r["request_id"]: sum(r["forecast"]) for r in made.collect()}
    assert totals == {"a": 7 * 2.5 + 2 * 5.0, "b": 0.0, "c": 0.0}
