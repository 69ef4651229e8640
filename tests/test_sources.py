import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwatch import sources
from shelfwatch.operators.features import demand_features
from shelfwatch.operators.asof import latest_per_key
from shelfwatch.plans.jobs import drift_job, feature_job


def write_sales(path, n_days=20):
    lines = ["id,date,store_nbr,family,sales,onpromotion"]
    start = dt.date(2016, 12, 20)
    for i in range(n_days):
        lines.append(f'{i},{start + dt.timedelta(days=i)},{1 + i % 2},"LIQUOR,WINE",{i * 1.5},{i % 3}')
    path.write_text("\n".join(lines))


def test_scan_sales_csv(spark, tmp_path):
    write_sales(tmp_path / "train.csv")
    df = sources.scan_sales_csv(spark, str(tmp_path / "train.csv"))
    assert dict(df.dtypes) == {
        "id": "string", "date": "date", "store_nbr": "bigint", "family": "string", "sales": "double", "onpromotion": "bigint"
    }
    assert df.count() == 20 and df.first()["family"] == "LIQUOR,WINE"


def test_scan_sales_csv_lists_missing_columns(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("date,store_nbr\n2020-01-01,1\n")
    with pytest.raises(ValueError, match="family, onpromotion, sales"):
        sources.scan_sales_csv(spark, str(tmp_path / "bad.csv"))


def test_scan_table_by_extension(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    df = sources.scan_table(spark, str(tmp_path / "t.csv"))
    assert df.count() == 2 and dict(df.dtypes)["a"] == "int"
    df.write.parquet(str(tmp_path / "t.parquet"))
    assert sources.scan_table(spark, str(tmp_path / "t.parquet")).count() == 2
    assert dict(sources.scan_table(spark, str(tmp_path / "t.csv"), "a string, b string").dtypes)["a"] == "string"
    with pytest.raises(Exception, match="(?i)path"):
        sources.scan_table(spark, str(tmp_path / "absent.parquet"))


def test_feature_table_round_trip_and_pruning(spark, tmp_path):
    write_sales(tmp_path / "train.csv", 30)
    feature_job(spark, str(tmp_path / "train.csv"), str(tmp_path / "features"))
    table = spark.read.parquet(str(tmp_path / "features"))
    assert sorted(table.columns) == sorted(sources.tables.FEATURE_COLUMNS)
    assert dict(table.dtypes)["event_timestamp"] == "timestamp"
    assert {p.name for p in (tmp_path / "features").iterdir() if p.is_dir()} == {"year=2016", "year=2017"}
    plan = table.filter("year = 2017")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    again = demand_features(sources.scan_sales_csv(spark, str(tmp_path / "train.csv")))
    sources.write_feature_table(again, str(tmp_path / "flat"), partition_by=())
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 30


GOOD_LINE = '{"question": "q", "context": "c", "answer": "a", "extra": [1]}'


def test_scan_eval_jsonl(spark, tmp_path):
    lines = {
        GOOD_LINE: None,
        "": "dropped",
        "   ": "dropped",
        "{broken": "bad_json",
        "[1, 2]": "not_an_object",
        "5": "not_an_object",
        '{"question": "q", "answer": "a"}': "missing: context",
        '{"answer": "a"}': "missing: context, question",
        '{"question": 5, "context": "c", "answer": "a"}': "not a non-empty string: question",
        '{"question": null, "context": "c", "answer": "a"}': "not a non-empty string: question",
        '{"question": "q", "context": "\\u00a0 \\u2003", "answer": ""}': "not a non-empty string: context, answer",
        '{"question": "q", "context": {"a": "b"}, "answer": "a"}': "not a non-empty string: context",
        '{"question": "q", "question": "r", "context": "c", "answer": "a"}': "bad_json",
    }
    (tmp_path / "set.jsonl").write_text("\n".join(lines), encoding="utf-8")
    good, bad = sources.scan_eval_jsonl(spark, str(tmp_path / "set.jsonl"))
    assert [tuple(r) for r in good.collect()] == [("q", "c", "a")]
    found = {r["raw"]: r["reason"] for r in bad.collect()}
    assert found == {k: v for k, v in lines.items() if v not in (None, "dropped")}
    assert bad.first()["source"].endswith("set.jsonl")
    with pytest.raises(sources.QuarantineNotEmpty, match="10 bad rows"):
        sources.scan_eval_jsonl(spark, str(tmp_path / "set.jsonl"), strict=True)


@pytest.fixture
def small_pieces(spark):
    """Files are cut into pieces of 64 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_numbers_over_many_pieces(spark, tmp_path, small_pieces, end):
    folder = tmp_path / "in"
    folder.mkdir()
    wanted = set()
    for name, n in (("a.txt", 200), ("b.txt", 1), ("c.txt", 63), ("empty.txt", 0)):
        lines = [f"{i} " + "é" * (i * 37 % 90) if i % 5 else "" for i in range(n)]
        text = end.join(lines) + (end if n % 2 == 0 else "")
        (folder / name).write_bytes(text.encode())
        wanted |= {(name, i, line) for i, line in enumerate(text.splitlines(), start=1)}
    found = sources.numbered_lines(spark, str(folder))
    assert found.rdd.getNumPartitions() > 40
    rows = found.collect()
    assert {(r["source"].rsplit("/", 1)[1], r["line_no"], r["value"]) for r in rows} == wanted and len(rows) == len(wanted)


def test_quarantine_and_strict_reading_name_the_line(spark, tmp_path, small_pieces):
    lines = [GOOD_LINE] * 40
    lines[17], lines[30] = "{broken", '{"question": "q"}'
    (tmp_path / "set.jsonl").write_text("\n".join(["", *lines]))
    good, bad = sources.scan_eval_jsonl(spark, str(tmp_path / "set.jsonl"))
    assert good.count() == 38
    assert sorted((r["line_no"], r["reason"]) for r in bad.collect()) == [(19, "bad_json"), (32, "missing: answer, context")]
    with pytest.raises(sources.QuarantineNotEmpty, match=r"2 bad rows, such as bad_json in line 19 of .*set.jsonl"):
        sources.scan_eval_jsonl(spark, str(tmp_path / "set.jsonl"), strict=True)


def test_strict_reading_of_an_empty_and_a_good_file(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("\n\n")
    (tmp_path / "good.jsonl").write_text(GOOD_LINE + "\n\n")
    with pytest.raises(sources.EmptyEvalSet):
        sources.scan_eval_jsonl(spark, str(tmp_path / "empty.jsonl"), strict=True)
    assert sources.scan_eval_jsonl(spark, str(tmp_path / "good.jsonl"), strict=True)[0].count() == 1


def test_gauge_lines_and_json(spark, tmp_path):
    scores = spark.createDataFrame([("b", 0.25), ("a", 0.0000019), ("c", None)], "feature string, psi double")
    sources.write_gauge_file(scores, str(tmp_path / "gauge"))
    part = next((tmp_path / "gauge").glob("part-*"))
    assert part.read_text().splitlines() == [
        "# HELP psi_score Population Stability Index per feature",
        "# TYPE psi_score gauge",
        'psi_score{feature="a"} 0.000002',
        'psi_score{feature="b"} 0.250000',
    ]
    assert sources.gauge_json(scores).first()["scores"] == '{"a":1.9E-6,"b":0.25}'


def test_drift_job(spark, tmp_path):
    ref = spark.range(1000).select((F.col("id") % 10).alias("x"), F.lit("k").alias("c"))
    ref.write.parquet(str(tmp_path / "ref"))
    ref.withColumn("x", F.col("x") * F.col("x") / 10).write.parquet(str(tmp_path / "cur"))
    decision = drift_job(spark, str(tmp_path / "ref"), str(tmp_path / "cur"), str(tmp_path / "psi"), str(tmp_path / "gauge"))
    assert decision["retrain"] and decision["max_feature"] == "x"
    assert (decision["ref_rows"], decision["cur_rows"]) == (1000, 1000)
    assert spark.read.parquet(str(tmp_path / "psi")).count() == 2


def test_drift_scores_over_time(spark, tmp_path):
    rows = spark.createDataFrame([(i % 3, float(i)) for i in range(60)], "a int, b double")
    rows.write.parquet(str(tmp_path / "ref"))
    rows.filter("b < 40").write.parquet(str(tmp_path / "cur"))
    paths = [str(tmp_path / name) for name in ("ref", "cur", "psi")]
    for day in ("2017-01-01", "2017-01-02"):
        drift_job(spark, *paths, history_path=str(tmp_path / "history"), scored_on=day)
    history = spark.read.parquet(str(tmp_path / "history"))
    assert history.count() == 4
    newest = latest_per_key(history, ["feature"], "scored_on").collect()
    assert {(r["feature"], str(r["scored_on"])) for r in newest} == {("a", "2017-01-02"), ("b", "2017-01-02")}


def grid_sales(spark, rows):
    return spark.createDataFrame(rows, "date date, store_nbr bigint, family string, onpromotion bigint, sales double")


def test_feature_table_grows_in_any_order(spark, tmp_path):
    start, rows = dt.date(2015, 11, 1), []
    for store in (1, 2, 3):
        for i in range(0, 130, store):
            rows.append((start + dt.timedelta(days=i), store, "A/B", i % 2, float(i * store % 17)))
    # A series with long gaps: its history lies further back than the first look.
    rows += [(start + dt.timedelta(days=100 * i), 9, "C", 0, float(i)) for i in range(20)]
    path, whole = str(tmp_path / "grown"), str(tmp_path / "whole")
    sources.write_feature_table(demand_features(grid_sales(spark, [r for n, r in enumerate(rows) if n % 4])), path)
    for part in (8, 0, 4):
        sources.update_feature_table(grid_sales(spark, [r for n, r in enumerate(rows) if n % 12 == part]), path)
    extra = [(start - dt.timedelta(days=3), 2, "A/B", 1, 4.0), (start, 7, "new", 0, 1.0)]
    sources.update_feature_table(grid_sales(spark, extra), path)
    sources.write_feature_table(demand_features(grid_sales(spark, rows + extra)), whole)
    columns = list(sources.FEATURE_COLUMNS)
    grown, built = (sorted(map(tuple, spark.read.parquet(p).select(*columns).collect())) for p in (path, whole))
    assert grown == built and len(grown) == len(rows) + 2


def test_an_update_replaces_days_and_leaves_other_partitions(spark, tmp_path):
    rows = [(dt.date(2015, 1, 1) + dt.timedelta(days=i), 1, "A", 0, float(i)) for i in range(800)]
    path = tmp_path / "features"
    sources.write_feature_table(demand_features(grid_sales(spark, rows)), str(path))
    before = {p: p.stat().st_mtime_ns for p in path.glob("year=2015/*.parquet")}
    changed = (*rows[797][:4], 1000.0)
    touched = sources.update_feature_table(grid_sales(spark, [changed]), str(path))
    assert touched == [(2017,)] and {p: p.stat().st_mtime_ns for p in path.glob("year=2015/*.parquet")} == before
    built = demand_features(grid_sales(spark, [*rows[:797], changed, *rows[798:]]))
    columns = ["lag_7", "rolling_mean_7", "sales"]
    wanted = {r["date"]: tuple(r[c] for c in columns) for r in built.collect()}
    got = {r["event_timestamp"].date(): tuple(r[c] for c in columns) for r in spark.read.parquet(str(path)).collect()}
    assert got == wanted
    assert sources.update_feature_table(grid_sales(spark, []), str(path)) == []
