"""The physical plans: what is read, shuffled, broadcast, and kept out of Python."""

import re

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import asof, drift, features, metrics, ordered
from shelfwatch.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PYTHON = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|MapInArrow")
NEEDS_PYTHON = {"score_faithfulness", "embed_text", "score_answers"}
WRITES_FIRST = {
    "train_regressor", "score_table", "forecast_requests", "search_params", "prediction_drift", "psi_windows",
    "stream_request_rate_5m", "stream_latency_quantiles_5m", "stream_psi", "stream_validate_requests",
    "train_stumps", "boosting_losses", "score_tree_rows", "feature_table_update", "answer_gate",
    "stream_latest_per_key", "stream_pit_join", "stream_delayed_truth",
}


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.collect()
    plan = initial(df)
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NEEDS_PYTHON - WRITES_FIRST))
def test_no_python_and_no_single_partition_of_rows(spark, name):
    plan = initial(QUERIES[name](spark, SF_DIR))
    assert not PYTHON.search(plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Whatever goes to one partition has been aggregated before: the operator that feeds the
    # exchange is the partial side of an aggregate.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "Aggregate" in lines[i + 1], lines[i : i + 2]


@pytest.fixture
def sales_table(spark, tmp_path):
    path = str(tmp_path / "sales")
    spark.range(60_000).select(
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 1500).cast("int")).alias("date"),
        (F.col("id") / 1500).cast("long").alias("store_nbr"),
        F.lit("A").alias("family"),
        F.lit(0).cast("long").alias("onpromotion"),
        (F.col("id") % 97).cast("double").alias("sales"),
        F.lit("unused").alias("note"),
    ).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def test_series_features_shuffle_the_rows_once(spark, sales_table):
    df = features.demand_features(sales_table.drop("note"))
    plan = final(df)
    assert plan.count("FileScan") == 1, "the tails must read the exchange of the main branch"
    assert "ReusedExchange" in plan
    assert "note" not in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) == 3  # the rows; and of the tails, one summary per series and one history


def test_as_of_join_places_each_side_once(spark, sales_table):
    features_side = sales_table.select("date", "store_nbr", F.col("sales").alias("known"))
    asked = sales_table.select("date", "store_nbr", "note")
    plan = final(asof.pit_join(asked, features_side, ["store_nbr"], "date"))
    by_stretch = [x for x in plan.splitlines() if "REPARTITION_BY_COL" in x and "Reused" not in x]
    assert len(by_stretch) == 2  # lookups with features, and what is inherited
    assert "ReusedExchange" in plan


def test_no_group_of_a_series_window_is_larger_than_its_stretch(spark, sales_table):
    rows = ordered.with_history(sales_table, ["store_nbr", "family"], "date", 14, chunk_days=100)
    groups = rows.groupBy("store_nbr", "family", ordered.CHUNK).count()
    assert groups.agg(F.max("count")).first()[0] == 114


def test_drift_reads_the_reference_twice_and_the_current_frame_once(spark, sales_table):
    cut = F.lit("2018-01-01").cast("date")
    ref, cur = sales_table.filter(F.col("date") < cut), sales_table.filter(F.col("date") >= cut)
    plan = final(drift.psi_numeric(ref, cur, ["sales", "store_nbr"]))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert len(scans) == 3
    assert sum("LessThan(date" in pushed for _, pushed in scans) == 2
    assert all({re.sub(r"#\d+L?", "", c) for c in cols.split(",")} == {"date", "store_nbr", "sales"} for cols, _ in scans)


def test_detail_of_a_large_column_is_a_small_part_of_it(spark, monkeypatch):
    df = spark.range(300_000).select((F.col("id") * 1.0).alias("v"))
    long = drift.long_form(df, ["v"], "double")
    assert ordered.ranks_near(long, "feature", "v", [i / 10 for i in range(1, 10)]).count() < 3000


def test_windows_of_a_log_combine_before_the_shuffle(spark):
    log = spark.createDataFrame([], "ts timestamp, status string, latency_s double")
    for df in (metrics.request_rate_5m(log), metrics.latency_quantiles_5m(log)):
        plan = initial(df)
        assert plan.count("Exchange hashpartitioning") <= 1 and ("partial_count" in plan or "LocalTableScan <empty>" in plan)
