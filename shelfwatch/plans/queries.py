"""Every operator as a query over the star schema's whole tables.

Dates and timestamps leave as text, so that results compare equal across engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import asof, checks, drift, evaluate, features, forecast, metrics, models, split
from ..session import scratch_path
from ..sources import FEATURE_COLUMNS, check_eval_lines, format_gauge_lines, gauge_json, numbered_lines
from ..sources import update_feature_table
from ..sources import write_feature_table as write_features
from ..streaming import append_table, delayed_truth, newest_stream, pit_join_stream, psi_stream, read_log_stream, read_newest
from ..streaming import validate_stream
from ..streaming.drift import reference_bins, window_bin_counts, window_psi
from . import star_tables as star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SERIES = ["store_nbr", "family"]
STREAM_DELAY = "10 minutes"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _day(col: str = "date") -> Column:
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def _time(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def _six(col: str | Column, name: str | None = None) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6).alias(name or col)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, for results that are read several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drift_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = features.calendar_features(star.daily_sales(spark, sf_dir))
    ref, cur = star.reference_window(rows), star.current_window(rows)
    return split.drift_window(ref), split.drift_window(cur)


def _series_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(_day(), *SERIES, "sales", *[_six(n) for n in names])


# Scans and sources ------------------------------------------------------------------------


@query
def scan_table(spark, sf_dir):
    from ..sources import scan_table as scan

    return scan(spark, f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query
def daily_sales(spark, sf_dir):
    return star.daily_sales(spark, sf_dir).select(_day(), *SERIES, "onpromotion", "sales")


@query
def scan_sales_csv(spark, sf_dir):
    """The sales written as a CSV file with a header, and read back."""
    from ..sources import scan_sales_csv as scan

    path = scratch_path(spark, "sales-csv")
    star.daily_sales(spark, sf_dir).write.option("header", True).csv(path)
    return scan(spark, path).select(_day(), *SERIES, "onpromotion", "sales")


@query
def scan_eval_jsonl(spark, sf_dir):
    """JSON lines made of conversation turns: most are valid, the rest break one rule each."""
    turns = star.table(spark, sf_dir, "conversations")
    kind = F.col("conv_id") * 7 + F.col("turn")
    whole = F.to_json(F.struct(F.col("role").alias("question"), F.col("text").alias("context"), F.col("text").alias("answer")))
    line = (
        F.when(kind % 9 == 1, F.to_json(F.struct(F.col("role").alias("question"), F.col("text").alias("answer"))))
        .when(kind % 9 == 2, F.to_json(F.struct(F.col("turn").alias("question"), F.col("text").alias("context"), F.col("text").alias("answer"))))
        .when(kind % 9 == 3, F.concat(F.lit("{not json "), F.col("role")))
        .when(kind % 9 == 4, F.lit("   "))
        .when(kind % 9 == 5, F.to_json(F.struct(F.lit(" ").alias("question"), F.col("text").alias("context"), F.col("text").alias("answer"))))
        .otherwise(whole)
    )
    checked = check_eval_lines(turns.select("conv_id", "turn", line.alias("value")))
    return checked.select(
        "conv_id", "turn", F.coalesce("reason", F.lit("ok")).alias("reason"),
        F.coalesce(F.when(F.col("reason").isNull(), F.col("context")), F.lit("")).alias("context"),
    )


@query
def scan_eval_lines(spark, sf_dir):
    """Lines of JSON files, each cut into many pieces: the number of every line and what is wrong with it.

    A file holds the turns of 200 conversations; every tenth turn has a blank line after it, every
    seventh does not end its JSON.
    """
    turns = star.table(spark, sf_dir, "conversations")
    path, key = scratch_path(spark, "json-lines"), F.col("conv_id") * 10 + F.col("turn")
    whole = F.to_json(F.struct(F.col("role").alias("question"), F.col("text").alias("context"), F.col("text").alias("answer")))
    line = F.when(key % 7 == 0, F.expr("substr(line, 1, length(line) - 1)")).otherwise(F.col("line"))
    line = F.concat(line, F.when(key % 10 == 0, "\n").otherwise(""))
    rows = turns.withColumn("line", whole).select("conv_id", "turn", line.alias("value"), F.expr("conv_id div 200").alias("file"))
    rows.repartition("file").sortWithinPartitions("file", "conv_id", "turn").select("file", "value").write.partitionBy("file").text(path)
    pieces, rows_n = "spark.sql.files.maxPartitionBytes", turns.count()
    before = spark.conf.get(pieces)
    spark.conf.set(pieces, str(min(128 << 20, max(16 << 10, 8 * rows_n))))
    try:
        lines = _stored(check_eval_lines(numbered_lines(spark, path)), "checked-lines")
    finally:
        spark.conf.set(pieces, before)
    file = F.regexp_extract("source", "file=(\\d+)", 1).cast("long").alias("file")
    return lines.select(file, "line_no", F.coalesce("reason", F.lit("ok")).alias("reason"), F.sha2("value", 256).alias("line_hash"))


@query
def scan_event_props(spark, sf_dir):
    """The field check on the events' own JSON: ``k`` is a number, so no row passes as text."""
    events = star.table(spark, sf_dir, "events").select("event_id", "props")
    checked = check_eval_lines(events, "props", ("k",))
    return checked.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def format_gauge_lines_(spark, sf_dir):
    return format_gauge_lines(drift.psi_report(*_drift_windows(spark, sf_dir))).select("line_no", "line")


QUERIES["format_gauge_lines"] = QUERIES.pop("format_gauge_lines_")


@query
def psi_json(spark, sf_dir):
    """The scores as one JSON object, read back into rows."""
    scores = gauge_json(drift.psi_report(*_drift_windows(spark, sf_dir)))
    return scores.select(F.explode(F.from_json("scores", "map<string,double>")).alias("feature", "psi"))


@query
def validate_requests(spark, sf_dir):
    valid, _ = forecast.validate_requests(star.raw_requests(spark, sf_dir), base_date=star.BASE_DATE)
    return valid.select("request_id", "store_nbr", "family", "onpromotion", _day("base_date"), "days_ahead")


@query
def quarantined_requests(spark, sf_dir):
    _, bad = forecast.validate_requests(star.raw_requests(spark, sf_dir), base_date=star.BASE_DATE)
    return bad.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


# Features ---------------------------------------------------------------------------------


@query
def calendar_features(spark, sf_dir):
    rows = features.calendar_features(star.daily_sales(spark, sf_dir))
    return rows.select(_day(), *SERIES, "day_of_week", "month", "year", "days_to_holiday")


@query
def days_to_holiday(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    days = fn.days_to_holiday(F.col("o_orderdate")).cast("long").alias("days_to_holiday")
    return orders.select("o_orderkey", days)


@query
def lag_features(spark, sf_dir):
    return _series_rows(features.lag_features(star.daily_sales(spark, sf_dir)), ["lag_7", "lag_14"])


@query
def rolling_mean(spark, sf_dir):
    return _series_rows(features.rolling_mean(star.daily_sales(spark, sf_dir)), ["rolling_mean_7"])


@query
def rolling_mean_before(spark, sf_dir):
    rows = features.rolling_mean(star.daily_sales(spark, sf_dir), exclude_current=True)
    return _series_rows(rows, ["rolling_mean_7"])


@query
def calendar_lag(spark, sf_dir):
    return _series_rows(features.calendar_lag(star.daily_sales(spark, sf_dir)), ["day_lag_7", "day_lag_14"])


@query
def one_hot_family(spark, sf_dir):
    encoded, _ = features.one_hot_family(star.daily_sales(spark, sf_dir).drop("onpromotion"))
    return encoded.withColumn("date", _day())


@query
def feature_table(spark, sf_dir):
    from ..sources.tables import feature_table as project

    table = project(features.demand_features(star.daily_sales(spark, sf_dir)))
    return table.withColumns(
        {"event_timestamp": _time("event_timestamp"), **{c: F.round(c, 6) for c in ("lag_7", "lag_14", "rolling_mean_7")}}
    )


def _feature_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "feature-table")
    write_features(features.demand_features(star.daily_sales(spark, sf_dir)), path)
    return path


@query
def write_feature_table(spark, sf_dir):
    """The feature table written by year, and read back."""
    return _feature_rows(spark.read.parquet(_feature_path(spark, sf_dir)))


def _feature_rows(table: DataFrame) -> DataFrame:
    numbers = {c: F.round(c, 6) for c in ("lag_7", "lag_14", "rolling_mean_7")}
    whole = {"event_timestamp": _time("event_timestamp"), "year": F.col("year").cast("long")}
    return table.select(*FEATURE_COLUMNS).withColumns({**whole, **numbers})


@query
def stored_features(spark, sf_dir):
    """Features of every sales row, looked up in the written feature table."""
    from .jobs import stored_features as look_up

    rows = look_up(star.daily_sales(spark, sf_dir), _feature_path(spark, sf_dir))
    return _series_rows(rows, ["lag_7", "lag_14", "rolling_mean_7"])


# As-of join, split, sample ----------------------------------------------------------------


@query
def pit_join(spark, sf_dir):
    """Each order looks up its nation's newest sales features of one family, at most ten days old."""
    sales = features.event_timestamp(star.daily_sales(spark, sf_dir))
    orders = star.table(spark, sf_dir, "orders")
    customers = star.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    asked = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_nationkey").cast("long").alias("store_nbr"),
        F.element_at(
            F.array(*[F.lit(f) for f in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]),
            (F.col("o_orderkey") % 6 + 1).cast("int"),
        ).alias("family"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
    )
    found = asof.pit_join(asked, sales, SERIES, ttl_days=10)
    missing = F.lit(-1)
    return found.select(
        "o_orderkey", *SERIES, _time("event_timestamp"),
        F.coalesce("onpromotion", missing).alias("onpromotion"),
        F.coalesce("sales", missing.cast("double")).alias("sales"),
    )


@query
def latest_per_key(spark, sf_dir):
    events = star.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    newest = asof.latest_per_key(events, ["user_id", "event_type"], "ts", ["event_id"])
    return newest.select("user_id", "event_type", "event_id", "value")


@query
def chrono_split(spark, sf_dir):
    return split.chrono_split(star.daily_sales(spark, sf_dir)).select(_day(), *SERIES, "split")


@query
def chrono_parts(spark, sf_dir):
    """Three parts by date, from one counting pass a level."""
    parts = {"train": 0.75, "valid": 0.125, "test": 0.125}
    return split.chrono_parts(star.daily_sales(spark, sf_dir), parts).select(_day(), *SERIES, "split")


@query
def rolling_origins(spark, sf_dir):
    """Rows and sales of what each of four back-test folds learns from and is judged on."""
    rows = split.rolling_origins(star.daily_sales(spark, sf_dir), 4)
    parts = []
    for k in range(1, 5):
        for name, part in zip(("train", "valid"), split.fold(rows, k)):
            sums = part.agg(F.count(F.lit(1)).alias("n"), F.sum("sales").alias("sales"), F.date_format(F.max("date"), "yyyy-MM-dd").alias("last"))
            parts.append(sums.select(F.lit(k).alias("fold"), F.lit(name).alias("part"), "n", "sales", "last"))
    return reduce(DataFrame.unionByName, parts)


@query
def feature_table_update(spark, sf_dir):
    """A stored table of three days in four of the sales, then the others added in two runs: the whole table."""
    sales = star.daily_sales(spark, sf_dir)
    turn = F.pmod(F.unix_date("date") + F.col("store_nbr"), F.lit(8))
    path = scratch_path(spark, "growing-features")
    write_features(features.demand_features(sales.filter(turn < 6)), path)
    for extra in (7, 6):
        update_feature_table(sales.filter(turn == extra), path)
    return _feature_rows(spark.read.parquet(path))


@query
def sample_exact(spark, sf_dir):
    sales = star.daily_sales(spark, sf_dir).withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    return split.sample_exact(sales, ["day", "store_nbr", "family"]).select("day", *SERIES, "sales")


# Drift ------------------------------------------------------------------------------------


@query
def value_share(spark, sf_dir):
    shares = drift.value_share(star.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])
    return shares.select("feature", "value", "n", _six("share"))


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"]
LINE_CATEGORIES = ["l_returnflag", "l_linestatus"]


@query
def quantile_edges(spark, sf_dir):
    ref, _ = star.line_windows(spark, sf_dir)
    edges = drift.quantile_edges(ref, LINE_NUMBERS)
    return edges.select("feature", F.posexplode("edges").alias("edge_no", "edge")).withColumn("edge", F.round("edge", 6))


@query
def histogram_counts(spark, sf_dir):
    ref, cur = star.line_windows(spark, sf_dir)
    edges = drift.quantile_edges(ref, LINE_NUMBERS)
    return drift.histogram_counts(drift.long_form(cur, LINE_NUMBERS, "double"), edges)


@query
def psi_numeric(spark, sf_dir):
    return drift.psi_numeric(*star.line_windows(spark, sf_dir), LINE_NUMBERS)


@query
def psi_categorical(spark, sf_dir):
    return drift.psi_categorical(*star.line_windows(spark, sf_dir), LINE_CATEGORIES)


@query
def psi_report(spark, sf_dir):
    report = drift.psi_report(*_drift_windows(spark, sf_dir), split.WINDOW_COLUMNS)
    return report.withColumn("band", F.coalesce("band", F.lit("")))


@query
def drift_band(spark, sf_dir):
    """Each order's discount-like figure sorted into the bands, both limits included."""
    psi = F.col("o_orderkey") % 31 / F.lit(100.0)
    orders = star.table(spark, sf_dir, "orders")
    return orders.groupBy(fn.drift_band(psi).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query
def retrain_decision(spark, sf_dir):
    return drift.retrain_decision(drift.psi_report(*_drift_windows(spark, sf_dir)))


@query
def window_sizes(spark, sf_dir):
    return drift.window_sizes(*_drift_windows(spark, sf_dir))


@query
def ks_statistic(spark, sf_dir):
    gaps = checks.ks_statistic(*star.line_windows(spark, sf_dir), LINE_NUMBERS)
    return gaps.select("feature", _six("ks"))


@query
def chi2_test(spark, sf_dir):
    found = checks.chi2_test(*star.line_windows(spark, sf_dir), LINE_CATEGORIES)
    return found.select("feature", _six("chi2"), "degrees")


@query
def drift_tests(spark, sf_dir):
    """Chances of so large a difference, and which columns drifted."""
    found = checks.drift_tests(*star.line_windows(spark, sf_dir))
    degrees = F.coalesce("degrees", F.lit(0).cast("long")).alias("degrees")
    return found.select("feature", "test", _six("statistic"), degrees, F.round("p_value", 9).alias("p_value"), "drift")


def _line_sketches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines before the cut, lines from it, sketches per day of all lines), the sketches as a stored table."""
    lines = star.table(spark, sf_dir, "lineitem")
    kept = _stored(drift.daily_sketches(lines, LINE_NUMBERS, "l_shipdate"), "daily-sketches")
    return (*star.line_windows(spark, sf_dir), kept.filter(F.col("day") < F.lit(star.CURRENT_FROM).cast("date")))


@query
def quantile_edges_kept(spark, sf_dir):
    """The same edges from sketches kept per day: the reference is read once."""
    ref, _, sketches = _line_sketches(spark, sf_dir)
    edges = drift.quantile_edges(ref, LINE_NUMBERS, sketches=sketches)
    return edges.select("feature", F.posexplode("edges").alias("edge_no", "edge")).withColumn("edge", F.round("edge", 6))


@query
def psi_numeric_kept(spark, sf_dir):
    """The same scores from sketches kept per day."""
    ref, cur, sketches = _line_sketches(spark, sf_dir)
    return drift.psi_numeric(ref, cur, LINE_NUMBERS, sketches=sketches)


# Answer quality ---------------------------------------------------------------------------


@query
def tokenize(spark, sf_dir):
    documents = star.table(spark, sf_dir, "documents")
    words = documents.select("doc_id", F.explode(fn.tokenize(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("documents"))


@query
def token_precision(spark, sf_dir):
    answers = star.answer_set(spark, sf_dir)
    return answers.select("id", _six(fn.token_precision(F.col("context"), F.col("answer")), "precision"))


def _vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = star.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    return vectors.join(following, "vec_id")


@query
def cosine_clip(spark, sf_dir):
    pairs = _vector_pairs(spark, sf_dir)
    return pairs.select("vec_id", _six(fn.cosine_clip(F.col("embedding"), F.col("following")), "relevance"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = star.table(spark, sf_dir, "labels")
    label = F.when(F.col("toxic") == 1, "contradiction").when(F.col("quality") == 1, "ENTAILMENT").otherwise("NEUTRAL")
    return labels.select("doc_id", label.alias("label"), ((F.col("doc_id") % 100) / F.lit(100.0)).alias("score"))


@query
def nli_score(spark, sf_dir):
    scored = fn.nli_score(F.col("label"), F.col("score"))
    return _labelled(spark, sf_dir).select("doc_id", _six(scored, "faithfulness"))


def length_scorer(max_tokens: int):
    """Stand-in for an entailment model: label and confidence from the length of the text."""
    names = ("entailment", "CONTRADICTION", "neutral")

    def score(texts: Sequence[str]) -> list[tuple[str, float]]:
        return [(names[len(t) % 3], (len(t) % 101) / 100.0) for t in texts]

    return score


def letter_embedder():
    """Stand-in for an embedding model: how often a few letters occur in the text."""

    def embed(texts: Sequence[str]) -> list[list[float]]:
        return [[float(t.count(letter)) for letter in "aeinst "] for t in texts]

    return embed


@query
def score_faithfulness(spark, sf_dir):
    scored = evaluate.score_faithfulness(star.answer_set(spark, sf_dir), length_scorer)
    return scored.select("id", _six("faithfulness"))


@query
def embed_text(spark, sf_dir):
    vectors = evaluate.embed_text(star.answer_set(spark, sf_dir), ["question", "answer"], letter_embedder)
    relevance = fn.cosine_clip(F.col("question_vec"), F.col("answer_vec"))
    return vectors.select("id", F.round(relevance, 4).alias("relevance"))


@query
def eval_gate(spark, sf_dir):
    scores = star.answer_set(spark, sf_dir).select(
        fn.token_precision(F.col("context"), F.col("answer")).alias("precision"),
        fn.nli_score(
            F.when(F.length("answer") % 2 == 0, "ENTAILMENT").otherwise("NEUTRAL"), F.lit(0.9)
        ).alias("faithfulness"),
        (F.length("question") % 100 / F.lit(100.0)).alias("relevance"),
    )
    return _gate_row(evaluate.eval_gate(scores, 0.6))


def _gate_row(gate: DataFrame) -> DataFrame:
    return gate.select("n", *[_six(f"mean_{m}") for m in evaluate.METRICS], *[f"pass_{m}" for m in evaluate.METRICS], "overall")


@query
def score_answers(spark, sf_dir):
    """All three scores of every answer, by the stand-in models."""
    scored = evaluate.score_answers(star.answer_set(spark, sf_dir), length_scorer, letter_embedder)
    return scored.select("id", _six("faithfulness"), F.round("relevance", 4).alias("relevance"), _six("precision"))


@query
def answer_gate(spark, sf_dir):
    """The gate over the scores of the whole answer set."""
    scored = evaluate.score_answers(star.answer_set(spark, sf_dir), length_scorer, letter_embedder)
    gate = evaluate.eval_gate(_stored(scored.select("id", *evaluate.METRICS), "answer-scores"), 0.45)
    return _gate_row(gate).withColumn("mean_relevance", F.round("mean_relevance", 4))


# Request metrics --------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.request_log(star.table(spark, sf_dir, "events"))


@query
def request_counts(spark, sf_dir):
    return metrics.request_counts(_log(spark, sf_dir))


@query
def latency_buckets(spark, sf_dir):
    return metrics.latency_buckets(_log(spark, sf_dir), by=["status"])


def _rates(df: DataFrame) -> DataFrame:
    return df.select(_time("window_start"), _time("window_end"), "status", "requests", _six("per_second"))


def _quantiles(df: DataFrame) -> DataFrame:
    return df.select(_time("window_start"), _time("window_end"), "requests", _six("p50"), _six("p95"))


@query
def request_rate_5m(spark, sf_dir):
    return _rates(metrics.request_rate_5m(_log(spark, sf_dir)))


@query
def latency_quantiles_5m(spark, sf_dir):
    return _quantiles(metrics.latency_quantiles_5m(_log(spark, sf_dir)))


# Streams ----------------------------------------------------------------------------------


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = star.table(spark, sf_dir, "events").schema
    return star.request_log(read_log_stream(spark, sf_dir, schema, name_filter="events.parquet"))


def _drained(stream: DataFrame, name: str) -> DataFrame:
    """The table a stream leaves after everything there is has gone through it."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    append_table(stream, path, once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query
def stream_request_rate_5m(spark, sf_dir):
    """The windows that the watermark has closed, from the stream."""
    rates = metrics.request_rate_5m(_log_stream(spark, sf_dir), watermark=STREAM_DELAY)
    return _rates(_drained(rates, "rates"))


@query
def stream_latency_quantiles_5m(spark, sf_dir):
    found = metrics.latency_quantiles_5m(_log_stream(spark, sf_dir), watermark=STREAM_DELAY)
    return _quantiles(_drained(found, "quantiles"))


DRIFT_FROM = "2024-01-11"
DRIFT_COLUMNS = ["value", "event_type"]


def _window_drift(df: DataFrame) -> DataFrame:
    return df.select(_time("window_start"), "feature", "psi", "band")


@query
def psi_windows(spark, sf_dir):
    """Daily windows against the first ten days, in one batch."""
    log = _log(spark, sf_dir)
    old = F.col("ts") < F.lit(DRIFT_FROM).cast("timestamp")
    bins = _stored(reference_bins(log.filter(old), DRIFT_COLUMNS), "reference-bins")
    counts = window_bin_counts(log.filter(~old), bins, DRIFT_COLUMNS, "1 day")
    return _window_drift(window_psi(counts, bins))


@query
def stream_psi(spark, sf_dir):
    """The same from a stream: every day but the last, which is still open."""
    old = F.col("ts") < F.lit(DRIFT_FROM).cast("timestamp")
    path = scratch_path(spark, "psi")
    log = _log_stream(spark, sf_dir).filter(~old)
    psi_stream(
        log, _log(spark, sf_dir).filter(old), DRIFT_COLUMNS, path, "1 day", watermark=STREAM_DELAY, once=True
    ).awaitTermination()
    return _window_drift(spark.read.parquet(path))


@query
def stream_latest_per_key(spark, sf_dir):
    """The newest event per user and type, from a stream that brings them out of order, a file at a time."""
    events = star.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    path, out = scratch_path(spark, "shuffled-events"), scratch_path(spark, "newest")
    events.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    stream = read_log_stream(spark, path, events.schema, files_per_trigger=1)
    keys = ["user_id", "event_type"]
    newest_stream(stream, out, keys, "ts", ["event_id"], once=True).awaitTermination()
    return read_newest(spark, out, events.schema, keys, "ts", ["event_id"]).select(*keys, "event_id", "value")


@query
def stream_pit_join(spark, sf_dir):
    """Each click of a user with the user's newest view of the day before; of all days but the last, whose end has not come."""
    events = star.table(spark, sf_dir, "events")
    stream = read_log_stream(spark, sf_dir, events.schema, name_filter="events.parquet")
    time = F.col("ts").cast("timestamp").alias("event_timestamp")
    views = stream.filter("event_type = 'view'").select("user_id", time, F.col("event_id").alias("view_id"), F.col("value").alias("seen"))
    clicks = stream.filter("event_type = 'click'").select("user_id", time, "event_id")
    found = _drained(pit_join_stream(clicks, views, ["user_id"], ttl_days=1, delay=STREAM_DELAY), "clicks")
    last = events.agg(F.unix_micros(F.date_trunc("day", F.max("ts")).cast("timestamp"))).first()[0]
    return found.filter(F.unix_micros("event_timestamp") < last).select("event_id", "user_id", "view_id", "seen")


def _labels_in_time(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions by a rule, and sales that become known up to eleven days after their date."""
    date = F.col("date").cast("timestamp").alias("date")
    rows = _stored(_baseline_rows(spark, sf_dir).select(date, *SERIES, "yhat", "sales"), "labelled")
    late = (F.day("date") + F.col("store_nbr")) % 12
    actuals = rows.select("date", *SERIES, "sales", (F.col("date") + F.make_dt_interval(days=late.cast("int"))).alias("known_at"))
    return rows.drop("sales"), actuals


def _truth_rows(joined: DataFrame, predictions: DataFrame) -> DataFrame:
    """Those whose wait was over ten days before the newest prediction."""
    end = predictions.agg(F.unix_micros(F.max("date") - F.expr("INTERVAL 20 DAYS"))).first()[0]
    return joined.filter(F.unix_micros("date") < end).select(_day(), *SERIES, _six("yhat"), F.coalesce("y", F.lit(-1.0)).alias("y"))


@query
def delayed_truth_join(spark, sf_dir):
    """Predictions with the sales that became known within a week."""
    predictions, actuals = _labels_in_time(spark, sf_dir)
    return _truth_rows(delayed_truth(predictions, actuals), predictions)


@query
def stream_delayed_truth(spark, sf_dir):
    """The same join of two streams."""
    predictions, actuals = _labels_in_time(spark, sf_dir)
    streams = []
    for rows, name in ((predictions, "predictions"), (actuals, "actuals")):
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        streams.append(read_log_stream(spark, path, rows.schema))
    return _truth_rows(_drained(delayed_truth(*streams), "truth"), predictions)


@query
def stream_validate_requests(spark, sf_dir):
    """Orders as a stream of raw requests; counts of good and quarantined rows."""
    schema = star.table(spark, sf_dir, "orders").schema
    orders = read_log_stream(spark, sf_dir, schema, name_filter="orders.parquet")
    key = F.col("o_orderkey")
    raw = orders.select(
        key.cast("string").alias("request_id"),
        F.when(key % 11 == 0, "not-an-int").otherwise((key % 25).cast("string")).alias("store_nbr"),
        F.col("o_orderpriority").alias("family"),
        F.lit("0").alias("onpromotion"),
        F.when(key % 5 != 0, (key % 30 + 1).cast("string")).alias("days_ahead"),
    )
    ok_path, bad_path = scratch_path(spark, "good"), scratch_path(spark, "bad")
    validate_stream(raw, ok_path, bad_path, base_date=star.BASE_DATE, once=True).awaitTermination()
    good = spark.read.parquet(ok_path).groupBy("days_ahead").agg(F.count(F.lit(1)).alias("n"))
    bad = spark.read.parquet(bad_path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return good.select(F.concat(F.lit("horizon "), F.col("days_ahead")).alias("outcome"), "n").unionByName(
        bad.select(F.col("reason").alias("outcome"), "n")
    )


# Forecasts --------------------------------------------------------------------------------


@query
def clip_forecast(spark, sf_dir):
    customers = star.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", fn.clip_forecast(F.col("c_acctbal")).alias("yhat"))


@query
def align_columns(spark, sf_dir):
    """The columns a model expects: one absent, one dropped, the rest in its order."""
    customers = star.table(spark, sf_dir, "customer")
    return forecast.align_columns(customers, ["lag_7", "c_acctbal", "c_custkey"])


@query
def expand_horizon(spark, sf_dir):
    rows = forecast.expand_horizon(star.requests(spark, sf_dir), sales_hint=F.col("store_nbr") + 0.5)
    return rows.select(
        "request_id", "step", _day(), "store_nbr", "lag_7", "lag_14", "rolling_mean_7", "day_of_week", "days_to_holiday"
    )


def _forecast_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "request_id", "model_version", "prediction_id", "status", F.size("forecast").alias("steps"),
        _six(F.aggregate("forecast", F.lit(0.0), lambda total, x: total + x), "total"),
    )


@query
def forecast_requests_no_model(spark, sf_dir):
    return _forecast_rows(forecast.forecast_requests(star.requests(spark, sf_dir)))


@query
def forecast_requests_baseline(spark, sf_dir):
    made = forecast.forecast_requests(
        star.requests(spark, sf_dir), forecast.baseline_forecast, version="baseline", sales_hint=40.0
    )
    return _forecast_rows(made)


@query
def forecast_requests_history(spark, sf_dir):
    """A request for every day of every series, three days later, from the sales known by then."""
    sales = star.daily_sales(spark, sf_dir)
    table = spark.read.parquet(_feature_path(spark, sf_dir))
    asked = sales.select(
        F.concat_ws("|", F.date_format("date", "yyyy-MM-dd"), F.col("store_nbr").cast("string"), "family").alias("request_id"),
        *SERIES,
        F.lit(0).cast("long").alias("onpromotion"),
        F.date_add("date", 3).alias("base_date"),
        (1 + F.day("date") % 10).cast("int").alias("days_ahead"),
    )
    hinted = forecast.history_hints(asked, table)
    made = forecast.forecast_requests(hinted, forecast.baseline_forecast, version="history", sales_hint="sales_hint")
    return _forecast_rows(made).withColumn("total", F.round("total", 4))


def _baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.baseline_forecast(features.series_features(star.daily_sales(spark, sf_dir), exclude_current=True))


@query
def baseline_forecast(spark, sf_dir):
    return _baseline_rows(spark, sf_dir).select(_day(), *SERIES, _six("yhat"))


@query
def rmse(spark, sf_dir):
    found = forecast.rmse(_baseline_rows(spark, sf_dir), "sales", "yhat", ["store_nbr"])
    return found.select("store_nbr", "n", _six("rmse"))


@query
def rmsle(spark, sf_dir):
    found = forecast.rmsle(_baseline_rows(spark, sf_dir), "sales", "yhat", ["family"])
    return found.select("family", "n", _six("rmsle"))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of each prediction: the plain rule, and the sale a week before."""
    rows = _baseline_rows(spark, sf_dir)
    versions = F.array(
        F.struct(F.lit("rule").alias("model_version"), F.col("yhat").alias("yhat")),
        F.struct(F.lit("week_before").alias("model_version"), F.col("lag_7").alias("yhat")),
    )
    return rows.select("date", *SERIES, F.col("sales").alias("y"), F.inline(versions))


@query
def compare_models(spark, sf_dir):
    found = forecast.compare_models(_predictions(spark, sf_dir), "rule", "week_before", SERIES)
    return found.select(*SERIES, *[_six(c) for c in ("candidate_rmse", "production_rmse", "delta")])


@query
def must_beat_production(spark, sf_dir):
    found = forecast.compare_models(_predictions(spark, sf_dir), "rule", "week_before", ["family"])
    return forecast.must_beat_production(found).select("family", "promote")


@query
def ground_truth_join(spark, sf_dir):
    """Stored predictions joined to the actual values, error per month."""
    stored = _predictions(spark, sf_dir).filter(F.col("model_version") == "rule").drop("y")
    joined = forecast.ground_truth_join(stored, star.daily_sales(spark, sf_dir))
    found = forecast.rmse(joined.withColumn("month", F.date_format("date", "yyyy-MM")), by=["month"])
    return found.select("month", "n", _six("rmse"))


@query
def prediction_drift(spark, sf_dir):
    """Drift of stored predictions."""
    rows = _stored(_baseline_rows(spark, sf_dir).select("date", "yhat"), "predictions")
    return checks.prediction_drift(star.reference_window(rows), star.current_window(rows))


@query
def quality_checks(spark, sf_dir):
    rules = {**checks.SALES_RULES, "many_promotions": "onpromotion > 2", "small_sales": "sales <= 5"}
    return checks.quality_checks(star.daily_sales(spark, sf_dir), rules)


@query
def store_attributes(spark, sf_dir):
    nations = star.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("store_nbr"), F.col("n_name").alias("store"), F.col("n_regionkey").alias("region")
    )
    rows = checks.store_attributes(star.daily_sales(spark, sf_dir), nations)
    return rows.select(_day(), *SERIES, "store", "region", "sales")


# Models -----------------------------------------------------------------------------------

TRIAL_ROUNDS = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.2, "seed": 42}
#: Trees of one split over numbers with few values: small enough to be fitted in SQL as well.
STUMP_FEATURES = ("store_nbr", "month", "day_of_week")
STUMPS = {"maxIter": 8, "maxDepth": 1, "stepSize": 0.6, "seed": 42}
STUMP_PATIENCE = 2


def _split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Feature rows of all series, written once: the split and every round of boosting read them."""
    rows = features.demand_features(star.daily_sales(spark, sf_dir), exclude_current=True)
    rows = split.chrono_split(_stored(rows, "training-rows"))
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "valid")


def _stump_fit(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, PipelineModel, list[float]]:
    """(train, valid, model, losses) of stumps over the calendar and the store."""
    rows = features.calendar_features(star.daily_sales(spark, sf_dir))
    rows = split.chrono_split(_stored(rows, "calendar-rows"))
    train, valid = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "valid")
    model, losses = models.fit_stages(
        train, valid, STUMP_FEATURES, params=STUMPS, category=None, patience=STUMP_PATIENCE, stage_rounds=3
    )
    return train, valid, model, losses


@query
def train_regressor(spark, sf_dir):
    """Error of the fit and of the training mean in both parts of the split, and the rounds kept."""
    train, valid = _split_rows(spark, sf_dir)
    model = models.train_regressor(train, valid, params=TRIAL_ROUNDS)
    mean = train.agg(F.avg("sales")).first()[0]
    scored = forecast.score_table(model, train.unionByName(valid)).withColumn("mean", F.lit(mean))
    fit, plain = forecast.rmse(scored, "sales", "yhat", ["split"]), forecast.rmse(scored, "sales", "mean", ["split"])
    plain = plain.select("split", _six("rmse", "plain_rmse"))
    kept = F.lit(model.stages[-1].getNumTrees).alias("rounds")
    return fit.join(plain, "split").select("split", "n", _six("rmse"), "plain_rmse", kept)


@query
def train_stumps(spark, sf_dir):
    """Error in both parts of the split and rounds kept of a fit that its patience ends."""
    train, valid, model, _ = _stump_fit(spark, sf_dir)
    scored = forecast.score_table(model, train.unionByName(valid))
    kept = F.lit(model.stages[-1].getNumTrees).cast("long").alias("rounds")
    return forecast.rmse(scored, "sales", "yhat", ["split"]).select("split", "n", _six("rmse"), kept)


@query
def boosting_losses(spark, sf_dir):
    """Validation loss after each round, up to the one at which the patience is over."""
    _, _, model, losses = _stump_fit(spark, sf_dir)
    kept = model.stages[-1].getNumTrees
    rows = models.loss_rows(spark, {0: losses}).filter(F.col("round") <= kept + STUMP_PATIENCE)
    return rows.select(F.col("round").cast("long").alias("round"), _six("loss"), (F.col("round") <= kept).alias("kept"))


@query
def score_table(spark, sf_dir):
    """The forecast of every row of the later part."""
    _, valid, model, _ = _stump_fit(spark, sf_dir)
    return forecast.score_table(model, valid).select(_day(), *SERIES, "sales", _six("yhat"))


@query
def forecast_requests(spark, sf_dir):
    """Forecasts of a fitted model: per request the identifiers, the steps and their total."""
    _, _, model, _ = _stump_fit(spark, sf_dir)
    made = forecast.forecast_requests(star.requests(spark, sf_dir), model)
    return _forecast_rows(made).withColumn("total", F.round("total", 3))


@query
def score_tree_rows(spark, sf_dir):
    """How far two scores of every row of the later part lie apart: the model's, and that of joins with its exported nodes."""
    train, valid = _split_rows(spark, sf_dir)
    model = models.train_regressor(train, valid, params={**TRIAL_ROUNDS, "maxIter": 5})
    key = ["date", *SERIES]
    vectors = PipelineModel(model.stages[:-1]).transform(valid).select(*key, vector_to_array("features").alias("x"))
    nodes = F.broadcast(models.tree_rows(spark, model))
    every = F.explode(F.sequence(F.lit(0), F.lit(model.stages[-1].getNumTrees - 1))).alias("tree")
    at = vectors.select(*key, "x", every).join(nodes.filter("node = 0"), "tree").select(*key, "x", *nodes.columns)
    x = F.col("x")[F.col("feature")]
    goes_below = F.when(F.col("members").isNull(), x <= F.col("threshold")).otherwise(F.array_contains("members", x))
    for _ in range(TRIAL_ROUNDS["maxDepth"]):
        step = at.withColumn("next", F.when(F.col("feature").isNull(), F.col("node")).when(goes_below, F.col("below")).otherwise(F.col("above")))
        below = nodes.withColumnsRenamed({"tree": "next_tree", "node": "next"})
        at = step.select(*key, "x", F.col("tree").alias("next_tree"), "next").join(below, ["next_tree", "next"])
        at = at.withColumnsRenamed({"next_tree": "tree", "next": "node"})
    again = at.groupBy(*key).agg(F.greatest(F.sum(F.col("value") * F.col("weight")), F.lit(0.0)).alias("by_rows"))
    gap = F.abs(F.col("yhat") - F.col("by_rows"))
    return forecast.score_table(model, valid).join(again, key).select(_day(), *SERIES, _six(gap, "gap"))


@query
def search_params(spark, sf_dir):
    """Twenty trials by successive halving: one row for each trial of a rung, with its error and whether it went on."""
    train, valid = _split_rows(spark, sf_dir)
    _, trials = models.search_params(train, valid, rounds=(6, 12), patience=4, stage_rounds=4)
    return trials.select("trial", "rung", "maxDepth", _six("stepSize"), "rounds", "maxIter", _six("val_rmse"), "goes_on")


@query
def rung_survivors(spark, sf_dir):
    """The rule of a rung over a table of errors made of parts: sizes stand for rungs, prices for errors."""
    parts = star.table(spark, sf_dir, "part")
    rungs = parts.select(F.col("p_size").alias("rung"), F.col("p_partkey").alias("trial"), F.col("p_retailprice").alias("val_rmse"))
    return models.survivors(rungs)


@query
def load_model(spark, sf_dir):
    """Rows per part of the split, and how many score alike after the model was saved and loaded."""
    train, valid = _split_rows(spark, sf_dir)
    model, path = models.train_regressor(train, valid, params={**TRIAL_ROUNDS, "maxIter": 5}), scratch_path(spark, "model")
    models.save_model(model, path)
    scored = forecast.score_table(model, train.unionByName(valid)).withColumnRenamed("yhat", "first")
    both = forecast.score_table(models.load_model(spark, path), scored)
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") == F.col("yhat")).alias("same"))


@query
def early_stop(spark, sf_dir):
    """The patience rule over a table of losses: the order values of each customer, in turn."""
    orders = star.table(spark, sf_dir, "orders")
    turn = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    losses = orders.select(F.col("o_custkey").alias("trial"), turn.alias("round"), F.col("o_totalprice").alias("loss"))
    return models.kept_rounds(losses, patience=3)


@query
def best_trial(spark, sf_dir):
    """The pick of the least error, over a table of trials made of parts: one per brand and size."""
    parts = star.table(spark, sf_dir, "part")
    trials = parts.groupBy("p_brand", F.col("p_size").alias("trial")).agg(F.min("p_retailprice").alias("val_rmse"))
    return models.best_trial(trials.filter(F.col("val_rmse").isNotNull()).select("trial", "val_rmse"))
