import datetime as dt
import types

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

import random

from shelfwatch.operators import asof, drift, metrics
from shelfwatch.streaming import append_table, delayed_truth, newest_stream, pit_join_stream, psi_stream, read_log_stream
from shelfwatch.streaming import read_newest, reference_bins, validate_stream, window_bin_counts, window_psi
from shelfwatch.streaming.state import _AsOf

SCHEMA = "ts timestamp, status string, latency_s double"
T0 = dt.datetime(2024, 1, 1, 12, 0)


def write_log(spark, path, data):
    spark.createDataFrame([(T0 + dt.timedelta(seconds=s), st, lat) for s, st, lat in data], SCHEMA).coalesce(1).write.mode(
        "append"
    ).parquet(str(path))


def drain(spark, stream, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    append_table(stream, out, checkpoint, once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def test_stream_rate_equals_batch_and_drops_late_rows(spark, tmp_path):
    log = tmp_path / "log"
    first = [(10 * i, "error" if i % 4 == 0 else "success", 0.02 * i) for i in range(100)]
    write_log(spark, log, first)
    rates = lambda: metrics.request_rate_5m(read_log_stream(spark, str(log), SCHEMA), watermark="2 minutes")
    drain(spark, rates(), tmp_path)
    # An hour on; the second row is far behind the watermark, the third on a window's edge.
    write_log(spark, log, [(3600, "success", 0.1)])
    drain(spark, rates(), tmp_path)
    write_log(spark, log, [(15, "late", 0.1), (7200, "success", 0.1)])
    got = drain(spark, rates(), tmp_path).collect()
    batch = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), st, lat) for s, st, lat in first + [(3600, "success", 0.1)]], SCHEMA)
    expected = {tuple(r) for r in metrics.request_rate_5m(batch).collect()}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_stream_quantiles_equal_batch(spark, tmp_path):
    log = tmp_path / "log"
    data = [(7 * i, "success", (i % 50) / 9) for i in range(200)]
    write_log(spark, log, data + [(86400, "success", 0.1)])
    stream = metrics.latency_quantiles_5m(read_log_stream(spark, str(log), SCHEMA), slide="5 minutes", watermark="1 minute")
    got = {tuple(r) for r in drain(spark, stream, tmp_path).collect()}
    batch = spark.read.schema(SCHEMA).parquet(str(log)).filter(F.col("ts") < F.lit(T0 + dt.timedelta(hours=2)))
    assert got == {tuple(r) for r in metrics.latency_quantiles_5m(batch, slide="5 minutes").collect()}


def sample(spark, n, shift=0.0, offset=0):
    return spark.range(n).select(
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 7 + offset)).alias("ts"),
        ((F.col("id") * 37) % 101 + shift).alias("value"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 50 == 1, "rare").otherwise("b").alias("kind"),
    )


def test_psi_stream_equals_the_report_of_each_window(spark, tmp_path):
    ref = sample(spark, 500)
    current = sample(spark, 600, 10.0).withColumn("kind", F.when(F.col("kind") == "a", "new").otherwise(F.col("kind")))
    closing = sample(spark, 1, 0.0, 86400)
    # The closing row comes last, in a file of its own: read earlier, it would make the others late.
    current.repartition(3).write.parquet(str(tmp_path / "log"))
    closing.write.mode("append").parquet(str(tmp_path / "log"))
    stream = read_log_stream(spark, str(tmp_path / "log"), "ts timestamp, value double, kind string", files_per_trigger=1)
    out = str(tmp_path / "psi")
    psi_stream(stream, ref, ["value", "kind"], out, "30 minutes", watermark="12 hours", once=True).awaitTermination()
    got = {(r["window_start"], r["feature"]): r["psi"] for r in spark.read.parquet(out).collect()}
    expected = {}
    for start in sorted({k[0] for k in got}):
        rows = current.filter((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(start + dt.timedelta(minutes=30))))
        for r in drift.psi_report(ref, rows, ["value", "kind"]).collect():
            expected[(start, r["feature"])] = r["psi"]
    assert len(got) == 6 and got == expected
    bins = reference_bins(ref, ["value", "kind"])
    twin = window_psi(window_bin_counts(current, bins, ["value", "kind"], "30 minutes"), bins)
    assert {(r["window_start"], r["feature"]): r["psi"] for r in twin.collect()} == got


def test_validate_stream(spark, tmp_path):
    schema = "request_id string, store_nbr string, days_ahead string"
    spark.createDataFrame([("a", "1", None), ("b", "x", "3")], schema).write.parquet(str(tmp_path / "in"))
    ok, bad, checkpoint = (str(tmp_path / n) for n in ("ok", "bad", "checkpoint"))
    run = lambda: validate_stream(
        read_log_stream(spark, str(tmp_path / "in"), schema), ok, bad, checkpoint, base_date="2020-01-01", once=True
    ).awaitTermination()
    run()
    run()
    spark.createDataFrame([("c", None, "4")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    good = {r["request_id"]: (r["store_nbr"], r["days_ahead"]) for r in spark.read.parquet(ok).collect()}
    assert good == {"a": (1, 30), "c": (1, 4)}
    assert [r["reason"] for r in spark.read.parquet(bad).collect()] == ["invalid: store_nbr"]


def test_a_restart_without_a_named_checkpoint_loses_nothing(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "rows")
    write_log(spark, log, [(i, "success", 0.1) for i in range(10)])
    append_table(read_log_stream(spark, log, SCHEMA), out, once=True).awaitTermination()
    write_log(spark, log, [(i, "success", 0.1) for i in range(50)])
    append_table(read_log_stream(spark, log, SCHEMA), out, once=True).awaitTermination()
    assert spark.read.schema(SCHEMA).parquet(out).count() == 60


def test_requests_and_drift_survive_a_restart(spark, tmp_path):
    asked, ok, bad = str(tmp_path / "asked"), str(tmp_path / "ok"), str(tmp_path / "bad")
    schema = "request_id string, store_nbr long, days_ahead int"
    for n in (10, 50):
        spark.range(n).selectExpr("cast(id as string) request_id", "id store_nbr", "5000 days_ahead").coalesce(1).write.mode(
            "append"
        ).parquet(asked)
        validate_stream(read_log_stream(spark, asked, schema), ok, bad, once=True).awaitTermination()
    assert spark.read.parquet(ok).count() == 60

    log, out = str(tmp_path / "values"), str(tmp_path / "psi")
    windows = []
    for shift in (0, 86400):
        sample(spark, 600, 10.0, shift).coalesce(1).write.mode("append").parquet(log)
        stream = read_log_stream(spark, log, "ts timestamp, value double, kind string")
        psi_stream(stream, sample(spark, 500), ["value", "kind"], out, watermark="1 minute", once=True).awaitTermination()
        windows.append(spark.read.parquet(out).select("window_start", "feature").distinct().count())
    assert windows[1] > windows[0] + 10


def put(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


NEWEST = "feature string, kind string, scored_on timestamp, psi double, note string, _class long"


def test_newest_of_late_rows_ties_and_restarts(spark, tmp_path):
    draw = random.Random(3)
    log, out = str(tmp_path / "scores"), str(tmp_path / "newest")
    data = [
        (draw.choice(["a", "b", None]), draw.choice("xy"), minutes(draw.randrange(30)), draw.choice([None, 0.1, 0.2]), draw.choice([None, "n", "m"]), draw.randrange(2))
        for _ in range(120)
    ]
    data += [("a", "x", None, 9.0, "no time", 1)]
    for part in range(4):
        put(spark, log, data[part * 30 : part * 30 + 31], NEWEST)
        stream = read_log_stream(spark, log, NEWEST, files_per_trigger=1)
        newest_stream(stream, out, ["feature", "kind"], "scored_on", ["psi"], once=True).awaitTermination()
    got = {tuple(r) for r in read_newest(spark, out, NEWEST, ["feature", "kind"], "scored_on", ["psi"]).collect()}
    batch = asof.latest_per_key(spark.read.schema(NEWEST).parquet(log), ["feature", "kind"], "scored_on", ["psi"])
    assert got == {tuple(r) for r in batch.collect()} and len(got) == 6
    changes = spark.read.schema(NEWEST).option("recursiveFileLookup", True).parquet(out)
    assert len(got) <= changes.count() < 60


def test_newest_with_expiry(spark, tmp_path):
    log, out = str(tmp_path / "scores"), str(tmp_path / "newest")
    # An hour behind the newest a key leaves; what comes in still later is dropped, a new row of the key is not.
    for n, rows in enumerate(
        (
            [("a", "x", minutes(1), 0.5, "n", 1), ("b", "x", minutes(70), 0.1, "n", 1)],
            [("a", "x", minutes(2), 9.0, "late", 1)],
            [("a", "x", minutes(50), 0.7, "n", 1)],
        )
    ):
        put(spark, log, rows, NEWEST)
        stream = read_log_stream(spark, log, NEWEST)
        newest_stream(stream, out, ["feature", "kind"], "scored_on", expire_hours=1.0, once=True).awaitTermination()
    found = read_newest(spark, out, NEWEST, ["feature", "kind"], "scored_on").collect()
    assert {(r["feature"], r["psi"]) for r in found} == {("a", 0.7), ("b", 0.1)}
    changes = spark.read.schema(NEWEST).option("recursiveFileLookup", True).parquet(out).collect()
    assert "late" not in {r["note"] for r in changes}


ASKED = "k string, n long, event_timestamp timestamp, request string"
KNOWN = "k string, n long, event_timestamp timestamp, v double, w string"


def test_point_in_time_stream_equals_batch(spark, tmp_path):
    draw = random.Random(9)
    asked_log, known_log = str(tmp_path / "asked"), str(tmp_path / "known")
    out = str(tmp_path / "out")
    asked, known = [], []
    for part in range(3):
        # Rows come up to 20 minutes out of order; the delay is half an hour.
        def at():
            return minutes(part * 120 + draw.randrange(120) - 20 * draw.randrange(2)) + dt.timedelta(microseconds=draw.randrange(1000))

        own_asked = [(draw.choice("ab"), draw.randrange(2), at(), f"{part}-{i}") for i in range(40)]
        own_asked += [(None, 1, at(), f"{part}-null key"), ("a", 1, None, f"{part}-null time")]
        own_known = [(draw.choice("abc"), draw.randrange(2), at(), draw.choice([None, 1.0, 2.0]), draw.choice([None, "p", "q"])) for _ in range(25)]
        own_known += [(*own_known[0][:3], 3.0, None), ("a", None, at(), 1.0, "p"), (*own_asked[0][:3], 7.0, "same time")]
        put(spark, asked_log, own_asked, ASKED)
        put(spark, known_log, own_known, KNOWN)
        asked += own_asked
        known += own_known
        if part == 2:
            put(spark, asked_log, [("z", 0, minutes(2000), "closing")], ASKED)
            put(spark, known_log, [("z", 0, minutes(2000), 0.0, "closing")], KNOWN)
        stream = pit_join_stream(
            read_log_stream(spark, asked_log, ASKED), read_log_stream(spark, known_log, KNOWN), ["k", "n"], ttl_days=1, delay="30 minutes"
        )
        append_table(stream, out, once=True).awaitTermination()
    got = sorted(map(str, (tuple(r) for r in spark.read.schema(stream.schema).parquet(out).filter("request <> 'closing'").collect())))
    batch = asof.pit_join(spark.createDataFrame(asked, ASKED), spark.createDataFrame(known, KNOWN), ["k", "n"], ttl_days=1)
    assert stream.columns == batch.columns
    assert got == sorted(map(str, (tuple(r) for r in batch.collect())))


def test_point_in_time_stream_forgets_old_features(spark, tmp_path):
    asked_log, known_log, out = (str(tmp_path / n) for n in ("asked", "known", "out"))
    put(spark, known_log, [("a", 0, minutes(0), 1.0, "old"), ("z", 0, minutes(3000), 0.0, "end")], KNOWN)
    put(spark, asked_log, [("a", 0, minutes(1445), "too old"), ("a", 0, minutes(1435), "in time"), ("z", 0, minutes(3000), "end")], ASKED)
    stream = pit_join_stream(read_log_stream(spark, asked_log, ASKED), read_log_stream(spark, known_log, KNOWN), ["k", "n"], ttl_days=1)
    append_table(stream, out, once=True).awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(out).collect()
    assert {r["request"]: r["w"] for r in rows} == {"too old": None, "in time": "old"}


class FakeState:
    """A state server of one key that counts its calls."""

    def __init__(self):
        self.calls, self.timers, self.lists = 0, set(), {}

    def called(self, result=None):
        self.calls += 1
        return result

    def getListState(self, name, schema):
        held = self.lists.setdefault(name, [])
        state = types.SimpleNamespace()
        state.get = lambda: iter(self.called(list(held)))
        state.appendList = lambda rows: self.called(held.extend(rows))
        state.put = lambda rows: self.called(held.__setitem__(slice(None), rows))
        state.clear = lambda: self.called(held.clear())
        return state

    def registerTimer(self, at):
        self.called(self.timers.add(at))

    def deleteTimer(self, at):
        self.called(self.timers.discard(at))

    def listTimers(self):
        return iter(self.called(sorted(self.timers)))


def test_point_in_time_state_calls_do_not_grow_with_the_rows_of_a_key():
    long = lambda *names: StructType([StructField(n, LongType()) for n in names])
    server, ms = FakeState(), 1000
    joined = _AsOf(1, long("r"), long("v"), [0], 86_400_000_000, long("k", "at", "r", "v"))
    joined.init(server)

    def expire(watermark):
        out = []
        for due in sorted(t for t in server.timers if t <= watermark):
            out += joined.handleExpiredTimer(
                (1,), types.SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark),
                types.SimpleNamespace(getExpiryTimeInMs=lambda: due),
            )
            server.timers.discard(due)
        return [tuple(r) for r in out]

    features = [(1, None, 2 * i * ms, 0, None, i) for i in range(500)]
    requests = [(1, None, (2 * i + 1) * ms, 1, i, None) for i in range(500)]
    # The second half comes first, so its timer has to move.
    for rows in (features[250:] + requests[250:], features[:250] + requests[:250]):
        assert list(joined.handleInputRows((1,), iter(rows), None)) == []
    assert server.timers == {1}
    got = expire(600)
    assert sorted(got) == [(1, (2 * i + 1) * ms, i, i) for i in range(300)]
    assert server.timers == {601} and len(server.lists["known"]) == 200 and len(server.lists["asked"]) == 200
    got = expire(5000)
    assert sorted(got) == [(1, (2 * i + 1) * ms, i, i) for i in range(300, 500)]
    assert server.timers == set() and server.lists == {"known": [(998 * ms, 499)], "asked": []}
    # Features alone are forgotten too.
    list(joined.handleInputRows((1,), iter([(1, None, t * ms, 0, None, t) for t in (6000, 7000)]), None))
    assert expire(8000) == [] and server.timers == set() and server.lists["known"] == [(7000 * ms, 7000)]
    assert server.calls < 40


def test_delayed_truth_stream_equals_batch(spark, tmp_path):
    made = "store_nbr long, family string, date timestamp, yhat double"
    truth = "store_nbr long, family string, date timestamp, known_at timestamp, sales double"
    days = lambda n: T0 + dt.timedelta(days=n)
    predictions = [(s, "F", days(d), s + d / 10) for d in range(30) for s in (1, 2)] + [(None, "F", days(3), 0.0)]
    actuals = [(s, "F", days(d), days(d + (d * s) % 11), float(d)) for d in range(30) for s in (1, 2) if d % 4]
    actuals += [(1, "F", days(8), days(7), 5.0), (1, "other", days(8), days(8), 5.0), (None, "F", days(3), days(3), 5.0)]
    asked, known, out = (str(tmp_path / n) for n in ("asked", "known", "out"))

    def join():
        return delayed_truth(read_log_stream(spark, asked, made), read_log_stream(spark, known, truth))

    # Labels come in the order in which they became known, in three runs with a restart between them.
    for first, last in ((0, 10), (10, 20), (20, 60)):
        put(spark, asked, [p for p in predictions if first <= (p[2] - T0).days < last], made)
        labels = [a for a in actuals if first <= (a[3] - T0).days < last]
        closing = [(9, "closing", days(200), days(200), 0.0)] if last == 60 else []
        put(spark, known, labels + closing, truth)
        if closing:
            put(spark, asked, [(9, "closing", days(200), 0.0)], made)
        append_table(join(), out, once=True).awaitTermination()
    got = spark.read.schema(join().schema).parquet(out).filter("family <> 'closing'").collect()
    batch = delayed_truth(spark.createDataFrame(predictions, made), spark.createDataFrame(actuals, truth)).collect()
    key = lambda r: (str(r["store_nbr"]), r["date"])
    assert sorted(map(tuple, sorted(got, key=key)), key=str) == sorted(map(tuple, sorted(batch, key=key)), key=str)
    assert len(got) == len(predictions) and {r["y"] is None for r in got} == {True, False}
