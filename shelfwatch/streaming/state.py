"""Keyed state on streams: the newest row of each key, and features point in time."""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DataType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from ..operators.asof import latest_per_key
from .tables import batch_folder, checkpoint_beside

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_AT, _SIDE = "asof_at", "asof_side"
#: Rows that go to the state server in one message.
_ROWS_A_MESSAGE = 4_096
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Named state needs the RocksDB store; streams started from now on use it."""
    spark.conf.set(_PROVIDER, _ROCKSDB)


def _safe(columns: Sequence[str]) -> dict[str, str]:
    """Names for use inside a state processor, whatever the columns are called."""
    return {c: f"c{i}" for i, c in enumerate(columns)}


def _stamps(schema: StructType) -> dict[str, DataType]:
    return {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))}


def _numbered(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Times as microseconds, so that nothing depends on Python's time zone; ``keep`` stay as they are."""
    times = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in _stamps(df.schema) if c not in keep}
    return df.withColumns(times) if times else df


def _timed(df: DataFrame, schema: StructType) -> DataFrame:
    """The times of ``schema`` again, from microseconds."""
    times = {c: F.timestamp_micros(c).cast(kind) for c, kind in _stamps(schema).items() if c in df.columns}
    return df.withColumns(times) if times else df


def _rank(row: Sequence, places: Sequence[int]) -> tuple:
    """What two rows are compared by: as Spark compares them, a missing value before all others, not-a-number last."""
    values = (row[p] for p in places)
    return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in values)


class _Newest(StatefulProcessor):
    """Holds the newest row of a key and gives it out when it changes."""

    def __init__(self, schema: StructType, keys: Sequence[str], order: Sequence[str], expires: bool):
        self.schema, self.expires = schema, expires
        self.kept = [i for i, f in enumerate(schema.fields) if f.name not in keys]
        self.keys = [schema.names.index(k) for k in keys]
        names = [schema.names[i] for i in self.kept]
        self.order = [names.index(o) for o in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", StructType([self.schema.fields[i] for i in self.kept]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = tuple(self.newest.get()) if self.newest.exists() else None
        new = max((tuple(row[i] for i in self.kept) for row in rows), key=lambda r: _rank(r, self.order), default=None)
        if new is None or (held is not None and _rank(new, self.order) <= _rank(held, self.order)):
            return
        self.newest.update(new)
        if self.expires:
            self.handle.registerTimer(self._time(new))
        values = [None] * len(self.schema.fields)
        for at, value in [*zip(self.keys, key), *zip(self.kept, new)]:
            values[at] = value
        yield Row(*self.schema.names)(*values)

    def _time(self, row: tuple) -> int:
        return -(-row[self.order[0]] // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # A key that has a newer row by now has a later timer too.
        if self.newest.exists() and self._time(tuple(self.newest.get())) <= expiredTimerInfo.getExpiryTimeInMs():
            self.newest.clear()
        yield from ()

    def close(self) -> None:
        pass


def newest_changes(
    stream: DataFrame, keys: Sequence[str], ts: str, tie_cols: Sequence[str] = (), expire_hours: float | None = None
) -> DataFrame:
    """Each row of a stream that became the newest of its key, with the stream's columns.

    Newest is by ``ts``, then ``tie_cols``, then all other columns, as in ``latest_per_key``; of a
    batch a key gives one row at most. A row that comes late, behind a newer one of its key,
    changes nothing. Rows without a time are left out; a null key is a key.

    State is one row a key. Without ``expire_hours`` there is no watermark, and a slow key loses no
    row. With it a key whose newest row lies so many hours behind the newest of the stream leaves
    the state, and rows that come in further behind are dropped.
    """
    keep_state_on_disk(stream.sparkSession)
    name, names = _safe(stream.columns), stream.columns
    others = [c for c in names if c not in keys]
    order = [name[c] for c in (ts, *tie_cols, *[c for c in others if c != ts and c not in tie_cols])]
    stream, keys, ts = stream.toDF(*name.values()), [name[k] for k in keys], name[ts]
    timed = stream.filter(F.col(ts).isNotNull())
    if expire_hours is not None:
        timed = timed.withColumn(_AT, F.col(ts).cast("timestamp")).withWatermark(_AT, f"{int(expire_hours * 3600)} seconds")
    numbers = _numbered(stream).schema
    found = _numbered(timed, [_AT]).groupBy(*keys).transformWithState(
        _Newest(numbers, keys, order, expire_hours is not None),
        outputStructType=numbers,
        outputMode="Update",
        timeMode="None" if expire_hours is None else "EventTime",
    )
    return _timed(found, stream.schema).toDF(*names)


def newest_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    tie_cols: Sequence[str] = (),
    expire_hours: float | None = None,
    checkpoint: str | None = None,
    once: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Write the changes of ``newest_changes``, one folder a batch; ``read_newest`` reads the present rows.

    The checkpoint stands beside ``path`` unless one is named, and a restart goes on from it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    writer = (
        newest_changes(stream, keys, ts, tie_cols, expire_hours)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or checkpoint_beside(path))
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def read_newest(
    spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str], ts: str, tie_cols: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key, from the changes below ``path``."""
    changes = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    return latest_per_key(changes, keys, ts, tie_cols)


def _append(state, rows: list[tuple]) -> None:
    """Adds rows to a list state, a bounded number in one message."""
    for a in range(0, len(rows), _ROWS_A_MESSAGE):
        state.appendList(rows[a : a + _ROWS_A_MESSAGE])


def _put(state, rows: list[tuple]) -> None:
    """The same in place of what a list state holds."""
    if not rows:
        state.clear()
        return
    state.put(rows[:_ROWS_A_MESSAGE])
    _append(state, rows[_ROWS_A_MESSAGE:])


class _AsOf(StatefulProcessor):
    """Holds the features of a key that may still answer a request, and the requests that wait.

    Both are lists that are written and read as a whole, and a key has one timer, so a batch costs
    a few calls of the state server for each key, not for each row. Rows are (keys..., time, micros, side, request values..., feature values...).
    """

    def __init__(self, n_keys: int, asked: StructType, known: StructType, order: Sequence[int], ttl_us: int, out: StructType):
        self.names = out.names
        self.asked_type, self.known_type, self.order, self.ttl_us = asked, known, list(order), ttl_us
        self.at, self.side, first = n_keys + 1, n_keys + 2, n_keys + 3
        self.asked_at = slice(first, first + len(asked.fields))
        self.known_at = slice(first + len(asked.fields), first + len(asked.fields) + len(known.fields))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        at = StructField("at", LongType())
        self.known = handle.getListState("known", StructType([at, *self.known_type.fields]))
        self.asked = handle.getListState("asked", StructType([at, *self.asked_type.fields]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict[int, tuple] = {}
        waiting = []
        for row in rows:
            row = tuple(row)
            at = row[self.at]
            if row[self.side]:
                waiting.append((at, *row[self.asked_at]))
            else:
                self._keep_best(best, at, row[self.known_at])
        _append(self.known, [(at, *new) for at, new in best.items()])
        _append(self.asked, waiting)
        # Nothing at or before a request can come once the watermark has reached it.
        self._wake(min((r[0] for r in waiting), default=max(best, default=0)), bool(waiting))
        yield from ()

    def _keep_best(self, best: dict[int, tuple], at: int, new: tuple) -> None:
        if at not in best or _rank(new, self.order) > _rank(best[at], self.order):
            best[at] = new

    def _wake(self, at: int, asked: bool) -> None:
        """One timer a key: at its first request that waits, or to forget features where none does."""
        due, timers = -(-at // 1000), list(self.handle.listTimers())
        if timers and (not asked or min(timers) <= due):
            return
        for later in timers:
            self.handle.deleteTimer(later)
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        asked = [tuple(r) for r in self.asked.get()]
        known = [tuple(r) for r in self.known.get()]
        best: dict[int, tuple] = {}
        for at, *new in known:
            self._keep_best(best, at, tuple(new))
        times = sorted(best)
        nothing, answer = (None,) * len(self.known_type.fields), Row(*self.names)
        left = []
        for row in asked:
            at, *values = row
            if at > now:
                left.append(row)
                continue
            found = bisect.bisect_right(times, at) - 1
            seen = found >= 0 and times[found] >= at - self.ttl_us
            yield answer(*key, at, *values, *(best[times[found]] if seen else nothing))
        # Later requests lie beyond the watermark: of what is before it they can see the newest only.
        kept = times[max(bisect.bisect_right(times, now) - 1, 0) :]
        if len(left) < len(asked):
            _put(self.asked, left)
        if len(kept) < len(known):
            _put(self.known, [(at, *best[at]) for at in kept])
        ahead = min((r[0] for r in left), default=kept[-1] if kept and kept[-1] > now else None)
        if ahead is not None:
            self.handle.registerTimer(-(-ahead // 1000))

    def close(self) -> None:
        pass


def pit_join_stream(
    requests: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    time_col: str = "event_timestamp",
    ttl_days: int = 3650,
    tie_cols: Sequence[str] = (),
    delay: str = "10 minutes",
) -> DataFrame:
    """``pit_join`` of a stream of requests with a stream of features that grows.

    A request is answered once the watermark, ``delay`` behind the slower stream, has reached its time: no feature at or
    before it can come any more, so the answer is that of the batch join over all rows that
    were not later than the delay. Requests without a key or time are answered at once, with
    nulls; a request or feature later than the delay is dropped, as Spark drops late rows.

    State is cut by the watermark: per key the features since, the newest one before it, and
    the requests that wait. ``ttl_days`` bounds the age of an answer. All rows of one key go
    through one task, a batch at a time; ``files_per_trigger`` of the source bounds a batch.
    """
    keep_state_on_disk(requests.sparkSession)
    values = [c for c in features.columns if c not in keys and c != time_col]
    asked = [c for c in requests.columns if c not in keys and c != time_col]
    clash = [c for c in values if c in asked]
    if clash:
        raise ValueError(f"columns are in both frames: {clash}")
    names = [*requests.columns, *values]
    name = _safe(names)
    requests, features = (df.select(*[F.col(c).alias(name[c]) for c in df.columns]) for df in (requests, features))
    keys, values, asked, tie_cols = ([name[c] for c in cs] for cs in (keys, values, asked, tie_cols))
    time_col = name[time_col]
    whole = StructType([*requests.schema.fields, *[features.schema[c] for c in values]])
    requests, features = _numbered(requests, [time_col, *keys]), _numbered(features, [time_col, *keys])
    order = [values.index(c) for c in (*tie_cols, *[c for c in values if c not in tie_cols])]

    def side(df: DataFrame, number: int) -> DataFrame:
        timed = df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, delay)

        def own(c: str, schema: StructType) -> Column:
            return F.col(c) if c in df.columns else F.lit(None).cast(schema[c].dataType).alias(c)

        return timed.select(
            *keys, time_col, F.unix_micros(time_col).alias(_AT), F.lit(number).alias(_SIDE),
            *[own(c, requests.schema) for c in asked], *[own(c, features.schema) for c in values],
        )

    present = F.col(time_col).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    both = side(features.filter(present), 0).union(side(requests.filter(present), 1))
    asked_type, known_type = StructType([requests.schema[c] for c in asked]), StructType([features.schema[c] for c in values])
    out = StructType([*[requests.schema[k] for k in keys], StructField(_AT, LongType()), *asked_type.fields, *known_type.fields])
    answered = both.groupBy(*keys).transformWithState(
        _AsOf(len(keys), asked_type, known_type, order, int(ttl_days) * 86_400_000_000, out),
        outputStructType=out, outputMode="Append", timeMode="EventTime",
    )
    time = F.timestamp_micros(_AT).cast(requests.schema[time_col].dataType).alias(time_col)
    columns = [*requests.columns, *values]
    answered = answered.select(*[time if c == time_col else F.col(c) for c in columns])
    unknown = requests.filter(~present).withColumns({c: F.lit(None).cast(features.schema[c].dataType) for c in values})
    payload = StructType([f for f in whole.fields if f.name not in (time_col, *keys)])
    return _timed(answered.unionByName(unknown.select(*columns)), payload).toDF(*names)
