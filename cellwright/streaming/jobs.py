"""Streams: ingest, windows, change-of-value, current state, loss checks.

State that ends has a watermark (windows). State of a sensor does not end: change-of-value and current
state keep one value for each, in hash buckets. Late rows are written to the day of their event."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import parse_payload, topic_patterns
from ..operators.change import passes, threshold
from ..operators.query import period_us
from ..sources.commits import Files
from ..sources.keyed import KeyedTable
from ..sources.sinks import with_event_date


def ingest(stream: DataFrame, path: str, checkpoint: str, patterns: Sequence[dict], fields: dict[str, str], ts_format: str = "iso", partitions: Sequence[str] = ("site_id", "date"), codec: str = "snappy", every: str | None = None, drop_points: Sequence[str] = ()) -> StreamingQuery:
    """Messages (topic, payload) parsed, filtered and appended by event date, each exactly once: offsets
    move on only after the write. every is the flush interval; without it what is there is read once."""
    rows = topic_patterns(parse_payload(stream, "payload", fields, ts_format=ts_format, on_bad="drop"), "topic", patterns)
    if drop_points:
        rows = rows.where(~F.coalesce(F.col("point_name").isin(*drop_points), F.lit(False)))
    rows = with_event_date(rows)
    cols = [c for c in partitions if c in rows.columns]
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).option("compression", codec).partitionBy(*cols)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def tumbling(stream: DataFrame, ts: str, width: str, by: Sequence[str], aggs: Sequence, late: str = "10 minutes") -> DataFrame:
    """aggs of fixed windows of event time, each given out once when its time is over."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *by).agg(*aggs)


def coalesce_stream(stream: DataFrame, ts: str, width: str, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """The last message of each key and window, at the window's first time of that key."""
    out = tumbling(stream, ts, width, keys, [F.min(ts).alias("first_ts"), F.max_by(F.struct(*cols), F.struct(*order)).alias("row")], late)
    return out.select(*keys, F.col("first_ts").alias(ts), "row.*")


def message_rate(stream: DataFrame, ts: str, by: Sequence[str] = (), late: str = "10 seconds") -> DataFrame:
    """Messages of each second that has any, given out when the second is over."""
    return tumbling(stream, ts, "1 second", by, [F.count("*").alias("n")], late)


def smoothed_rate(stream: DataFrame, ts: str, by: Sequence[str], late: str = "10 seconds", alpha: float = 0.2) -> DataFrame:
    """(by, us, n, rate): message_rate with its moving average, which starts at 0; a second without messages leaves it as it is.
    Of a key its average and the counts of seconds that are not over yet are state; a timer closes these."""
    rows = stream.withWatermark(ts, late).where(F.col(ts).isNotNull())
    rows = rows.select(*by, ts, F.expr(f"unix_micros({ts}) div 1000000").alias("_second"))
    types = dict(rows.dtypes)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rate, seconds, counts = state.get if state.exists else (0.0, [], [])
        open_ = Counter(dict(zip(map(int, seconds), map(int, counts))))
        if not state.hasTimedOut:
            for pdf in batches:
                open_.update(Counter(pdf["_second"].tolist()))
        now = state.getCurrentWatermarkMs()
        out = []
        for second in sorted(s for s in open_ if (s + 1) * 1000 <= now):
            n = open_.pop(second)
            rate = rate * (1 - alpha) + n * alpha
            out.append((*key, second * 1_000_000, n, rate))
        state.update((rate, sorted(open_), [open_[s] for s in sorted(open_)]))
        if open_:
            state.setTimeoutTimestamp(max((min(open_) + 1) * 1000, now + 1))
        yield pd.DataFrame(out, columns=[*by, "us", "n", "rate"])

    schema = ", ".join(f"`{c}` {types[c]}" for c in by) + ", us long, n long, rate double"
    kept = "rate double, seconds array<long>, counts array<long>"
    return rows.groupBy(*by).applyInPandasWithState(run, schema, kept, "append", "EventTimeTimeout")


#: Hash buckets of sensors, of which each is one row of state and one call for each micro-batch.
BUCKETS = 1024


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> tuple[DataFrame, list[str]]:
    """rows with _bucket, and the columns by which a sensor is told from the others of its bucket: keys as text, so that nulls
    and whole numbers come whole into Python."""
    types = dict(rows.dtypes)
    names = [k if types[k] == "string" else f"_text_{k}" for k in keys]
    rows = rows.withColumns({n: F.col(k).cast("string") for k, n in zip(keys, names) if n != k})
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")), names


def counted_cov_stream(stream: DataFrame, keys: Sequence[str], ts: str, value: str, hold: str, late: str = "10 minutes", rules: Sequence[tuple[str, float]] = (), default: float = 0.5, kind: str = "absolute", buckets: int = BUCKETS) -> DataFrame:
    """Change-of-value of a stream with counts: (keys, us, value, held, timed).

    A reading that differs enough from the last one that went out goes out, as does one that comes hold after that; held is how many
    readings were held back since. A sensor that is silent for hold once its event time is sure to be over (late) gets a row
    of a timer: its last reading, its time and how many are held, if any are; timed is true. State is five numbers for
    each sensor. Rows that come later than late are dropped. Sensors are kept by hash buckets, as a call for each costs far more
    than its readings: a bucket that a micro-batch touches is read and written whole, and its readings of one micro-batch, three
    numbers each and the keys, are held to bring them in order. A checkpoint belongs to its number of buckets. Keys are
    strings, numbers, booleans or dates."""
    hold_us = period_us(hold)
    rows = stream.withWatermark(ts, late).where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    types = dict(rows.dtypes)
    rows, names = _bucketed(rows, keys, buckets)
    rows = rows.select("_bucket", *names, ts, F.unix_micros(ts).alias("_us"), F.col(value).cast("double").alias("_value"), threshold(keys[-1], rules, default).alias("_limit"))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        *marks, last, last_us, seen, seen_us, held = state.get if state.exists else ([],) * (len(names) + 5)
        sensors = {m: list(x) for m, x in zip(zip(*marks), zip(last, last_us, seen, seen_us, held))}
        now = state.getCurrentWatermarkMs()
        out = []
        for mark, x in sensors.items():
            if x[4] and now * 1000 >= x[3] + hold_us:  # also if readings came with the timer
                out.append((*mark, x[3], x[2], x[4], True))
                x[0], x[1], x[4] = x[2], x[3], 0
        parts = [] if state.hasTimedOut else list(batches)
        if parts:
            pdf = pd.concat(parts).sort_values("_us", kind="stable")
            columns = [pdf[c].tolist() for c in ("_us", "_value", "_limit")]
            for mark, t, v, limit in zip(zip(*[pdf[n].tolist() for n in names]), *columns, strict=True):
                x = sensors.get(mark)
                if x is None:
                    x = sensors[mark] = [None, None, None, None, 0]
                if passes(x[0], x[1], v, t, limit, kind, False, hold_us):
                    out.append((*mark, t, v, x[4], False))
                    x[0], x[1], x[4] = v, t, 0
                else:
                    x[4] += 1
                x[2], x[3] = v, t
        if out:
            yield pd.DataFrame(out, columns=[*names, "us", "value", "held", "timed"])
        if sensors:
            state.update((*map(list, zip(*sensors)), *map(list, zip(*sensors.values()))))
        silent = [(x[3] + hold_us) // 1000 for x in sensors.values() if x[4]]
        if silent:
            state.setTimeoutTimestamp(max(min(silent), now + 1))

    schema = ", ".join(f"`{n}` string" for n in names) + ", us long, value double, held long, timed boolean"
    kept = ", ".join(f"key{n} array<string>" for n in range(len(names))) + ", last array<double>, last_us array<long>, seen array<double>, seen_us array<long>, held array<long>"
    out = rows.groupBy("_bucket").applyInPandasWithState(run, schema, kept, "append", "EventTimeTimeout")
    return out.select(*[F.col(n).cast(types[k]).alias(k) for k, n in zip(keys, names)], "us", "value", "held", "timed")


def route(stream: DataFrame, sinks: dict[str, Column], checkpoint: str, codec: str = "zstd") -> StreamingQuery:
    """One stream to several stores: each path of sinks gets the rows of its condition, each row once.

    A micro-batch is a folder batch=<number> of each store, moved in whole when it is written. A batch that is replayed, after
    one of its sinks failed or before its number was noted, leaves the stores that have it as they are. A
    store belongs to one checkpoint: with a new one its numbers start anew, which is an error."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read once for all sinks
        try:
            for path, condition in sinks.items():
                files = Files(spark, path)
                owner, mine = f"{path}/_owner", f"{checkpoint}\n"
                if not files.exists(owner):
                    files.write(owner, mine)
                elif files.read(owner) != mine:
                    raise ValueError(f"{path} belongs to the checkpoint {files.read(owner).strip()}")
                target = f"{path}/batch={number}"
                if not files.exists(target):
                    hidden = f"{path}/_batch-{number}-{uuid.uuid4().hex}"
                    batch.where(condition).write.option("compression", codec).parquet(hidden)
                    files.move(hidden, target)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cov_stream(stream: DataFrame, keys: Sequence[str], us: str, value: str, rules: Sequence[tuple[str, float]] = (), default: float = 0.5, kind: str = "absolute", heartbeat_us: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """operators.change.cov on a stream: the state of a key is its last value that went out. Rows of a
    micro-batch are taken in order of time. Keys are kept by hash buckets, as counted_cov_stream keeps them."""
    rows = stream.where(F.col(value).isNotNull() & F.col(us).isNotNull()).withColumn("_limit", threshold(keys[-1], rules, default))
    fields = stream.schema
    rows, names = _bucketed(rows, keys, buckets)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        *marks, last, last_us = state.get if state.exists else ([],) * (len(names) + 2)
        sensors = dict(zip(zip(*marks), zip(last, last_us)))
        pdf = pd.concat(list(batches)).sort_values(us, kind="stable")
        keep = []
        columns = [pdf[value].astype(float).tolist(), pdf[us].tolist(), pdf["_limit"].tolist()]
        for mark, v, t, limit in zip(zip(*[pdf[n].tolist() for n in names]), *columns, strict=True):
            ok = passes(*sensors.get(mark, (None, None)), v, t, limit, kind, False, heartbeat_us)
            if ok:
                sensors[mark] = v, t
            keep.append(ok)
        state.update((*map(list, zip(*sensors)), *map(list, zip(*sensors.values()))))
        if any(keep):
            yield pdf[fields.fieldNames()][keep]

    kept = ", ".join(f"key{n} array<string>" for n in range(len(names))) + ", last array<double>, last_us array<long>"
    return rows.groupBy("_bucket").applyInPandasWithState(run, fields, kept, "append", "NoTimeout")


def current_state(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, order: Sequence[str] = (), buckets: int = 64) -> StreamingQuery:
    """The latest row of each sensor in a KeyedTable at path: a micro-batch rewrites the buckets that it touches, and
    one that is replayed after a failure changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read once for its buckets and once for its rows
        try:
            KeyedTable(batch.sparkSession, path, keys, ts, order, buckets).upsert(batch, number, checkpoint)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def received_counts(batches: Iterator[pd.DataFrame], every_us: int, most: int = 100_000) -> Iterator[pd.DataFrame]:
    """Marks with n: of rows one mark for a session and interval, at the interval's end, with their count n;
    beats as they are. No more than about most counts are held before they are given out."""
    held = None

    def given(counts: pd.Series) -> pd.DataFrame:
        out = counts.rename("n").reset_index().assign(kind="row", published=0)
        return out[["session_id", "kind", "us", "published", "n"]]

    for pdf in batches:
        beats = pdf[pdf["kind"] != "row"]
        if len(beats):
            yield beats.assign(n=0)[["session_id", "kind", "us", "published", "n"]]
        rows = pdf[pdf["kind"] == "row"]
        counts = rows.assign(us=rows["us"] // every_us * every_us + every_us - 1).groupby(["session_id", "us"], dropna=False).size()
        held = counts if held is None else held.add(counts, fill_value=0).astype("int64")
        if len(held) > most:
            yield given(held)
            held = None
    if held is not None and len(held):
        yield given(held)


def sync_stream(marks: DataFrame, every_us: int = 1) -> DataFrame:
    """Loss by session from a stream of rows (session_id, kind, us, published): kind "row" is a message
    received, "beat" a heartbeat with the session's published total. After each beat: session_id, us,
    published, received (both since the session's first beat), loss. A new session starts anew.

    Each task counts its rows by intervals of every_us first, so a session's group reads a count for each
    task and interval, not its rows. Beats must be at the last microsecond of an interval."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        base, got = state.get if state.exists else (None, 0)
        pdf = pd.concat(list(batches)).sort_values(["us", "kind"], ascending=[True, False], kind="stable")
        out = []
        for kind, us, published, n in zip(pdf["kind"], pdf["us"], pdf["published"], pdf["n"], strict=True):
            if kind == "row":
                got += int(n) if base is not None else 0
            elif base is None:
                base = int(published)
            else:
                out.append((key[0], int(us), int(published) - base, got, int(published) - base - got))
        state.update((base, got))
        yield pd.DataFrame(out, columns=["session_id", "us", "published", "received", "loss"])

    schema = "session_id string, us long, published long, received long, loss long"
    counted = marks.select("session_id", "kind", "us", "published").mapInPandas(
        lambda batches: received_counts(batches, every_us), "session_id string, kind string, us long, published long, n long"
    )
    return counted.groupBy("session_id").applyInPandasWithState(run, schema, "base long, got long", "append", "NoTimeout")
