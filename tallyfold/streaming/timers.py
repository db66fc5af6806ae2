"""Keyed state with timers: what an agent's tickers do on a stream.

* :func:`start_filled_report` - at the end of each interval every metric seen
  so far is reported again, counters with their total so far, also the metrics
  that the interval did not touch (the streaming form of
  ``operators.sampling.report_filled``).  The updates of an interval are folded
  by Spark's own streaming aggregate, partial sums first, so a hot metric is one
  row per interval and map task before it meets any Python; the small closed
  rows enter lanes of keyed state, whose event-time timers fire per interval.
* :func:`start_batching` - size-or-interval payloads.  A list state of fewer
  than ``max_size`` rows holds an interval's open batch; a full one goes out at
  once, and a tick sends the rest without any new row: the end of the interval
  in event time, or a processing-time timer.

State lives in the session's state store, which must be the RocksDB provider
(``session.STATE_STORE``, or a session from ``session.with_state_store``).  Any row
with a time moves the event-time clock, valid or not; late rows (behind the watermark) are dropped by rule.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyfold.functions.jsoncodec import encode_json
from tallyfold.functions.timeutil import utc_instant, utc_wall
from tallyfold.operators import batching, fold
from tallyfold.schema import COUNTER, GAUGE, KEY
from tallyfold.sources.store import committed_versions, version_path

#: Lanes of keyed state that the metrics of a report are dealt to; one lane's metrics are one state value.
LANES = 64
#: Metrics of one lane that a report hands over at a time.
REPORT_ROWS = 10_000


def interval_ms(spark: SparkSession, every: str) -> int:
    """Length of a tumbling interval in milliseconds (a constant, no job)."""
    made = spark.range(1).select(F.window(F.lit(0).cast("timestamp"), every).alias("w"))
    return made.select(F.unix_millis("w.end") - F.unix_millis("w.start")).first()[0]


def _instant(df: DataFrame, ts: str) -> Column:
    return utc_instant(F.col(ts)) if dict(df.dtypes)[ts] == "timestamp_ntz" else F.col(ts)


def _with_clock(df: DataFrame, ts: str, delay: str, wanted: Column) -> DataFrame:
    """``df`` with the event time ``_at`` and its watermark, then the wanted rows.

    The condition names the event time, so that Spark does not move it below the
    watermark: rows that are not wanted still move the clock."""
    stamped = df.withColumn("_at", _instant(df, ts)).withWatermark("_at", delay)
    return stamped.where(F.when(F.col("_at").isNotNull(), wanted).otherwise(F.lit(False)))


def _started(df: DataFrame, checkpoint: str, available_now: bool, interval: str | None):
    w = df.option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "10 seconds")


# ---------------------------------------------------------------- reports

METRIC_STATE = pa.schema([("type", pa.string()), ("id", pa.string()), ("delta", pa.int64()), ("value", pa.float64())])


class FilledReport(StatefulProcessor):
    """A lane of metrics: totals and newest values up to the last closed interval."""

    def __init__(self, every: int) -> None:
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.metrics = handle.getValueState("metrics", "next bigint, rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed: dict[int, list] = {}
        for part in rows:
            for r in part[["start", "type", "id", "delta", "value"]].itertuples(index=False, name=None):
                closed.setdefault(int(r[0]), []).append(r[1:])
        yield from self.advance(key[0], closed, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.advance(key[0], {}, timerValues.getCurrentWatermarkInMs())

    def advance(self, lane: int, closed: dict[int, list], watermark: int) -> Iterator[pd.DataFrame]:
        """Report every interval that the watermark has passed, from the next one on."""
        known = self.metrics.get() if self.metrics.exists() else None
        metrics: dict[tuple[str, str], list] = {}
        at = min(closed) if known is None else int(known[0])
        if known is not None:
            rows = pa.ipc.open_stream(io.BytesIO(known[1])).read_all().to_pydict()
            metrics = {(t, i): [d, v] for t, i, d, v in zip(*rows.values(), strict=True)}
        while at + self.every <= watermark:
            for kind, name, delta, value in closed.pop(at, ()):
                held = metrics.setdefault((kind, name), [None, None])
                if kind == GAUGE:
                    held[1] = float(value)
                else:
                    held[0] = int(delta) + (held[0] or 0)
            yield from self.report(lane, at, metrics)
            at += self.every
        table = pa.table([pa.array([k[0] for k in metrics], pa.string()), pa.array([k[1] for k in metrics], pa.string()),
                          pa.array([m[0] for m in metrics.values()], pa.int64()),
                          pa.array([m[1] for m in metrics.values()], pa.float64(), from_pandas=False)], schema=METRIC_STATE)
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, METRIC_STATE) as out:
            out.write_table(table)
        self.metrics.update((at, sink.getvalue()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at + self.every)

    def report(self, lane: int, at: int, metrics: dict[tuple[str, str], list]) -> Iterator[pd.DataFrame]:
        items = list(metrics.items())
        for i in range(0, len(items), REPORT_ROWS):
            some = items[i:i + REPORT_ROWS]
            yield pd.DataFrame({
                "lane": [lane] * len(some), "start": [at] * len(some), "type": [k[0] for k, _ in some], "id": [k[1] for k, _ in some],
                "delta": [None if m[0] is None else str(m[0]) for _, m in some],
                "value": [None if m[1] is None else repr(m[1]) for _, m in some],
            })

    def close(self) -> None:
        pass


# Numbers travel to and from the state as text: a data frame's column cannot hold
# whole 64-bit numbers beside missing ones, nor NaN.
FILLED = "lane int, start bigint, type string, id string, delta string, value string"


def filled_report(src: DataFrame, every: str, delay: str, ts: str = "ts", seq: str = "seq", lanes: int = LANES) -> DataFrame:
    """A stream of reports: ``win_start`` (UTC wall time), ``type``, ``id``, ``delta`` (total so far), ``value``."""
    t = F.col("type")
    kept = _with_clock(src, ts, delay, fold.is_valid_update())
    per = kept.groupBy(F.window("_at", every).alias("win"), *KEY).agg(
        F.sum(F.when(t == COUNTER, F.col("delta"))).alias("delta"),
        F.max_by(F.when(t == GAUGE, F.col("value")), F.col(seq)).alias("value"))
    lane = F.pmod(F.xxhash64(*KEY), F.lit(lanes)).cast("int")
    dealt = per.select(F.window_time("win").alias("at"), lane.alias("lane"), F.unix_millis("win.start").alias("start"),
                       *KEY, F.col("delta").cast("string").alias("delta"), F.col("value").cast("string").alias("value"))
    out = dealt.groupBy("lane").transformWithStateInPandas(
        FilledReport(interval_ms(src.sparkSession, every)), FILLED, "append", "eventTime")
    return out.select(utc_wall(F.timestamp_millis("start")).alias("win_start"), *KEY, F.col("delta").cast("bigint").alias("delta"),
                      F.col("value").cast("double").alias("value"))


def start_filled_report(src: DataFrame, path: str, checkpoint: str, every: str, delay: str, lanes: int = LANES,
                        available_now: bool = True, interval: str | None = None):
    """Append the reports to the Parquet folder ``path``, each exactly once.

    An interval is reported when the watermark passes its end, so reports follow
    the clock of the source: a source that goes on without some metrics, or with
    rows that no metric takes, still has all of them reported."""
    out = filled_report(src, every, delay, lanes=lanes)
    w = out.writeStream.format("parquet").outputMode("append").option("path", path)
    return _started(w, checkpoint, available_now, interval).start()


# ---------------------------------------------------------------- batches

RECORD = "seq bigint, record string"
BATCHED = f"start bigint, batch_no bigint, {RECORD}"


class Batches(StatefulProcessor):
    """One interval's batches: fewer than ``max_size`` open rows, and how many batches went out."""

    def __init__(self, max_size: int, every: int, processing: bool) -> None:
        self.max_size, self.every, self.processing = max_size, every, processing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", RECORD)
        self.sent = handle.getValueState("sent", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        new = [r for part in rows for r in part[["seq", "record"]].itertuples(index=False, name=None)]
        yield from self.send(key[0], held + sorted(new, key=lambda r: r[0]), False)
        if not list(self.handle.listTimers()):
            if self.processing:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
            else:
                self.handle.registerTimer(int(key[0]) + self.every - 1)  # fires once the watermark is above it

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.send(key[0], [tuple(r) for r in self.open.get()] if self.open.exists() else [], True)
        if not self.processing:
            self.sent.clear()

    def send(self, start: int, rows: list[tuple], all_of_them: bool) -> Iterator[pd.DataFrame]:
        sent = int(self.sent.get()[0]) if self.sent.exists() else 0
        full = len(rows) if all_of_them else len(rows) // self.max_size * self.max_size
        for i in range(0, full, self.max_size):
            some = rows[i:i + self.max_size]
            yield pd.DataFrame({"start": [start] * len(some), "batch_no": [sent] * len(some), "seq": [r[0] for r in some],
                                "record": [r[1] for r in some]})
            sent += 1
        rest = rows[full:]
        if rest:
            self.open.put(rest)
        else:
            self.open.clear()
        self.sent.update((sent,))

    def close(self) -> None:
        pass


def _payloads(rows: DataFrame) -> DataFrame:
    """One payload per batch, as ``encode_batches`` makes it; a batch is bounded by its size cap."""
    records = F.transform(F.array_sort(F.collect_list(F.struct("seq", "record"))), lambda r: r["record"])
    made = rows.groupBy("start", "batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.concat(F.lit("["), F.array_join(records, ","), F.lit("]")).alias("payload"))
    return made.select(utc_wall(F.timestamp_millis("start")).alias("win_start"), "batch_no", "n_rows", "first_seq", "last_seq", "payload")


def start_batching(src: DataFrame, path: str, checkpoint: str, max_size: int, every: str, delay: str = "0 seconds",
                   tick: str = "event", available_now: bool = True, interval: str | None = None):
    """Size-or-interval payloads, independent of where micro-batches end.

    The rows of an interval of ``every`` are batched in ``seq`` order; a batch goes
    out as soon as it has ``max_size`` rows, and the rest at the tick, new rows or
    not: with ``tick="event"`` when the watermark passes the interval's end, with
    ``tick="processing"`` ``every`` after the interval's first open row came.
    Only rows still open are kept, in the state store; payloads are written to
    ``path`` as version folders, and nothing else is.  Rows without a time belong
    to no interval and rows without ``seq`` are only ticks: neither is batched."""
    batching.require_bounded(max_size)
    if tick not in ("event", "processing"):
        raise ValueError(f"unknown tick {tick!r}")
    root, ms = path.rstrip("/"), interval_ms(src.sparkSession, every)
    ordered = F.col("seq").isNotNull()
    kept = _with_clock(src, "ts", delay, ordered) if tick == "event" else src.withColumn("_at", _instant(src, "ts")).where(ordered)
    rows = kept.where("_at is not null").select(
        *(["_at"] if tick == "event" else []), F.unix_millis(F.window("_at", every).start).alias("start"),
        "seq", encode_json().alias("record"))
    out = rows.groupBy("start").transformWithStateInPandas(
        Batches(max_size, ms, tick == "processing"), BATCHED, "append", "eventTime" if tick == "event" else "processingTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        _payloads(batch).write.mode("overwrite").json(version_path(f"{root}/out", batch_id))

    w = out.writeStream.outputMode("append").foreachBatch(write)
    return _started(w, checkpoint, available_now, interval).start()


PAYLOADS = "win_start timestamp_ntz, batch_no bigint, n_rows bigint, first_seq bigint, last_seq bigint, payload string"


def read_batches(spark: SparkSession, path: str, checkpoint: str | None = None) -> DataFrame:
    """All payloads so far; with ``checkpoint``, the open rest of each interval
    too, as its last one, read from the state store."""
    root = path.rstrip("/")
    done = [version_path(f"{root}/out", v) for v in committed_versions(spark, f"{root}/out")]
    sent = spark.read.schema(PAYLOADS).json(done) if done else spark.createDataFrame([], PAYLOADS)
    if checkpoint is None:
        return sent

    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    rows = state("open").select(F.col("key.start").alias("start"), F.col("list_element.*"))
    numbers = state("sent").select(F.col("key.start").alias("start"), F.col("value.n").alias("batch_no"))
    return sent.unionByName(_payloads(rows.join(numbers, "start")))
