"""Streams with timers: re-sent reports, batches flushed by a tick; state read from the store."""

import datetime as dt
import os
import time

import pytest
from conftest import SF001, SF01, rows
from pyspark.sql import functions as F

from tallyfold.operators import batching, fold, sampling
from tallyfold.schema import STATE_COLS
from tallyfold.sources.feed import load_feed
from tallyfold.streaming import stream, timers

FEED = "seq long, ts timestamp_ntz, id string, type string, delta long, value double"
DAY = dt.datetime(2024, 1, 1)


def feed_files(spark, path, files):
    """A stream that takes each list of rows as one micro-batch."""
    for i, part in enumerate(files):
        spark.createDataFrame(part, FEED).coalesce(1).write.parquet(f"{path}/f={i}")
        for name in os.listdir(f"{path}/f={i}"):
            os.utime(f"{path}/f={i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


@pytest.mark.parametrize("parts", [1, 4])
def test_batches_do_not_depend_on_micro_batches(spark, tmp_dir, parts):
    stream.write_feed_files(spark, SF01, f"{tmp_dir}/in", files=parts)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1, glob="*.parquet")
    timers.start_batching(src, f"{tmp_dir}/out", f"{tmp_dir}/ck", 100, "1 day").awaitTermination()
    cols = ("first_seq", "batch_no", "n_rows", "last_seq", "payload")
    want = batching.encode_batches(batching.assign_batches(load_feed(spark, SF01), 100, "1 day"))
    sent, whole = (rows(timers.read_batches(spark, f"{tmp_dir}/out", ck), *cols) for ck in (None, f"{tmp_dir}/ck"))
    assert whole == rows(want, *cols) and len(sent) == len(whole) - 1  # the last interval is still open


def test_a_tick_flushes_without_new_rows(spark, tmp_dir):
    some = [(i, at(i % 2 * 24), "a", "counter", i, None) for i in range(7)] + [(8, None, "a", "counter", 1, None)]
    src = feed_files(spark, f"{tmp_dir}/in", [some])
    q = timers.start_batching(src, f"{tmp_dir}/out", f"{tmp_dir}/ck", 3, "2 seconds", tick="processing",
                              available_now=False, interval="1 second")
    try:
        deadline, found = time.time() + 60, []
        while time.time() < deadline:  # the source stays silent from here on
            assert q.exception() is None
            found = rows(timers.read_batches(spark, f"{tmp_dir}/out"), "first_seq", "batch_no", "n_rows")
            if sum(r[2] for r in found) == 7:
                break
            time.sleep(1)
    finally:
        q.stop()
    assert found == [(0, 0, 3), (1, 0, 3), (6, 1, 1)]
    assert sorted(os.listdir(f"{tmp_dir}/out")) == ["out"]  # payloads only, no copies of rows


def test_payload_numbers_and_missing_fields(spark, tmp_dir):
    src = feed_files(spark, f"{tmp_dir}/in", [
        [(2**60 + 1, at(1), "a", "counter", 2**60 + 1, None), (3, at(1), None, "gauge", None, 0.1)],
        [(4, at(2), "b", None, None, None), (None, at(30), None, None, None, None)]])
    timers.start_batching(src, f"{tmp_dir}/out", f"{tmp_dir}/ck", 10, "1 day").awaitTermination()
    (row,) = timers.read_batches(spark, f"{tmp_dir}/out").collect()
    assert row["payload"] == ('[{"type":"gauge","value":0.1},{"id":"b"},{"id":"a","type":"counter","delta":1152921504606846977}]')


def test_reports_repeat_silent_metrics(spark, tmp_dir):
    files = [
        [(1, at(1), "n", "counter", 2, None), (2, at(2), "g", "gauge", None, 1.5), (3, at(3), "n", "counter", 3, None)],
        [(4, at(25), "n", "counter", 10, None), (5, None, "n", "counter", 99, None)],
        [(6, at(80), "x", "other", None, None)],  # moves the clock only
        [(7, at(81), "g", "gauge", None, float("nan")), (8, at(2), "n", "counter", 50, None)],  # the last one is late
        [(9, at(96), "x", "other", None, None)],
    ]
    src = feed_files(spark, f"{tmp_dir}/in", files)
    timers.start_filled_report(src, f"{tmp_dir}/out", f"{tmp_dir}/ck", "1 day", "0 seconds", lanes=3).awaitTermination()
    got = spark.read.schema(stream.REPORT).parquet(f"{tmp_dir}/out").collect()
    found = {(r["win_start"].day, r["id"]): (r["delta"], str(r["value"])) for r in got}
    assert len(got) == len(found) and found == {
        (1, "n"): (5, "None"), (1, "g"): (None, "1.5"), (2, "n"): (15, "None"), (2, "g"): (None, "1.5"),
        (3, "n"): (15, "None"), (3, "g"): (None, "1.5"), (4, "n"): (15, "None"), (4, "g"): (None, "nan")}


def test_reports_go_on_after_a_restart(spark, tmp_dir):
    stream.write_feed_files(spark, SF01, f"{tmp_dir}/all", files=4, clock=stream.closing_tick(spark, SF01, "1 day"))
    src = stream.feed_stream(spark, f"{tmp_dir}/all", max_files=1, glob="*.parquet")
    for part in range(2):  # stopped after some micro-batches, then run to the end
        q = timers.start_filled_report(src, f"{tmp_dir}/out", f"{tmp_dir}/ck", "1 day", "0 seconds", lanes=5)
        if part == 0:
            while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] < 1):
                time.sleep(0.2)
            q.stop()
        else:
            q.awaitTermination()
    got = spark.read.schema(stream.REPORT).parquet(f"{tmp_dir}/out")
    want = sampling.report_filled(load_feed(spark, SF01), "1 day")
    cols = ("win_start", "type", "id", "delta", "value")
    assert rows(got, *cols) == rows(want, *cols)


def test_state_store_is_a_cut_at_any_micro_batch(spark, tmp_dir):
    stream.write_feed_files(spark, SF01, f"{tmp_dir}/in", files=3)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1, glob="*.parquet")
    stream.stream_fold(src).writeStream.outputMode("update").format("noop").option(
        "checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start().awaitTermination()
    feed = load_feed(spark, SF01)
    sizes = [spark.read.parquet(f"{tmp_dir}/in/{n}") for n in sorted(os.listdir(f"{tmp_dir}/in")) if n.endswith(".parquet")]
    edge = sizes[1].agg(F.min("event_id")).first()[0]
    for batch, part in ((0, feed.where(F.col("seq") < edge)), (None, feed)):
        assert rows(stream.read_state_store(spark, f"{tmp_dir}/ck", batch), *STATE_COLS) == rows(fold.fold(part), *STATE_COLS)


def test_feed_files_keep_rows_without_id(spark, tmp_dir):
    events = spark.read.parquet(f"{SF01}/events.parquet")
    nameless = events.limit(5).withColumn("event_id", F.lit(None).cast("bigint"))
    events.unionByName(nameless).write.parquet(f"{tmp_dir}/sf/events.parquet")
    stream.write_feed_files(spark, f"{tmp_dir}/sf", f"{tmp_dir}/in", files=4, reverse=True)
    assert spark.read.parquet(f"{tmp_dir}/in").count() == events.count() + 5
    names = sorted(n for n in os.listdir(f"{tmp_dir}/in") if n.endswith(".parquet"))
    times = [os.path.getmtime(f"{tmp_dir}/in/{n}") for n in names]
    assert len(names) == 4 and times == sorted(times, reverse=True) and len(set(times)) == 4


def plain_session(spark):
    """A session with Spark's default state store, as one is that nobody set up."""
    plain = spark.newSession()
    plain.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    return plain


def two_sites(spark, folder):
    """Events of two sites: the second's ids come after the first's, its times do not."""
    events = spark.read.parquet(f"{SF001}/events.parquet")
    more = events.withColumn("event_id", F.col("event_id") + 1_000_000)
    events.unionByName(more).write.parquet(f"{folder}/events.parquet")
    return folder


def test_batches_run_under_the_default_state_store(spark, tmp_dir):
    plain, sf = plain_session(spark), two_sites(spark, f"{tmp_dir}/sf")
    store = plain.conf.get("spark.sql.streaming.stateStore.providerClass")
    got = stream.run_stream_batches(plain, sf, 100, "1 day")
    want = batching.encode_batches(batching.assign_batches(load_feed(spark, sf), 100, "1 day"))
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert plain.conf.get("spark.sql.streaming.stateStore.providerClass") == store


def test_filled_reports_run_under_the_default_state_store(spark, tmp_dir):
    sf = two_sites(spark, f"{tmp_dir}/sf")
    got = stream.run_stream_filled_report(plain_session(spark), sf, "1 day")
    want = sampling.report_filled(load_feed(spark, sf), "1 day")
    cols = ("win_start", "type", "id", "delta", "value")
    assert rows(got, *cols) == rows(want, *cols)
