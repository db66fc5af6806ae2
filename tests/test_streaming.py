"""Structured Streaming forms give the batch answers."""

import os
import time

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from conftest import SF01, rows
from pyspark.sql import functions as F

from tallyfold.operators import fold
from tallyfold.sources.feed import load_feed
from tallyfold.streaming import stream

STATE_COLS = ("type", "id", "delta", "value", "last_seq")


def split_events(src_dir: str, out_dir: str, parts: int, reverse: bool = False) -> None:
    """Copy the events table into ``parts`` files by seq range, with file
    modification times in seq order (or reversed)."""
    t = pq.read_table(f"{src_dir}/events.parquet")
    n = t.num_rows
    os.makedirs(out_dir, exist_ok=True)
    step = (n + parts - 1) // parts
    now = time.time() - 1000
    order = list(range(parts))
    for rank, i in enumerate(reversed(order) if reverse else order):
        lo, hi = i * step, min(n, (i + 1) * step)
        mask = pc.and_(pc.greater_equal(t["event_id"], lo), pc.less(t["event_id"], hi))
        path = f"{out_dir}/events_{i:03d}.parquet"
        pq.write_table(t.filter(mask), path)
        os.utime(path, (now + rank * 10, now + rank * 10))


@pytest.fixture(scope="module")
def batch_state(spark):
    return rows(fold.fold(load_feed(spark, SF01)), *STATE_COLS)


def test_stream_fold_equals_batch(spark, tmp_dir, batch_state):
    split_events(SF01, f"{tmp_dir}/in", 4)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    q = stream.start_snapshots(src, f"{tmp_dir}/snap", f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    assert stream.latest_version(spark, f"{tmp_dir}/snap") == 3
    assert rows(stream.read_version(spark, f"{tmp_dir}/snap"), *STATE_COLS) == batch_state


@pytest.mark.parametrize("reverse", [False, True])
def test_stream_merge_equals_batch(spark, tmp_dir, batch_state, reverse):
    split_events(SF01, f"{tmp_dir}/in", 5, reverse=reverse)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    q = stream.start_merge(src, f"{tmp_dir}/state", f"{tmp_dir}/ck")
    q.awaitTermination()
    assert stream.latest_version(spark, f"{tmp_dir}/state") == 4
    seen = [p["observedMetrics"]["ingest"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["rows"] for m in seen) == 10000 and sum(m["applied"] for m in seen) == 7189
    assert rows(stream.read_version(spark, f"{tmp_dir}/state"), *STATE_COLS) == batch_state


def test_replayed_micro_batch_is_idempotent(spark, tmp_dir, batch_state):
    feed = load_feed(spark, SF01)
    parts = [feed.where((F.col("seq") >= lo) & (F.col("seq") < lo + 2500)) for lo in range(0, 10000, 2500)]
    root = f"{tmp_dir}/state"
    for i, p in enumerate(parts):
        stream.merge_micro_batch(spark, p, i, root)
    # Batch 2 is delivered again after a failure, then batch 3 again.
    stream.merge_micro_batch(spark, parts[2], 2, root)
    stream.merge_micro_batch(spark, parts[3], 3, root)
    assert rows(stream.read_version(spark, root), *STATE_COLS) == batch_state


def test_stream_merge_with_initial_snapshot(spark, tmp_dir, batch_state):
    from tallyfold.sources.store import write_snapshot

    feed = load_feed(spark, SF01)
    write_snapshot(fold.fold(feed.where("seq < 5000")), f"{tmp_dir}/init")
    t = pq.read_table(f"{SF01}/events.parquet")
    os.makedirs(f"{tmp_dir}/in")
    pq.write_table(t.filter(pc.greater_equal(t["event_id"], 5000)), f"{tmp_dir}/in/events_late.parquet")
    src = stream.feed_stream(spark, f"{tmp_dir}/in")
    stream.start_merge(src, f"{tmp_dir}/state", f"{tmp_dir}/ck", initial_path=f"{tmp_dir}/init").awaitTermination()
    assert rows(stream.read_version(spark, f"{tmp_dir}/state"), *STATE_COLS) == batch_state


def test_stream_report_closed_windows(spark, tmp_dir):
    split_events(SF01, f"{tmp_dir}/in", 6)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    rep = stream.stream_report(src, "1 day", "1 hour")
    q = (rep.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_dir}/out")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress if p["stateOperators"])
    assert dropped == 0
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert dict(got.dtypes)["win_start"] == "timestamp_ntz"
    feed = fold.valid_updates(load_feed(spark, SF01))
    t = F.col("type")
    want = feed.groupBy(F.window("ts", "1 day").start.alias("win_start"), "type", "id").agg(
        F.sum(F.when(t == "counter", F.col("delta"))).alias("delta"),
        F.max_by(F.when(t == "gauge", F.col("value")), "seq").alias("value"))
    emitted = {r.w for r in got.select(F.col("win_start").cast("string").alias("w")).distinct().collect()}
    assert len(emitted) >= 28  # the last windows stay open at the end of input
    closed = want.where(F.col("win_start").cast("string").isin(*emitted))
    norm = lambda df: rows(df.select(F.col("win_start").cast("string").alias("w"), "type", "id", "delta", "value"))
    assert norm(got) == norm(closed)


def test_initial_state_joins_the_stream(spark, tmp_dir, batch_state):
    feed = load_feed(spark, SF01)
    stream.write_feed_files(spark, SF01, f"{tmp_dir}/in", files=3)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1, glob="*.parquet").where("seq >= 5000")
    seeded = stream.with_initial_state(src, fold.fold(feed.where("seq < 5000")), f"{tmp_dir}/seed")
    stream.start_live_fold(seeded, f"{tmp_dir}/live", f"{tmp_dir}/ck").awaitTermination()
    assert rows(stream.read_live_state(spark, f"{tmp_dir}/live"), *STATE_COLS) == batch_state


def test_live_state_takes_the_newest_change_not_the_highest_seq(spark, tmp_dir):
    # A late update of -2 lowers the counter and leaves last_seq where it was.
    for v, (delta, seq) in enumerate([(5, 10), (3, 10)]):
        state = spark.createDataFrame([("counter", "c", delta, None, seq)], stream.STATE)
        state.write.parquet(stream.version_path(f"{tmp_dir}/live/changes", v))
    assert rows(stream.read_live_state(spark, f"{tmp_dir}/live"), "delta", "last_seq") == [(3, 10)]
    for _ in range(2):  # a compaction may be replayed
        assert stream.compact_live_state(spark, f"{tmp_dir}/live") == 1
        assert rows(stream.read_live_state(spark, f"{tmp_dir}/live"), "delta", "last_seq") == [(3, 10)]


def test_report_holds_open_intervals_too(spark, tmp_dir):
    split_events(SF01, f"{tmp_dir}/in", 6)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    stream.start_report(src, f"{tmp_dir}/out", f"{tmp_dir}/ck", "1 day", "1 hour").awaitTermination()
    feed = fold.valid_updates(load_feed(spark, SF01))
    want = feed.select(F.window("ts", "1 day").start, "type", "id").distinct().count()
    assert stream.read_report(spark, f"{tmp_dir}/out").count() == want == 5898


def test_old_versions_are_removed(spark, tmp_dir, batch_state):
    split_events(SF01, f"{tmp_dir}/in", 6)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    stream.start_merge(src, f"{tmp_dir}/state", f"{tmp_dir}/ck").awaitTermination()
    assert stream.committed_versions(spark, f"{tmp_dir}/state") == [3, 4, 5]
    assert rows(stream.read_version(spark, f"{tmp_dir}/state"), *STATE_COLS) == batch_state


def test_stream_report_independent_of_session_zone(spark):
    from tallyfold.streaming import stream

    utc = rows(stream.run_stream_report(spark, "/root/testdata/sf0.001", "1 day", "1 hour"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = rows(stream.run_stream_report(spark, "/root/testdata/sf0.001", "1 day", "1 hour"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == other and len(utc) > 0


@pytest.mark.parametrize("reverse", [False, True])
def test_live_fold_change_log(spark, tmp_dir, batch_state, reverse):
    split_events(SF01, f"{tmp_dir}/in", 4, reverse=reverse)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    root = f"{tmp_dir}/live"
    stream.start_live_fold(src, root, f"{tmp_dir}/ck").awaitTermination()
    changes = stream.committed_versions(spark, f"{root}/changes")
    assert len(changes) == 4
    # Each version holds only the keys its micro-batch changed.
    assert spark.read.parquet(stream.version_path(f"{root}/changes", changes[0])).count() < 600
    assert rows(stream.read_live_state(spark, root), *STATE_COLS) == batch_state
    assert stream.compact_live_state(spark, root) == changes[-1]
    assert rows(stream.read_live_state(spark, root), *STATE_COLS) == batch_state


def test_periodic_snapshots_processing_time(spark, tmp_dir, batch_state):
    split_events(SF01, f"{tmp_dir}/in", 2)
    src = stream.feed_stream(spark, f"{tmp_dir}/in")
    q = stream.start_snapshots(src, f"{tmp_dir}/snap", f"{tmp_dir}/ck", interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert stream.latest_version(spark, f"{tmp_dir}/snap") is not None
    assert rows(stream.read_version(spark, f"{tmp_dir}/snap"), *STATE_COLS) == batch_state


def test_stream_report_counts_late_rows(spark, tmp_dir):
    # Files arrive newest first: after the first micro-batch the watermark is
    # past the older files, whose rows are dropped by rule and counted.
    split_events(SF01, f"{tmp_dir}/in", 4, reverse=True)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    q = (stream.stream_report(src, "1 day", "1 hour").writeStream.outputMode("append").format("parquet")
         .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p["stateOperators"])
    assert dropped > 0


def test_live_fold_periodic_compaction(spark, tmp_dir, batch_state):
    split_events(SF01, f"{tmp_dir}/in", 5)
    src = stream.feed_stream(spark, f"{tmp_dir}/in", max_files=1)
    root = f"{tmp_dir}/live"
    stream.start_live_fold(src, root, f"{tmp_dir}/ck", compact_every=2).awaitTermination()
    assert stream.committed_versions(spark, f"{root}/base") == [1, 3]
    assert rows(stream.read_live_state(spark, root), *STATE_COLS) == batch_state
