"""State versions that write changed buckets only."""

import os

from conftest import SF01, rows
from pyspark.sql import functions as F

from tallyfold.operators import fold
from tallyfold.schema import STATE_COLS
from tallyfold.sources import buckets
from tallyfold.sources.feed import load_feed
from tallyfold.streaming import stream


def written(root, version):
    at = f"{root}/data/v={version:012d}"
    return sorted(n for n in os.listdir(at) if n.startswith("bucket=")) if os.path.isdir(at) else []


def test_snapshots_write_what_changed(spark, tmp_dir):
    state = fold.fold(load_feed(spark, SF01)).select(*STATE_COLS).cache()
    assert buckets.publish(state, tmp_dir, 0, 20) == 20
    assert buckets.publish(state.orderBy(F.rand()), tmp_dir, 1, 20) == 0 and written(tmp_dir, 1) == []
    one = state.first()
    other = state.withColumn("last_seq", F.when((F.col("type") == one["type"]) & (F.col("id") == one["id"]), F.lit(10**9))
                             .otherwise(F.col("last_seq")))
    assert buckets.publish(other, tmp_dir, 2, 99) == 1 and len(written(tmp_dir, 2)) == 1  # the first version fixes the buckets
    gone = other.where(F.col("id") != one["id"])
    assert 0 <= buckets.publish(gone, tmp_dir, 3, 20) <= 2
    for v, want in ((1, state), (2, other), (3, gone), (None, gone)):
        assert rows(buckets.read(spark, tmp_dir, v), *STATE_COLS) == rows(want, *STATE_COLS), v
    assert buckets.publish(state.limit(0), tmp_dir, 4, 20) == 0 and buckets.read(spark, tmp_dir).count() == 0
    assert buckets.read(spark, f"{tmp_dir}/none").count() == 0


def test_merges_touch_the_buckets_of_a_batch(spark, tmp_dir):
    feed = load_feed(spark, SF01).cache()
    parts = [feed.where("seq < 5000"), feed.where("seq >= 5000 and seq < 9990"), feed.where("seq between 9990 and 9992"),
             feed.where("seq > 9992")]
    sizes = [buckets.merge(p, tmp_dir, i, buckets=30) for i, p in enumerate(parts)]
    assert sizes[0] == 30 and 1 <= sizes[2] <= 3 == max(3, len(written(tmp_dir, 2)))
    want = rows(fold.fold(feed), *STATE_COLS)
    assert rows(buckets.read(spark, tmp_dir), *STATE_COLS) == want
    # A replayed micro-batch writes its version again and adds nothing twice.
    assert buckets.merge(parts[3], tmp_dir, 3, buckets=30) == sizes[3]
    assert rows(buckets.read(spark, tmp_dir), *STATE_COLS) == want
    assert buckets.merge(feed.where("type = 'other'"), tmp_dir, 4) == 0 and rows(buckets.read(spark, tmp_dir), *STATE_COLS) == want
    # Files that no kept version consists of are removed.
    used = {(m["holder"], b) for v in (2, 3, 4) for b, m in buckets.manifest(spark, tmp_dir, v).items()}
    there = {(v, int(n.split("=")[1])) for v in range(5) for n in written(tmp_dir, v)}
    assert there == used


def test_streams_into_buckets(spark, tmp_dir):
    early, late = load_feed(spark, SF01).where("seq < 5000"), f"{tmp_dir}/late"
    stream.write_feed_files(spark, SF01, late, files=3)
    src = stream.feed_stream(spark, late, max_files=1, glob="*.parquet").where("seq >= 5000")
    fold.fold(early).select(*STATE_COLS).write.parquet(f"{tmp_dir}/initial")
    stream.start_merge(src, f"{tmp_dir}/merged", f"{tmp_dir}/ck1", f"{tmp_dir}/initial", buckets=8).awaitTermination()
    stream.start_snapshots(src, f"{tmp_dir}/snap", f"{tmp_dir}/ck2", available_now=True, buckets=8).awaitTermination()
    feed = load_feed(spark, SF01)
    assert rows(buckets.read(spark, f"{tmp_dir}/merged"), *STATE_COLS) == rows(fold.fold(feed), *STATE_COLS)
    assert rows(buckets.read(spark, f"{tmp_dir}/snap"), *STATE_COLS) == rows(fold.fold(feed.where("seq >= 5000")), *STATE_COLS)
