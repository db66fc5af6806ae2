"""Algebraic laws of the fold, merges, snapshots and counter overflow."""

import json
import os

import pytest
from conftest import SF01, rows
from pyspark.sql import functions as F

from tallyfold.operators import fold
from tallyfold.sources import store
from tallyfold.sources.feed import load_feed

STATE_COLS = ("type", "id", "delta", "value", "last_seq")


@pytest.fixture(scope="module")
def feed(spark):
    return load_feed(spark, SF01).cache()


def test_fold_counts(feed):
    s = fold.fold(feed)
    assert s.count() == 600
    assert feed.where(fold.is_valid_update()).count() == 7189


def test_fold_concat_equals_merge(feed):
    a = feed.where(F.col("seq") < 4000)
    b = feed.where(F.col("seq") >= 4000)
    whole = rows(fold.fold(feed), *STATE_COLS)
    assert rows(fold.merge_state(fold.fold(a), b), *STATE_COLS) == whole
    assert rows(fold.merge_state_join(fold.fold(a), b), *STATE_COLS) == whole
    # Batches arriving in the wrong order still give the newest gauges.
    assert rows(fold.merge_state(fold.fold(b), a), *STATE_COLS) == whole
    assert rows(fold.merge_state_join(fold.fold(b), a), *STATE_COLS) == whole


def test_fold_ignores_row_order(feed):
    shuffled = feed.repartition(7).orderBy(F.rand(3))
    assert rows(fold.fold(shuffled), *STATE_COLS) == rows(fold.fold(feed), *STATE_COLS)


def test_gauge_and_counter_folds(feed):
    s = fold.fold(feed)
    g = rows(fold.fold_gauges(feed), "type", "id", "value", "last_seq")
    c = rows(fold.fold_counters(feed), "type", "id", "delta", "last_seq")
    assert g == rows(s.where("type = 'gauge'"), "type", "id", "value", "last_seq")
    assert c == rows(s.where("type = 'counter'"), "type", "id", "delta", "last_seq")
    assert fold.metric_names(feed).count() == 600


def test_fold_has_one_exchange(feed):
    plan = fold.fold(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "partial_max_by" in plan


def test_counter_overflow_raises(spark):
    big = 2**63 - 1
    upd = spark.createDataFrame([(1, "c", "counter", big, None), (2, "c", "counter", 1, None)],
                                "seq long, id string, type string, delta long, value double")
    with pytest.raises(Exception, match="(?i)overflow"):
        fold.fold(upd).collect()


def test_snapshot_roundtrip(spark, feed, tmp_dir):
    s = fold.fold(feed)
    store.write_snapshot(s, f"{tmp_dir}/p", fmt="parquet")
    assert rows(store.restore_snapshot(spark, f"{tmp_dir}/p"), *STATE_COLS) == rows(s, *STATE_COLS)
    store.write_snapshot(s, f"{tmp_dir}/j", fmt="json")
    back = store.restore_snapshot(spark, f"{tmp_dir}/j", fmt="json")
    assert rows(back, "type", "id", "delta", "value") == rows(s, "type", "id", "delta", "value")
    assert {r.last_seq for r in back.select("last_seq").distinct().collect()} == {-1}


def test_restore_missing_is_empty(spark, tmp_dir):
    assert store.restore_snapshot(spark, f"{tmp_dir}/absent").count() == 0


def test_restore_reference_array_with_duplicates(spark, tmp_dir):
    # One indented JSON array, as the reference writes it; later duplicates win
    # and counters are assigned, not added; bad rows are skipped.
    recs = [
        {"id": "c", "type": "counter", "delta": 5}, {"id": "g", "type": "gauge", "value": 1.5},
        {"id": "c", "type": "counter", "delta": 7}, {"id": "g", "type": "gauge", "value": 2.5},
        {"id": "n", "type": "gauge"}, {"id": "u", "type": "other", "value": 1},
    ]
    os.makedirs(f"{tmp_dir}/snap")
    with open(f"{tmp_dir}/snap/metrics.json", "w") as f:
        json.dump(recs, f, indent=2)
    s = store.restore_snapshot(spark, f"{tmp_dir}/snap", fmt="json_array")
    assert rows(s, "type", "id", "delta", "value") == [("counter", "c", 7, None), ("gauge", "g", None, 2.5)]


def test_resume(spark, feed, tmp_dir):
    a = feed.where(F.col("seq") < 5000)
    b = feed.where(F.col("seq") >= 5000)
    store.write_snapshot(fold.fold(a), f"{tmp_dir}/s", fmt="json")
    restored = store.restore_snapshot(spark, f"{tmp_dir}/s", fmt="json")
    got = rows(fold.resume(restored, b), "type", "id", "delta", "value")
    assert got == rows(fold.fold(feed), "type", "id", "delta", "value")


def test_state_table_ddl(spark, tmp_dir):
    store.create_state(spark, "tf_state_t", f"{tmp_dir}/tbl")
    store.create_state(spark, "tf_state_t", f"{tmp_dir}/tbl")
    spark.sql("INSERT INTO tf_state_t VALUES ('a', 1, NULL, 3, 'counter')")
    assert spark.table("tf_state_t").count() == 1
    store.drop_state(spark, "tf_state_t")
    store.drop_state(spark, "tf_state_t")


def test_outcome_counts(spark, feed):
    from tallyfold.functions.jsoncodec import encode_json
    from tallyfold.operators import validate

    j = validate.validate(feed.withColumn("body", encode_json()), mode="json")
    got = {r.status: r.n for r in fold.outcome_counts(j).collect()}
    assert got == {200: 7189, 400: 797, 501: 2014}


def test_poll_count(spark):
    from conftest import SF001

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    assert fold.poll_count(ev).first().delta == ev.count()
    per = fold.poll_count(ev, every="1 day").orderBy("win_start").collect()
    assert per[-1].delta == ev.count()


def test_nan_gauge_snapshot_roundtrip(spark, tmp_dir):
    upd = spark.createDataFrame([(1, "g", "gauge", None, float("nan")), (2, "h", "gauge", None, float("inf"))],
                                "seq long, id string, type string, delta long, value double")
    s = fold.fold(upd)
    store.write_snapshot(s, f"{tmp_dir}/j", fmt="json")
    back = {r.id: r.value for r in store.restore_snapshot(spark, f"{tmp_dir}/j", fmt="json").collect()}
    assert back["g"] != back["g"] and back["h"] == float("inf")


def test_no_snapshot_interval_means_no_snapshots(spark, tmp_dir):
    from tallyfold.streaming import stream

    src = stream.feed_stream(spark, "/root/testdata/sf0.001")
    assert stream.start_snapshots(src, f"{tmp_dir}/s", f"{tmp_dir}/ck", interval=None) is None


def test_bucketed_state_merge_shuffles_only_the_batch(spark, feed, tmp_dir):
    old_parts = spark.conf.get("spark.sql.shuffle.partitions")
    old_bhj = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.save_state_table(fold.fold(feed.where("seq < 5000")), "tf_bucketed_state", 8, f"{tmp_dir}/st")
        m = fold.merge_state_join(spark.table("tf_bucketed_state"), feed.where("seq >= 5000"))
        plan = m._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 2  # the batch's fold, and the few rows without an id
        assert rows(m, *STATE_COLS) == rows(fold.fold(feed), *STATE_COLS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old_parts)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_bhj)
        spark.sql("DROP TABLE IF EXISTS tf_bucketed_state")


def test_publish_snapshot_versions(spark, feed, tmp_dir):
    root = f"{tmp_dir}/snaps"
    assert store.restore_latest(spark, root).count() == 0
    a = fold.fold(feed.where("seq < 5000"))
    assert store.publish_snapshot(a, root) == 0
    assert store.publish_snapshot(fold.fold(feed), root) == 1
    # An unfinished newer version (no _SUCCESS marker) is not visible.
    os.makedirs(store.version_path(root, 2))
    assert rows(store.restore_latest(spark, root), *STATE_COLS) == rows(fold.fold(feed), *STATE_COLS)
    assert store.publish_snapshot(a, root, version=1) == 1
    assert rows(store.restore_latest(spark, root), *STATE_COLS) == rows(a, *STATE_COLS)


def test_metric_tables_roundtrip(spark, feed, tmp_dir):
    s = fold.fold(feed)
    store.write_metric_tables(s, f"{tmp_dir}/db")
    back = store.read_metric_tables(spark, f"{tmp_dir}/db")
    assert rows(back, "type", "id", "delta", "value") == rows(s, "type", "id", "delta", "value")
    assert set(spark.read.parquet(f"{tmp_dir}/db/gauge_metrics").columns) == {"name", "value"}
