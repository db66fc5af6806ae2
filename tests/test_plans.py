"""Physical-plan properties of the registered queries."""

import pytest
from conftest import SF01, SF001, rows
from pyspark.sql import functions as F

from tallyfold.plans.catalog import QUERIES

# Registered queries that run a stream or write when called are skipped
# here; the others are planned without executing.
RUNS_WHEN_CALLED = {"stream_fold", "stream_merge", "stream_merge_reversed", "stream_stateful",
                    "stream_batches", "restore_snapshot", "restore_snapshot_json", "resume", "state_ddl",
                    "feed_roundtrip", "state_table", "stream_report", "stream_live_fold", "read_batches", "stream_report_filled", "stream_state_cut",
                    "restore_array"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(q(spark, SF001)) for n, q in QUERIES.items() if n not in RUNS_WHEN_CALLED}


def test_no_cross_or_nested_loop_joins(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_no_python_in_batch_queries(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_fold_one_exchange_and_pruned_scan(plans):
    p = plans["fold"]
    assert p.count("Exchange hashpartitioning") == 1
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "ts" not in scan.split("ReadSchema:")[1]


def test_lookup_cutoff_pushed(plans):
    assert "LessThan(ts,2024-01-16" in plans["lookup"]


@pytest.fixture()
def sort_merge(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_raw_rows_of_a_large_key_are_shuffled_once(spark, sort_merge):
    from tallyfold.operators import history
    from tallyfold.sources.feed import load_feed

    p = plan(history.running_counter(load_feed(spark, SF001, hot=True), range_rows=100))
    # Raw rows by (key, range) once, for the join and the window; the values before each range, read
    # from a table, per key and back to (key, range).
    assert p.count("Exchange hashpartitioning") == 3 and p.count("Exchange") == 3 + p.count("BroadcastExchange")
    assert "SortMergeJoin" in p and "hashpartitioning(_k0" in p or "hashpartitioning(__k0" in p


def test_small_keys_need_no_ranges(spark):
    from tallyfold.operators import history
    from tallyfold.sources.feed import load_feed

    p = plan(history.running_counter(load_feed(spark, SF001)))
    assert p.count("Exchange") == 1 and "Join" not in p


@pytest.mark.parametrize("size", [20, 137, 5000])
def test_no_task_sorts_more_than_a_set_number_of_rows(spark, size):
    """On the hot feed, at any bound: the window's groups, and those of the levels above."""
    from tallyfold.operators import history
    from tallyfold.schema import KEY
    from tallyfold.sources.feed import load_feed

    feed = load_feed(spark, SF01, hot=True, types=("counter", "gauge")).select("seq", "type", "id", "delta")
    seen, one_level = [], history._one_level

    def watch(df, keys, order, specs):
        seen.append(df.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return one_level(df, keys, order, specs)

    history._one_level = watch
    try:
        out = history.running(feed, KEY, "seq", {"n": ("count", None), "s": ("sum", "delta")}, range_rows=size)
    finally:
        history._one_level = one_level
    hot = feed.groupBy(*KEY).count().agg(F.max("count")).first()[0]
    assert hot > 1000 and max(seen) <= max(size, history.LEAST_SUMMARIES)
    assert len(seen) == {20: 4, 137: 2}.get(size, 1)  # levels of summaries
    whole = one_level(feed, KEY, "seq", {"n": ("count", None), "s": ("sum", "delta")})
    assert rows(out, "seq", "n", "s") == rows(whole, "seq", "n", "s")


def test_many_cuts_are_joined_with_salted_keys(spark, monkeypatch):
    from tallyfold.operators import history
    from tallyfold.sources.feed import load_feed

    feed = load_feed(spark, SF001, hot=True).select("seq", "id")
    monkeypatch.setattr(history, "BROADCAST_VALUES", 1)
    out = history.running(feed, ["id"], "seq", {"n": ("count", None)}, range_rows=200)
    assert rows(out, "seq", "n") == rows(history._one_level(feed, ["id"], "seq", {"n": ("count", None)}), "seq", "n")


def test_report_fill_is_one_aggregation(plans):
    p = plans["report_filled"]
    assert "Union" not in p and "Generate" in p


@pytest.mark.parametrize("name", ["unpivot_fold", "sample_intervals", "fold_atomic", "ingest_batches"])
def test_no_raw_rows_are_sorted_to_aggregate(plans, name):
    assert "SortAggregate" not in plans.get(name, "")
