"""Running windows (incl. a hot key), batching, sampling, delivery outcomes."""

import pytest
from conftest import SF001, SF01, rows
from pyspark.sql import functions as F

from tallyfold.functions.codes import classify_delivery, is_retriable_sqlstate
from tallyfold.operators import batching, delivery, history, sampling
from tallyfold.sources.feed import load_feed
from tallyfold.sources.readers import decode_batches


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of the rows and more fall on one hot key.
    f = load_feed(spark, SF01)
    hot = F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("id"))
    return f.withColumn("id", hot).withColumn(
        "type", F.when(F.col("seq") % 3 == 0, F.lit("counter")).otherwise(F.col("type"))
    ).withColumn("delta", F.when(F.col("seq") % 3 == 0, F.col("seq") % 7).otherwise(F.col("delta"))).cache()


SPECS = {"s": ("sum", "delta"), "n": ("count", None), "l": ("last", "value"), "p": ("prev", "delta")}


@pytest.mark.parametrize("bucket", [1, 2, 7, 64])
def test_two_level_equals_one_level(skewed, bucket):
    base = skewed.select("seq", "type", "id", "delta", "value")
    one = history.running(base, ["type", "id"], "seq", SPECS, range_rows=None)
    two = history.running(base, ["type", "id"], "seq", SPECS, range_rows=bucket)
    assert rows(two) == rows(one)


def test_two_level_null_keys(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 2), (3, "a", 5), (4, None, 3)], "seq long, k string, d long")
    got = rows(history.running(df, ["k"], "seq", {"s": ("sum", "d")}, range_rows=2), "seq", "s")
    assert got == [(1, 1), (2, 3), (3, 5), (4, 6)]


@pytest.mark.parametrize("key", ["string", "struct<a:int>", "binary"])
def test_two_level_keeps_rows_without_key_or_order(spark, key):
    df = spark.range(12).select(
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("seq"), F.col("id").alias("d"),
        F.when(F.col("id") % 3 != 0, F.lit("x").cast("binary").cast("string")).alias("k0"))
    made = {"string": F.col("k0"), "struct<a:int>": F.when(F.col("k0").isNotNull(), F.struct(F.lit(1).alias("a"))),
            "binary": F.col("k0").cast("binary")}[key]
    df = df.withColumn("k", made).drop("k0")
    specs = {"n": ("count", None), "t": ("total", "d")}
    one, two = (history.running(df, ["k"], "seq", specs, range_rows=r) for r in (None, 4))
    assert sorted(map(str, two.select("d", "t").collect())) == sorted(map(str, one.select("d", "t").collect()))
    ordered = [sorted(map(str, x.where("seq is not null").collect())) for x in (one, two)]
    assert ordered[0] == ordered[1] and two.count() == 12


def test_rows_without_a_time_are_batched(spark):
    df = spark.createDataFrame([(1, None), (2, "2024-02-03 04:05:06"), (3, None)], "seq long, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    for size in (0, 1):
        out = batching.assign_batches(df, size, "1 day")
        assert rows(out.where("win_start is null"), "seq") == [(1,), (3,)] and out.count() == 3


def test_cumulative_to_delta_resets(spark):
    upd = spark.createDataFrame(
        [(1, "PollCount", "counter", 3, None), (2, "PollCount", "counter", 5, None),
         (3, "PollCount", "counter", 9, None), (4, "PollCount", "counter", 2, None), (5, "PollCount", "counter", 4, None)],
        "seq long, id string, type string, delta long, value double")
    got = [r.delta for r in history.cumulative_to_delta(upd, range_rows=2).orderBy("seq").collect()]
    assert got == [3, 2, 4, 2, 2]


def test_replay_reads(spark):
    upd = spark.createDataFrame(
        [(1, "c", "counter", None, None), (2, "c", "counter", 2, None), (3, "c", "counter", None, None),
         (4, "c", "counter", 5, None), (5, "c", "counter", None, None), (6, "g", "gauge", None, None),
         (7, "g", "gauge", None, 1.5), (8, "g", "gauge", None, None)],
        "seq long, id string, type string, delta long, value double")
    got = rows(history.replay_reads(upd, range_rows=3), "seq", "status", "delta", "value")
    assert got == [(1, 404, None, None), (3, 200, 2, None), (5, 200, 7, None), (6, 404, None, None), (8, 200, None, 1.5)]


def test_update_rank_and_gauge_asof(spark):
    f = load_feed(spark, SF001)
    r = history.update_rank(f, range_rows=50)
    assert r.groupBy("type", "id").agg(F.max("rank").alias("m"), F.count("*").alias("n")).where("m != n").count() == 0
    g = history.running_gauge(f, range_rows=50)
    assert g.where("value IS NOT NULL AND value_asof != value").count() == 0


def test_assign_batches_size_and_ticks(spark):
    f = load_feed(spark, SF01)
    b = batching.assign_batches(f, 100, "1 day", range_rows=300)
    sizes = b.groupBy("win_start", "batch_no").count()
    assert sizes.where("count > 100").count() == 0
    assert b.count() == f.count()
    assert batching.assign_batches(f, 0, "1 day").select("batch_no").distinct().count() == 1


def test_encode_decode_roundtrip(spark):
    f = load_feed(spark, SF001)
    enc = batching.encode_batches(batching.assign_batches(f, 50, "1 day"))
    dec = decode_batches(enc, "payload", keep=("first_seq",)).withColumn("seq", F.col("first_seq") + F.col("pos"))
    assert rows(dec, "seq", "id", "type", "delta", "value") == rows(f, "seq", "id", "type", "delta", "value")


def test_unpivot_and_explode(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    long = sampling.unpivot_sample(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])
    assert long.count() == 2 * li.count()
    assert {r.id for r in long.select("id").distinct().collect()} == {"l_quantity", "l_tax"}
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    e = sampling.explode_indexed(emb, "CPUutilization", "embedding", keep=("vec_id",))
    n = emb.select(F.sum(F.size("embedding"))).first()[0]
    assert e.count() == n and e.where("id = 'CPUutilization1'").count() == emb.count()


def test_random_gauge_range(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey")
    r = sampling.with_random_gauge(li, seed=1).agg(F.min("random_value").alias("lo"), F.max("random_value").alias("hi")).first()
    assert 0.0 <= r.lo and r.hi < 1.0


def test_gauge_and_counter_rows(spark):
    df = spark.createDataFrame([("x", 1.5, 3)], "n string, v double, d long")
    g = sampling.gauge_rows(df, "n", "v").first()
    c = sampling.counter_rows(df, F.lit("PollCount"), "d").first()
    assert (g.type, g.id, g.value, g.delta) == ("gauge", "x", 1.5, None)
    assert (c.type, c.id, c.delta, c.value) == ("counter", "PollCount", 3, None)


def test_report_filled_carries_forward(spark):
    upd = spark.createDataFrame(
        [(1, "2024-01-01 00:10:00", "g", "gauge", None, 1.0), (2, "2024-01-01 02:10:00", "c", "counter", 4, None),
         (3, "2024-01-01 03:10:00", "c", "counter", 1, None)],
        "seq long, ts string, id string, type string, delta long, value double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = rows(sampling.report_filled(upd, "1 hour"), "id", "delta", "value")
    assert out == sorted([("g", None, 1.0)] * 4 + [("c", 4, None), ("c", 5, None)], key=repr)
    assert sampling.report_intervals(upd, "1 hour").count() == 3
    s = sampling.sample_intervals(upd, "2 hours").orderBy("win_start").collect()
    assert [r.seq for r in s] == [1, 3]


def test_classify_and_sqlstate(spark):
    df = spark.createDataFrame([(s,) for s in [200, 500, 502, 503, 504, 404, 400, 301, None]], "s int")
    single = [r.c for r in df.select(classify_delivery("s", "single").alias("c")).collect()]
    batch = [r.c for r in df.select(classify_delivery("s", "batch").alias("c")).collect()]
    assert single == ["ok", "ok", "temporary", "temporary", "temporary", "client_error", "client_error", "ok", "temporary"]
    assert batch == ["ok", "server_error", "temporary", "temporary", "temporary", "client_error", "client_error", "server_error", "temporary"]
    st = spark.createDataFrame([("08006",), ("57P03",), ("23505",), (None,)], "s string")
    assert [r.r for r in st.select(is_retriable_sqlstate("s").alias("r")).collect()] == [True, True, False, False]


def test_delivery_outcome(spark):
    att = spark.createDataFrame(
        [(11, 1, 201), (12, 1, None), (12, 2, 504), (12, 3, 200), (13, 1, 404), (13, 2, 404), (14, 1, 500),
         *[(15, n, 502) for n in range(1, 5)], *[(16, n, 503) for n in range(1, 5)], (16, 5, 200),
         *[(17, n, None) for n in range(1, 8)]],
        "request_id long, attempt int, http_status int")
    cols = ("request_id", "success_at", "attempts", "outcome", "wait_s")
    assert rows(delivery.delivery_outcome(att, "single"), *cols) == [
        (11, 1, 1, "delivered", 0), (12, 3, 3, "delivered", 4), (13, None, 2, "failed", 1), (14, 1, 1, "delivered", 0),
        (15, None, 4, "failed", 9), (16, 5, 5, "over_limit", None), (17, None, 7, "over_limit", None)]
    batch = {r.request_id: r.outcome for r in delivery.delivery_outcome(att, "batch").collect()}
    assert batch[11] == batch[14] == "failed" and batch[12] == "delivered"


def test_database_attempts_end_at_the_first_state_that_is_not_retriable(spark):
    att = spark.createDataFrame(
        [(1, 1, "08006"), (1, 2, None), (2, 1, "57P03"), (2, 2, "23505"), (2, 3, None), (3, 1, "08001"), (3, 2, "08001")],
        "request_id long, attempt int, sqlstate string")
    assert rows(delivery.delivery_outcome(att, "database"), "request_id", "success_at", "attempts", "outcome", "wait_s") == [
        (1, 2, 2, "delivered", 1), (2, None, 2, "failed", 1), (3, None, 2, "failed", 1)]


def test_host_rows(spark):
    df = spark.createDataFrame([(5, 16e9, 4e9, [0.5, 99.5])], "seq long, TotalMemory double, FreeMemory double, cpus array<double>")
    df = df.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert rows(sampling.host_rows(df), "id", "value") == sorted(
        [("TotalMemory", 16e9), ("FreeMemory", 4e9), ("CPUutilization1", 0.5), ("CPUutilization2", 99.5)])


def _wide_samples(spark, n=25):
    # Wide samples with the agent's runtime columns, values derived from lineitem.
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").limit(n)
    w = li.select(F.monotonically_increasing_id().alias("seq"), F.col("l_shipdate").alias("ts"), "l_quantity")
    return w.select("seq", "ts", *[(F.col("l_quantity") + i).alias(c) for i, c in enumerate(sampling.RUNTIME_GAUGES)]).cache()


def test_report_rows(spark):
    s = _wide_samples(spark)
    r = sampling.report_rows(s, seed=3)
    ids = {x.id for x in r.select("id").distinct().collect()}
    assert {"Alloc", "TotalAlloc", "NextGC", "NumGC", "RandomValue", "PollCount"} <= ids
    assert len(ids) == 29 and r.count() == 29 * 25
    rv = r.where("id = 'RandomValue'").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    assert 0.0 <= rv.lo and rv.hi < 1.0
    polls = [x.delta for x in r.where("id = 'PollCount'").orderBy("seq").collect()]
    assert polls == list(range(1, 26))


def test_ship_samples(spark):
    s = _wide_samples(spark)
    out = sampling.ship_samples(s, 50, "1 day", seed=3)
    assert out.agg(F.sum("n_rows")).first()[0] == 29 * 25
    assert out.where("n_rows > 50").count() == 0
    dec = decode_batches(out, "payload")
    assert dec.where("id = 'PollCount'").count() == 25


def test_unbounded_payloads_refused(spark):
    s = _wide_samples(spark, 3)
    with pytest.raises(ValueError):
        sampling.ship_samples(s, 0, "1 day")


def test_payloads_need_bounded_batches(spark, monkeypatch):
    f = load_feed(spark, SF001)
    uncapped = batching.assign_batches(f, 0, "1000 days")
    monkeypatch.setattr(batching, "MOST_ROWS", 500)
    with pytest.raises(ValueError, match="size cap"):
        batching.encode_batches(uncapped)
    with pytest.raises(Exception, match="more than 20 rows"):
        batching.encode_batches(batching.assign_batches(f, 30, "1 day"), max_size=20).collect()
    assert batching.encode_batches(batching.assign_batches(f, 30, "1 day"), max_size=30).agg(F.sum("n_rows")).first()[0] == f.count()
