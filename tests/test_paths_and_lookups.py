"""Path-form updates, lookups, listings and the stored state."""


from conftest import rows
from pyspark.sql import functions as F

from tallyfold.operators import fold, listing, lookup, validate
from tallyfold.sources.readers import split_update_path, split_value_path


def _paths(spark, paths):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "seq long, path string")
    return validate.validate(split_update_path(df, "path"), mode="path")


def test_path_updates(spark):
    cases = [
        ("/update/counter/jobs/-12", 200, -12, None), ("/update/gauge/heat/36.6", 200, None, 36.6),
        ("/update/gauge/heat/36,6", 400, None, None), ("/update/counter//3", 404, 3, None),
        ("/update/timer/heat/3", 400, None, None), ("/update/gauge/heat", 404, None, None),
        ("/updates/gauge/heat/3", 404, None, None), ("/update/gauge/heat/3/4", 404, None, None),
    ]
    out = _paths(spark, [c[0] for c in cases]).orderBy("seq").collect()
    assert [(r.status, r.delta, r.value) for r in out] == [c[1:] for c in cases]


def test_path_number_rules(spark):
    good = {"counter": ["+77", "-0", "9223372036854775807", "007"],
            "gauge": ["1e5", "+.25", "7.", "-2.5E-3", "inf", "-Infinity", "nan", "0x1.8p1", "-0XAp-2", "5e-324"]}
    bad = {"counter": ["", " 77", "77 ", "77\n", "7_7", "7e1", "0x7", "-9223372036854775809", "٧"],
           "gauge": ["", " 1", "1\n", "1.0f", "2d", "1e999", "-1e999", ".", "e5", "0x18", "0x1p9999", "1,5", "infin"]}
    cases = {f"/update/{t}/m/{x}": status for status, group in ((200, good), (400, bad)) for t, xs in group.items() for x in xs}
    out = {r.path: r.status for r in _paths(spark, list(cases)).collect()}
    assert out == cases
    assert _paths(spark, ["/update/gauge/m/0x1.8p1"]).first().value == 3.0


def _state(spark):
    upd = spark.createDataFrame(
        [(4, "heat", "gauge", None, 36.6), (5, "jobs", "counter", 40, None), (6, "jobs", "counter", 2, None),
         (7, "", "gauge", None, 0.5)],
        "seq long, id string, type string, delta long, value double",
    )
    return fold.fold(upd)


def test_value_paths(spark):
    want = {
        "/value/counter/jobs": (200, "42"), "/value/gauge/heat": (200, "36.6"), "/value/gauge/jobs": (404, None),
        "/value/counter/heat": (404, None), "/value/timer/heat": (400, None), "/value/gauge/": (200, "0.5"),
        "/elsewhere": (400, None),
    }
    req = spark.createDataFrame([(p,) for p in want], "path string")
    out = lookup.lookup(split_value_path(req), _state(spark), form="path")
    assert {r.path: (r.status, r.text) for r in out.collect()} == want


def test_json_lookups(spark):
    req = spark.createDataFrame(
        [("jobs", "counter"), ("heat", "gauge"), ("cold", "gauge"), ("heat", "timer"), (None, "gauge"), ("heat", None)],
        "id string, type string")
    state = _state(spark)
    out = {(r.id, r.type): (r.status, r.delta, r.value) for r in lookup.lookup(req, state).collect()}
    assert out == {("jobs", "counter"): (200, 42, None), ("heat", "gauge"): (200, None, 36.6), ("cold", "gauge"): (404, None, None),
                   ("heat", "timer"): (501, None, None), ("", "gauge"): (200, None, 0.5), ("heat", None): (501, None, None)}
    assert rows(lookup.lookup_hits(req, state), "id") == [("heat",), ("jobs",)]
    # a request of unknown type is refused, it is not a miss
    assert rows(lookup.lookup_misses(req.where("id is not null"), state), "id") == [("cold",)]


def test_lookup_one_pushdown(spark, tmp_dir):
    from tallyfold.sources.store import read_state, write_state

    write_state(_state(spark), f"{tmp_dir}/state")
    q = lookup.lookup_one(read_state(spark, f"{tmp_dir}/state"), "gauge", "heat")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan and "EqualTo(id,heat)" in plan
    assert [r.value for r in q.collect()] == [36.6]


def test_report_lines(spark):
    lines = [r.line for r in listing.render_report(_state(spark)).orderBy("section", "id").collect()]
    assert lines == ["gauge  = 0.500000", "gauge heat = 36.600000", "counter jobs = 42"]


def test_split_and_all_metrics(spark):
    s = _state(spark)
    g, c = listing.split_state(s)
    assert rows(g, "id", "value") == [("", 0.5), ("heat", 36.6)]
    assert rows(c, "id", "delta") == [("jobs", 42)]
    back = listing.all_metrics(g, c).select("type", "id", "delta", "value")
    assert rows(back) == rows(s.select("type", "id", "delta", "value"))
    assert [r.id for r in listing.list_metrics(s).collect()] == ["jobs", "", "heat"]


def test_merge_forms_agree_on_null_names(spark):
    upd = "seq long, id string, type string, delta long, value double"
    old = fold.fold(spark.createDataFrame([(1, None, "counter", 5, None)], upd))
    new = spark.createDataFrame([(2, None, "counter", 7, None)], upd)
    cols = ("type", "id", "delta", "value", "last_seq")
    assert rows(fold.merge_state(old, new), *cols) == rows(fold.merge_state_join(old, new), *cols) == [("counter", None, 12, None, 2)]


def test_state_files_are_sorted_by_name(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from tallyfold.sources.store import write_state

    state = spark.range(500).selectExpr("'gauge' type", "concat('m', hash(id)) id", "cast(null as bigint) delta",
                                        "cast(id as double) value", "id last_seq")
    write_state(state.unionByName(state.withColumn("type", F.lit("counter"))), f"{tmp_dir}/state")
    files = glob.glob(f"{tmp_dir}/state/type=*/*.parquet")
    assert files
    for f in files:
        ids = pq.read_table(f, columns=["id"]).column("id").to_pylist()
        assert ids == sorted(ids)


def test_same_name_in_both_types(spark):
    upd = spark.createDataFrame(
        [(1, "x", "gauge", None, 1.5), (2, "x", "counter", 3, None), (3, "x", "counter", 4, None)],
        "seq long, id string, type string, delta long, value double")
    assert rows(fold.fold(upd), "type", "id", "delta", "value") == [
        ("counter", "x", 7, None), ("gauge", "x", None, 1.5)]


def test_salted_lookup_equals_plain(spark):
    from conftest import SF01
    from pyspark.sql import functions as F

    from tallyfold.sources.feed import load_feed

    feed = load_feed(spark, SF01, hot=True)
    state = fold.fold(feed.where(F.col("seq") < 5000))
    req = feed.select("seq", "type", "id")
    cols = ("seq", "type", "id", "status", "delta", "value")
    assert rows(lookup.lookup(req, state, salt_buckets=8), *cols) == rows(lookup.lookup(req, state), *cols)


def scanned_rows(df):
    """Rows that the file scan handed on: those of row groups and pages that could not be skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while "Scan" not in plan.nodeName():
        plan = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_a_lookup_that_misses_reads_no_row_group(spark, tmp_path):
    from pyspark.sql import functions as F

    from tallyfold.operators.lookup import lookup_one
    from tallyfold.sources import store

    n = 20_000
    state = spark.range(n).select(F.lit("counter").alias("type"), F.format_string("id%06d", F.col("id") * 2).alias("id"),
                                  F.col("id").alias("delta"), F.lit(None).cast("double").alias("value"), F.col("id").alias("last_seq"))
    store.write_state(state, f"{tmp_path}/with", ids_per_file=n)
    state.write.partitionBy("type").parquet(f"{tmp_path}/without")
    absent = [f"id{i:06d}" for i in range(101, 301, 20)]  # within the bounds of every file, odd: not there
    read = {kind: [scanned_rows(lookup_one(store.read_state(spark, f"{tmp_path}/{kind}"), "counter", i)) for i in absent]
            for kind in ("with", "without")}
    assert sum(x > 0 for x in read["with"]) <= 1 and all(x > 0 for x in read["without"])
    assert lookup_one(store.read_state(spark, f"{tmp_path}/with"), "counter", "id000200").collect()[0]["delta"] == 100
