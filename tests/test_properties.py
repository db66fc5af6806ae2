"""Property tests: operators against small Python models on random inputs.

Each example is one Spark job, so examples are few but each carries many
rows."""

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyfold.functions.numtext import format_shortest
from tallyfold.operators import fold, history, validate

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

update = st.tuples(
    st.sampled_from(["gauge", "counter", "other"]),
    st.sampled_from(["a", "b", "c", "d"]),
    st.one_of(st.none(), st.integers(-1000, 1000)),
    st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
)
feeds = st.lists(update, min_size=1, max_size=60)


def _df(spark, feed, offset=0):
    data = [(i + offset, t, k, d, v) for i, (t, k, d, v) in enumerate(feed)]
    return spark.createDataFrame(data, "seq long, type string, id string, delta long, value double")


def model_fold(feed, offset=0):
    state = {}
    for i, (t, k, d, v) in enumerate(feed):
        seq = i + offset
        if t == "gauge" and v is not None:
            state[(t, k)] = (None, v, seq)
        elif t == "counter" and d is not None:
            old = state.get((t, k), (0, None, None))[0]
            state[(t, k)] = (old + d, None, seq)
    return sorted(((t, k) + s for (t, k), s in state.items()), key=repr)


@SETTINGS
@given(feeds)
def test_fold_matches_model(spark, feed):
    assert rows(fold.fold(_df(spark, feed)), "type", "id", "delta", "value", "last_seq") == model_fold(feed)


@SETTINGS
@given(feeds, feeds)
def test_merge_law_any_arrival_order(spark, a, b):
    da, db = _df(spark, a), _df(spark, b, offset=len(a))
    whole = model_fold(a + b)
    cols = ("type", "id", "delta", "value", "last_seq")
    assert rows(fold.merge_state(fold.fold(da), db), *cols) == whole
    assert rows(fold.merge_state(fold.fold(db), da), *cols) == whole
    assert rows(fold.merge_state_join(fold.fold(db), da), *cols) == whole


@SETTINGS
@given(feeds, st.integers(1, 7))
def test_two_level_running_matches_one_level(spark, feed, bucket):
    df = _df(spark, feed)
    specs = {"s": ("sum", "delta"), "n": ("count", None), "l": ("last", "value"), "p": ("prev", "delta"),
             "t": ("total", "delta")}
    one = history.running(df, ["type", "id"], "seq", specs, range_rows=None)
    two = history.running(df, ["type", "id"], "seq", specs, range_rows=bucket)
    assert rows(two) == rows(one)


@SETTINGS
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=200))
def test_shortest_text_round_trips(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.s for r in df.select("v", format_shortest("v").alias("s")).collect()]
    for v, s in zip(values, got):
        assert "E" not in s and "e" not in s
        assert float(s) == v or (v == 0 and float(s) == 0)
        if v == int(v) and abs(v) < 1e15:
            assert "." not in s


@SETTINGS
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=200))
def test_shortest_text_is_shortest_for_java_repr(spark, values):
    # Digits never exceed the 17 significant digits a double can need.
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select(format_shortest("v").alias("s")).collect():
        digits = r.s.lstrip("-").replace(".", "").lstrip("0").rstrip("0")
        assert len(digits) <= 17


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), update), min_size=1, max_size=60))
def test_strict_batches_apply_prefix(spark, items):
    data = [(b, i, t, k, d, v) for i, (b, (t, k, d, v)) in enumerate(items)]
    df = spark.createDataFrame(data, "batch_id int, seq long, type string, id string, delta long, value double")
    got = rows(validate.validate(df, "batch_strict"), "seq", "status")
    want = []
    for b in sorted({x[0] for x in items}):
        mine = [(i, t, d, v) for i, (bb, (t, k, d, v)) in enumerate(items) if bb == b]
        bad = [i for i, t, d, v in mine if not ((t == "gauge" and v is not None) or (t == "counter" and d is not None))]
        first = min(bad) if bad else None
        status = 400 if bad else 200
        want += [(i, status) for i, *_ in mine if first is None or i < first]
    assert got == sorted(want, key=repr)


requests = st.lists(st.tuples(st.sampled_from(["gauge", "counter", "other"]), st.sampled_from(["a", "b", "c", "z"])),
                    min_size=1, max_size=40)


@SETTINGS
@given(feeds, requests, st.sampled_from(["json", "path"]))
def test_lookup_matches_model(spark, feed, reqs, form):
    from tallyfold.operators import lookup

    state = {(t, k): (d, v) for t, k, d, v, _ in model_fold(feed)}
    req = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(reqs)], "rid long, type string, id string")
    got = rows(lookup.lookup(req, fold.fold(_df(spark, feed)), form=form), "rid", "status", "delta", "value")
    want = []
    for i, (t, k) in enumerate(reqs):
        if t not in ("gauge", "counter"):
            want.append((i, 501 if form == "json" else 400, None, None))
        elif (t, k) not in state:
            want.append((i, 404, None, None))
        else:
            d, v = state[(t, k)]
            want.append((i, 200, d, v))
    assert got == sorted(want, key=repr)


@SETTINGS
@given(feeds)
def test_report_intervals_matches_model(spark, feed):
    import datetime as dt

    from pyspark.sql import functions as F

    from tallyfold.operators import sampling

    base = dt.datetime(2024, 1, 1)
    df = _df(spark, feed).withColumn("ts", (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("seq") * 7).cast("int"))))
    got = rows(sampling.report_intervals(df, "1 hour"), "win_start", "type", "id", "delta", "value")
    per, totals = {}, {}
    for i, (t, k, d, v) in enumerate(feed):
        hour = base + dt.timedelta(hours=(i * 7) // 60)
        if t == "gauge" and v is not None:
            per.setdefault((hour, t, k), [None, None])[1] = v
        elif t == "counter" and d is not None:
            slot = per.setdefault((hour, t, k), [0, None])
            slot[0] = (slot[0] or 0) + d
    want = []
    for (hour, t, k) in sorted(per, key=lambda x: x[0]):
        d, v = per[(hour, t, k)]
        if t == "counter":
            totals[k] = totals.get(k, 0) + d
            want.append((hour, t, k, totals[k], None))
        else:
            want.append((hour, t, k, None, v))
    assert got == sorted(want, key=repr)


@SETTINGS
@given(st.lists(st.floats(min_value=-1e29, max_value=1e29, allow_nan=False), min_size=1, max_size=200))
def test_fixed6_matches_correctly_rounded_printf(spark, values):
    from tallyfold.functions.numtext import format_fixed6

    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.f for r in df.select(format_fixed6("v").alias("f")).collect()]
    assert got == ["%f" % v for v in values]
