"""Samples to updates: wide rows and arrays to gauge rows, interval reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.functions.numtext import indexed_name
from tallyfold.functions.timeutil import with_interval
from tallyfold.operators.fold import valid_updates
from tallyfold.operators.history import DEFAULT_RANGE_ROWS, running
from tallyfold.schema import COUNTER, GAUGE, KEY

# The runtime memory statistics the agent reports as gauges,
# one column each in a wide sample.
RUNTIME_GAUGES = (
    "Alloc", "BuckHashSys", "Frees", "GCCPUFraction", "GCSys", "HeapAlloc", "HeapIdle", "HeapInuse",
    "HeapObjects", "HeapReleased", "HeapSys", "LastGC", "Lookups", "MCacheInuse", "MCacheSys",
    "MSpanInuse", "MSpanSys", "Mallocs", "NextGC", "NumForcedGC", "NumGC", "OtherSys", "PauseTotalNs",
    "StackInuse", "StackSys", "Sys", "TotalAlloc",
)
# The host statistics that join the same stream.
HOST_GAUGES = ("TotalMemory", "FreeMemory")
CPU_PREFIX = "CPUutilization"
RANDOM_GAUGE = "RandomValue"
POLL_COUNTER = "PollCount"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gauge_rows(df: DataFrame, id_col: Column | str, value_col: Column | str, keep: Sequence[str] = ()) -> DataFrame:
    """Gauge update rows ``(type, id, delta, value)`` from an id and a value."""
    c = _c
    return df.select(*keep, F.lit(GAUGE).alias("type"), c(id_col).alias("id"),
                     F.lit(None).cast("bigint").alias("delta"), c(value_col).cast("double").alias("value"))


def counter_rows(df: DataFrame, id_col: Column | str, delta_col: Column | str, keep: Sequence[str] = ()) -> DataFrame:
    """Counter update rows ``(type, id, delta, value)`` from an id and a delta."""
    c = _c
    return df.select(*keep, F.lit(COUNTER).alias("type"), c(id_col).alias("id"),
                     c(delta_col).cast("bigint").alias("delta"), F.lit(None).cast("double").alias("value"))


def unpivot_sample(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Wide sample -> one gauge row per named column (``id`` = column name)."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    long = typed.unpivot(list(ids), list(cols), "id", "value")
    return long.select(*ids, F.lit(GAUGE).alias("type"), "id", F.lit(None).cast("bigint").alias("delta"), "value")


def explode_indexed(df: DataFrame, prefix: str, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Array sample -> one gauge row per element, named ``prefix{i}`` (1-based)."""
    e = df.select(*keep, F.posexplode(F.col(col)).alias("_pos", "_v"))
    return e.select(*keep, F.lit(GAUGE).alias("type"), indexed_name(prefix, "_pos").alias("id"),
                    F.lit(None).cast("bigint").alias("delta"), F.col("_v").cast("double").alias("value"))


def with_random_gauge(df: DataFrame, seed: int | None = None, name: str = "RandomValue") -> DataFrame:
    """Add a uniform [0, 1) gauge per sample row as ``id``/``value``."""
    r = F.rand(seed) if seed is not None else F.rand()
    return df.withColumn("random_id", F.lit(name)).withColumn("random_value", r)


def report_intervals(df: DataFrame, every: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Per report interval and metric touched in it: the gauge's newest value,
    or the counter's running total through the end of the interval.

    The interval aggregate is partial (map-side); the running total runs per
    key over its intervals, whose number is bounded by the time span."""
    v = with_interval(valid_updates(df), ts, every)
    t = F.col("type")
    per = v.groupBy("win_start", *KEY).agg(
        F.sum(F.when(t == COUNTER, F.col("delta"))).alias("_d"),
        F.max_by(F.when(t == GAUGE, F.col("value")), F.col(seq)).alias("value"),
    )
    w = W.partitionBy(*KEY).orderBy("win_start").rowsBetween(W.unboundedPreceding, W.currentRow)
    return per.select("win_start", *KEY, F.sum("_d").over(w).alias("delta"), "value")


def report_filled(df: DataFrame, every: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Like :func:`report_intervals`, but every metric seen so far is
    reported again in each later interval (the agent re-sends all gauges
    each report), up to the last interval of the feed.

    Each report is repeated until the interval before the key's next report
    (or the feed's last one, a scalar subquery): one aggregation, no join and
    no union, and arrays only as long as a gap.  A metric without an interval
    (no time) is not repeated."""
    base = report_intervals(df, every, ts, seq)
    last_win = with_interval(valid_updates(df), ts, every).select(F.max("win_start")).scalar()
    step = F.expr(f"INTERVAL {every}")
    by_key = W.partitionBy(*KEY).orderBy("win_start")
    carried = base.select(
        "win_start", *KEY, "delta",
        F.last("value", ignorenulls=True).over(by_key.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("value"),
        F.lead("win_start").over(by_key).alias("_next"),
    )
    until = F.coalesce(F.col("_next") - step, last_win)
    wins = F.when(F.col("win_start").isNull(), F.array(F.col("win_start"))).otherwise(
        F.sequence(F.col("win_start"), until, step))
    return carried.select(F.explode(wins).alias("win_start"), *KEY, "delta", "value")


def sample_intervals(df: DataFrame, every: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Poll sampling: the newest row of each interval.

    The newest ``seq`` per interval is a hash aggregate of two numbers; the
    rows are then found by a semi join on it, so no raw row is sorted.
    ``seq`` must be unique."""
    cut = with_interval(df, ts, every)
    newest = cut.groupBy("win_start").agg(F.max(seq).alias(seq)).select(seq)
    return cut.join(newest, seq, "left_semi").select("win_start", seq, *[c for c in df.columns if c != seq])


def host_rows(samples: DataFrame, cpus: str = "cpus", seq: str = "seq", ts: str = "ts") -> DataFrame:
    """Host samples (total and free memory, an array of CPU shares) -> gauge
    rows, one per memory figure and one per CPU (1-based)."""
    memory = unpivot_sample(samples, [seq, ts], HOST_GAUGES)
    return memory.unionByName(explode_indexed(samples, CPU_PREFIX, cpus, keep=(seq, ts)))


def report_rows(
    samples: DataFrame,
    gauge_cols: Sequence[str] = RUNTIME_GAUGES,
    seq: str = "seq",
    ts: str = "ts",
    seed: int | None = None,
    range_rows: int | None = DEFAULT_RANGE_ROWS,
) -> DataFrame:
    """The agent's report for each wide sample: one gauge per named column,
    a ``RandomValue`` gauge in [0, 1), and the ``PollCount`` counter carrying
    the number of samples taken so far (a running count in ``seq`` order,
    two-level so a long sample history is not sorted in one task).

    Output: ``seq, ts, type, id, delta, value``."""
    gauges = unpivot_sample(samples, [seq, ts], gauge_cols)
    rnd = F.rand(seed) if seed is not None else F.rand()
    random_rows = samples.select(
        seq, ts, F.lit(GAUGE).alias("type"), F.lit(RANDOM_GAUGE).alias("id"),
        F.lit(None).cast("bigint").alias("delta"), rnd.alias("value"),
    )
    counted = running(samples.select(seq, ts), [], seq, {"_n": ("count", None)}, range_rows)
    polls = counted.select(
        seq, ts, F.lit(COUNTER).alias("type"), F.lit(POLL_COUNTER).alias("id"),
        F.col("_n").cast("bigint").alias("delta"), F.lit(None).cast("double").alias("value"),
    )
    return gauges.unionByName(random_rows).unionByName(polls)


def ship_samples(
    samples: DataFrame,
    max_size: int,
    every: str,
    gauge_cols: Sequence[str] = RUNTIME_GAUGES,
    seq: str = "seq",
    ts: str = "ts",
    seed: int | None = None,
) -> DataFrame:
    """Wide samples -> report rows -> size-or-interval batches -> one JSON
    payload per batch (``win_start, batch_no, n_rows, first_seq, last_seq,
    payload``).  Rows of one sample keep their column order inside a batch
    through a fine-grained order key ``(seq, metric index)``."""
    from tallyfold.operators.batching import assign_batches, encode_batches, require_bounded

    require_bounded(max_size)
    rows = report_rows(samples, gauge_cols, seq, ts, seed)
    names = list(gauge_cols) + [RANDOM_GAUGE, POLL_COUNTER]
    idx = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("id"))
    ordered = rows.withColumn("_o", F.col(seq) * F.lit(len(names) + 1) + idx).drop(seq).withColumnRenamed("_o", "seq")
    return encode_batches(assign_batches(ordered, max_size, every), max_size=max_size)
