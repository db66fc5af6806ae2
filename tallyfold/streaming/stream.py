"""Structured Streaming forms of the fold, merge, report and batching.

* :func:`stream_fold` - the live fold; ``complete`` or ``update`` output.
* :func:`start_snapshots` - the live fold written as a full snapshot every
  trigger interval (periodic snapshot; default 300 s).
* :func:`start_merge` - each micro-batch merged into a durable state table
  kept as version directories ``v=<batch_id>``.  A micro-batch reads the
  newest version below its id and overwrites version ``batch_id``, so a
  replayed batch after a failure rewrites the same version and never adds
  twice.  It rewrites the whole state per micro-batch.
* :func:`start_live_fold` - the fold kept in Spark's state store, writing
  only the keys each micro-batch changed (a change log with compaction);
  its work follows the changes, not the state size.
* :func:`stream_report` - tumbling interval report with a watermark;
  :func:`start_report` writes it as change versions, open intervals included.
* :mod:`tallyfold.streaming.timers` - reports that re-send every metric and
  size-or-interval payloads, with timers.
* :func:`read_state_store` - the fold read from the state store itself, all keys
  as of one micro-batch.

Order inside the stream is the ``seq`` column (source offset or event id),
never processing time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.timeutil import utc_instant, utc_wall
from tallyfold.operators import fold
from tallyfold.schema import COUNTER, GAUGE, KEY, STATE, STATE_COLS
from tallyfold.session import scratch_path, with_state_store
from tallyfold.sources import buckets as state_buckets
from tallyfold.sources.feed import feed_from_events
from tallyfold.sources.store import (  # noqa: F401  (version helpers are part of this module's API)
    VERSION_PREFIX,
    _fs,
    committed_versions,
    latest_version,
    prune_versions,
    read_version,
    restore_snapshot,
    version_path,
)


def feed_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None,
                glob: str = "events*.parquet") -> DataFrame:
    """The update feed read as a stream from the events files in ``sf_dir``
    (files are taken in modification-time order).  ``ts`` stays
    TIMESTAMP_NTZ, like the batch feed, so intervals align the same way;
    :func:`stream_report` casts it where a watermark needs TIMESTAMP."""
    sample = spark.read.option("pathGlobFilter", glob).parquet(sf_dir)
    r = spark.readStream.schema(sample.schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    events = r.parquet(sf_dir)
    return feed_from_events(events)


def stream_fold(src: DataFrame) -> DataFrame:
    """Live fold of a streaming feed (one stateful aggregate)."""
    return fold.fold(src)


# ---------------------------------------------------------------- sinks


def start_snapshots(src: DataFrame, path: str, checkpoint: str, interval: str | None = "300 seconds",
                    available_now: bool = False, buckets: int | None = None):
    """Periodic snapshot of the live fold: the complete state is written as a
    new version each trigger.  ``interval=None`` and not ``available_now``
    means no snapshots at all (``STORE_INTERVAL=0``).  With ``buckets`` a version
    holds the changed hash buckets only (:mod:`tallyfold.sources.buckets`)."""
    agg = stream_fold(src)

    def write(batch: DataFrame, batch_id: int) -> None:
        if buckets:
            state_buckets.publish(batch, path, batch_id, buckets)
            return
        batch.select(*STATE_COLS).write.mode("overwrite").parquet(version_path(path, batch_id))
        prune_versions(batch.sparkSession, path)

    w = agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    else:
        return None
    return w.start()


def merge_micro_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str,
                      initial: DataFrame | None = None) -> None:
    """Merge one micro-batch into version ``batch_id - 1``, write ``batch_id``."""
    # Always the newest version older than this batch: a replayed batch (after
    # a failure between write and commit) rebuilds the same version.
    prev = latest_version(spark, root, below=batch_id)
    if prev is None:
        base = initial if initial is not None else spark.createDataFrame([], STATE)
    else:
        base = read_version(spark, root, prev)
    merged = fold.merge_state(base, batch.select("seq", "type", "id", "delta", "value"))
    merged.select(*STATE_COLS).write.mode("overwrite").parquet(version_path(root, batch_id))
    prune_versions(spark, root)


def observe_ingest(src: DataFrame, name: str = "ingest") -> DataFrame:
    """Attach live ingest statistics to a feed: rows seen and rows applied
    per micro-batch, reported in ``StreamingQueryProgress.observedMetrics``
    under ``name`` (no extra job)."""
    return src.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(fold.is_valid_update(), F.lit(1))).alias("applied"),
    )


def start_merge(src: DataFrame, root: str, checkpoint: str, initial_path: str | None = None,
                available_now: bool = True, interval: str | None = None, buckets: int | None = None):
    """Fold a stream into the durable state table at ``root`` (versions).
    Each micro-batch's progress carries ``observedMetrics["ingest"]``.  With
    ``buckets`` a micro-batch reads and writes only the hash buckets that it
    touches (:mod:`tallyfold.sources.buckets`); without, the whole state."""
    spark = src.sparkSession
    src = observe_ingest(src)

    def write(batch: DataFrame, batch_id: int) -> None:
        init = restore_snapshot(spark, initial_path) if initial_path else None
        if buckets:
            state_buckets.merge(batch, root, batch_id, init, buckets)
            return
        merge_micro_batch(spark, batch, batch_id, root, init)

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "10 seconds")
    return w.start()


def stream_report(src: DataFrame, every: str, delay: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Tumbling interval report on a stream: per interval and metric, the
    newest gauge value and the counter sum within the interval.  Rows later
    than the watermark ``delay`` are dropped by rule (Spark counts them in
    ``numRowsDroppedByWatermark``); an interval is emitted once it closes.
    A TIMESTAMP_NTZ event time is taken as UTC, so intervals align the same
    in every session time zone."""
    v = fold.valid_updates(src)
    ntz = dict(v.dtypes)[ts] == "timestamp_ntz"
    if ntz:
        v = v.withColumn(ts, utc_instant(F.col(ts)))
    v = v.withWatermark(ts, delay)
    t = F.col("type")
    return v.groupBy(F.window(F.col(ts), every).alias("win"), *KEY).agg(
        F.sum(F.when(t == COUNTER, F.col("delta"))).alias("delta"),
        F.max_by(F.when(t == GAUGE, F.col("value")), F.col(seq)).alias("value"),
    ).select((utc_wall(F.col("win.start")) if ntz else F.col("win.start")).alias("win_start"), *KEY, "delta", "value")


REPORT = "win_start timestamp_ntz, type string, id string, delta bigint, value double"


def start_report(src: DataFrame, root: str, checkpoint: str, every: str, delay: str, available_now: bool = True,
                 interval: str | None = None, compact_every: int | None = 4):
    """The interval report as change versions: each micro-batch writes the
    intervals it touched, closed or still open, so none is missing when the
    input ends.  Every ``compact_every`` micro-batches the changes are folded
    into a base and removed.  Rows later than the watermark are dropped by rule."""
    spark, changes = src.sparkSession, f"{root.rstrip('/')}/changes"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(version_path(changes, batch_id))
        if compact_every and (batch_id + 1) % compact_every == 0:
            _compact(spark, root, REPORT, _newest_report)

    w = stream_report(src, every, delay).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "10 seconds")
    return w.start()


def _newest_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy("win_start", *KEY).agg(*[F.max_by(c, "_version").alias(c) for c in ("delta", "value")])


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of every interval and metric."""
    rows = _live_rows(spark, root, schema=REPORT)
    return spark.createDataFrame([], REPORT) if rows is None else _newest_report(rows)


# ---------------------------------------------------------------- registered runs

# Files that the registered runs cut the feed into, one micro-batch each.
FEED_FILES = 8
# Hash buckets of the states that they keep.
RUN_BUCKETS = 16


def write_feed_files(spark: SparkSession, sf_dir: str, path: str, files: int = FEED_FILES, reverse: bool = False,
                     clock: str | None = None) -> None:
    """The events as ``files`` Parquet files of consecutive ids, written in one
    pass by as many tasks (rows without an id come first).  File times are then
    set so that a stream takes the files by ascending ids, or descending.

    ``clock`` adds a last file with one event of no known type at that time: no
    metric takes it, but it moves a stream's event-time clock, as a tick does."""
    from tallyfold.sources.tables import load_table

    events = load_table(spark, sf_dir, "events")
    events.repartitionByRange(files, F.col("event_id").asc_nulls_first()).write.parquet(path)
    fs, _ = _fs(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    names = sorted(s.getPath().toString() for s in fs.listStatus(hadoop.Path(path)) if s.getPath().getName().endswith(".parquet"))
    if clock is not None:
        write_tick(spark, path, clock)
        names += [s.getPath().toString() for s in fs.listStatus(hadoop.Path(path))
                  if s.getPath().getName().endswith(".parquet") and s.getPath().toString() not in names]
    now = fs.getFileStatus(hadoop.Path(names[0])).getModificationTime() if names else 0
    for i, name in enumerate(reversed(names) if reverse else names):
        fs.setTimes(hadoop.Path(name), now + 1000 * i - 1000 * len(names), -1)


def write_tick(spark: SparkSession, path: str, clock: str) -> None:
    """Add a file with one event of no known type at the time ``clock`` to the feed files at ``path``."""
    tick = spark.range(1).select(*[
        F.lit(clock).cast("timestamp_ntz").alias(c) if c == "ts" else F.lit("tick").alias(c) if c == "event_type"
        else F.lit(None).cast(kind).alias(c) for c, kind in spark.read.parquet(path).dtypes])
    tick.write.mode("append").parquet(path)


def lateness(spark: SparkSession, path: str) -> int:
    """Milliseconds, rounded up, by which an event in the feed files at ``path`` can be older
    than one in a file before its own: 0 if ids follow time."""
    per = spark.read.parquet(path).where("ts is not null").groupBy(F.col("_metadata.file_name").alias("name")).agg(
        *[F.unix_micros(utc_instant(f("ts"))).alias(c) for c, f in (("lo", F.min), ("hi", F.max))])
    late, newest = 0, None
    for r in sorted(per.collect()):  # one row per file
        late = max(late, (newest if newest is not None else r["lo"]) - r["lo"])
        newest = r["hi"] if newest is None else max(newest, r["hi"])
    return -(-late // 1000)


def ticking_stream(spark: SparkSession, sf_dir: str, root: str, every: str) -> tuple[DataFrame, str]:
    """The feed as a stream of several files and a tick that closes its last interval, and the
    watermark delay that lets no event come too late, in whatever order of time the ids are."""
    path = f"{root}/events"
    write_feed_files(spark, sf_dir, path)
    late, end = lateness(spark, path), closing_tick(spark, sf_dir, every)
    if end is not None:
        moved = F.lit(end).cast("timestamp_ntz") + F.expr(f"make_dt_interval(0, 0, 0, {late} / 1000BD)")
        write_tick(spark, path, spark.range(1).select(moved.cast("string")).first()[0])
    return feed_stream(spark, path, max_files=1, glob="*.parquet"), f"{late} milliseconds"


def feed_files_stream(spark: SparkSession, sf_dir: str, root: str, reverse: bool = False,
                      clock: str | None = None) -> DataFrame:
    """The feed as a stream of several files, one per micro-batch."""
    write_feed_files(spark, sf_dir, f"{root}/events", reverse=reverse, clock=clock)
    return feed_stream(spark, f"{root}/events", max_files=1, glob="*.parquet")


def run_stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the live fold over the feed to the end; return the last snapshot."""
    root = scratch_path(spark, "stream-fold")
    src = feed_files_stream(spark, sf_dir, root)
    q = start_snapshots(src, f"{root}/state", f"{root}/_checkpoint", available_now=True, buckets=RUN_BUCKETS)
    q.awaitTermination()
    return state_buckets.read(spark, f"{root}/state")


def run_stream_merge(spark: SparkSession, sf_dir: str, reverse: bool = False) -> DataFrame:
    """Run the durable merge over the feed to the end; return the last version."""
    root = scratch_path(spark, "stream-merge")
    src = feed_files_stream(spark, sf_dir, root, reverse)
    q = start_merge(src, f"{root}/state", f"{root}/_checkpoint", available_now=True, buckets=RUN_BUCKETS)
    q.awaitTermination()
    return state_buckets.read(spark, f"{root}/state")


def closing_tick(spark: SparkSession, sf_dir: str, every: str) -> str | None:
    """The end of the feed's last interval (None for an empty feed)."""
    from tallyfold.sources.tables import load_table

    last = load_table(spark, sf_dir, "events").agg(F.max("ts").alias("ts"))
    row = last.select((F.window("ts", every).end).cast("string")).first() if last.first()[0] is not None else None
    return row[0] if row else None


def run_stream_batches(spark: SparkSession, sf_dir: str, max_size: int, every: str) -> DataFrame:
    """Run size-or-interval batching over the feed stream; return the payloads.
    A tick at the end of the last interval flushes its rest."""
    from tallyfold.streaming import timers

    root = scratch_path(spark, "stream-batches")
    src, delay = ticking_stream(with_state_store(spark), sf_dir, root, every)
    timers.start_batching(src, f"{root}/out", f"{root}/_checkpoint", max_size, every, delay).awaitTermination()
    return timers.read_batches(spark, f"{root}/out")


def run_stream_filled_report(spark: SparkSession, sf_dir: str, every: str) -> DataFrame:
    """Run the report that re-sends every metric over the feed stream; a tick at
    the end of the last interval closes it.  Return all reports."""
    from tallyfold.streaming import timers

    root = scratch_path(spark, "stream-filled")
    src, delay = ticking_stream(with_state_store(spark), sf_dir, root, every)
    timers.start_filled_report(src, f"{root}/out", f"{root}/_checkpoint", every, delay).awaitTermination()
    return spark.read.schema(REPORT).parquet(f"{root}/out")


def read_state_store(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The live fold's state as the state store holds it: every key as of one
    micro-batch (the last one, or ``batch_id``), a consistent cut that no version
    on disk has to be written for."""
    r = spark.read.format("statestore")
    held = (r if batch_id is None else r.option("batchId", batch_id)).load(checkpoint)
    # The aggregate's buffers, in the order of the fold's columns: sum, (value, its order), max.
    total, value, _, last = held.schema["value"].dataType.names
    return held.select("key.type", "key.id", F.col("value")[total].alias("delta"), F.col("value")[value].alias("value"),
                       F.col("value")[last].alias("last_seq"))


def run_state_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the fold over the feed stream without any output; read the state store."""
    root = scratch_path(spark, "state-cut")
    src = feed_files_stream(spark, sf_dir, root)
    stream_fold(src).writeStream.outputMode("update").format("noop").option(
        "checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    return read_state_store(spark, f"{root}/_checkpoint")


def run_stream_report(spark: SparkSession, sf_dir: str, every: str, delay: str) -> DataFrame:
    """Run the watermark interval report over the feed stream to the end;
    return all intervals."""
    root = scratch_path(spark, "stream-report")
    q = start_report(feed_files_stream(spark, sf_dir, root), f"{root}/out", f"{root}/_checkpoint", every, delay)
    q.awaitTermination()
    return read_report(spark, f"{root}/out")


# ---------------------------------------------------------------- live fold with change log

def start_live_fold(src: DataFrame, root: str, checkpoint: str, available_now: bool = True,
                    interval: str | None = None, compact_every: int | None = None):
    """Live fold whose work per micro-batch follows the keys it changes.

    The fold is Spark's streaming aggregate: its state lives in the session's
    state store (for large state the RocksDB provider with changelog
    checkpointing, see ``session.STATE_STORE``; restart-safe, exactly-once
    state updates), and ``update`` mode emits only the keys a micro-batch
    changed, each with its full new state.  Those rows are written to
    ``{root}/changes/v=<batch_id>`` (overwrite, so a replayed batch rewrites
    its own version).  :func:`read_live_state` gives the current state.
    ``compact_every=n`` folds the change log into a new base every n
    micro-batches (a periodic snapshot); a replayed batch redoes the same
    compaction, which overwrites the same base version."""
    spark = src.sparkSession
    changes = f"{root.rstrip('/')}/changes"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*STATE_COLS).write.mode("overwrite").parquet(version_path(changes, batch_id))
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_live_state(spark, root)

    w = stream_fold(src).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "10 seconds")
    return w.start()


def _live_rows(spark: SparkSession, root: str, below: int | None = None, schema=STATE) -> DataFrame | None:
    """The latest base (below ``below``) and the changes after it, each row with its ``_version``."""
    root = root.rstrip("/")
    base_v = latest_version(spark, f"{root}/base", below=below)
    parts = [version_path(f"{root}/base", base_v)] if base_v is not None else []
    parts += [version_path(f"{root}/changes", v) for v in committed_versions(spark, f"{root}/changes", above=base_v)]
    if not parts:
        return None
    version = F.regexp_extract(F.input_file_name(), rf"/{VERSION_PREFIX}(\d+)/[^/]*$", 1).cast("bigint")
    return spark.read.schema(schema).parquet(*parts).withColumn("_version", version)


def _newest(rows: DataFrame) -> DataFrame:
    """The row of the highest version per key.  A change row holds the key's
    full state, whichever way its numbers moved, so the version alone decides."""
    v = F.col("_version")
    return rows.groupBy(*KEY).agg(*[F.max_by(c, v).alias(c) for c in ("delta", "value", "last_seq")])


def read_live_state(spark: SparkSession, root: str) -> DataFrame:
    """Current state of a live fold: the latest compacted base plus the
    change versions after it, newest version per key (a partial aggregate)."""
    rows = _live_rows(spark, root)
    return spark.createDataFrame([], STATE) if rows is None else _newest(rows)


def compact_live_state(spark: SparkSession, root: str) -> int | None:
    """Fold the change log into a new base version named after the newest
    change it includes; later reads start from it.  Older bases (but for the
    one before) and the changes they include are removed.  Returns that version."""
    return _compact(spark, root, STATE, lambda rows: _newest(rows).select(*STATE_COLS))


def _compact(spark: SparkSession, root: str, schema, newest) -> int | None:
    root = root.rstrip("/")
    versions = committed_versions(spark, f"{root}/changes")
    if not versions:
        return None
    # A replayed compaction must not read the base that it overwrites.
    top, before = versions[-1], latest_version(spark, f"{root}/base", below=versions[-1])
    newest(_live_rows(spark, root, below=top, schema=schema)).write.mode("overwrite").parquet(version_path(f"{root}/base", top))
    if before is not None:
        prune_versions(spark, f"{root}/changes", below=before + 1)
        prune_versions(spark, f"{root}/base", below=before)
    return top


def with_initial_state(src: DataFrame, state: DataFrame, path: str) -> DataFrame:
    """``src`` preceded by a restored state: its rows are written as updates
    under ``path`` and join the stream in its first micro-batch, so the keyed
    state starts from them and no other state machinery is needed."""
    seed = fold.state_as_updates(state).withColumn("ts", F.lit(None).cast(dict(src.dtypes)["ts"]))
    seed.select(*src.columns).write.mode("overwrite").parquet(path)
    return src.unionByName(src.sparkSession.readStream.schema(src.schema).parquet(path))


def run_stream_stateful(spark: SparkSession, sf_dir: str, cutoff: str) -> DataFrame:
    """Snapshot the fold of the feed before ``cutoff``, restore it as initial
    state, stream the rest in several micro-batches; return the final state."""
    from tallyfold.sources.feed import load_feed
    from tallyfold.sources.store import write_snapshot

    root = scratch_path(spark, "stream-stateful")
    cut = F.lit(cutoff).cast("timestamp_ntz")
    write_snapshot(fold.fold(load_feed(spark, sf_dir).where(F.col("ts") < cut)), f"{root}/snapshot")
    late = feed_files_stream(spark, sf_dir, root).where(F.col("ts") >= cut)
    src = with_initial_state(late, restore_snapshot(spark, f"{root}/snapshot"), f"{root}/initial")
    start_live_fold(src, f"{root}/live", f"{root}/_checkpoint", compact_every=3).awaitTermination()
    return read_live_state(spark, f"{root}/live")


def run_live_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the live fold over the feed to the end; return the current state."""
    root = scratch_path(spark, "live-fold")
    q = start_live_fold(feed_files_stream(spark, sf_dir, root), root, f"{root}/_checkpoint", compact_every=3)
    q.awaitTermination()
    return read_live_state(spark, root)
