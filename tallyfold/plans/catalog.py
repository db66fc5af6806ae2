"""Registered queries: each reads the input tables of one scale factor
(``{sf_dir}/{table}.parquet``) and returns a DataFrame built from the
library's operators.  ``tallyfold.plans.sql.ORACLES`` holds the DuckDB
statement for each name that has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.jsoncodec import encode_json
from tallyfold.functions.numtext import format_int, format_shortest
from tallyfold.functions.signing import sign_rows
from tallyfold.operators import batching, delivery, fold, history, listing, lookup, sampling, validate
from tallyfold.plans.sql import CUTOFF, SIGN_KEY
from tallyfold.schema import COUNTER, GAUGE, METRIC_TYPES
from tallyfold.session import materialize, scratch_path
from tallyfold.sources import readers, store
from tallyfold.sources.feed import load_feed
from tallyfold.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]

BATCH_EVERY = "1 day"
BATCH_SIZE = 100


def _cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def q_fold(spark, sf):
    # Only gauge and counter events can fold: filtering them on the stored
    # column lets the predicate reach the Parquet scan.
    return fold.fold(load_feed(spark, sf, types=METRIC_TYPES))


def q_fold_gauges(spark, sf):
    return fold.fold_gauges(load_feed(spark, sf, types=(GAUGE,)))


def q_fold_counters(spark, sf):
    return fold.fold_counters(load_feed(spark, sf, types=(COUNTER,)))


def q_metric_names(spark, sf):
    return fold.metric_names(load_feed(spark, sf, types=METRIC_TYPES))


def q_list_metrics(spark, sf):
    return listing.list_metrics(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)))


def q_all_metrics(spark, sf):
    # One fold, written once, split and put together again.
    state = materialize(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)), "all-metrics")
    gauges, counters = listing.split_state(state)
    return listing.all_metrics(gauges, counters).select("type", "id", "delta", "value", "last_seq")


def _halves(spark, sf):
    feed = load_feed(spark, sf, types=METRIC_TYPES)
    early = feed.where(F.col("ts") < _cutoff())
    late = feed.where(F.col("ts") >= _cutoff())
    return early, late


def q_merge_state(spark, sf):
    early, late = _halves(spark, sf)
    return fold.merge_state(fold.fold(early), late)


def q_merge_state_join(spark, sf):
    early, late = _halves(spark, sf)
    return fold.merge_state_join(fold.fold(early), late)


def q_merge_state_reversed(spark, sf):
    # The later half is folded first and the earlier half arrives late: the
    # state's last_seq keeps the newer gauge values.
    early, late = _halves(spark, sf)
    return fold.merge_state(fold.fold(late), early)


def q_restore_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    store.write_snapshot(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)), path, fmt="parquet")
    return store.restore_snapshot(spark, path, fmt="parquet")


def q_restore_snapshot_json(spark, sf):
    path = scratch_path(spark, "snapshot-json")
    store.write_snapshot(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)), path, fmt="json")
    return store.restore_snapshot(spark, path, fmt="json").select("type", "id", "delta", "value")


def q_restore_array(spark, sf):
    # JSON arrays in which every metric stands twice, the second time changed, beside rows
    # that restore must skip: the last row of a key wins, rows without payload or of no type do not count.
    path = scratch_path(spark, "snapshot-array")
    state = fold.fold(load_feed(spark, sf, types=METRIC_TYPES)).drop("last_seq")
    changed = state.select("type", "id", (F.col("delta") + 1).alias("delta"), (F.col("value") * 2).alias("value"))
    empty = state.select("type", "id", F.lit(None).cast("bigint").alias("delta"), F.lit(None).cast("double").alias("value"))
    other = state.select(F.lit("}other{").alias("type"), "id", "delta", "value")
    rows = None
    for rank, part in enumerate((state, changed, empty, other)):
        part = part.withColumn("rank", F.lit(rank))
        rows = part if rows is None else rows.unionByName(part)
    store.write_json_arrays(rows.select("type", "id", "rank", encode_json().alias("record")), path, 4)
    return store.restore_snapshot(spark, path, fmt="json_array").select("type", "id", "delta", "value")


def q_resume(spark, sf):
    early, late = _halves(spark, sf)
    path = scratch_path(spark, "snapshot-json")
    store.write_snapshot(fold.fold(early), path, fmt="json")
    restored = store.restore_snapshot(spark, path, fmt="json")
    return fold.resume(restored, late).select("type", "id", "delta", "value")


def q_running_counter(spark, sf):
    return history.running_counter(load_feed(spark, sf, types=(COUNTER,)))


def q_running_gauge(spark, sf):
    return history.running_gauge(load_feed(spark, sf, types=(GAUGE,)))


def q_cumulative_to_delta(spark, sf):
    return history.cumulative_to_delta(load_feed(spark, sf, types=(COUNTER,)))


def q_update_rank(spark, sf):
    return history.update_rank(load_feed(spark, sf, types=METRIC_TYPES))


def q_replay_reads(spark, sf):
    return history.replay_reads(load_feed(spark, sf, types=METRIC_TYPES))


# Rows of one key that a task may sort in the queries on hot keys: few enough that the given tables are cut too.
HOT_RANGE_ROWS = 1000


def q_running_counter_hot(spark, sf):
    # Five keys share the whole feed: no task sorts more than one range of a key.
    return history.running_counter(load_feed(spark, sf, hot=True, types=(COUNTER,)), HOT_RANGE_ROWS)


def q_replay_reads_hot(spark, sf):
    return history.replay_reads(load_feed(spark, sf, hot=True, types=METRIC_TYPES), HOT_RANGE_ROWS)


def q_fold_hot(spark, sf):
    return fold.fold(load_feed(spark, sf, hot=True, types=METRIC_TYPES))


def q_report_intervals(spark, sf):
    return sampling.report_intervals(load_feed(spark, sf, types=METRIC_TYPES), "1 hour")


def q_report_filled(spark, sf):
    return sampling.report_filled(load_feed(spark, sf, types=METRIC_TYPES), "1 day")


def q_sample_intervals(spark, sf):
    return sampling.sample_intervals(load_feed(spark, sf), "6 hours")


def _batched(spark, sf):
    return batching.assign_batches(load_feed(spark, sf), BATCH_SIZE, BATCH_EVERY)


def q_assign_batches(spark, sf):
    return _batched(spark, sf)


def q_encode_batches(spark, sf):
    return batching.encode_batches(_batched(spark, sf), max_size=BATCH_SIZE)


def _requests(spark, sf):
    """The feed as batch requests, some of them faulty by a rule on
    ``first_seq`` that the oracle restates: cut short, empty, of another
    content type, not an array, a field of the wrong type, a number beyond a
    double, an element that is no object."""
    enc = batching.encode_batches(_batched(spark, sf), max_size=BATCH_SIZE)
    k, p = F.col("first_seq") % 10, F.col("payload")
    body = (
        F.when(k == 1, F.substring(p, F.lit(1), F.length(p) - 1)).when(k == 2, F.lit("[]"))
        .when(k == 4, F.lit('{"id":"a","type":"gauge","value":1}')).when(k == 5, F.lit('[{"id":"a","type":"counter","delta":1.5}]'))
        .when(k == 6, F.lit('[{"id":"a","type":"gauge","value":1e400}]')).when(k == 7, F.lit("[null,5]"))
        # Other cases of the same keys, a repeated key whose last value counts, text behind the array.
        .when(k == 8, F.concat(F.replace(F.replace(p, F.lit('"id":'), F.lit('"id":"no","ID":')), F.lit('"delta":'),
                                         F.lit('"delta":null,"Delta":')), F.lit(" trailing"))).otherwise(p)
    )
    kind = F.when(k == 3, F.lit("text/plain")).when(k == 8, F.lit("")).otherwise(F.lit("application/json"))
    return enc.select("win_start", "batch_no", F.col("first_seq").alias("batch_seq"), body.alias("body"),
                      kind.alias("content_type"))


def q_batch_status(spark, sf):
    return validate.validate_batches(_requests(spark, sf)).select("win_start", "batch_no", "status")


def q_fold_atomic(spark, sf):
    # Batches travel as JSON payloads, some of them faulty; each is checked
    # whole, and only the rows of accepted batches are folded.
    judged = materialize(validate.validate_batches(_requests(spark, sf)).select("win_start", "batch_no", "status"), "judged")
    rows = _batched(spark, sf)
    key = F.struct("win_start", "batch_no")
    return fold.fold_atomic(rows.withColumn("batch_id", key), judged.withColumn("batch_id", key))


def q_ingest_batches(spark, sf):
    # The same requests, signed; some signatures are tampered with, some are
    # empty (nothing to check).  Accepted batches are decoded in order and folded.
    from tallyfold.functions.signing import hmac_sha256_hex
    from tallyfold.operators.ingest import ingest_batches

    k = F.col("batch_seq") % 10
    signature = F.when(k == 9, F.lit("00")).when(k == 8, F.lit("")).otherwise(hmac_sha256_hex("body", SIGN_KEY))
    _, state = ingest_batches(_requests(spark, sf).withColumn("signature", signature), key=SIGN_KEY)
    return state


def q_batch_ack(spark, sf):
    # The acknowledgements of accepted batches.
    acked = validate.batch_ack(validate.validate_batches(_requests(spark, sf)))
    return acked.select("win_start", "batch_no", "status", "reply")


def q_read_batches(spark, sf):
    # Batch requests written as files of many, read back and folded in request order.
    path = scratch_path(spark, "batch-files")
    enc = batching.encode_batches(_batched(spark, sf), max_size=BATCH_SIZE).select(F.col("first_seq").alias("batch_seq"), F.col("payload").alias("body"))
    enc.write.json(path)
    rows = readers.read_batch_requests(spark, path)
    return fold.fold_batches(rows, "batch_seq").select("type", "id", "delta", "value")


def q_batch_strict(spark, sf):
    # Batch numbering is itself a two-level running pass; it is written once
    # to the shared folder so the strict check (which reads its input twice)
    # does not recompute its shuffles.
    b = materialize(_batched(spark, sf), "batched").withColumn("batch_id", F.struct("win_start", "batch_no"))
    return validate.validate(b, mode="batch_strict", batch_col="batch_id").select(
        "seq", "id", "type", "delta", "value", "win_start", "batch_no", "status"
    )


def _json_judged(spark, sf, keep=()):
    feed = load_feed(spark, sf, keep).withColumn("body", encode_json())
    return validate.validate(feed, mode="json")


def q_validate_json(spark, sf):
    # The reply to an accepted update echoes the request, i.e. its own body.
    j = _json_judged(spark, sf)
    return j.select("seq", "type", "id", "status", F.when(F.col("status") == 200, F.col("body")).alias("reply"))


def q_ack(spark, sf):
    # Accepted single updates, echoed.
    return validate.ack(_json_judged(spark, sf)).select("seq", "reply")


def q_decode_json(spark, sf):
    # Each feed row is sent as a JSON body (P2), decoded back (P1) and judged
    # as a single JSON update (P7); some bodies are faulty by a rule on ``seq``.
    from tallyfold.functions.jsoncodec import decode_json

    k, body = F.col("seq") % 20, encode_json()
    faulty = (
        F.when(k == 1, F.substring(body, F.lit(1), F.length(body) - 1))
        .when(k == 2, F.lit('{"id":"big","type":"gauge","value":1e400}'))
        .when(k == 3, F.lit('{"id":"half","type":"counter","delta":0.5}'))
        .when(k == 4, F.lit('{"id":"old","id":"twice","type":"counter","delta":1,"delta":7}'))
        .when(k == 5, F.lit('{"type":"gauge","value":2.5}')).when(k == 6, F.lit('{"id":"untyped","value":1}'))
        .when(k == 7, F.lit('{"id":"text","type":"gauge","value":"1"}')).when(k == 8, F.lit("[]"))
        # Keys in any case, repeated in two cases, a wrong type behind a right one, text behind the object.
        .when(k == 9, F.lit('{"ID":"upper","Type":"counter","DELTA":9}'))
        .when(k == 10, F.lit('{"id":"a","ID":"last","type":"gauge","tYpe":"counter","delta":3,"Id":null,"delta":4}'))
        .when(k == 11, F.lit('{"id":"a","type":"counter","delta":"x","Delta":1}'))
        .when(k == 12, F.concat(body, F.lit("{]"))).when(k == 13, F.lit("null")).otherwise(body)
    )
    bodies = load_feed(spark, sf).select("seq", faulty.alias("body"))
    judged = validate.validate(decode_json(bodies, "body"), mode="json")
    ok = F.col("status") == 200
    return judged.select("seq", "status", *[F.when(ok, F.col(c)).alias(c) for c in ("type", "id", "delta", "value")])


def q_outcome_counts(spark, sf):
    return fold.outcome_counts(_json_judged(spark, sf), body="body")


def _paths(spark, sf, line_end="\n"):
    """Update paths of the feed, some of them faulty by a rule on ``seq``."""
    feed = load_feed(spark, sf)
    k = F.col("seq") % 20
    text = F.coalesce(format_int("delta"), format_shortest("value"), F.lit(""))
    text = (F.when(k == 1, F.lit(" 5")).when(k == 2, F.lit("1e400")).when(k == 3, F.lit(f"5{line_end}")).when(k == 4, F.lit("1.5d"))
            .when(k == 5, F.lit("0x1p-2")).when(k == 6, F.lit("+7")).otherwise(text))
    name = F.when(k == 7, F.lit("")).otherwise(F.col("id"))
    path = F.concat(F.lit("/update/"), F.col("type"), F.lit("/"), name, F.lit("/"), text)
    return feed.select("seq", F.when(k == 8, F.lit("/else/where")).otherwise(path).alias("path"))


def q_validate_paths(spark, sf):
    parsed = readers.split_update_path(_paths(spark, sf), "path")
    return validate.validate(parsed, mode="path").select("seq", "status", "delta", "value")


def q_read_paths(spark, sf):
    # Update paths written as lines of text, read back and judged: requests per outcome.
    path = scratch_path(spark, "paths")
    _paths(spark, sf, line_end="\t").select("path").write.text(path)
    return fold.outcome_counts(validate.validate(readers.read_update_paths(spark, path), mode="path"), body="path")


def _requests_and_state(spark, sf):
    feed = load_feed(spark, sf)
    state = fold.fold(feed.where(F.col("ts") < _cutoff()))
    return feed.select("seq", "type", "id"), state


def q_lookup(spark, sf):
    req, state = _requests_and_state(spark, sf)
    return lookup.lookup(req, state, form="json")


def q_read_requests(spark, sf):
    # Lookup requests written as JSON lines and as path lines, read back and answered: replies per form and status.
    req, state = _requests_and_state(spark, sf)
    root = scratch_path(spark, "requests")
    req.select("id", "type").write.json(f"{root}/json")
    req.select(F.concat(F.lit("/value/"), F.col("type"), F.lit("/"), F.col("id")).alias("path")).write.text(f"{root}/path")
    answers = [lookup.lookup(readers.read_value_requests(spark, f"{root}/{form}", form), state, form=form)
               .select(F.lit(form).alias("form"), "status", "delta", "value") for form in ("json", "path")]
    return answers[0].unionByName(answers[1]).groupBy("form", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("delta").alias("deltas"), F.count("value").alias("gauges"))


def q_lookup_one(spark, sf):
    # The first metric by name and type, looked up in the stored state table.
    path = scratch_path(spark, "state-one")
    state = fold.fold(load_feed(spark, sf, types=METRIC_TYPES))
    store.write_state(state, path)
    first = store.read_state(spark, path).agg(F.min(F.struct("id", "type")).alias("k")).first()["k"]
    return lookup.lookup_one(store.read_state(spark, path), first["type"], first["id"]).select(
        "type", "id", "delta", "value", "last_seq")


def q_state_ddl(spark, sf):
    # The state table created, filled, read and dropped; its files stay at their location.
    path = scratch_path(spark, "state-ddl")
    name = "state_" + path.rsplit("-", 1)[1]
    store.create_state(spark, name, path)
    state = fold.fold(load_feed(spark, sf, types=METRIC_TYPES))
    state.select("id", "delta", "value", "last_seq", "type").write.insertInto(name, overwrite=True)
    rows = spark.table(name).select("type", "id", "delta", "value", "last_seq")
    rows = materialize(rows, "state-ddl-read")
    store.drop_state(spark, name)
    return rows


def q_lookup_hot_salted(spark, sf):
    # Every request falls on one of five metrics; salting spreads each hot
    # metric's requests over 8 tasks.
    feed = load_feed(spark, sf, hot=True)
    state = fold.fold(feed.where(F.col("ts") < _cutoff()))
    return lookup.lookup(feed.select("seq", "type", "id"), state, form="json", salt_buckets=8)


def q_lookup_path(spark, sf):
    req, state = _requests_and_state(spark, sf)
    return lookup.lookup(req, state, form="path")


def q_lookup_hits(spark, sf):
    req, state = _requests_and_state(spark, sf)
    return lookup.lookup_hits(req, state)


def q_lookup_misses(spark, sf):
    req, state = _requests_and_state(spark, sf)
    return lookup.lookup_misses(req, state)


def q_render_report(spark, sf):
    return listing.render_report(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)))


def q_value_text(spark, sf):
    s = fold.fold(load_feed(spark, sf, types=METRIC_TYPES))
    text = F.when(F.col("type") == "counter", format_int("delta")).otherwise(format_shortest("value"))
    return s.select("type", "id", text.alias("text"))


WIDE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _wide_seq():
    # Order of the samples: order, line, part (below 10^12), as one wide number that never overflows.
    wide = "decimal(38,0)"
    line = F.col("l_orderkey").cast(wide) * F.lit(100).cast("decimal(3,0)") + F.col("l_linenumber").cast("decimal(10,0)")
    return (line.cast("decimal(24,0)") * F.lit(10**12).cast("decimal(13,0)") + F.col("l_partkey").cast("decimal(13,0)")).cast(wide)


def q_unpivot_fold(spark, sf):
    # Each lineitem row is one wide sample of the agent ``l_suppkey``: every
    # row is unpivoted into one gauge per column, and the gauges are folded in
    # sample order.
    li = load_table(spark, sf, "lineitem")
    seq = _wide_seq()
    long = sampling.unpivot_sample(li.withColumn("seq", seq), ["seq", "l_suppkey"], WIDE_COLS)
    named = long.withColumn("id", F.concat(F.col("l_suppkey").cast("string"), F.lit("/"), F.col("id")))
    return fold.fold(named).drop("delta").withColumn("last_seq", F.col("last_seq").cast("string"))


def q_explode_indexed(spark, sf):
    emb = load_table(spark, sf, "embeddings")
    return sampling.explode_indexed(emb, "dim", "embedding", keep=("vec_id",)).drop("delta")


def q_random_gauge(spark, sf):
    # One uniform value per sample: how many, and whether all lie in [0, 1).
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    r = F.col("random_value")
    return sampling.with_random_gauge(li, seed=7).groupBy("random_id").agg(
        F.count(F.lit(1)).alias("n"), F.min((r >= 0) & (r < 1)).alias("in_range"))


def q_update_rows(spark, sf):
    # Gauges from order prices and counters from line numbers, folded per return flag.
    li = load_table(spark, sf, "lineitem")
    base = li.select(_wide_seq().alias("seq"), F.col("l_returnflag").alias("mode"), "l_extendedprice", "l_linenumber")
    rows = sampling.gauge_rows(base, "mode", "l_extendedprice", keep=("seq",)).unionByName(
        sampling.counter_rows(base, "mode", "l_linenumber", keep=("seq",)))
    return fold.fold(rows).withColumn("last_seq", F.col("last_seq").cast("string"))


def q_split_state(spark, sf):
    # State, written once, split into gauges and counters.
    gauges, counters = listing.split_state(materialize(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)), "split-state"))
    return gauges.select("type", "id", F.lit(None).cast("bigint").alias("delta"), "value").unionByName(
        counters.select("type", "id", "delta", F.lit(None).cast("double").alias("value")))


def q_poll_count(spark, sf):
    return fold.poll_count(load_table(spark, sf, "events"), ts="ts", every="1 day")


def q_sign_rows(spark, sf):
    return sign_rows(load_feed(spark, sf), SIGN_KEY).select("seq", "body", "signature")


def _attempts(spark, sf):
    # Every event is one send by its user; four sends in a row are the attempts
    # of one request.  Every seventh send gets no answer, every eleventh a 503.
    judged = _json_judged(spark, sf, keep=("user_id",))
    ranked = history.running(judged.select("seq", "user_id", "status"), ["user_id"], "seq", {"n": ("count", None)})
    nth = F.col("n") - 1
    answer = F.when(F.col("seq") % 7 == 0, F.lit(None)).when(F.col("seq") % 11 == 0, F.lit(503)).otherwise(F.col("status"))
    state = F.when(F.col("seq") % 3 == 0, F.lit("08006")).when(F.col("seq") % 5 == 0, F.lit("23505"))
    return ranked.select(
        F.struct("user_id", F.floor(nth / 4).alias("request_no")).alias("request_id"), (nth % 4 + 1).cast("int").alias("attempt"),
        answer.cast("int").alias("http_status"), state.alias("sqlstate"),
    )


def _by_request(outcomes):
    return outcomes.select("request_id.user_id", "request_id.request_no", *outcomes.columns[1:])


def q_delivery_outcome(spark, sf):
    return _by_request(delivery.delivery_outcome(_attempts(spark, sf), mode="single"))


def q_delivery_outcome_batch(spark, sf):
    # Batch sends count any other non-200 answer (here 501) as a server error.
    return _by_request(delivery.delivery_outcome(_attempts(spark, sf), mode="batch"))


def q_delivery_outcome_database(spark, sf):
    # Retriable SQLSTATEs are tried again, the first other one ends the request.
    return _by_request(delivery.delivery_outcome(_attempts(spark, sf), mode="database"))


def q_stream_fold(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_stream_fold(spark, sf)


def q_stream_merge(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_stream_merge(spark, sf)


def q_stream_merge_reversed(spark, sf):
    # The files arrive newest first.
    from tallyfold.streaming import stream

    return stream.run_stream_merge(spark, sf, reverse=True)


def q_stream_stateful(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_stream_stateful(spark, sf, CUTOFF)


def q_stream_live_fold(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_live_fold(spark, sf)


def q_stream_batches(spark, sf):
    from tallyfold.streaming import stream

    out = stream.run_stream_batches(spark, sf, BATCH_SIZE, BATCH_EVERY)
    return out.select(
        "win_start", "batch_no", "n_rows", "first_seq",
        "last_seq", "payload",
    )


def q_stream_report(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_stream_report(spark, sf, "1 day", "1 hour")


def q_stream_report_filled(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_stream_filled_report(spark, sf, "1 day")


def q_stream_state_cut(spark, sf):
    from tallyfold.streaming import stream

    return stream.run_state_cut(spark, sf)


def q_feed_roundtrip(spark, sf):
    # The feed written as gzip JSON lines and read back with the feed reader
    # (corrupt-record column, gzip by suffix), then folded.
    path = scratch_path(spark, "feed-json-gz")
    store.write_feed(load_feed(spark, sf).select("seq", "id", "type", "delta", "value"), path)
    back = readers.read_metric_feed(spark, path, order_col="seq")
    return fold.fold(back.where(F.col("_corrupt_record").isNull()))


def q_state_table(spark, sf):
    # State stored partitioned by type and sorted by id, read back whole.
    path = scratch_path(spark, "state-table")
    store.write_state(fold.fold(load_feed(spark, sf, types=METRIC_TYPES)), path)
    return store.read_state(spark, path).select("type", "id", "delta", "value", "last_seq")


QUERIES: dict[str, Query] = {
    "fold": q_fold,
    "fold_gauges": q_fold_gauges,
    "fold_counters": q_fold_counters,
    "metric_names": q_metric_names,
    "list_metrics": q_list_metrics,
    "all_metrics": q_all_metrics,
    "merge_state": q_merge_state,
    "merge_state_join": q_merge_state_join,
    "merge_state_reversed": q_merge_state_reversed,
    "restore_snapshot": q_restore_snapshot,
    "restore_snapshot_json": q_restore_snapshot_json,
    "restore_array": q_restore_array,
    "resume": q_resume,
    "running_counter": q_running_counter,
    "running_gauge": q_running_gauge,
    "running_counter_hot": q_running_counter_hot,
    "replay_reads_hot": q_replay_reads_hot,
    "fold_hot": q_fold_hot,
    "cumulative_to_delta": q_cumulative_to_delta,
    "update_rank": q_update_rank,
    "replay_reads": q_replay_reads,
    "report_intervals": q_report_intervals,
    "report_filled": q_report_filled,
    "sample_intervals": q_sample_intervals,
    "assign_batches": q_assign_batches,
    "encode_batches": q_encode_batches,
    "batch_status": q_batch_status,
    "fold_atomic": q_fold_atomic,
    "batch_ack": q_batch_ack,
    "read_batches": q_read_batches,
    "ack": q_ack,
    "read_paths": q_read_paths,
    "read_requests": q_read_requests,
    "lookup_one": q_lookup_one,
    "state_ddl": q_state_ddl,
    "update_rows": q_update_rows,
    "split_state": q_split_state,
    "delivery_outcome_database": q_delivery_outcome_database,
    "stream_merge_reversed": q_stream_merge_reversed,
    "ingest_batches": q_ingest_batches,
    "batch_strict": q_batch_strict,
    "validate_json": q_validate_json,
    "decode_json": q_decode_json,
    "outcome_counts": q_outcome_counts,
    "validate_paths": q_validate_paths,
    "lookup": q_lookup,
    "lookup_path": q_lookup_path,
    "lookup_hot_salted": q_lookup_hot_salted,
    "lookup_hits": q_lookup_hits,
    "lookup_misses": q_lookup_misses,
    "render_report": q_render_report,
    "value_text": q_value_text,
    "unpivot_fold": q_unpivot_fold,
    "explode_indexed": q_explode_indexed,
    "random_gauge": q_random_gauge,
    "poll_count": q_poll_count,
    "sign_rows": q_sign_rows,
    "delivery_outcome": q_delivery_outcome,
    "delivery_outcome_batch": q_delivery_outcome_batch,
    "stream_fold": q_stream_fold,
    "stream_merge": q_stream_merge,
    "stream_stateful": q_stream_stateful,
    "stream_batches": q_stream_batches,
    "stream_live_fold": q_stream_live_fold,
    "stream_report": q_stream_report,
    "stream_report_filled": q_stream_report_filled,
    "stream_state_cut": q_stream_state_cut,
    "feed_roundtrip": q_feed_roundtrip,
    "state_table": q_state_table,
}
