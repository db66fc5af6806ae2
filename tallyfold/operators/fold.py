"""Folding updates into state: last write wins for gauges, sums for counters.

All folds are one hash aggregate on ``(type, id)``.  ``sum`` and ``max_by``
both have partial forms, so a hot key is combined map-side before the single
exchange and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.schema import COUNTER, GAUGE, KEY

def is_valid_update(type_col: str = "type", delta: str = "delta", value: str = "value") -> Column:
    """A batch row is applied when it is a gauge with a value or a counter
    with a delta; everything else is skipped."""
    t = F.col(type_col)
    return ((t == GAUGE) & F.col(value).isNotNull()) | ((t == COUNTER) & F.col(delta).isNotNull())


def valid_updates(df: DataFrame) -> DataFrame:
    """Lenient batch filter: drop unknown types and rows without payload."""
    return df.where(is_valid_update())


def _fold_valid(df: DataFrame, seq: str = "seq") -> DataFrame:
    t = F.col("type")
    return df.groupBy(*KEY).agg(
        F.sum(F.when(t == COUNTER, F.col("delta"))).alias("delta"),
        F.max_by(F.when(t == GAUGE, F.col("value")), F.col(seq)).alias("value"),
        F.max(F.col(seq)).alias("last_seq"),
    )


def fold(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Updates ``(seq, type, id, delta, value)`` -> state
    ``(type, id, delta, value, last_seq)``; invalid rows are skipped.

    Counter sums follow ANSI rules: an int64 overflow fails the job instead of
    wrapping."""
    return _fold_valid(valid_updates(df), seq)


def fold_gauges(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Last value per gauge id."""
    g = df.where((F.col("type") == GAUGE) & F.col("value").isNotNull())
    return g.groupBy(*KEY).agg(
        F.max_by(F.col("value"), F.col(seq)).alias("value"),
        F.max(F.col(seq)).alias("last_seq"),
    )


def fold_counters(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Sum of deltas per counter id."""
    c = df.where((F.col("type") == COUNTER) & F.col("delta").isNotNull())
    return c.groupBy(*KEY).agg(
        F.sum(F.col("delta")).alias("delta"),
        F.max(F.col(seq)).alias("last_seq"),
    )


def state_as_updates(state: DataFrame) -> DataFrame:
    """State rows as updates stamped with their ``last_seq``."""
    return state.select(
        F.col("last_seq").alias("seq"), "type", "id",
        F.col("delta").cast("bigint").alias("delta"), F.col("value").cast("double").alias("value"),
    )


def merge_state(state: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Merge a batch of updates into existing state (union + fold, one shuffle).

    The state keeps its ``last_seq``, so a batch that arrives late cannot
    overwrite a newer gauge, and counters simply add.  Merging the same batch
    twice adds its counters twice: retries stay exact by rebuilding a version
    from the version before it (see ``streaming.stream.merge_micro_batch``),
    not by merging again."""
    upd = batch.select(F.col(seq).alias("seq"), "type", "id", "delta", "value")
    return _fold_valid(state_as_updates(state).unionByName(valid_updates(upd)))


def merge_state_join(state: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Upsert as a full outer join of state with the folded batch.

    Same result as :func:`merge_state`; useful when ``state`` is stored
    bucketed by ``(type, id)`` so its side of the join needs no exchange.
    A plain equi-join keeps that; the rows without an id, one per type at
    most, are merged apart."""
    nameless = merge_state(state.where("id is null"), batch.where("id is null"), seq)
    b = fold(batch.where("id is not null"), seq).alias("b")
    s = state.where("id is not null").alias("s")
    cond = [F.col("s.type") == F.col("b.type"), F.col("s.id") == F.col("b.id")]
    j = s.join(b, cond, "full_outer")
    newer = F.col("s.last_seq").isNull() | (F.col("b.last_seq") > F.col("s.last_seq"))
    merged = j.select(
        F.coalesce(F.col("s.type"), F.col("b.type")).alias("type"),
        F.coalesce(F.col("s.id"), F.col("b.id")).alias("id"),
        F.when(
            F.col("s.delta").isNull() & F.col("b.delta").isNull(), F.lit(None).cast("bigint")
        ).otherwise(F.coalesce(F.col("s.delta"), F.lit(0)) + F.coalesce(F.col("b.delta"), F.lit(0))).alias("delta"),
        F.when(F.col("b.last_seq").isNotNull() & newer, F.col("b.value")).otherwise(F.col("s.value")).alias("value"),
        F.greatest(F.col("s.last_seq"), F.col("b.last_seq")).alias("last_seq"),
    )
    return merged.unionByName(nameless)


def resume(restored: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Restored snapshot state followed by later updates."""
    return merge_state(restored, updates, seq)


def fold_atomic(df: DataFrame, batch_status: DataFrame, batch_col: str = "batch_id", seq: str = "seq") -> DataFrame:
    """All-or-nothing per batch: only batches whose status is 200 are folded.

    ``batch_status`` holds one row per batch; it is joined as a semi join, so
    Spark broadcasts it only when its runtime size is under the AQE threshold
    and shuffles otherwise."""
    ok = batch_status.where(F.col("status") == 200).select(batch_col)
    return fold(df.join(ok, on=batch_col, how="left_semi"), seq)


def fold_batches(rows: DataFrame, order: str, pos: str = "pos") -> DataFrame:
    """Rows of ordered batches -> state, applied in (batch, position) order.

    Each batch is folded by position first, then the batches by ``order``: two
    hash aggregates, and no combined order key that could overflow.
    ``last_seq`` is the ``order`` of the newest batch that touched the key."""
    t = F.col("type")
    v = valid_updates(rows)
    within = v.groupBy(order, *KEY).agg(
        F.sum(F.when(t == COUNTER, F.col("delta"))).alias("delta"),
        F.max_by(F.when(t == GAUGE, F.col("value")), F.col(pos)).alias("value"),
    )
    return within.groupBy(*KEY).agg(
        F.sum("delta").alias("delta"), F.max_by("value", order).alias("value"), F.max(order).alias("last_seq"))


def metric_names(df: DataFrame) -> DataFrame:
    """Distinct ``(type, id)`` of the valid updates."""
    return valid_updates(df).select(*KEY).distinct()


def poll_count(samples: DataFrame, ts: str = "ts", every: str | None = None) -> DataFrame:
    """The agent's ``PollCount`` counter: number of samples taken.

    Without ``every``: one row with the total.  With ``every``: one row per
    interval holding the running count through the end of that interval, as
    the agent reports it (a cumulative value).  The per-interval counts are a
    partial aggregate; their running sum is the two-level prefix scan, so no
    window gathers all intervals in one task."""
    if every is None:
        return samples.agg(F.count(F.lit(1)).alias("delta")).select(
            F.lit(COUNTER).alias("type"), F.lit("PollCount").alias("id"), "delta"
        )
    from tallyfold.operators.history import running

    from tallyfold.functions.timeutil import epoch_seconds, with_interval

    per = with_interval(samples, ts, every).groupBy("win_start").agg(F.count(F.lit(1)).alias("n"))
    per = per.withColumn("_o", epoch_seconds(F.col("win_start")))
    r = running(per, [], "_o", {"delta": ("sum", "n")})
    return r.select("win_start", F.lit(COUNTER).alias("type"), F.lit("PollCount").alias("id"), "delta")


def outcome_counts(df: DataFrame, status: str = "status", body: str | None = None) -> DataFrame:
    """Ingest statistics: requests and bytes per outcome code."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if body is not None:
        aggs.append(F.sum(F.octet_length(F.col(body))).alias("bytes"))
    return df.groupBy(F.col(status).alias("status")).agg(*aggs)


def observe_outcomes(df: DataFrame, name: str = "outcomes", status: str = "status") -> DataFrame:
    """Live ingest statistics: attach per-outcome request counts as named
    observed metrics (read them from ``StreamingQueryProgress.observedMetrics``
    or an ``Observation``).  The counts ride along with the query; no extra
    job runs."""
    s = F.col(status)
    return df.observe(
        name,
        F.count(F.lit(1)).alias("requests"),
        F.count(F.when(s == 200, F.lit(1))).alias("ok"),
        F.count(F.when((s >= 400) & (s < 500), F.lit(1))).alias("client_errors"),
        F.count(F.when(s >= 500, F.lit(1))).alias("server_errors"),
    )
