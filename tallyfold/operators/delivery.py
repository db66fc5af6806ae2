"""Delivery outcomes from a table of send attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.codes import MAX_ATTEMPTS, RETRY_DELAYS, classify_delivery, is_retriable_sqlstate


def delivery_outcome(attempts: DataFrame, mode: str = "single") -> DataFrame:
    """Per ``request_id``: the attempt that succeeded (``success_at``), the
    attempts used, ``outcome`` and the seconds waited between attempts.

    ``single`` and ``batch`` judge ``http_status``; every failure is retried.
    ``database`` judges ``sqlstate`` (NULL: success); the first state that is
    not retriable ends the request.  ``outcome`` is ``delivered`` or
    ``failed``, and ``over_limit`` when a request needed or made more than
    ``MAX_ATTEMPTS`` attempts, which a sender never does; its wait is NULL.
    One grouped aggregate with partial combine; a request with many attempts
    is not gathered into one task."""
    n = F.col("attempt")
    if mode == "database":
        ok, final = F.col("sqlstate").isNull(), ~is_retriable_sqlstate("sqlstate")
    else:
        ok = classify_delivery(F.col("http_status"), mode) == "ok"
        final = ok
    g = attempts.groupBy("request_id").agg(
        F.min(F.when(ok, n)).alias("_ok"), F.min(F.when(final, n)).alias("_end"), F.count(F.lit(1)).alias("_seen"),
    )
    used = F.coalesce(F.col("_end"), F.col("_seen"))
    delivered = F.col("_ok") == F.col("_end")
    waits = [0]
    for d in RETRY_DELAYS:
        waits.append(waits[-1] + d)
    wait = F.try_element_at(F.array(*[F.lit(w) for w in waits]), used.cast("int"))
    return g.select(
        "request_id", F.when(delivered, F.col("_ok")).alias("success_at"), used.cast("int").alias("attempts"),
        F.when(used > MAX_ATTEMPTS, F.lit("over_limit")).when(delivered, F.lit("delivered"))
        .otherwise(F.lit("failed")).alias("outcome"),
        wait.alias("wait_s"),
    )
