"""Lookups of metric state: point lookup and batch lookups as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.schema import COUNTER, GAUGE, KEY


def lookup_one(state: DataFrame, mtype: str, mid: str) -> DataFrame:
    """One metric by type and name; the predicates reach the Parquet scan
    when ``state`` is read from storage."""
    return state.where((F.col("type") == mtype) & (F.col("id") == mid))


def lookup(requests: DataFrame, state: DataFrame, form: str = "json", salt_buckets: int | None = None) -> DataFrame:
    """Answer a table of lookup requests ``(…, type, id)`` from ``state``.

    ``status`` is 200 with the payload, 404 when the metric is absent, and
    for an unknown type 501 (JSON form) or 400 (path form); a JSON request
    that did not decode (``decoded = false``, see ``decode_json``) is 400.  The payload of
    a hit is ``delta`` for counters and ``value`` for gauges; ``text`` is the
    plain-text reply of the path form.

    One left join on ``(type, id)``: AQE turns it into a broadcast join when
    the state side is small at run time, and splits hot request keys on the
    request side otherwise.  ``salt_buckets=n`` salts explicitly (for runs
    without AQE): each request takes a random salt in [0, n) and every state
    row is replicated n times, so one hot metric's requests spread over n
    tasks.  Any salt meets a copy of its state row, so the answer does not
    depend on the draw, and recomputation after a lost executor is safe."""
    if form not in ("json", "path"):
        raise ValueError(f"unknown form {form!r}")
    from tallyfold.functions.numtext import format_int, format_shortest

    # A key without a name is the empty name, in requests as in state.
    requests = requests.withColumn("id", F.coalesce("id", F.lit("")))
    s = state.select("type", F.coalesce("id", F.lit("")).alias("id"), F.col("delta").alias("_d"),
                     F.col("value").alias("_v"), F.lit(True).alias("_hit"))
    if salt_buckets and salt_buckets > 1:
        n = int(salt_buckets)
        req = requests.withColumn("_salt", F.floor(F.rand() * n).cast("int"))
        s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        j = req.join(s, on=[*KEY, "_salt"], how="left").drop("_salt")
    else:
        j = requests.join(s, on=KEY, how="left")
    t = F.col("type")
    known = t.isin(GAUGE, COUNTER)
    bad_type = F.lit(501) if form == "json" else F.lit(400)
    status = F.when(~known | t.isNull(), bad_type).when(F.col("_hit").isNull(), F.lit(404)).otherwise(F.lit(200))
    if form == "json" and "decoded" in requests.columns:
        status = F.when(~F.coalesce(F.col("decoded"), F.lit(False)), F.lit(400)).otherwise(status)
    ok = status == 200
    out = j.withColumn("status", status).withColumn(
        "delta", F.when(ok & (t == COUNTER), F.col("_d"))
    ).withColumn("value", F.when(ok & (t == GAUGE), F.col("_v")))
    if form == "path":
        out = out.withColumn(
            "text",
            F.when(F.col("delta").isNotNull(), format_int("delta")).when(
                F.col("value").isNotNull(), format_shortest("value")
            ),
        )
    return out.drop("_d", "_v", "_hit")


def lookup_hits(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Requests whose metric exists (semi join)."""
    return requests.join(state.select(*KEY), on=KEY, how="left_semi")


def lookup_misses(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Requests for a known type whose metric does not exist (anti join);
    other types are not lookups that miss but requests that are refused."""
    return requests.where(F.col("type").isin(GAUGE, COUNTER)).join(state.select(*KEY), on=KEY, how="left_anti")
