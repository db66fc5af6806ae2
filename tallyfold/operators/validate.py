"""Validation of updates with the reference's outcome codes.

The same record is judged differently per entry point:

* ``path``   (``/update/{type}/{name}/{value}``): 404 empty name, 400 unknown
  type, 400 unparsable number, else 200.
* ``json``   (one JSON update): 400 undecodable, 400 missing payload, 501
  unknown type, else 200.
* ``batch``  (JSON array, lenient store): unknown types and rows without
  payload are skipped silently.
* ``batch_strict`` (per-record fallback): rows before the first bad row of
  a batch are applied, the batch answers 400.

Every rule is one ``CASE`` chain or one aggregate; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.jsoncodec import entries_ok, parse_batch
from tallyfold.functions.numtext import parse_counter, parse_gauge
from tallyfold.operators.fold import is_valid_update
from tallyfold.schema import COUNTER, GAUGE

MAX_BODY_BYTES = 10 * 1024 * 1024
JSON_CONTENT_TYPE = "application/json"


def route_by_type(df: DataFrame, text: str = "text") -> DataFrame:
    """Parse the payload text into the column its type selects."""
    t = F.col("type")
    return df.withColumn("delta", F.when(t == COUNTER, parse_counter(text))).withColumn(
        "value", F.when(t == GAUGE, parse_gauge(text))
    )


def path_status(type_col: str = "type", id_col: str = "id", text: str = "text") -> Column:
    t, name, s = F.col(type_col), F.col(id_col), F.col(text)
    return (
        F.when(name.isNull() | (name == ""), F.lit(404))
        .when(t == GAUGE, F.when(parse_gauge(s).isNull(), F.lit(400)).otherwise(F.lit(200)))
        .when(t == COUNTER, F.when(parse_counter(s).isNull(), F.lit(400)).otherwise(F.lit(200)))
        .otherwise(F.lit(400))
    )


def json_status(decoded: Column | None = None) -> Column:
    t = F.col("type")
    chain = F.when(t == GAUGE, F.when(F.col("value").isNull(), F.lit(400)).otherwise(F.lit(200))).when(
        t == COUNTER, F.when(F.col("delta").isNull(), F.lit(400)).otherwise(F.lit(200))
    ).otherwise(F.lit(501))
    if decoded is not None:
        chain = F.when(~F.coalesce(decoded, F.lit(False)), F.lit(400)).otherwise(chain)
    return chain


def validate(df: DataFrame, mode: str = "batch", batch_col: str = "batch_id", seq: str = "seq") -> DataFrame:
    """Judge update rows per entry point (see module doc).

    ``path`` expects ``type, id, text`` and adds parsed ``delta``/``value``
    and ``status``; ``json`` expects decoded ``type, id, delta, value``
    (and optionally ``decoded``) and adds ``status``; ``batch`` keeps the
    rows that are applied; ``batch_strict`` keeps, per ``batch_col``, the
    rows before the first bad one and adds the batch ``status``."""
    if mode == "path":
        return route_by_type(df.withColumn("status", path_status()))
    if mode == "json":
        dec = F.col("decoded") if "decoded" in df.columns else None
        return df.withColumn("status", json_status(dec))
    if mode == "batch":
        return df.where(is_valid_update())
    if mode == "batch_strict":
        return _batch_strict(df, batch_col, seq)
    raise ValueError(f"unknown mode {mode!r}")


def _batch_strict(df: DataFrame, batch_col: str, seq: str) -> DataFrame:
    # One pass of the two-level running sum over each batch in seq order:
    # rows before the first bad row have a running bad count of 0, and the
    # batch's total bad count gives its status.  A hot batch is never sorted
    # or gathered in one task, and the input is not computed twice.
    from tallyfold.operators.history import running

    bad = F.when(F.coalesce(is_valid_update(), F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    r = running(df.withColumn("_bad", bad), [batch_col], seq,
                {"_pre": ("sum", "_bad"), "_all": ("total", "_bad")})
    status = F.when(F.col("_all") > 0, F.lit(400)).otherwise(F.lit(200))
    return r.where(F.col("_pre") == 0).withColumn("status", status).drop("_bad", "_pre", "_all")


def batch_status(df: DataFrame, batch_col: str = "batch_id", seq: str = "seq") -> DataFrame:
    """Per batch: 400 with the first bad seq, or 200 (strict fallback)."""
    return df.groupBy(batch_col).agg(
        F.min(F.when(~F.coalesce(is_valid_update(), F.lit(False)), F.col(seq))).alias("first_bad")
    ).withColumn("status", F.when(F.col("first_bad").isNull(), F.lit(200)).otherwise(F.lit(400)))


def limited(body: Column) -> Column:
    """What of a body is read: its first 10 MiB."""
    return F.when(F.octet_length(body) <= MAX_BODY_BYTES, body).otherwise(
        F.substring(body.cast("binary"), 1, MAX_BODY_BYTES).cast("string"))


def batch_body_status(body: Column | str = "body", content_type: Column | str | None = "content_type",
                      parsed: Column | None = None) -> Column:
    """Status of a whole batch request body.

    415 for a content type other than JSON; 400 for one that does not begin with
    a JSON array, complete within its first 10 MiB, of update objects with fields
    of the right JSON types, or for an empty array; else 200.  ``parsed`` is
    ``parse_batch(limited(body))``, if the caller has it."""
    b = F.col(body) if isinstance(body, str) else body
    arr = parsed if parsed is not None else parse_batch(limited(b))
    chain = F.when(arr.isNull(), F.lit(400)).when(F.size(arr) == 0, F.lit(400)).when(
        ~F.forall(arr, lambda el: entries_ok(el)), F.lit(400)).otherwise(F.lit(200))
    if content_type is not None:
        ct = F.col(content_type) if isinstance(content_type, str) else content_type
        chain = F.when(ct.isNotNull() & (ct != "") & (ct != JSON_CONTENT_TYPE), F.lit(415)).otherwise(chain)
    return chain


def validate_batches(df: DataFrame, body: str = "body", content_type: str | None = "content_type",
                     keep_parsed: bool = False) -> DataFrame:
    """Add the batch-level ``status`` to a table of batch requests.

    ``keep_parsed`` also keeps the parsed body as the column ``parsed``, so
    accepted batches can be decoded without parsing again
    (see :func:`tallyfold.sources.readers.decode_parsed_batches`)."""
    ct = content_type if (content_type and content_type in df.columns) else None
    p = df.withColumn("parsed", parse_batch(limited(F.col(body))))
    judged = p.withColumn("status", batch_body_status(body, ct, F.col("parsed")))
    return judged if keep_parsed else judged.drop("parsed")


def ack(df: DataFrame) -> DataFrame:
    """Acknowledgement of accepted single JSON updates: the request echoed
    (with its ``hash``, if the table has one)."""
    fields = ["id", "type", "delta", "value", *(["hash"] if "hash" in df.columns else [])]
    return df.where(F.col("status") == 200).withColumn("reply", F.to_json(F.struct(*fields)))


def batch_ack(df: DataFrame) -> DataFrame:
    """Acknowledgement per accepted batch (plain ``{"status":"ok"}``)."""
    return df.where(F.col("status") == 200).withColumn("reply", F.lit('{"status":"ok"}'))
