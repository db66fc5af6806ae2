"""The batch ingest flow: signed batch bodies into merged state.

signature check -> whole-batch check -> decode accepted batches -> order ->
lenient fold merged into state.  Every step is a native expression or one
aggregate; bodies are parsed once for both the check and the decode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.signing import verify_signature
from tallyfold.operators import fold
from tallyfold.functions.jsoncodec import parse_batch
from tallyfold.operators.validate import batch_body_status, limited
from tallyfold.sources.readers import decode_parsed_batches


def batch_statuses(
    batches: DataFrame,
    key: str | None = None,
    body: str = "body",
    signature: str | None = "signature",
    content_type: str | None = "content_type",
) -> DataFrame:
    """Add ``parsed`` (the body's elements) and ``status`` per batch: 400 for
    a signature that does not match (when a key is set and a signature sent),
    else the whole-batch check (415 / 400 / 200)."""
    p = batches.withColumn("parsed", parse_batch(limited(F.col(body))))
    ct = content_type if (content_type and content_type in batches.columns) else None
    checked = batch_body_status(body, ct, F.col("parsed"))
    if key and signature and signature in batches.columns:
        sig_ok = verify_signature(F.col(body), F.col(signature), key) == 200
        checked = F.when(sig_ok, checked).otherwise(F.lit(400))
    return p.withColumn("status", checked)


def ingest_batches(
    batches: DataFrame,
    state: DataFrame | None = None,
    key: str | None = None,
    order_col: str = "batch_seq",
    body: str = "body",
    signature: str | None = "signature",
    content_type: str | None = "content_type",
) -> tuple[DataFrame, DataFrame]:
    """Apply a table of batch requests to ``state``.

    ``batches`` has one row per request with ``order_col`` (arrival order of
    the batch: a unique BIGINT), ``body`` and
    optionally ``signature`` and ``content_type``.  Returns ``(statuses,
    new_state)``: the status of every batch, and the state after the
    accepted batches, whose rows are applied in (batch order, position)
    order with the lenient rules (unknown types and rows without payload are
    skipped).  ``last_seq`` is the order of the newest batch of a key; a
    ``state`` must carry the same orders."""
    judged = batch_statuses(batches, key, body, signature, content_type)
    statuses = judged.drop("parsed")
    rows = decode_parsed_batches(judged.where(F.col("status") == 200), "parsed", keep=(order_col,))
    folded = fold.fold_batches(rows, order_col)
    new_state = folded if state is None else fold.merge_state(state, fold.state_as_updates(folded))
    return statuses, new_state
