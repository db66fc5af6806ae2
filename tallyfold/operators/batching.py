"""Size-or-interval batching of updates and batch payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.timeutil import with_interval
from tallyfold.operators.history import DEFAULT_RANGE_ROWS, running

WIRE_FIELDS = ("id", "type", "delta", "value")


def assign_batches(
    df: DataFrame,
    max_size: int,
    every: str,
    ts: str = "ts",
    seq: str = "seq",
    range_rows: int | None = DEFAULT_RANGE_ROWS,
) -> DataFrame:
    """Batch number of each row: a batch is flushed at each interval tick and
    whenever it reaches ``max_size`` rows (``max_size <= 0``: ticks only).

    Adds ``win_start`` (the tick interval) and ``batch_no`` (0-based within
    the interval).  The row number inside an interval is a two-level running
    count, so a busy interval is not sorted in one task.  Rows without a time
    are batched together, under a NULL interval."""
    w = with_interval(df, ts, every)
    if max_size <= 0:
        return w.withColumn("batch_no", F.lit(0).cast("bigint"))
    r = running(w, ["win_start"], seq, {"_rn": ("count", None)}, range_rows)
    return r.withColumn("batch_no", F.floor((F.col("_rn") - 1) / F.lit(max_size))).drop("_rn")


def require_bounded(max_size: int) -> None:
    """Payload encoding collects one batch into one array: only batches with
    a size cap are bounded."""
    if max_size <= 0:
        raise ValueError("encoding payloads needs max_size > 0 (a batch is collected into one array)")


# Rows of one batch that are collected without a stated cap.
MOST_ROWS = 100_000


def encode_batches(df: DataFrame, seq: str = "seq", batch_cols=("win_start", "batch_no"), max_size: int | None = None) -> DataFrame:
    """One payload row per batch: the JSON array of its records in seq order.

    Collecting a batch into one array needs a bound.  With ``max_size`` (the cap
    given to :func:`assign_batches`) a larger batch fails the job; without, the
    batches are counted first, and one of more than ``MOST_ROWS`` rows is refused
    before anything is collected."""
    if max_size is not None:
        require_bounded(max_size)
    else:
        largest = df.groupBy(*batch_cols).count().agg(F.max("count")).first()[0] or 0
        if largest > MOST_ROWS:
            raise ValueError(f"a batch of {largest} rows: batches need a size cap (assign_batches with max_size > 0)")
    rec = F.struct(F.col(seq).alias("_o"), *[F.col(c) for c in WIRE_FIELDS])
    recs = F.array_sort(F.collect_list(rec))
    wire = F.transform(recs, lambda r: F.struct(*[r[c].alias(c) for c in WIRE_FIELDS]))
    rows = F.count(F.lit(1))
    if max_size is not None:
        rows = F.when(rows > max_size, F.raise_error(F.lit(f"a batch has more than {max_size} rows")).cast("bigint")).otherwise(rows)
    return df.groupBy(*batch_cols).agg(
        rows.alias("n_rows"),
        F.min(seq).alias("first_seq"),
        F.max(seq).alias("last_seq"),
        F.to_json(wire).alias("payload"),
    )
