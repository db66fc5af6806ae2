"""Schemas and fixed vocabulary of the metric model."""

from __future__ import annotations

from pyspark.sql import types as T

# The two metric type names.
GAUGE = "gauge"
COUNTER = "counter"
METRIC_TYPES = (GAUGE, COUNTER)

# Wire record: one update.  ``delta`` is set for counters, ``value`` for gauges.
METRIC = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("hash", T.StringType()),
    ]
)

# Update feed: a wire record plus the engine's order columns.  ``seq`` is the
# arrival order and must be unique per (type, id).
FEED = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Folded state: one row per (type, id).  ``last_seq`` is the seq of the newest
# update folded in; it keeps merges correct when batches arrive out of order.
STATE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("last_seq", T.LongType()),
    ]
)

# Snapshot record as the reference writes it: no order column.
SNAPSHOT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# Lookup request.
VALUE_REQUEST = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("type", T.StringType())]
)

# One delivery attempt of a request.
ATTEMPT = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("sqlstate", T.StringType()),
    ]
)

KEY = ["type", "id"]
STATE_COLS = ["type", "id", "delta", "value", "last_seq"]
