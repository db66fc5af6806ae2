"""Readers for update batches, feeds, update paths and lookup requests.

Compressed files (``.gz``) are decoded by the Hadoop codec chosen by file
suffix, so every reader here also reads gzip input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.jsoncodec import decoded_field, empty_if_absent, parse_batch, parse_object
from tallyfold.schema import METRIC, VALUE_REQUEST
from tallyfold.sources.arrays import read_json_arrays

def decode_batches(df: DataFrame, body: str = "body", keep=()) -> DataFrame:
    """Batch bodies (JSON arrays) -> one update row per element, with the
    element's 0-based position as ``pos`` (array order is arrival order)."""
    return decode_parsed_batches(df.withColumn("_batch", parse_batch(F.col(body))), "_batch", keep)


def decode_parsed_batches(df: DataFrame, parsed: str = "parsed", keep=()) -> DataFrame:
    """Like :func:`decode_batches`, from bodies already parsed by ``parse_batch``
    (``validate_batches(..., keep_parsed=True)``): no second JSON parse."""
    e = df.select(*keep, F.posexplode(parsed).alias("pos", "_entries"))
    return e.select(*keep, "pos", *[decoded_field(F.col("_entries"), f.name).alias(f.name) for f in METRIC.fields])


def read_metric_batch(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """JSON array files -> update rows in array order.

    Each file is one batch (``batch_id`` = file name); ``pos`` keeps the
    array order.  Files are read whole, one per task, like request bodies: a
    malformed one gives no rows.  With ``whole=False`` each file is cut into
    blocks for many tasks (a large feed kept as one array; see
    :mod:`tallyfold.sources.arrays`)."""
    if whole:
        raw = spark.read.text(path, wholetext=True).select(
            F.input_file_name().alias("batch_id"), F.col("value").alias("body")
        )
        return decode_batches(raw, "body", keep=("batch_id",))
    e = read_json_arrays(spark, path).withColumn("_entries", parse_object(F.col("record")))
    return e.select(F.col("file").alias("batch_id"), "pos",
                    *[decoded_field(F.col("_entries"), f.name).alias(f.name) for f in METRIC.fields])


def read_batch_requests(spark: SparkSession, path: str) -> DataFrame:
    """Batch requests kept as JSON lines ``{batch_seq, body}``, many to a file -> update
    rows with ``batch_seq`` and ``pos``."""
    return decode_batches(spark.read.schema("batch_seq bigint, body string").json(path), "body", keep=("batch_seq",))


def read_metric_feed(spark: SparkSession, path: str, streaming: bool = False, order_col: str | None = None) -> DataFrame:
    """JSON-lines updates (one object per line); malformed lines are kept
    with their text in ``_corrupt_record``.  ``order_col`` names an extra
    BIGINT field carrying the arrival order (e.g. ``seq``)."""
    extra = [T.StructField(order_col, T.LongType())] if order_col else []
    schema = T.StructType(extra + METRIC.fields + [T.StructField("_corrupt_record", T.StringType())])
    reader = spark.readStream if streaming else spark.read
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("allowNonNumericNumbers", "false")
        .json(path)
    )


def split_update_path(df: DataFrame, col: str = "value") -> DataFrame:
    """``/update/{type}/{name}/{value}`` -> ``type, id, text``."""
    p = F.split(F.col(col), "/", -1)
    well = (F.size(p) == 5) & (F.element_at(p, 1) == "") & (F.element_at(p, 2) == "update")
    return df.select(
        "*",
        F.when(well, F.element_at(p, 3)).alias("type"),
        F.when(well, F.element_at(p, 4)).alias("id"),
        F.when(well, F.element_at(p, 5)).alias("text"),
    )


def read_update_paths(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of update paths -> ``path, type, id, text``."""
    return split_update_path(spark.read.text(path).withColumnRenamed("value", "path"), "path")


def split_value_path(df: DataFrame, col: str = "path") -> DataFrame:
    """``/value/{type}/{name}`` -> ``type, id``."""
    p = F.split(F.col(col), "/", -1)
    well = (F.size(p) == 4) & (F.element_at(p, 1) == "") & (F.element_at(p, 2) == "value")
    return df.select("*", F.when(well, F.element_at(p, 3)).alias("type"), F.when(well, F.element_at(p, 4)).alias("id"))


def read_value_requests(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    """Lookup requests: JSON ``{id, type}`` lines or ``/value/{type}/{name}`` lines."""
    if form == "json":
        raw = spark.read.schema(VALUE_REQUEST).json(path)
        return raw.select(*[empty_if_absent(c, F.col(c)).alias(c) for c in raw.columns])
    if form == "path":
        return split_value_path(spark.read.text(path).withColumnRenamed("value", "path"), "path")
    raise ValueError(f"unknown form {form!r}")
