"""Large JSON arrays read by many tasks.

A snapshot file is one JSON array, often one line; a JSON reader takes such a
file whole, in one task.  Here the file is cut at every ``}`` by Spark's own
splittable text source, and two prefix scans tell which cuts end a record:

1. unescaped quotes before a fragment: an odd number means that the fragment
   begins inside a string;
2. brackets outside strings: the nesting depth at the fragment's ends.

Both scans run in two levels: inside a byte block of the file (what one task
reads) and over the blocks' totals, a row per block.  A fragment that begins and
ends between two records is a record; the few longer ones (a ``}`` in a string,
a nested value) are put together from their fragments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FILE, BLOCK, AT = "_file", "_block", "_at"


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of the files under ``path``, each up to a ``}``, with file, block and place in it."""
    raw = spark.read.option("lineSep", "}").text(path)
    return raw.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
                      F.monotonically_increasing_id().alias(AT), F.col("value").alias("text"))


def before(df: DataFrame, amount: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``amount`` over all earlier fragments of the file."""
    inside = W.partitionBy(FILE, BLOCK).orderBy(AT).rowsBetween(W.unboundedPreceding, -1)
    made = df.withColumn("_amount", amount)
    # One row per block; a file has as many as it has scan splits.
    earlier = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    blocks = made.groupBy(FILE, BLOCK).agg(F.sum("_amount").alias("_n")).select(
        F.col(FILE).alias("_f"), F.col(BLOCK).alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    joined = made.withColumn("_run", F.coalesce(F.sum("_amount").over(inside), F.lit(0))).join(
        blocks, (F.col(FILE) == F.col("_f")) & (F.col(BLOCK) == F.col("_b")))
    return joined.withColumn(name, F.col("_run") + F.col("_first")).drop("_amount", "_run", "_first", "_f", "_b")


def _outside_strings(text: Column, in_string: Column) -> Column:
    """What of a fragment lies outside strings; escapes are gone already."""
    opened = F.when(in_string, F.regexp_replace(text, r'^[^"]*("|$)', "")).otherwise(text)
    return F.regexp_replace(opened, r'"[^"]*("|$)', "")


def read_json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """The records of the JSON arrays under ``path``: ``file``, ``pos`` (0-based, in
    array order) and ``record``, the text of each object.

    Elements must be objects; other elements between them are passed over, and an
    array cut short loses what follows its last whole object.  Compressed files
    cannot be split and take one task each."""
    plain = F.regexp_replace("text", r"\\.", "")
    quoted = before(fragments(spark, path).withColumn("_plain", plain),
                    F.length("_plain") - F.length(F.replace(F.col("_plain"), F.lit('"'), F.lit(""))), "_quotes")
    started = quoted.withColumn("_in", F.col("_quotes") % 2 == 1)
    own = F.length("_plain") - F.length(F.replace(F.col("_plain"), F.lit('"'), F.lit("")))
    bare = started.withColumn("_bare", _outside_strings(F.col("_plain"), F.col("_in"))).withColumn(
        "_ends", (F.col("_quotes") + own) % 2 == 0)

    def count(signs: str) -> Column:
        return F.length("_bare") - F.length(F.translate("_bare", signs, ""))

    change = count("{[") - count("]") - F.when(F.col("_ends"), 1).otherwise(0)
    deep = before(bare.withColumn("_change", change), F.col("_change"), "_depth")
    # Depth 1 is the array itself; a record is over where the depth is back there (the file's end has none).
    closes = F.when(F.col("_ends") & (F.col("_depth") + F.col("_change") == 1) & F.contains("text", F.lit("{"))
                    | (F.col("_ends") & (F.col("_depth") + F.col("_change") == 1) & (F.col("_depth") > 1)), 1).otherwise(0)
    numbered = before(deep.withColumn("_closes", closes), F.col("_closes"), "pos")
    begins = F.col("_depth") <= 1
    # A record's text starts at its first brace outside the array's own signs.
    piece = F.concat(F.when(begins, F.regexp_extract("text", r"(?s)^[^{]*(\{.*)$", 1)).otherwise(F.col("text")), F.lit("}"))
    parts = numbered.select(F.col(FILE).alias("file"), "pos", BLOCK, AT, piece.alias("piece"), (begins & (F.col("_closes") == 1)).alias("whole"),
                            F.col("_closes").alias("closes"))
    whole = parts.where("whole").select("file", "pos", F.col("piece").alias("record"))
    together = parts.where("not whole").groupBy("file", "pos").agg(
        F.max("closes").alias("closes"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(BLOCK, AT, "piece"))),
                                                      lambda p: p["piece"]), "").alias("record"))
    return whole.unionByName(together.where("closes = 1").select("file", "pos", "record"))
