"""Sharding by sampled splitters (native).

Records are ordered by a key made of a hash of the text and, below it, a hash
of the id, so equal texts stand together while even a group of copies that
holds a third of all rows can be cut.  Size-weighted key samples give quantile
boundaries, rows are range-partitioned at them, ranges that came out overfull
are subdivided from a finer sample of their own, and one running sum inside
each range, added to the ranges' offsets, gives every row its exact place in
the order of all bytes.  Shard ``i`` takes the rows whose middle byte lies in
the ``i``-th of equal parts of all bytes (law ``bytes``): shard sizes differ
from equal by at most the size of the record at a boundary.

Null texts have size 1; texts may be of any length; null ids sort first; repeated
rows get places of their own; an empty table gives no rows.  Other columns pass
through whatever their names are; only input columns that carry one of the output
names (``size``, ``shard``, ``slot``) are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, range_index, splitters, uniform

#: Rows that one range should hold, and the least number of ranges.
RANGE_ROWS = 250_000
MIN_RANGES = 64
#: A range is overfull beyond this many times its equal share.
OVERFULL = 3.0
#: Bits of the key that tell copies of one text apart.
COPY_BITS = 24
#: Sampled rows per range that a cut is made of.
SAMPLE = 32


def _digits(text: Column, first: int, n: int) -> Column:
    """A number from ``n`` hexadecimal digits of the MD5 of ``text``."""
    return F.conv(F.substring(F.md5(text), first, n), 16, 10).cast("long")


def sharding_key() -> Column:
    """36 bits of the text's MD5 and, below them, ``COPY_BITS`` of the id's."""
    by_id = _digits(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), 1, COPY_BITS // 4)
    return _digits(F.coalesce(F.col("text"), F.lit("")), 1, 9) * F.lit(1 << COPY_BITS) + by_id


def boundaries(keyed: DataFrame, ranges: int, total: int, key: str = "key") -> list[int]:
    """Quantile boundaries of ``key`` by ``size``; overfull ranges get more, all of
    a round's from one finer sample of their own."""
    spark, x = keyed.sparkSession, F.col(key)
    cuts = splitters(keyed, x, F.col("size"), ranges, total)
    share = total / ranges
    for again in range(1, 5):
        sizes = (keyed.groupBy(range_index(x, cuts).alias("r"))
                 .agg(F.sum("size").alias("b"), F.min(x).alias("lo"), F.max(x).alias("hi"))
                 .where((F.col("b") > OVERFULL * share) & (F.col("lo") < F.col("hi")))
                 .collect())  # at most ranges / OVERFULL rows
        if not sizes:
            break
        parts = {r["r"]: (math.ceil(r["b"] / share) + 1, int(r["b"])) for r in sizes}
        rates = spark.createDataFrame([(r, n * SAMPLE / b) for r, (n, b) in parts.items()], "r int, rate double")
        drawn = (keyed.select(range_index(x, cuts).alias("r"), x.alias("k"), F.col("size").cast("double").alias("s")).join(rates, "r")
                 .withColumn("p", F.least(F.lit(1.0), F.col("s") * F.col("rate")))
                 .where(uniform(F.col("k"), F.lit(again)) < F.col("p")).select("r", "k", (F.col("s") / F.col("p")).alias("w")).collect())
        new = set(cuts)
        for r, (n, _) in parts.items():
            mine = sorted((d["k"], d["w"]) for d in drawn if d["r"] == r)
            whole, run, made = sum(w for _, w in mine), 0.0, 0
            for k, w in mine:
                run += w
                while made < n - 1 and run >= whole * (made + 1) / n:
                    new.add(int(k))
                    made += 1
        cuts = sorted(new)
    return cuts


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    size = F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + 1
    key = free_name("key", [*docs.columns, "size", "shard", "slot"])
    return shard_rows(docs.withColumn("size", size).withColumn(key, sharding_key()), shards, key)


def shard_rows(keyed: DataFrame, shards: int = 8, key: str = "key") -> DataFrame:
    """Rows with ``doc_id``, a long ``key`` and ``size`` (both as ``shard`` makes them)
    dealt to shards; the key column is dropped."""
    keyed = keyed.drop("shard", "slot")
    at, before, rank, b0, n0, first = (free_name(n, [*keyed.columns, "shard", "slot"])
                                       for n in ("range", "before", "rank", "b0", "n0", "first"))
    stat = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).first()
    n, total = int(stat["n"]), int(stat["b"] or 0)
    ranges = max(MIN_RANGES, math.ceil(n / RANGE_ROWS))
    cuts = boundaries(keyed.select(key, "size"), ranges, total, key)
    placed = keyed.withColumn(at, range_index(F.col(key), cuts))

    # One row per range: exact sizes, then offsets.
    up_to = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(at).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
               .select(at, F.coalesce(F.sum("b").over(up_to), F.lit(0)).alias(b0),
                       F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias(n0)))
    order = Window.partitionBy(at).orderBy(key, "doc_id")
    inside = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (placed.withColumn(before, F.sum("size").over(inside) - F.col("size"))
              .withColumn(rank, F.row_number().over(order))
              .join(offsets, at)
              .withColumn(before, F.col(before) + F.col(b0))
              .withColumn(rank, F.col(rank) - 1 + F.col(n0)))
    nth = F.call_function("div", (2 * F.col(before) + F.col("size")) * shards, F.lit(2 * max(total, 1))).cast("int")
    ranked = materialize(ranked.withColumn("shard", F.least(nth, F.lit(shards - 1))).drop(key, at, before, b0, n0), "sharding")
    firsts = ranked.groupBy("shard").agg(F.min(rank).alias(first))  # at most `shards` rows
    return ranked.join(F.broadcast(firsts), "shard").withColumn("slot", F.col(rank) - F.col(first)).drop(rank, first)
