"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a size (words) and a weight.  All sources together are to give
``share`` times all words; a source's target is its weight's part, at most
``most`` times its own size, the excess going to the others by weight (water
filling).  A target is met by complete epochs of the source first; the rest is
a weighted sample without replacement: document ``d`` gets the exponential key
``-ln(u(d)) / quality(d)``, documents are sorted by it within their source, and
those are taken whose words, summed in that order, come nearest to what is left.

A hot source is not sorted in one task: keys are cut into buckets, bucket sums
give offsets, and only rows of one bucket are sorted together.

Null texts have size 0, a null source is a source of its own and comes last,
rows of equal keys are ordered by id and text, and an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

#: Characters whose share in a text lowers its quality weight.
SYMBOLS = "#*$%&|<>!"
#: Rows of one source that one sort should hold.
BUCKET_ROWS = 200_000


def quality(text: Column) -> Column:
    """The document's weight, from 0.05 (many symbols) to 1 (none)."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - 4.0 * symbols / n)


def draw(doc_id: Column) -> Column:
    """A number in (0, 1) from the id alone, so reruns agree."""
    digits = F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Water filling over one row per source (``source``, ``source_size``)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), nth + 1))
    ratio = most * F.col("source_size") / F.col("_w")
    asc = Window.orderBy("_r", F.col("source").asc_nulls_last())
    before = asc.rowsBetween(Window.unboundedPreceding, -1)
    rest = asc.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) * share
             - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    filled = (weighed.withColumn("_r", ratio).withColumn("_level", level)
              .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_r"), F.struct("_r", "_level")))
                          .over(everything)["_level"]))
    cap = most * F.col("source_size")
    return filled.select("source", "source_size",
                         F.coalesce(F.least(cap, F.col("_level") * F.col("_w")), cap).cast("double").alias("target"))


def mix(docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0,
        prefix: str = "") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (of the source),
    ``copies`` (how often the mix takes the row) and ``taken`` (words).

    The new columns' names get ``prefix``; columns of ``docs`` that have such a
    name are replaced.
    """
    names = {f"_mix_{n}": prefix + n for n in ("size", "source_size", "target", "copies", "taken")}
    given = docs.drop(*names.values())
    text, size = F.coalesce(F.col("text"), F.lit("")), F.col("_mix_size")
    key = -F.ln(draw(F.col("doc_id"))) / quality(text)
    sized = (given.withColumn("_mix_size", F.regexp_count(text, F.lit(WORD)).cast("long"))
             .withColumn("_mix_key", key).withColumn("_mix_tie", F.xxhash64(text)))
    rows = docs.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = max(16, math.ceil(rows / BUCKET_ROWS))
    # exp(-key) is u^(1/quality), in (0, 1): equal steps of it cut the keys into buckets in key order.
    dealt = (sized.withColumn("_mix_bucket", F.floor((1.0 - F.exp(-F.col("_mix_key"))) * buckets).cast("int"))
             .withColumn("_mix_s", F.coalesce(F.col("source"), F.lit(""))).withColumn("_mix_z", F.col("source").isNull()))

    # At most `buckets` rows per source from here on; sums within a source are exact (whole numbers).
    per_bucket = dealt.groupBy("source", "_mix_bucket").agg(F.sum(size).alias("b"))
    before = Window.partitionBy("source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("source", "_mix_bucket", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("_mix_b0"))
    aims = targets(per_bucket.groupBy("source").agg(F.sum("b").alias("source_size")),
                   [float(w) for w in weights], share, most)
    plan = (offsets.join(aims, offsets["source"].eqNullSafe(aims["source"])).select(
        F.coalesce(offsets["source"], F.lit("")).alias("_mix_s"), offsets["source"].isNull().alias("_mix_z"),
        "_mix_bucket", "_mix_b0", F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target")))

    inside = (Window.partitionBy("_mix_s", "_mix_z", "_mix_bucket").orderBy("_mix_key", "doc_id", "_mix_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = dealt.withColumn("_mix_run", F.sum(size).over(inside) - size).join(plan, ["_mix_s", "_mix_z", "_mix_bucket"])
    whole, target = F.col("_mix_source_size"), F.col("_mix_target")
    epochs = F.when(whole > 0, F.floor(target / whole)).otherwise(F.lit(0)).cast("long")
    left = target - epochs * whole
    picked = (left > 0) & (2 * (F.col("_mix_run") + F.col("_mix_b0")) + size <= 2 * left)
    made = placed.withColumn("_mix_copies", epochs + F.when(picked, 1).otherwise(0)).withColumn(
        "_mix_taken", F.col("_mix_copies") * size)
    return made.select(*given.columns, *[F.col(n).alias(to) for n, to in names.items()])
