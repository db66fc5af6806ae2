"""Listing, combining and splitting state; the text report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numtext import format_fixed6, format_int
from tallyfold.schema import COUNTER, GAUGE


def list_metrics(state: DataFrame) -> DataFrame:
    """Deterministic listing: ordered by type, then id (a range-partitioned
    sort, no single-task collect)."""
    return state.orderBy("type", "id")


def all_metrics(gauges: DataFrame, counters: DataFrame) -> DataFrame:
    """Gauges followed by counters, as one state table."""
    return gauges.unionByName(counters, allowMissingColumns=True)


def split_state(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State -> (gauges, counters)."""
    g = state.where(F.col("type") == GAUGE).drop("delta")
    c = state.where(F.col("type") == COUNTER).drop("value")
    return g, c


def render_report(state: DataFrame) -> DataFrame:
    """One text line per metric: ``gauge <id> = %f`` then ``counter <id> = %d``.

    ``section`` (0 gauges, 1 counters) and ``id`` give the line order."""
    t = F.col("type")
    line = F.when(
        t == GAUGE, F.concat(F.lit("gauge "), F.col("id"), F.lit(" = "), format_fixed6("value"))
    ).otherwise(F.concat(F.lit("counter "), F.col("id"), F.lit(" = "), format_int("delta")))
    return state.where(t.isin(GAUGE, COUNTER)).select(
        F.when(t == GAUGE, F.lit(0)).otherwise(F.lit(1)).alias("section"), "id", line.alias("line")
    )
