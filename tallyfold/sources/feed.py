"""The update feed projected from the ``events`` table.

Each event becomes one metric update.  The projection is fixed so that the
Spark side and the SQL oracle see the same feed:

* ``seq``   = ``event_id`` (unique, equal to the rank by ``ts``)
* ``id``    = ``event_type || '_' || user_id``
* ``type``  = gauge for purchase/view, counter for click/signup, other else
* ``delta`` = ``props.k`` for counters, NULL on every tenth event
* ``value`` = ``value`` for gauges, NULL on every tenth event

The NULL payloads and the ``other`` type give the feed rows that validation
must reject or skip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.schema import COUNTER, GAUGE
from tallyfold.sources.tables import load_table

# Which event types map to which metric type.
GAUGE_EVENTS = ("purchase", "view")
COUNTER_EVENTS = ("click", "signup")
OTHER_TYPE = "other"


def metric_type_of(event_type: Column) -> Column:
    return (
        F.when(event_type.isin(*GAUGE_EVENTS), F.lit(GAUGE))
        .when(event_type.isin(*COUNTER_EVENTS), F.lit(COUNTER))
        .otherwise(F.lit(OTHER_TYPE))
    )


def feed_from_events(events: DataFrame, keep: tuple[str, ...] = (), hot: bool = False) -> DataFrame:
    """``events`` -> update feed ``(seq, ts, id, type, delta, value)``, plus
    any source columns named in ``keep``.

    ``hot=True`` names each metric by its event type alone, so the whole
    feed falls on five keys (each holds about a fifth of all rows): the
    skewed form used to exercise hot-key handling."""
    has_payload = (F.col("event_id") % 10) != 0
    mtype = metric_type_of(F.col("event_type"))
    mid = F.col("event_type") if hot else F.concat(F.col("event_type"), F.lit("_"), F.col("user_id").cast("string"))
    return events.select(
        *keep,
        F.col("event_id").alias("seq"),
        F.col("ts"),
        mid.alias("id"),
        mtype.alias("type"),
        F.when(
            F.col("event_type").isin(*COUNTER_EVENTS) & has_payload,
            F.get_json_object(F.col("props"), "$.k").cast("bigint"),
        ).alias("delta"),
        F.when(F.col("event_type").isin(*GAUGE_EVENTS) & has_payload, F.col("value")).alias("value"),
    )


def load_feed(
    spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = (), hot: bool = False, types: tuple[str, ...] | None = None
) -> DataFrame:
    """The update feed of ``{sf_dir}/events.parquet``.

    ``types`` keeps only the events of those metric types, filtered on the
    stored ``event_type`` column so the predicate reaches the Parquet scan
    (a filter on the derived ``type`` cannot be pushed)."""
    events = load_table(spark, sf_dir, "events")
    if types is not None:
        wanted = [e for t, names in ((GAUGE, GAUGE_EVENTS), (COUNTER, COUNTER_EVENTS)) if t in types for e in names]
        events = events.where(F.col("event_type").isin(*wanted))
    return feed_from_events(events, keep, hot)
