"""Zone-free conversions between TIMESTAMP_NTZ (UTC wall time) and TIMESTAMP.

Casting between the two goes through the session time zone, and through its
daylight-saving gaps and overlaps.  These helpers use only field and epoch
arithmetic, so results are the same in every session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_instant(ntz: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall time -> TIMESTAMP (watermarks need
    TIMESTAMP).  Built from the wall-time fields with an explicit UTC zone, so
    the session time zone and its daylight-saving changes play no part."""
    secs = F.second(ntz).cast("decimal(8,6)") + (F.date_format(ntz, "SSSSSS").cast("int") / F.lit(1000000)).cast(
        "decimal(8,6)"
    )
    return F.make_timestamp(
        F.year(ntz), F.month(ntz), F.dayofmonth(ntz), F.hour(ntz), F.minute(ntz), secs.cast("decimal(8,6)"),
        F.lit("UTC"),
    )


def utc_wall(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding its UTC wall time: the epoch plus
    the instant's microseconds as a day-time interval (zone-free)."""
    micros = F.unix_micros(ts)
    day = F.lit(86_400_000_000)
    days = F.floor(micros / day)
    rest = ((micros - days * day) / F.lit(1000000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), rest)


def interval_start(ts: Column, every: str) -> Column:
    """Start of the tumbling interval of ``ts``; NULL for a NULL time.  A plain
    ``window`` would drop such rows."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.window(F.coalesce(ts, epoch), every).start


def with_interval(df, ts: str, every: str, name: str = "win_start"):
    """``df`` with the interval start; rows without a time form an interval of their own (NULL)."""
    made = df.withColumn(name, interval_start(F.col(ts), every))
    return made.withColumn(name, F.when(F.col(ts).isNotNull(), F.col(name)))


def epoch_seconds(ntz: Column) -> Column:
    """Seconds since the epoch of a UTC wall time (zone-free)."""
    return F.unix_seconds(utc_instant(ntz))
