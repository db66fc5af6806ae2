"""State over time: running counters, gauges as of each update, ranks.

A plain ``Window.partitionBy(key).orderBy(seq)`` sorts one metric's whole
history inside one task, which breaks when one key holds a large share of
all rows.  :func:`running` bounds what a task sorts by a number of rows, for
any distribution of keys and order values:

1. rows are counted per key.  A key with at most ``range_rows`` rows is one
   range; the order column of a larger key is cut at approximate quantiles of
   *that key's* rows, into as many ranges as its rows ask for, and a range that
   is still too large is cut again, until none is;
2. each range of a cut key is summarised by a partial aggregate (combined
   map-side, so a hot key ships one row per range and map task).  What precedes
   a range within its key is the same running value over the summaries, so it
   comes from :func:`running` itself: a key with more ranges than ``range_rows``
   is cut again at that level, and so on;
3. the rows meet the values before their range by a join on (key, range) and
   run through a window on the same partitioning: the raw rows are shuffled once.

The result equals the one-level window for every row; rows without an order
come first, in a range of their own.  If no key is large, the one-level window
is all there is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.operators.fold import valid_updates
from tallyfold.schema import COUNTER, GAUGE, KEY
from tallyfold.session import materialize

# Rows of one key that a task sorts at most.
DEFAULT_RANGE_ROWS = 1_000_000
# Ranges that one pass over the data cuts a group into at most, and passes at most
# (more are only asked for by order values that repeat, which cannot be cut).
FANOUT, PASSES = 1024, 6
# Cut values (8 bytes each) that are broadcast at most; a larger table is joined with salted keys.
BROADCAST_VALUES, SALTS = 4_000_000, 64
# Summaries are cut into ranges of this many rows at least, so that every level is smaller than the one below.
LEAST_SUMMARIES = 16

# Kinds of running value:
#   sum   running sum, current row included (NULL until a non-NULL input)
#   count running row count, current row included
#   last  last non-NULL value, current row included
#   prev  last non-NULL value strictly before the current row
#   before  running sum strictly before the current row
#   total sum over all rows of the key (no order)
KINDS = ("sum", "count", "last", "prev", "before", "total")


def _one_level(df: DataFrame, keys: Sequence[str], order: str, specs: dict[str, tuple[str, str | None]]) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(order)
    inc = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    exc = w.rowsBetween(W.unboundedPreceding, -1)
    cols = []
    for out, (kind, c) in specs.items():
        if kind == "sum":
            cols.append(F.sum(c).over(inc).alias(out))
        elif kind == "count":
            cols.append(F.count(F.lit(1)).over(inc).alias(out))
        elif kind == "last":
            cols.append(F.last(c, ignorenulls=True).over(inc).alias(out))
        elif kind == "prev":
            cols.append(F.last(c, ignorenulls=True).over(exc).alias(out))
        elif kind == "before":
            cols.append(F.sum(c).over(exc).alias(out))
        else:
            cols.append(F.sum(c).over(W.partitionBy(*keys)).alias(out))
    return df.select("*", *cols)


def _key_columns(df: DataFrame, keys: Sequence[str], p: str) -> tuple[DataFrame, list[str], list[str]]:
    """Null-safe surrogate keys: each key becomes (value with NULL replaced by
    a default of its type, is-NULL flag).  Window partitioning and the join
    below then use the very same plain columns, so the join reuses the
    window's hash partitioning and sort instead of shuffling the rows again.
    Keys of types without a simple default are returned apart: the join
    compares them null-safely."""
    types = dict(df.dtypes)
    cols, names, others = [], [], []
    for i, k in enumerate(keys):
        dt = types[k]
        if dt == "string":
            default = F.lit("")
        elif dt in ("tinyint", "smallint", "int", "bigint", "float", "double") or dt.startswith("decimal"):
            default = F.lit(0).cast(dt)
        elif dt in ("timestamp", "timestamp_ntz", "date"):
            default = F.lit(0).cast("timestamp").cast(dt)
        elif dt == "boolean":
            default = F.lit(False)
        else:
            cols.append(F.col(k).alias(f"{p}k{i}"))
            others.append(f"{p}k{i}")
            continue
        cols += [F.coalesce(F.col(k), default).alias(f"{p}k{i}"), F.col(k).isNull().alias(f"{p}n{i}")]
        names += [f"{p}k{i}", f"{p}n{i}"]
    return df.select("*", *cols), names, others


def quantiles(df: DataFrame, order: str, ranges: int) -> list:
    """At most ``ranges - 1`` increasing values that cut ``order`` into about
    equally full ranges (one aggregate; that many values reach the driver)."""
    if ranges <= 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    return sorted(set(df.agg(F.percentile_approx(order, shares, 4 * ranges)).first()[0] or []))


def _join_cuts(rows: DataFrame, cuts: DataFrame, values: int, columns: Sequence[str], p: str, how: str) -> DataFrame:
    """Rows and the cuts of their group.  The cuts are broadcast while they have few
    values; beyond that each row draws one of ``SALTS`` copies of them, so that
    the rows of a hot group spread over as many tasks."""
    theirs = {c: f"{p}their_{c}" for c in columns}
    named = cuts.select(*[F.col(c).alias(n) for c, n in theirs.items()], *[c for c in cuts.columns if c not in columns])
    on = F.lit(True)
    for c, n in theirs.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    if values <= BROADCAST_VALUES:
        return rows.join(F.broadcast(named), on, how).drop(*theirs.values())
    copies = named.withColumn(f"{p}copy", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salted = rows.withColumn(f"{p}salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return salted.join(copies, on & (F.col(f"{p}salt") == F.col(f"{p}copy")), how).drop(f"{p}salt", f"{p}copy", *theirs.values())


def _range_of(x: Column, cuts: Column) -> Column:
    """Number of ``cuts`` (an increasing array) not above ``x``, by binary search."""
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(FANOUT.bit_length()))])
    return F.aggregate(powers, F.lit(0), lambda lo, step: F.when(
        (lo + step <= F.size(cuts)) & (F.get(cuts, lo + step - 1) <= x), lo + step).otherwise(lo))


def free_prefix(columns: Sequence[str]) -> str:
    """Underscores that no column's name begins with, for names of our own."""
    p = "_"
    while any(c.startswith(p) for c in columns):
        p += "_"
    return p


def with_ranges(df: DataFrame, keys: Sequence[str], order: str, range_rows: int, p: str) -> tuple[DataFrame, int]:
    """``df`` with ``{p}rb``, a range of ``order`` within the key, and ``{p}hot`` (the
    key was cut), and how many passes cut it (0: no key is large, and no columns).

    No (key, range) has more than ``range_rows`` rows, but for rows of equal
    order values.  Every pass reads ``df`` twice; ranges are numbered in order."""
    rb, hot, n, low, high, value, cuts_col, grid = (p + c for c in ("rb", "hot", "n", "lo", "hi", "x", "cuts", "grid"))
    rows, cut = df.withColumn(rb, F.lit(0).cast("bigint")).withColumn(hot, F.lit(False)), [*keys, rb]
    x = F.col(order)
    for done in range(PASSES):
        large = rows.groupBy(*cut).agg(F.count(F.lit(1)).alias(n), F.min(x).alias(low), F.max(x).alias(high))
        large = large.where((F.col(n) > range_rows) & (F.col(low) < F.col(high)))
        size = large.agg(F.count(F.lit(1)), F.sum(n)).first()
        if not size[0]:
            return (rows, done) if done else (df, 0)
        large = materialize(large, "large-keys")
        # Twice as many ranges as full ones would give leaves room for the approximation.
        shares = [i / FANOUT for i in range(1, FANOUT)]
        ranges = F.least(F.lit(FANOUT), F.ceil(2 * F.col(n) / F.lit(range_rows)))
        found = (_join_cuts(rows.select(*cut, x.alias(value)), large, 4 * size[0], cut, p, "inner")
                 .groupBy(*cut).agg(F.percentile_approx(value, shares, 4 * FANOUT).alias(grid),
                                    *[F.first(c).alias(c) for c in (n, low, high)]))
        some = F.transform(F.sequence(F.lit(1), ranges - 1),
                           lambda i: F.get(grid, (F.floor(i * FANOUT / ranges) - 1).cast("int")))
        inner = F.array_sort(F.array_distinct(F.filter(some, lambda c: c > F.col(low))))
        cuts = found.select(*cut, F.when(F.size(inner) > 0, inner).otherwise(F.array(high)).alias(cuts_col))
        values = size[0] * 4 + math.ceil(2 * size[1] / range_rows)
        rows = _join_cuts(rows, materialize(cuts, "key-cuts"), values, cut, p, "left")
        place = F.when(F.col(cuts_col).isNull() | x.isNull(), F.lit(0)).otherwise(_range_of(x, F.col(cuts_col)) + 1)
        rows = (rows.withColumn(rb, F.col(rb) * (FANOUT + 1) + place)
                .withColumn(hot, F.col(hot) | F.col(cuts_col).isNotNull()).drop(cuts_col))
    return rows, PASSES


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    specs: dict[str, tuple[str, str | None]],
    range_rows: int | None = DEFAULT_RANGE_ROWS,
) -> DataFrame:
    """Add running values per ``keys`` in ``order`` (numeric, unique within a key).

    ``specs`` maps an output name to ``(kind, input column)``; see ``KINDS``.
    No task sorts more than ``range_rows`` rows of one key; ``None`` uses a
    single window level.  ``df`` is read once for the rows per key when this is
    called and, if a key is large, again for its cuts and summaries: cheap for a
    scan, but an expensive ``df`` should be materialised first
    (:func:`tallyfold.session.materialize` or ``checkpoint()``)."""
    for kind, _ in specs.values():
        if kind not in KINDS:
            raise ValueError(f"unknown running kind {kind!r}")
    if range_rows is None:
        return _one_level(df, keys, order, specs)
    if range_rows <= 0:
        raise ValueError("range_rows must be positive")

    p = free_prefix(df.columns)
    rb, hot = f"{p}rb", f"{p}hot"
    keyed, names, others = _key_columns(df, keys, p)
    kcols = [*names, *others]
    base, passes = with_ranges(keyed, kcols, order, range_rows, p)
    if not passes:
        return _one_level(df, keys, order, specs)
    part = [*kcols, rb]

    # Range summaries: a partial (map-side) aggregate, so only one small
    # row per (key, range) and map task is shuffled.  All buffers are
    # fixed-width, so this stays a hash aggregate.
    first = F.coalesce(F.col(order), F.lit(-(2**63)))
    aggs, above = [], {}
    for out, (kind, c) in specs.items():
        within, off = f"{p}bs_{out}", f"{p}off_{out}"
        if kind in ("last", "prev"):  # newest non-NULL value of the range
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), first)).alias(within))
            above[off] = ("prev", within)
        else:
            aggs.append((F.count(F.lit(1)) if kind == "count" else F.sum(c)).alias(within))
            above[off] = ("total" if kind == "total" else "before", within)
    summary = materialize(base.where(hot).groupBy(*part).agg(*aggs), "range-summaries")

    # What precedes each range within its key: the same operator, one level up.
    offsets = running(summary, kcols, rb, above, max(range_rows, LEAST_SUMMARIES))
    offsets = offsets.select(*[F.col(c).alias(f"{p}o_{c}") for c in part], *above)

    # The raw rows meet their offsets first, then the level-1 window runs on
    # the same (key, range) partitioning: the raw rows are shuffled once.
    same = F.lit(True)
    for c in [*names, rb]:
        same = same & (F.col(c) == F.col(f"{p}o_{c}"))
    for c in others:
        same = same & F.col(c).eqNullSafe(F.col(f"{p}o_{c}"))
    j = base.join(offsets, on=same, how="left")
    lvl1 = _one_level(j, part, order, {f"{p}in_{o}": ks for o, ks in specs.items()})

    finals = []
    for out, (kind, _) in specs.items():
        a, b = F.col(f"{p}in_{out}"), F.col(f"{p}off_{out}")
        if kind == "total":
            finals.append(F.when(F.col(hot), b).otherwise(a).alias(out))
        elif kind in ("sum", "count", "before"):
            total = F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
            finals.append(F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(total).alias(out))
        else:
            finals.append(F.coalesce(a, b).alias(out))
    return lvl1.select(*df.columns, *finals)


def running_counter(df: DataFrame, range_rows: int | None = DEFAULT_RANGE_ROWS) -> DataFrame:
    """Counter total after every applied counter update: ``total``."""
    c = valid_updates(df).where(F.col("type") == COUNTER).select("seq", "type", "id", "delta")
    return running(c, KEY, "seq", {"total": ("sum", "delta")}, range_rows)


def running_gauge(df: DataFrame, range_rows: int | None = DEFAULT_RANGE_ROWS) -> DataFrame:
    """For every gauge row (with or without a value) the gauge as of that
    position: ``value_asof`` is the newest value at or before it."""
    g = df.where(F.col("type") == GAUGE).select("seq", "type", "id", "value")
    return running(g, KEY, "seq", {"value_asof": ("last", "value")}, range_rows)


def cumulative_to_delta(df: DataFrame, range_rows: int | None = DEFAULT_RANGE_ROWS) -> DataFrame:
    """Counters reported as running totals -> increments.

    The increment is the change from the previous report of the same id; the
    first report, and one lower than its predecessor (the sender restarted
    from zero), counts in full."""
    c = valid_updates(df).where(F.col("type") == COUNTER).select(
        "seq", "type", "id", F.col("delta").alias("cumulative")
    )
    r = running(c, KEY, "seq", {"_prev": ("prev", "cumulative")}, range_rows)
    cur, prev = F.col("cumulative"), F.col("_prev")
    inc = F.when(prev.isNull() | (cur < prev), cur).otherwise(cur - prev)
    return r.select("seq", "type", "id", "cumulative", inc.alias("delta"))


def update_rank(df: DataFrame, range_rows: int | None = DEFAULT_RANGE_ROWS) -> DataFrame:
    """1-based number of each applied update within its metric."""
    v = valid_updates(df).select("seq", "type", "id")
    return running(v, KEY, "seq", {"rank": ("count", None)}, range_rows)


def replay_reads(df: DataFrame, range_rows: int | None = DEFAULT_RANGE_ROWS) -> DataFrame:
    """What a lookup at each position of the feed would have returned.

    Reads are rows of a known type without payload; writes are the applied
    updates.  Both go through one running pass per key: the counter total,
    the newest gauge value and the number of writes so far.  A read with no
    earlier write is a 404."""
    t = F.col("type")
    known = df.where(t.isin(GAUGE, COUNTER)).select(
        "seq", "type", "id",
        F.when(t == COUNTER, F.col("delta")).alias("delta"),
        F.when(t == GAUGE, F.col("value")).alias("value"),
    )
    is_write = F.col("delta").isNotNull() | F.col("value").isNotNull()
    tagged = known.withColumn("_w", F.when(is_write, F.lit(1)))
    r = running(
        tagged, KEY, "seq",
        {"_n": ("sum", "_w"), "_tot": ("sum", "delta"), "_val": ("last", "value")},
        range_rows,
    )
    reads = r.where(F.col("_w").isNull())
    found = F.coalesce(F.col("_n"), F.lit(0)) > 0
    return reads.select(
        "seq", "type", "id",
        F.when(found, F.lit(200)).otherwise(F.lit(404)).alias("status"),
        F.when(found & (t == COUNTER), F.col("_tot")).alias("delta"),
        F.when(found & (t == GAUGE), F.col("_val")).alias("value"),
    )
