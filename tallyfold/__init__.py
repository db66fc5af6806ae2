"""tallyfold: metric-state operators on Spark DataFrames.

Gauge and counter updates are folded into keyed state (last write wins for
gauges, sums for counters) with one shuffle; around the fold sit validation,
encoding, signing, batching, snapshots, lookups, history and interval reports.
Every operator is ``DataFrame -> DataFrame`` built from native Spark
expressions.

The most used operators are importable from the package itself::

    from tallyfold import fold, merge_state, lookup, running_counter
"""

from tallyfold.operators.batching import assign_batches, encode_batches  # noqa: F401
from tallyfold.operators.fold import fold, fold_counters, fold_gauges, merge_state, merge_state_join  # noqa: F401
from tallyfold.operators.history import (  # noqa: F401
    cumulative_to_delta,
    replay_reads,
    running,
    running_counter,
    running_gauge,
    update_rank,
)
from tallyfold.operators.ingest import ingest_batches  # noqa: F401
from tallyfold.operators.lookup import lookup, lookup_hits, lookup_misses, lookup_one  # noqa: F401
from tallyfold.operators.sampling import report_filled, report_intervals, sample_intervals  # noqa: F401
from tallyfold.operators.validate import validate, validate_batches  # noqa: F401
from tallyfold.schema import COUNTER, GAUGE, METRIC, STATE  # noqa: F401
