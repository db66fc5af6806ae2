"""Oracle SQL (DuckDB dialect) for the registered queries.

Every statement reads the pre-registered input views; the common table
expressions below restate the feed projection and the fold in plain SQL so
each query is checked independently of the Spark code.
"""

from __future__ import annotations

CUTOFF = "2024-01-16 00:00:00"
SIGN_KEY = "secret"

FEED = """
feed AS (
  SELECT event_id AS seq, ts,
         event_type || '_' || CAST(user_id AS VARCHAR) AS id,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'gauge'
              WHEN event_type IN ('click', 'signup') THEN 'counter'
              ELSE 'other' END AS type,
         CASE WHEN event_type IN ('click', 'signup') AND event_id % 10 <> 0
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS delta,
         CASE WHEN event_type IN ('purchase', 'view') AND event_id % 10 <> 0
              THEN value END AS value
  FROM events
),
valid AS (
  SELECT * FROM feed
  WHERE (type = 'gauge' AND value IS NOT NULL) OR (type = 'counter' AND delta IS NOT NULL)
)"""

FOLD_CTE = """
folded AS (
  SELECT type, id, CAST(sum(delta) AS BIGINT) AS delta, arg_max(value, seq) AS value,
         max(seq) AS last_seq
  FROM valid GROUP BY type, id
)"""


def with_feed(body: str, *extra: str, hot: bool = False) -> str:
    feed = FEED.replace("event_type || '_' || CAST(user_id AS VARCHAR) AS id", "event_type AS id") if hot else FEED
    ctes = [feed] + list(extra)
    return "WITH " + ",".join(ctes) + "\n" + body


# JSON text of an update as Spark's to_json writes it (NULL fields dropped).
JSON_BODY = (
    "'{' || '\"id\":\"' || id || '\",\"type\":\"' || type || '\"'"
    " || COALESCE(',\"delta\":' || CAST(delta AS VARCHAR), '')"
    " || COALESCE(',\"value\":' || CAST(value AS VARCHAR), '') || '}'"
)

# Shortest decimal text of a gauge without a trailing ".0".
SHORT_TEXT = "regexp_replace(CAST(value AS VARCHAR), '\\.0$', '')"

FOLD = with_feed("SELECT * FROM folded", FOLD_CTE)
FOLD_NO_SEQ = with_feed("SELECT type, id, delta, value FROM folded", FOLD_CTE)

BATCHES = """
batched AS (
  SELECT *, time_bucket(INTERVAL '1 day', ts) AS win_start,
         (row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts) ORDER BY seq) - 1) // 100
           AS batch_no
  FROM feed
)"""

ENCODED = f"""
encoded AS (
  SELECT win_start, CAST(batch_no AS BIGINT) AS batch_no, count(*) AS n_rows, min(seq) AS first_seq,
         max(seq) AS last_seq, '[' || string_agg({JSON_BODY}, ',' ORDER BY seq) || ']' AS payload
  FROM batched GROUP BY 1, 2
)"""

EARLY_STATE = f"""
early AS (
  SELECT type, id, CAST(sum(delta) AS BIGINT) AS delta, arg_max(value, seq) AS value,
         max(seq) AS last_seq
  FROM valid WHERE ts < TIMESTAMP '{CUTOFF}' GROUP BY type, id
)"""


def _hmac_sql(expr: str, key: str) -> str:
    block = key.encode().ljust(64, b"\0")  # keys of up to 64 bytes
    ipad, opad = bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)
    return (
        f"sha256(from_hex('{opad.hex()}') || unhex(sha256(from_hex('{ipad.hex()}') || encode({expr}))))"
    )


ORACLES: dict[str, str] = {
    "fold": FOLD,
    "fold_gauges": with_feed(
        "SELECT type, id, arg_max(value, seq) AS value, max(seq) AS last_seq FROM valid "
        "WHERE type = 'gauge' GROUP BY type, id"
    ),
    "fold_counters": with_feed(
        "SELECT type, id, CAST(sum(delta) AS BIGINT) AS delta, max(seq) AS last_seq FROM valid "
        "WHERE type = 'counter' GROUP BY type, id"
    ),
    "metric_names": with_feed("SELECT DISTINCT type, id FROM valid"),
    "list_metrics": FOLD,
    "all_metrics": FOLD,
    "merge_state": FOLD,
    "merge_state_join": FOLD,
    "merge_state_reversed": FOLD,
    "resume": FOLD_NO_SEQ,
    "restore_snapshot": FOLD,
    "restore_snapshot_json": FOLD_NO_SEQ,
    "stream_fold": FOLD,
    "stream_merge": FOLD,
    "stream_stateful": FOLD,
    "running_counter": with_feed(
        "SELECT seq, type, id, delta, CAST(sum(delta) OVER (PARTITION BY type, id ORDER BY seq "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total "
        "FROM valid WHERE type = 'counter'"
    ),
    "running_gauge": with_feed(
        "SELECT seq, type, id, value, last_value(value IGNORE NULLS) OVER (PARTITION BY type, id "
        "ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_asof "
        "FROM feed WHERE type = 'gauge'"
    ),
    "cumulative_to_delta": with_feed(
        "SELECT seq, type, id, cumulative, CASE WHEN prev IS NULL OR cumulative < prev THEN cumulative "
        "ELSE cumulative - prev END AS delta FROM ("
        "SELECT seq, type, id, delta AS cumulative, lag(delta) OVER (PARTITION BY type, id ORDER BY seq) AS prev "
        "FROM valid WHERE type = 'counter')"
    ),
    "update_rank": with_feed(
        "SELECT seq, type, id, row_number() OVER (PARTITION BY type, id ORDER BY seq) AS rank FROM valid"
    ),
    "replay_reads": with_feed(
        "SELECT r.seq, r.type, r.id, "
        "CASE WHEN EXISTS (SELECT 1 FROM valid u WHERE u.type = r.type AND u.id = r.id AND u.seq < r.seq) "
        "THEN 200 ELSE 404 END AS status, "
        "(SELECT CAST(sum(u.delta) AS BIGINT) FROM valid u WHERE u.type = r.type AND u.id = r.id "
        " AND u.seq < r.seq AND r.type = 'counter') AS delta, "
        "(SELECT arg_max(u.value, u.seq) FROM valid u WHERE u.type = r.type AND u.id = r.id "
        " AND u.seq < r.seq AND r.type = 'gauge') AS value "
        "FROM feed r WHERE r.type IN ('gauge', 'counter') AND r.delta IS NULL AND r.value IS NULL"
    ),
    "report_intervals": with_feed(
        "SELECT win_start, type, id, CAST(sum(d) OVER (PARTITION BY type, id ORDER BY win_start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS delta, value FROM ("
        "SELECT time_bucket(INTERVAL '1 hour', ts) AS win_start, type, id, sum(delta) AS d, "
        "arg_max(value, seq) AS value FROM valid GROUP BY 1, 2, 3)"
    ),
    "report_filled": with_feed(
        "SELECT s.win_start, s.type, s.id, "
        "CAST(last_value(p.d IGNORE NULLS) OVER w AS BIGINT) AS delta, "
        "last_value(p.value IGNORE NULLS) OVER w AS value "
        "FROM spine s LEFT JOIN rep p ON p.win_start = s.win_start AND p.type = s.type AND p.id = s.id "
        "WINDOW w AS (PARTITION BY s.type, s.id ORDER BY s.win_start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        """
per AS (
  SELECT time_bucket(INTERVAL '1 day', ts) AS win_start, type, id, sum(delta) AS dsum,
         arg_max(value, seq) AS value
  FROM valid GROUP BY 1, 2, 3
),
rep AS (
  SELECT win_start, type, id, sum(dsum) OVER (PARTITION BY type, id ORDER BY win_start
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d, value FROM per
),
spine AS (
  SELECT k.type, k.id, unnest(generate_series(k.first, (SELECT max(win_start) FROM per),
         INTERVAL '1 day')) AS win_start
  FROM (SELECT type, id, min(win_start) AS first FROM per GROUP BY type, id) k
)""",
    ),
    "sample_intervals": with_feed(
        "SELECT win_start, seq, ts, id, type, delta, value FROM ("
        "SELECT *, time_bucket(INTERVAL '6 hours', ts) AS win_start, row_number() OVER ("
        "PARTITION BY time_bucket(INTERVAL '6 hours', ts) ORDER BY seq DESC) AS rn FROM feed) WHERE rn = 1"
    ),
    "assign_batches": with_feed(
        "SELECT seq, ts, id, type, delta, value, win_start, CAST(batch_no AS BIGINT) AS batch_no FROM batched",
        BATCHES,
    ),
    "encode_batches": with_feed("SELECT * FROM encoded", BATCHES, ENCODED),
    "batch_strict": with_feed(
        "SELECT seq, id, type, delta, value, win_start, CAST(batch_no AS BIGINT) AS batch_no, "
        "CASE WHEN first_bad IS NULL THEN 200 ELSE 400 END AS status FROM ("
        "SELECT *, min(CASE WHEN NOT ((type = 'gauge' AND value IS NOT NULL) OR "
        "(type = 'counter' AND delta IS NOT NULL)) THEN seq END) OVER (PARTITION BY win_start, batch_no) "
        "AS first_bad FROM batched) WHERE first_bad IS NULL OR seq < first_bad",
        BATCHES,
    ),
    "validate_json": with_feed(
        "SELECT seq, type, id, status, CASE WHEN status = 200 THEN body END AS reply FROM ("
        f"SELECT seq, type, id, {JSON_BODY} AS body, "
        "CASE WHEN type = 'gauge' THEN CASE WHEN value IS NULL THEN 400 ELSE 200 END "
        "WHEN type = 'counter' THEN CASE WHEN delta IS NULL THEN 400 ELSE 200 END ELSE 501 END AS status "
        "FROM feed)"
    ),
    "outcome_counts": with_feed(
        "SELECT status, count(*) AS n, CAST(sum(octet_length(encode(body))) AS BIGINT) AS bytes FROM ("
        f"SELECT {JSON_BODY} AS body, "
        "CASE WHEN type = 'gauge' THEN CASE WHEN value IS NULL THEN 400 ELSE 200 END "
        "WHEN type = 'counter' THEN CASE WHEN delta IS NULL THEN 400 ELSE 200 END ELSE 501 END AS status "
        "FROM feed) GROUP BY status"
    ),
    "lookup": with_feed(
        "SELECT r.seq, r.type, r.id, CASE WHEN r.type NOT IN ('gauge', 'counter') THEN 501 "
        "WHEN e.id IS NULL THEN 404 ELSE 200 END AS status, "
        "CASE WHEN r.type = 'counter' THEN e.delta END AS delta, "
        "CASE WHEN r.type = 'gauge' THEN e.value END AS value "
        "FROM feed r LEFT JOIN early e ON e.type = r.type AND e.id = r.id",
        EARLY_STATE,
    ),
    "lookup_path": with_feed(
        "SELECT r.seq, r.type, r.id, CASE WHEN r.type NOT IN ('gauge', 'counter') THEN 400 "
        "WHEN e.id IS NULL THEN 404 ELSE 200 END AS status, "
        "CASE WHEN r.type = 'counter' THEN e.delta END AS delta, "
        "CASE WHEN r.type = 'gauge' THEN e.value END AS value, "
        "CASE WHEN r.type = 'counter' THEN CAST(e.delta AS VARCHAR) "
        "WHEN r.type = 'gauge' THEN regexp_replace(CAST(e.value AS VARCHAR), '\\.0$', '') END AS text "
        "FROM feed r LEFT JOIN early e ON e.type = r.type AND e.id = r.id",
        EARLY_STATE,
    ),
    "lookup_hits": with_feed(
        "SELECT r.seq, r.type, r.id FROM feed r WHERE EXISTS "
        "(SELECT 1 FROM early e WHERE e.type = r.type AND e.id = r.id)",
        EARLY_STATE,
    ),
    "lookup_misses": with_feed(
        "SELECT r.seq, r.type, r.id FROM feed r WHERE r.type IN ('gauge', 'counter') AND NOT EXISTS "
        "(SELECT 1 FROM early e WHERE e.type = r.type AND e.id = r.id)",
        EARLY_STATE,
    ),
    "render_report": with_feed(
        "SELECT CASE WHEN type = 'gauge' THEN 0 ELSE 1 END AS section, id, "
        "CASE WHEN type = 'gauge' THEN printf('gauge %s = %f', id, value) "
        "ELSE printf('counter %s = %d', id, delta) END AS line FROM folded",
        FOLD_CTE,
    ),
    "value_text": with_feed(
        "SELECT type, id, CASE WHEN type = 'counter' THEN CAST(delta AS VARCHAR) "
        f"ELSE {SHORT_TEXT} END AS text FROM folded",
        FOLD_CTE,
    ),
    "unpivot_fold": (
        "WITH long AS (UNPIVOT (SELECT (l_orderkey::HUGEINT * 100 + l_linenumber) * 1000000000000 + l_partkey AS seq, l_suppkey, "
        "l_quantity::DOUBLE AS l_quantity, "
        "l_extendedprice::DOUBLE AS l_extendedprice, l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax FROM lineitem) "
        "ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME col VALUE value) "
        "SELECT 'gauge' AS type, CAST(l_suppkey AS VARCHAR) || '/' || col AS id, arg_max(value, seq) AS value, "
        "CAST(max(seq) AS VARCHAR) AS last_seq FROM long GROUP BY l_suppkey, col"
    ),
    "explode_indexed": (
        "SELECT vec_id, 'gauge' AS type, 'dim' || CAST(i AS VARCHAR) AS id, CAST(embedding[i] AS DOUBLE) AS value "
        "FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)"
    ),
    "poll_count": (
        "SELECT win_start, 'counter' AS type, 'PollCount' AS id, CAST(sum(n) OVER (ORDER BY win_start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS delta FROM ("
        "SELECT time_bucket(INTERVAL '1 day', ts) AS win_start, count(*) AS n FROM events GROUP BY 1)"
    ),
    "sign_rows": with_feed(
        f"SELECT seq, body, {_hmac_sql('body', SIGN_KEY)} AS signature FROM ("
        f"SELECT seq, {JSON_BODY} || chr(10) AS body FROM feed)"
    ),
}

RUNNING_COUNTER_SQL = (
    "SELECT seq, type, id, delta, CAST(sum(delta) OVER (PARTITION BY type, id ORDER BY seq "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total "
    "FROM valid WHERE type = 'counter'"
)
REPLAY_READS_SQL = (
    "SELECT r.seq, r.type, r.id, "
    "CASE WHEN w.n > 0 THEN 200 ELSE 404 END AS status, "
    "CASE WHEN w.n > 0 AND r.type = 'counter' THEN CAST(w.tot AS BIGINT) END AS delta, "
    "CASE WHEN w.n > 0 AND r.type = 'gauge' THEN w.val END AS value "
    "FROM (SELECT seq, type, id, is_read, "
    "  count(CASE WHEN NOT is_read THEN 1 END) OVER w AS n, sum(delta) OVER w AS tot, "
    "  last_value(value IGNORE NULLS) OVER w AS val "
    "  FROM (SELECT seq, type, id, delta, value, (delta IS NULL AND value IS NULL) AS is_read "
    "        FROM feed WHERE type IN ('gauge', 'counter')) "
    "  WINDOW w AS (PARTITION BY type, id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) w "
    "JOIN feed r ON r.seq = w.seq WHERE w.is_read"
)
ORACLES["running_counter_hot"] = with_feed(RUNNING_COUNTER_SQL, hot=True)
ORACLES["replay_reads_hot"] = with_feed(REPLAY_READS_SQL, hot=True)
ORACLES["fold_hot"] = with_feed("SELECT * FROM folded", FOLD_CTE, hot=True)
ORACLES["stream_batches"] = ORACLES["encode_batches"]
ORACLES["feed_roundtrip"] = FOLD
ORACLES["state_table"] = FOLD
ORACLES["lookup_hot_salted"] = with_feed(
    "SELECT r.seq, r.type, r.id, CASE WHEN r.type NOT IN ('gauge', 'counter') THEN 501 "
    "WHEN e.id IS NULL THEN 404 ELSE 200 END AS status, "
    "CASE WHEN r.type = 'counter' THEN e.delta END AS delta, "
    "CASE WHEN r.type = 'gauge' THEN e.value END AS value "
    "FROM feed r LEFT JOIN early e ON e.type = r.type AND e.id = r.id",
    EARLY_STATE,
    hot=True,
)
ORACLES["stream_report"] = with_feed(
    "SELECT time_bucket(INTERVAL '1 day', ts) AS win_start, type, id, CAST(sum(delta) AS BIGINT) AS delta, "
    "arg_max(value, seq) AS value FROM valid GROUP BY 1, 2, 3"
)
ORACLES["stream_live_fold"] = FOLD
ORACLES["restore_array"] = with_feed("SELECT type, id, delta + 1 AS delta, value * 2 AS value FROM folded", FOLD_CTE)
ORACLES["stream_state_cut"] = FOLD
ORACLES["stream_report_filled"] = ORACLES["report_filled"]
ORACLES["stream_merge_reversed"] = FOLD
ORACLES["state_ddl"] = FOLD
ORACLES["read_batches"] = FOLD_NO_SEQ
ORACLES["split_state"] = FOLD_NO_SEQ
ORACLES["lookup_one"] = with_feed("SELECT * FROM folded ORDER BY id, type LIMIT 1", FOLD_CTE)

# Faulty batch requests: every batch whose first_seq ends in 1 to 7 is refused.
JUDGED = """
judged AS (
  SELECT win_start, batch_no, first_seq,
         CASE WHEN first_seq % 10 = 3 THEN 415 WHEN first_seq % 10 IN (1, 2, 4, 5, 6, 7) THEN 400 ELSE 200 END AS status
  FROM encoded
),
taken AS (
  SELECT b.*, j.first_seq FROM batched b JOIN judged j ON j.win_start = b.win_start AND j.batch_no = b.batch_no
  WHERE j.status = 200 AND ((b.type = 'gauge' AND b.value IS NOT NULL) OR (b.type = 'counter' AND b.delta IS NOT NULL))
)"""
ORACLES["batch_status"] = with_feed("SELECT win_start, batch_no, status FROM judged", BATCHES, ENCODED, JUDGED)
ORACLES["batch_ack"] = with_feed(
    "SELECT win_start, batch_no, status, '{\"status\":\"ok\"}' AS reply FROM judged WHERE status = 200",
    BATCHES, ENCODED, JUDGED,
)
ORACLES["fold_atomic"] = with_feed(
    "SELECT type, id, CAST(sum(delta) AS BIGINT) AS delta, arg_max(value, seq) AS value, max(seq) AS last_seq "
    "FROM taken GROUP BY type, id",
    BATCHES, ENCODED, JUDGED,
)
# Signatures of batches whose first_seq ends in 9 are wrong.
ORACLES["ingest_batches"] = with_feed(
    "SELECT type, id, CAST(sum(delta) AS BIGINT) AS delta, arg_max(value, seq) AS value, max(first_seq) AS last_seq "
    "FROM taken WHERE first_seq % 10 <> 9 GROUP BY type, id",
    BATCHES, ENCODED, JUDGED,
)
ORACLES["ack"] = with_feed(f"SELECT seq, {JSON_BODY} AS reply FROM valid")
ORACLES["decode_json"] = with_feed(
    "SELECT seq, status, CASE WHEN status = 200 THEN t END AS type, CASE WHEN status = 200 THEN i END AS id, "
    "CASE WHEN status = 200 THEN d END AS delta, CASE WHEN status = 200 THEN v END AS value FROM ("
    "SELECT seq, CASE WHEN k IN (1, 2, 3, 7, 8, 11) THEN 400 WHEN k IN (4, 5, 9, 10) THEN 200 WHEN k IN (6, 13) THEN 501 "
    "WHEN type = 'gauge' THEN CASE WHEN value IS NULL THEN 400 ELSE 200 END "
    "WHEN type = 'counter' THEN CASE WHEN delta IS NULL THEN 400 ELSE 200 END ELSE 501 END AS status, "
    "CASE WHEN k IN (4, 9, 10) THEN 'counter' WHEN k = 5 THEN 'gauge' ELSE type END AS t, "
    "CASE k WHEN 4 THEN 'twice' WHEN 5 THEN '' WHEN 9 THEN 'upper' WHEN 10 THEN 'last' ELSE id END AS i, "
    "CASE k WHEN 4 THEN 7 WHEN 5 THEN NULL WHEN 9 THEN 9 WHEN 10 THEN 4 ELSE delta END AS d, "
    "CASE WHEN k IN (4, 9, 10) THEN NULL WHEN k = 5 THEN 2.5 ELSE value END AS v "
    "FROM (SELECT *, seq % 20 AS k FROM feed))"
)
PATHS = f"""
paths AS (
  SELECT seq, k, CASE WHEN k = 8 THEN '/else/where' ELSE '/update/' || type || '/' || CASE WHEN k = 7 THEN '' ELSE id END
         || '/' || CASE k WHEN 1 THEN ' 5' WHEN 2 THEN '1e400' WHEN 3 THEN '5' || chr(10) WHEN 4 THEN '1.5d'
                   WHEN 5 THEN '0x1p-2' WHEN 6 THEN '+7' ELSE coalesce(CAST(delta AS VARCHAR), {SHORT_TEXT}, '') END END AS path,
         CASE WHEN k IN (7, 8) THEN 404 WHEN type NOT IN ('gauge', 'counter') OR k IN (1, 2, 3, 4) THEN 400
              WHEN k = 5 THEN CASE WHEN type = 'gauge' THEN 200 ELSE 400 END WHEN k = 6 THEN 200
              WHEN delta IS NULL AND value IS NULL THEN 400 ELSE 200 END AS status,
         CASE WHEN k IN (1, 2, 3, 4, 5, 8) OR type <> 'counter' THEN NULL WHEN k = 6 THEN 7 ELSE delta END AS delta,
         CASE WHEN k IN (1, 2, 3, 4, 8) OR type <> 'gauge' THEN NULL WHEN k = 5 THEN 0.25 WHEN k = 6 THEN 7.0
              ELSE value END AS value
  FROM (SELECT *, seq % 20 AS k FROM feed)
)"""
ORACLES["validate_paths"] = with_feed("SELECT seq, status, delta, value FROM paths", PATHS)
ORACLES["read_paths"] = with_feed(
    "SELECT status, count(*) AS n, CAST(sum(octet_length(encode(path))) AS BIGINT) AS bytes FROM paths "
    "GROUP BY status",
    PATHS,
)
ORACLES["read_requests"] = with_feed(
    "SELECT form, status, count(*) AS n, CAST(sum(delta) AS BIGINT) AS deltas, count(value) AS gauges FROM ("
    "SELECT f.form, CASE WHEN r.type NOT IN ('gauge', 'counter') THEN f.unknown WHEN e.id IS NULL THEN 404 ELSE 200 END AS status, "
    "CASE WHEN r.type = 'counter' THEN e.delta END AS delta, CASE WHEN r.type = 'gauge' THEN e.value END AS value "
    "FROM feed r CROSS JOIN (VALUES ('json', 501), ('path', 400)) f(form, unknown) "
    "LEFT JOIN early e ON e.type = r.type AND e.id = r.id) GROUP BY form, status",
    EARLY_STATE,
)
ORACLES["random_gauge"] = "SELECT 'RandomValue' AS random_id, count(*) AS n, true AS in_range FROM lineitem"
ORACLES["update_rows"] = (
    "SELECT 'gauge' AS type, l_returnflag AS id, CAST(NULL AS BIGINT) AS delta, "
    "arg_max(CAST(l_extendedprice AS DOUBLE), (l_orderkey::HUGEINT * 100 + l_linenumber) * 1000000000000 + l_partkey) AS value, "
    "CAST(max((l_orderkey::HUGEINT * 100 + l_linenumber) * 1000000000000 + l_partkey) AS VARCHAR) AS last_seq "
    "FROM lineitem GROUP BY l_returnflag UNION ALL "
    "SELECT 'counter', l_returnflag, CAST(sum(l_linenumber) AS BIGINT), NULL, "
    "CAST(max((l_orderkey::HUGEINT * 100 + l_linenumber) * 1000000000000 + l_partkey) AS VARCHAR) FROM lineitem GROUP BY l_returnflag"
)

# Four sends of a user in a row are the attempts of one request; every seventh
# send gets no answer, every eleventh a 503; every third meets a connection
# failure of the database (retriable), every fifth of the rest a broken constraint.
ATTEMPTS = """
sends AS (
  SELECT user_id, seq, row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1 AS n,
         CASE WHEN f.type = 'gauge' THEN CASE WHEN f.value IS NULL THEN 400 ELSE 200 END
              WHEN f.type = 'counter' THEN CASE WHEN f.delta IS NULL THEN 400 ELSE 200 END ELSE 501 END AS status
  FROM events e JOIN feed f ON f.seq = e.event_id
),
attempts AS (
  SELECT user_id, n // 4 AS request_no, n % 4 + 1 AS attempt,
         CASE WHEN seq % 7 = 0 THEN NULL WHEN seq % 11 = 0 THEN 503 ELSE status END AS http_status,
         CASE WHEN seq % 3 = 0 THEN '08006' WHEN seq % 5 = 0 THEN '23505' END AS sqlstate
  FROM sends
)"""


def _delivery(ok: str, final: str) -> str:
    return with_feed(
        "SELECT user_id, request_no, CAST(CASE WHEN ok = fin THEN ok END AS INTEGER) AS success_at, "
        "CAST(coalesce(fin, seen) AS INTEGER) AS attempts, CASE WHEN ok = fin THEN 'delivered' ELSE 'failed' END AS outcome, "
        "[0, 1, 4, 9][coalesce(fin, seen)] AS wait_s FROM ("
        f"SELECT user_id, request_no, min(CASE WHEN {ok} THEN attempt END) AS ok, min(CASE WHEN {final} THEN attempt END) AS fin, "
        "count(*) AS seen FROM attempts GROUP BY user_id, request_no)",
        ATTEMPTS,
    )


_SINGLE = "http_status IS NOT NULL AND http_status <> 503 AND NOT http_status BETWEEN 400 AND 499"
ORACLES["delivery_outcome"] = _delivery(_SINGLE, _SINGLE)
ORACLES["delivery_outcome_batch"] = _delivery("http_status = 200", "http_status = 200")
ORACLES["delivery_outcome_database"] = _delivery("sqlstate IS NULL", "sqlstate IS NULL OR sqlstate = '23505'")
