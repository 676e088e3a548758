"""DuckDB SQL twins of the registered queries, over the driver's pre-registered tables.

Each statement starts from the same conformed ``curated`` view the Spark side builds (see
``shoplake.sources.adapter``) and computes the same columns under the same names. Money is summed as
``decimal(18,2)`` and the mean uses whole-cent integer arithmetic, so both engines agree exactly.
"""

from __future__ import annotations

from shoplake.operators.quality import DOMAINS
from shoplake.plans import defects as D
from shoplake.schema import (
    CATEGORIES,
    CURATED_COLUMNS,
    ERROR_TYPES,
    EVENT_COLUMNS,
    FUNNEL_STAGES,
    NO_PRODUCT_EVENTS,
    PURCHASE_RATE_BOUNDS,
    STAGE_RATES,
)
from shoplake.sources.adapter import MARKET_SEGMENTS

# Report date of the storage audit: late enough that the oldest landed hours have passed both transition ages.
AUDIT_AS_OF = "2024-04-15"

# Rules below the lifecycle's own folders: part of the raw zone is kept warm, one day's results are kept.
NESTED_RULES = [("raw/year=2024/month=01/day=1", 60, "STANDARD_IA"), ("athena-results/2024-01-03", 400, "EXPIRE")]

_CATEGORY_LIST = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"

CURATED_CTE = f"""curated AS (
    SELECT CAST(e.event_id AS VARCHAR) AS event_id,
           CASE e.event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                WHEN 'signup' THEN 'checkout_start' WHEN 'purchase' THEN 'purchase'
                ELSE 'page_view' END AS event_type,
           CAST(e.user_id AS VARCHAR) AS user_id,
           CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') AS session_id,
           strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
           CASE WHEN e.event_type <> 'error'
                THEN CAST(TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 40 AS VARCHAR) END AS product_id,
           CASE WHEN e.event_type <> 'error'
                THEN {_CATEGORY_LIST}[TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 8 + 1] END AS category,
           CASE WHEN e.event_type <> 'error' THEN e.value END AS price,
           c.c_mktsegment AS device_type,
           CAST(NULL AS VARCHAR) AS referrer,
           n.n_name AS country,
           CAST(NULL AS VARCHAR) AS discount_code,
           strftime(e.ts, '%Y') AS year, strftime(e.ts, '%m') AS month, strftime(e.ts, '%d') AS day,
           CAST(e.ts AS TIMESTAMP) AS event_ts
    FROM events e
    LEFT JOIN customer c ON e.user_id = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def with_curated(body: str, *ctes: str) -> str:
    parts = [CURATED_CTE, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _pct(a: str, b: str) -> str:
    return f"ROUND(CAST(100 * {a} AS DOUBLE) / NULLIF({b}, 0), 2)"


MONEY = "CAST(price AS DECIMAL(18,2))"
MONEY_SUM = f"CAST(SUM({MONEY}) AS DOUBLE)"
CENTS = f"CAST({MONEY} * 100 AS BIGINT)"
MONEY_MEAN = (f"CASE WHEN COUNT(price) > 0 THEN sign(SUM({CENTS})) * CAST((2 * abs(SUM({CENTS})) + COUNT(price)) "
              f"// (2 * COUNT(price)) AS DOUBLE) / 100.0 END")


def _window(minutes: int) -> str:
    return (f"date_trunc('hour', event_ts) + to_minutes(CAST(floor(minute(event_ts) / {minutes}) * {minutes} "
            "AS BIGINT))")


WINDOW_5 = _window(5)

# One row per session: the first and last of its events ranked by time, and a running count of page-like ones.
SESSION_STATS = """session_stats AS (
    SELECT DISTINCT session_id,
           SUM(CAST(event_type IN ('page_view', 'product_view') AS INTEGER)) OVER of_session AS page_like_events,
           FIRST_VALUE(event_ts) OVER of_session AS session_start,
           LAST_VALUE(event_ts) OVER of_session AS session_end
    FROM curated
    WINDOW of_session AS (PARTITION BY session_id ORDER BY event_ts
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)"""


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _stages_values() -> str:
    return ", ".join(f"('{s}', {i})" for i, s in enumerate(FUNNEL_STAGES))


def _rates_values() -> str:
    return ", ".join(f"('{a}', '{b}', {r})" for a, b, r in STAGE_RATES)


def _reached(event_type: str) -> str:
    """Sessions of category ``k.category`` with an event of the type."""
    return (f"COALESCE((SELECT t.sessions FROM tally t WHERE t.category = k.category AND t.event_type = '{event_type}'), "
            "CAST(0 AS BIGINT))")


# Every eleventh event, and all of one category, without a session.
_NULL_SESSIONS = f"""gaps AS (
    SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 OR category = '{CATEGORIES[0]}' THEN NULL
                      ELSE session_id END AS session_id) FROM curated)"""


def _abandoned(source: str) -> str:
    """Carts for which no purchase exists; a null session equals nothing, so its carts always count."""
    return f"""SELECT product_id, COUNT(*) AS abandoned_count
           FROM (SELECT session_id, product_id FROM {source} a
                 WHERE event_type = 'add_to_cart' AND product_id IS NOT NULL
                   AND NOT EXISTS (SELECT 1 FROM {source} b WHERE b.event_type = 'purchase'
                                   AND b.session_id = a.session_id AND b.product_id = a.product_id)
                 GROUP BY ALL)
           GROUP BY product_id ORDER BY abandoned_count DESC, product_id LIMIT 20"""


# The pivot's device list is shorter than the data's, so that "other" holds revenue.
PIVOT_DEVICES = MARKET_SEGMENTS[:3]

ANALYTICS = {
    "event_type_counts": with_curated(
        "SELECT event_type, COUNT(*) AS event_count FROM curated GROUP BY event_type"),
    "funnel_by_category": with_curated(
        f"""SELECT k.category, {_reached('product_view')} AS viewed_sessions,
               {_reached('add_to_cart')} AS added_to_cart_sessions, {_reached('purchase')} AS purchased_sessions,
               {_pct(_reached('add_to_cart'), _reached('product_view'))} AS view_to_cart_pct,
               {_pct(_reached('purchase'), _reached('add_to_cart'))} AS cart_to_purchase_pct,
               {_pct(_reached('purchase'), _reached('product_view'))} AS view_to_purchase_pct
        FROM (SELECT DISTINCT category FROM curated WHERE category IS NOT NULL) k""",
        """visits AS (SELECT category, event_type, session_id FROM curated
                      WHERE category IS NOT NULL AND session_id IS NOT NULL GROUP BY ALL)""",
        """tally AS MATERIALIZED (SELECT category, event_type, COUNT(*) AS sessions FROM visits GROUP BY ALL)"""),
    "funnel_overall": with_curated(
        """SELECT CAST(SUM(CAST(list_contains(kinds, 'product_view') AS INTEGER)) AS BIGINT) AS viewed,
                  CAST(SUM(CAST(list_contains(kinds, 'add_to_cart') AS INTEGER)) AS BIGINT) AS added_to_cart,
                  CAST(SUM(CAST(list_contains(kinds, 'checkout_start') AS INTEGER)) AS BIGINT) AS checkout_started,
                  CAST(SUM(CAST(list_contains(kinds, 'purchase') AS INTEGER)) AS BIGINT) AS purchased
           FROM (SELECT session_id, list(DISTINCT event_type) AS kinds FROM curated
                 WHERE session_id IS NOT NULL GROUP BY session_id)"""),
    "revenue_by_country_device": with_curated(
        f"""SELECT country, device_type, COUNT(*) AS purchase_count, {MONEY_SUM} AS total_revenue,
                  {MONEY_MEAN} AS avg_order_value
           FROM curated WHERE event_type = 'purchase' GROUP BY country, device_type
           ORDER BY total_revenue DESC"""),
    "session_stats": with_curated(
        """SELECT session_id, CAST(page_like_events AS BIGINT) AS page_like_events, session_start, session_end
           FROM session_stats""",
        SESSION_STATS),
    "session_engagement": with_curated(
        """SELECT COUNT(*) AS total_sessions,
                  ROUND(AVG(date_sub('second', session_start, session_end)), 1) AS avg_session_duration_seconds,
                  ROUND(AVG(page_like_events), 2) AS avg_pages_per_session
           FROM session_stats""",
        SESSION_STATS),
    "revenue_trend": with_curated(
        f"""SELECT year, month, day, COUNT(*) AS purchase_count, {MONEY_SUM} AS daily_revenue
           FROM curated WHERE event_type = 'purchase' GROUP BY year, month, day
           ORDER BY year, month, day"""),
    "revenue_trend_dated": with_curated(
        f"""SELECT make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER)) AS date,
                  {MONEY_SUM} AS daily_revenue
           FROM curated WHERE event_type = 'purchase' GROUP BY year, month, day ORDER BY 1"""),
    "curated_row_count": with_curated("SELECT COUNT(*) AS event_count FROM curated"),
    "revenue_pivot": with_curated(
        "SELECT country, " + ", ".join(
            f"COALESCE(CAST(SUM({MONEY}) FILTER (WHERE device_type = '{d}') AS DOUBLE), 0.0) AS \"{d}\""
            for d in PIVOT_DEVICES)
        + f", COALESCE(CAST(SUM({MONEY}) FILTER (WHERE device_type IS NULL OR device_type NOT IN ({_in(PIVOT_DEVICES)})) "
        "AS DOUBLE), 0.0) AS other FROM curated WHERE event_type = 'purchase' GROUP BY country"),
    "abandoned_cart_products": with_curated(_abandoned("curated")),
    "abandoned_cart_null_session": with_curated(_abandoned("gaps"), _NULL_SESSIONS),
    "funnel_null_session": with_curated(
        """SELECT category, CAST(COUNT(DISTINCT session_id) FILTER (WHERE event_type = 'product_view') AS BIGINT) AS viewed_sessions,
                  CAST(COUNT(DISTINCT session_id) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchased_sessions
           FROM gaps WHERE category IS NOT NULL GROUP BY category""", _NULL_SESSIONS),
    "events_per_5min": with_curated(
        """SELECT window_start, strftime(window_start, '%Y%m%d_%H%M') AS window_key, COUNT(*) AS event_count
           FROM w GROUP BY window_start ORDER BY window_key""",
        f"w AS (SELECT CAST({WINDOW_5} AS TIMESTAMP) AS window_start FROM curated)"),
    "events_per_7min": with_curated(
        """SELECT window_start, strftime(window_start, '%Y%m%d_%H%M') AS window_key, COUNT(*) AS event_count
           FROM w GROUP BY window_start ORDER BY window_key""",
        f"w AS (SELECT CAST({_window(7)} AS TIMESTAMP) AS window_start FROM curated)"),
    "partition_key": with_curated(
        """SELECT event_id,
                  printf('raw/year=%04d/month=%02d/day=%02d/hour=%02d/%s', year(event_ts), month(event_ts),
                         day(event_ts), hour(event_ts),
                         'events_' || strftime(window_start, '%Y%m%d_%H%M') || '.jsonl') AS partition_key
           FROM w""",
        f"w AS (SELECT event_id, event_ts, {WINDOW_5} AS window_start FROM curated)"),
}


_HOUR_PARTS = ("strftime(event_ts, '%Y') AS year, strftime(event_ts, '%m') AS month, "
               "strftime(event_ts, '%d') AS day, strftime(event_ts, '%H') AS hour")
_REASONS = "(VALUES " + ", ".join(f"('{r}')" for r in ERROR_TYPES) + ") r(error_type)"
_CURATED_15 = ", ".join(f'"{c}"' if c == "timestamp" else c for c in CURATED_COLUMNS)
# Outcome of each defect (see ``plans.defects``), by the event id modulo 50.
_DEFECTS = f"""defects AS (
    SELECT *, CASE WHEN m = {D.TRUNCATED} THEN 'malformed_json'
                   WHEN m IN ({D.EMPTY_ID}, {D.NULL_ID}) THEN 'missing_event_id'
                   WHEN m = {D.NULL_TIME} THEN 'missing_timestamp'
                   WHEN m IN ({D.GARBAGE_TIME}, {D.BARE_TIME}) THEN 'unparseable_timestamp' END AS error_type,
           CASE WHEN m NOT IN ({D.TRUNCATED}, {D.NULL_TIME}, {D.GARBAGE_TIME}, {D.BARE_TIME}) THEN event_ts END AS line_ts,
           CASE WHEN m = {D.WRONG_HOUR} THEN event_ts + INTERVAL 1 HOUR ELSE event_ts END AS path_ts,
           CASE WHEN m = {D.COPIED_ID} THEN CAST(CAST(event_id AS BIGINT) - {D.COPIED_ID} AS VARCHAR) ELSE event_id END AS line_id,
           event_ts >= TIMESTAMP '{D.KEY_SINCE}' AND m <> {D.TRUNCATED} AS has_discount,
           m BETWEEN {D.DISCOUNTED[0]} AND {D.DISCOUNTED[1]} AS discounted
    FROM (SELECT *, CAST(event_id AS BIGINT) % {D.EVERY} AS m FROM curated))"""
_TAGGED = "tagged AS (SELECT error_type FROM defects)"
_REASON_COUNTS = f"""reason_counts AS (
    SELECT r.error_type, CAST(COUNT(t.error_type) AS BIGINT) AS rows
    FROM {_REASONS} LEFT JOIN tagged t ON t.error_type = r.error_type GROUP BY r.error_type)"""

# Files of six hours; every fifth is broken at first.
_FILES = """files AS (
    SELECT COUNT(*) AS n, (day(MIN(event_ts)) * 4 + hour(MIN(event_ts)) // 6) % 5 = 0 AS broken
    FROM curated GROUP BY date_trunc('day', event_ts), hour(event_ts) // 6)"""
_LINES = f"""lines AS (SELECT * FROM defects WHERE m <> {D.TRUNCATED})"""


def _merged_columns() -> str:
    """Columns of the merged raw table: type, change, and how many whole lines have the key."""
    rows = []
    for c in EVENT_COLUMNS:
        have = {"discount_code": "has_discount", "referrer": f"m <> {D.NO_REFERRER}"}.get(c, "true")
        change = {"price": "widened", "discount_code": "added"}.get(c, "kept")
        rows.append(f"""SELECT '{c}' AS column_name, '{"double" if c == "price" else "string"}' AS table_type, '{change}' AS change,
                        COUNT(*) FILTER (WHERE {have}) AS rows FROM lines""")
    rows.append(f"SELECT 'utm', 'string', 'added', COUNT(*) FILTER (WHERE m = {D.EXTRA_KEY}) FROM lines")
    return " UNION ALL ".join(rows)


BATCH = {
    "load_ledger": with_curated(
        """SELECT load, state, COUNT(*) AS files, CAST(SUM(rows) AS BIGINT) AS rows FROM (
               SELECT 'first' AS load, CASE WHEN broken THEN 'failed' ELSE 'loaded' END AS state, CASE WHEN broken THEN 0 ELSE n END AS rows
               FROM files
               UNION ALL SELECT 'second', 'loaded', n FROM files WHERE broken) GROUP BY ALL""", _FILES),
    "delete_after_load": with_curated(
        """SELECT CASE WHEN broken THEN 'failed' ELSE 'loaded' END AS state, COUNT(*) AS files,
                  COUNT(*) FILTER (WHERE broken) AS files_left, CAST(SUM(CASE WHEN broken THEN 0 ELSE n END) AS BIGINT) AS rows
           FROM files GROUP BY broken""", _FILES),
    "outcome_publish": with_curated(
        "SELECT COALESCE(error_type, 'kept') AS outcome, COUNT(*) AS rows FROM defects GROUP BY 1", _DEFECTS),
    "catalog_snapshot_changes": with_curated(
        """SELECT 'year=' || year || '/month=' || month || '/day=' || day AS partition,
                  CASE WHEN d = (SELECT MAX(d) FROM days) THEN 'added' ELSE 'changed' END AS change, true AS registered
           FROM days WHERE d = (SELECT MAX(d) FROM days) OR d = (SELECT MIN(d) FROM days)""",
        "days AS (SELECT DISTINCT year, month, day, year || '-' || month || '-' || day AS d FROM curated)"),
    "catalog_schema_merge": with_curated(_merged_columns(), _DEFECTS, _LINES),
    "raw_scan": with_curated(
        "SELECT " + ", ".join(f'"{c}"' if c == "timestamp" else c for c in EVENT_COLUMNS)
        + f", CAST(NULL AS VARCHAR) AS _corrupt_record, {_HOUR_PARTS} FROM curated"),
    "raw_landing_counts": with_curated(
        f"SELECT year, month, day, hour, COUNT(*) AS event_count FROM (SELECT {_HOUR_PARTS} FROM curated) "
        "GROUP BY ALL"),
    "file_landing_counts": with_curated(
        f"""SELECT year, month, day, hour, CAST(SUM(n) AS BIGINT) AS event_count
            FROM (SELECT COUNT(*) AS n, MIN(event_ts) AS event_ts FROM curated
                  GROUP BY date_trunc('day', event_ts), hour(event_ts) // 6)
            CROSS JOIN LATERAL (SELECT {_HOUR_PARTS}) GROUP BY ALL"""),
    "landing_manifest": with_curated(
        """SELECT 'events_' || strftime(window_start, '%Y%m%d_%H%M') || '.jsonl' AS source,
                  printf('raw/year=%04d/month=%02d/day=%02d/hour=%02d/%s', year(window_start),
                         month(window_start), day(window_start), hour(window_start),
                         'events_' || strftime(window_start, '%Y%m%d_%H%M') || '.jsonl') AS target,
                  COUNT(*) AS rows
           FROM w GROUP BY window_start""",
        f"w AS (SELECT {WINDOW_5} AS window_start FROM curated)"),
    "landing_agreement": with_curated(
        f"""SELECT 'year=' || year || '/month=' || month || '/day=' || day || '/hour=' || hour || '/batch=all' AS location,
                   COUNT(*) AS manifest_rows, COUNT(*) AS landed_rows
            FROM (SELECT {_HOUR_PARTS} FROM curated) GROUP BY 1"""),
    "partition_listing": with_curated(
        """SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day || '/hour=' || hour AS partition,
                  year, month, day, hour FROM p""",
        f"p AS (SELECT {_HOUR_PARTS} FROM curated)"),
    "etl_clean_counts": with_curated(
        "SELECT COUNT(*) AS input_rows, COUNT(*) FILTER (WHERE error_type IS NULL) AS kept_rows, "
        "COUNT(error_type) AS dropped_rows, "
        + ", ".join(f"COUNT(*) FILTER (WHERE error_type = '{r}') AS {r}" for r in ERROR_TYPES) + " FROM tagged",
        _DEFECTS, _TAGGED),
    "etl_partition_counts": with_curated(
        "SELECT year, month, day, COUNT(*) AS event_count FROM curated GROUP BY year, month, day"),
    "curated_write_readback": with_curated(f"SELECT {_CURATED_15} FROM curated"),
    "quarantine_by_reason": with_curated("SELECT error_type, rows FROM reason_counts", _DEFECTS, _TAGGED, _REASON_COUNTS),
    "defective_curated": with_curated(
        """SELECT line_id AS event_id, user_id, "timestamp", CASE WHEN has_discount AND discounted THEN 'SAVE10' END AS discount_code,
                  year, month, day FROM defects WHERE error_type IS NULL""", _DEFECTS),
    "result_csv_readback": ANALYTICS["revenue_by_country_device"],
    "catalog_publish": with_curated(
        "SELECT year, month, day, COUNT(*) AS event_count FROM curated GROUP BY year, month, day"),
    "catalog_refresh": with_curated(
        "SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day AS partition FROM curated"),
    "dq_missing_partitions": with_curated(
        """SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day AS partition FROM curated
           WHERE year || '-' || month || '-' || day = (SELECT MAX(year || '-' || month || '-' || day) FROM curated)"""),
}

_STAGES = f"stages AS (SELECT * FROM (VALUES {_stages_values()}) t(stage, rank))"
_COUNTS = """counts AS (
    SELECT s.stage, s.rank, COALESCE(c.n, 0) AS n FROM stages s
    LEFT JOIN (SELECT event_type AS stage, COUNT(*) AS n FROM curated GROUP BY event_type) c ON s.stage = c.stage)"""
_DOMAIN_VALUES = ", ".join(f"('{c}', '{v}')" for c, vs in DOMAINS.items() for v in vs)
_LO, _HI = PURCHASE_RATE_BOUNDS

BATCH["resumed_landing_counts"] = BATCH["file_landing_counts"]

QUALITY = {
    "dq_funnel_shape": with_curated(
        """SELECT rule, observed, lower, upper,
                  COALESCE(observed IS NOT NULL AND (lower IS NULL OR observed > lower)
                           AND (upper IS NULL OR observed < upper), false) AS passed
           FROM rules""",
        _STAGES, _COUNTS,
        """lagged AS (SELECT stage, rank, n, LAG(n) OVER (ORDER BY rank) AS prev_n,
                             LAG(stage) OVER (ORDER BY rank) AS prev_stage FROM counts)""",
        f"""rules AS (
            SELECT 'stage_positive:' || stage AS rule, CAST(n AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS lower,
                   CAST(NULL AS DOUBLE) AS upper FROM lagged
            UNION ALL
            SELECT 'falls:' || prev_stage || '>' || stage, CAST(n AS DOUBLE), CAST(NULL AS DOUBLE),
                   CAST(prev_n AS DOUBLE) FROM lagged WHERE prev_n IS NOT NULL
            UNION ALL
            SELECT 'purchase_rate',
                   ROUND(CAST(MAX(CASE WHEN stage = '{FUNNEL_STAGES[-1]}' THEN n END) AS DOUBLE)
                         / NULLIF(MAX(CASE WHEN stage = '{FUNNEL_STAGES[0]}' THEN n END), 0), 6),
                   CAST({_LO} AS DOUBLE), CAST({_HI} AS DOUBLE) FROM counts)"""),
    "dq_stage_rates": with_curated(
        """SELECT e.from_stage, e.to_stage, e.expected_rate,
                  ROUND(CAST(b.n AS DOUBLE) / NULLIF(a.n, 0), 4) AS observed_rate
           FROM expected e LEFT JOIN counts a ON a.stage = e.from_stage LEFT JOIN counts b ON b.stage = e.to_stage""",
        _STAGES, _COUNTS,
        f"""expected AS (SELECT from_stage, to_stage, CAST(r AS DOUBLE) AS expected_rate
                          FROM (VALUES {_rates_values()}) t(from_stage, to_stage, r))"""),
    "dq_duplicate_ids": with_curated(
        """SELECT a.line_id AS event_id, CAST(2 AS BIGINT) AS occurrences FROM defects a JOIN defects b ON a.line_id = b.event_id
           WHERE a.m = """ + str(D.COPIED_ID) + " AND b.error_type IS NULL", _DEFECTS),
    "dq_domain_violations": with_curated(
        """SELECT v.column_name, v.value, COUNT(*) AS rows FROM v
           WHERE v.value IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM dom d WHERE d.column_name = v.column_name AND d.value = v.value)
           GROUP BY v.column_name, v.value""",
        f"dom AS (SELECT * FROM (VALUES {_DOMAIN_VALUES}) t(column_name, value))",
        "v AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM curated" for c in DOMAINS) + ")"),
    "dq_product_presence": with_curated(
        f"""SELECT event_type, COUNT(*) AS events,
                  COUNT(CASE WHEN (event_type IN ({_in(NO_PRODUCT_EVENTS)}) AND product_id IS NOT NULL)
                               OR (event_type NOT IN ({_in(NO_PRODUCT_EVENTS)}) AND product_id IS NULL)
                             THEN 1 END) AS violations
           FROM curated GROUP BY event_type"""),
    "dq_unexpected_keys": with_curated(
        f"""SELECT key, problem, rows FROM (
               SELECT 'discount_code' AS key, 'missing' AS problem,
                      COUNT(*) FILTER (WHERE NOT has_discount AND m <> {D.TRUNCATED}) AS rows FROM defects
               UNION ALL SELECT 'referrer', 'missing', COUNT(*) FILTER (WHERE m = {D.NO_REFERRER}) FROM defects
               UNION ALL SELECT 'utm', 'unexpected', COUNT(*) FILTER (WHERE m = {D.EXTRA_KEY}) FROM defects)
            WHERE rows > 0""", _DEFECTS),
    "schema_evolution_profile": with_curated(
        """SELECT date_trunc('hour', line_ts) AS window_start, 'discount_code' AS field, COUNT(*) AS rows,
                  COUNT(*) FILTER (WHERE has_discount) AS present_rows,
                  COUNT(*) FILTER (WHERE NOT (has_discount AND discounted)) AS null_rows
           FROM defects GROUP BY 1""", _DEFECTS),
    "dq_partition_mismatch": with_curated(
        """SELECT strftime(path_ts, '%Y') AS year, strftime(path_ts, '%m') AS month, strftime(path_ts, '%d') AS day,
                  strftime(path_ts, '%H') AS hour, strftime(line_ts, '%Y') AS event_year, strftime(line_ts, '%m') AS event_month,
                  strftime(line_ts, '%d') AS event_day, strftime(line_ts, '%H') AS event_hour, COUNT(*) AS rows
           FROM defects WHERE date_trunc('hour', path_ts) IS DISTINCT FROM date_trunc('hour', line_ts)
           GROUP BY ALL""", _DEFECTS),
}


_STAGE_RANKS = f"ranks AS (SELECT * FROM (VALUES {_stages_values()}) t(stage, rank))"

STREAMING = {
    "stream_landing": with_curated("SELECT COUNT(*) AS event_count, CAST(0 AS BIGINT) AS without_hour FROM curated"),
    "stream_landing_by_event_date": BATCH["raw_landing_counts"],
    "stream_quarantine": with_curated(
        """SELECT 'kept' AS outcome, COUNT(*) AS rows FROM tagged WHERE error_type IS NULL
           UNION ALL SELECT error_type, rows FROM reason_counts""", _DEFECTS, _TAGGED, _REASON_COUNTS),
    "stream_dedup": with_curated(f"SELECT {_CURATED_15} FROM curated"),
    "stream_session_stage": with_curated(
        """SELECT c.session_id, MAX(r.rank) AS stage_rank FROM curated c JOIN ranks r ON c.event_type = r.stage
           GROUP BY c.session_id""", _STAGE_RANKS),
    # A step is an event of a later stage than all before it in its session.
    "stream_session_transitions": with_curated(
        """SELECT s.session_id, CAST(ROW_NUMBER() OVER (PARTITION BY s.session_id ORDER BY s.reached) AS INTEGER) AS step,
                  f.stage AS from_stage, t.stage AS to_stage, CAST(s.reached AS TIMESTAMP) AS reached_at,
                  CASE WHEN furthest = (SELECT MAX(rank) FROM ranks) THEN 'completed'
                       WHEN date_sub('minute', last, (SELECT MAX(event_ts) FROM curated)) >= 1440 THEN 'dropped' ELSE 'open' END AS state
           FROM (SELECT *, MAX(rank) OVER (PARTITION BY session_id ORDER BY reached ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                 FROM times) s
           JOIN lasts USING (session_id) JOIN ranks t ON t.rank = s.rank LEFT JOIN ranks f ON f.rank = s.before
           WHERE s.before IS NULL OR s.rank > s.before""", _STAGE_RANKS,
        """times AS (SELECT session_id, event_ts AS reached, MAX(rank) AS rank FROM curated JOIN ranks ON event_type = stage
                     GROUP BY session_id, event_ts)""",
        """lasts AS (SELECT session_id, MAX(event_ts) AS last, MAX(rank) AS furthest FROM curated LEFT JOIN ranks ON event_type = stage
                     GROUP BY session_id)"""),
    "stream_flushes": """WITH RECURSIVE sized AS (
            SELECT event_id, strlen(props) AS size, event_id % 8 AS buffer,
                   ROW_NUMBER() OVER (PARTITION BY event_id % 8 ORDER BY event_id) AS place FROM events
        ), walk AS (
            SELECT buffer, event_id, size, place, CAST(0 AS BIGINT) AS flush, CAST(size AS BIGINT) AS held FROM sized WHERE place = 1
            UNION ALL
            SELECT s.buffer, s.event_id, s.size, s.place, w.flush + CASE WHEN w.held >= 4096 THEN 1 ELSE 0 END,
                   s.size + CASE WHEN w.held >= 4096 THEN 0 ELSE w.held END
            FROM walk w JOIN sized s ON s.buffer = w.buffer AND s.place = w.place + 1
        ) SELECT buffer, event_id, CAST(size AS BIGINT) AS size, flush FROM walk""",
    "stream_events_per_5min": ANALYTICS["events_per_5min"],
    "stream_events_per_7min": ANALYTICS["events_per_7min"],
    "batch_stream_union": with_curated(
        "SELECT " + ", ".join(f'"{c}"' if c == "timestamp" else c for c in EVENT_COLUMNS) + " FROM curated"),
}


OPS = {
    "tier_audit": with_curated(
        f"""SELECT 'raw/' AS prefix, CASE WHEN age >= 90 THEN 'GLACIER_IR' WHEN age >= 30 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS tier,
                   COUNT(*) AS days
            FROM (SELECT DISTINCT date_diff('day', CAST(event_ts AS DATE), DATE '{AUDIT_AS_OF}') AS age FROM curated) GROUP BY 2
            UNION ALL SELECT 'curated/', 'STANDARD', COUNT(DISTINCT CAST(event_ts AS DATE)) FROM curated
            UNION ALL SELECT 'athena-results/', 'STANDARD', 0"""),
    # An object's rules by trying every rule against its key.
    "tier_bytes": f"""WITH objects AS (
            SELECT key, SUM(bytes) AS size_bytes, MAX(day) AS day FROM (
                SELECT unnest([strftime(w, 'raw/year=%Y/month=%m/day=%d/hour=%H/events_%Y%m%d_%H%M.jsonl'),
                               strftime(ts, 'curated/day=%Y-%m-%d.parquet'), strftime(ts, 'athena-results/%Y-%m-%d.csv')]) AS key,
                       unnest([400, 20, 1]) * strlen(props) AS bytes, CAST(ts AS DATE) AS day
                FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, CAST(ts AS TIMESTAMP)) AS w FROM events)) GROUP BY key
        ), rules AS (
            SELECT * FROM (VALUES ('raw/', 30, 'STANDARD_IA'), ('raw/', 90, 'GLACIER_IR'), ('athena-results/', 7, 'EXPIRED'),
                           ('test-intelligent-tiering/', 0, 'INTELLIGENT_TIERING'),
                           ('{NESTED_RULES[0][0]}', {NESTED_RULES[0][1]}, '{NESTED_RULES[0][2]}'),
                           ('{NESTED_RULES[1][0]}', {NESTED_RULES[1][1]}, 'EXPIRED')) t(prefix, days, tier)
        ), governed AS (
            SELECT o.*, (SELECT arg_max(prefix, length(prefix)) FROM rules r WHERE starts_with(o.key, r.prefix)) AS rule FROM objects o
        ), tiered AS (
            SELECT *, COALESCE((SELECT arg_max(tier, days) FROM rules r WHERE r.prefix = g.rule
                                AND date_diff('day', g.day, DATE '{AUDIT_AS_OF}') >= r.days), 'STANDARD') AS tier FROM governed g
        )
        SELECT COALESCE(rule, regexp_extract(key, '^[^/]*/')) AS prefix, tier, COUNT(*) AS objects, CAST(SUM(size_bytes) AS BIGINT) AS bytes,
               CAST(SUM(CASE WHEN tier IN ('STANDARD_IA', 'GLACIER_IR') THEN greatest(size_bytes, 131072) ELSE size_bytes END) AS BIGINT) AS billable_bytes
        FROM tiered GROUP BY 1, 2""",
    "scan_cost_log": """WITH days AS (
            SELECT CAST(ts AS DATE) AS day, SUM(strlen(props) + 64) AS whole FROM events GROUP BY 1
        ), per AS (
            SELECT event_type AS query_name, CAST(SUM(n) * 24 AS BIGINT) AS parquet, CAST(SUM(whole) AS BIGINT) AS json
            FROM (SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY ALL) JOIN days USING (day) GROUP BY 1
        ), formats AS (
            UNPIVOT per ON json, parquet INTO NAME source_format VALUE bytes_scanned
        )
        SELECT query_name, source_format, bytes_scanned, bytes_scanned / 1099511627776.0::DOUBLE * 5.0::DOUBLE AS cost_usd,
               ROUND((1 - bytes_scanned / (SELECT MAX(b.bytes_scanned) FROM formats b WHERE b.query_name = formats.query_name)::DOUBLE) * 100, 2) AS reduction_pct
        FROM formats""",
    "compaction_effect": with_curated(
        """SELECT 'year=' || year || '/month=' || month || '/day=' || day AS partition, COUNT(*) AS rows_before,
                  COUNT(*) AS rows_after, true AS not_more_files FROM curated GROUP BY 1"""),
    "compaction_moves": with_curated(
        "SELECT partition, rows, files_before, CAST(1 AS BIGINT) AS files_after, files_before > 1 AS moved FROM days",
        """days AS (
            SELECT 'year=' || year || '/month=' || month || '/day=' || day AS partition, COUNT(*) AS rows,
                   CASE WHEN CAST(day AS INTEGER) % 2 = 0 THEN COUNT(DISTINCT CAST(event_id AS BIGINT) % 4) ELSE 1 END AS files_before
            FROM curated GROUP BY year, month, day
        )"""),
    "scan_cost": """SELECT 'revenue_by_country_device' AS query_name, source_format, saves
                    FROM (VALUES ('json', false), ('parquet', true)) t(source_format, saves)""",
}


def oracle_sql() -> dict[str, str]:
    out = dict(ANALYTICS)
    out.update(BATCH)
    out.update(QUALITY)
    out.update(STREAMING)
    out.update(OPS)
    return out
