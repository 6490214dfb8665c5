"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code: the same fixture definition
(FIXTURES.md) is expressed with DuckDB's JSON and string functions, over the
pre-registered views ``events``, ``part``, ``lineitem``. Each query is a
``WITH`` chain of the shared building blocks below plus its own final SELECT.
"""

from __future__ import annotations

# Fixed values of the fixture (same as eventsieve.sources.fixtures).
_TYPES = "('view', 'click', 'purchase', 'signup', 'error')"
_SOURCES = "('app')"
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)?$"

SRC = """
src AS (
  SELECT event_id, ts, user_id, event_type, value, event_id % 100 AS d,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

LINES = SRC + """,
lines AS (
  SELECT event_id AS seq, ts AS arrival_ts,
    '{' ||
    CASE WHEN d = 1 OR (d = 9 AND event_id < 100) THEN ''
         ELSE '"event_id":"evt-' || CAST(CASE WHEN d = 9 THEN event_id - 59 ELSE event_id END AS VARCHAR) || '",' END ||
    '"event_type":' || CASE d WHEN 2 THEN '""' WHEN 6 THEN '"inventory.unknown_action"' ELSE '"' || event_type || '"' END || ',' ||
    CASE WHEN d = 3 THEN ''
         ELSE '"event_ts":"' || CASE WHEN d = 8 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END || '",' END ||
    '"source":' || CASE d WHEN 4 THEN 'null' WHEN 7 THEN '"external-api"' ELSE '"app"' END || ',' ||
    '"entity_id":"SKU-' || CAST(user_id AS VARCHAR) || '"' ||
    CASE WHEN d = 5 THEN ''
         ELSE ',"payload":{"sku_id":"SKU-' || CAST(user_id AS VARCHAR) || '","quantity_delta":' || CAST(k - 50 AS VARCHAR)
              || ',"current_stock_level":' || CAST(k AS VARCHAR) ||
              CASE WHEN d = 0 THEN ',"price": 12,"corrupt":'
                   ELSE ',"checkout_lane":' || CASE WHEN k > 50 THEN 'null' ELSE '"lane-' || CAST(event_id % 6 + 1 AS VARCHAR) || '"' END
                        || ',"price":' || CAST(value AS VARCHAR) || '}' END
    END ||
    CASE WHEN d = 0 THEN '' ELSE '}' END AS json_string
  FROM src
)"""

PARSED = LINES + """,
gated AS (
  SELECT *, coalesce(json_string <> '' AND json_valid(json_string), false) AS ok FROM lines
),
parsed AS (
  SELECT seq, arrival_ts, json_string, ok,
    CASE WHEN ok THEN json_extract_string(json_string, '$.event_id') END AS event_id,
    CASE WHEN ok THEN json_extract_string(json_string, '$.event_type') END AS event_type,
    CASE WHEN ok THEN json_extract_string(json_string, '$.event_ts') END AS event_ts,
    CASE WHEN ok THEN json_extract_string(json_string, '$.source') END AS source,
    CASE WHEN ok THEN json_extract_string(json_string, '$.entity_id') END AS entity_id,
    CASE WHEN ok THEN json_extract(json_string, '$.payload') IS NOT NULL
                      AND json_type(json_extract(json_string, '$.payload')) <> 'NULL' ELSE false END AS has_payload,
    CASE WHEN ok THEN json_extract_string(json_string, '$.payload.sku_id') END AS sku_id,
    CASE WHEN ok THEN TRY_CAST(json_extract_string(json_string, '$.payload.quantity_delta') AS INTEGER) END AS quantity_delta,
    CASE WHEN ok THEN TRY_CAST(json_extract_string(json_string, '$.payload.current_stock_level') AS INTEGER) END AS current_stock_level,
    CASE WHEN ok THEN json_extract_string(json_string, '$.payload.checkout_lane') END AS checkout_lane,
    CASE WHEN ok THEN TRY_CAST(json_extract_string(json_string, '$.payload.price') AS DOUBLE) END AS price
  FROM gated
)"""

# V1-V10 (no history).
_RULES9 = f"""
    CASE WHEN NOT ok THEN 'Failed to parse JSON' END,
    CASE WHEN ok AND coalesce(event_id, '') = '' THEN 'Missing event_id' END,
    CASE WHEN ok AND coalesce(event_type, '') = '' THEN 'Missing event_type' END,
    CASE WHEN ok AND coalesce(event_ts, '') = '' THEN 'Missing event_ts' END,
    CASE WHEN ok AND coalesce(source, '') = '' THEN 'Missing source' END,
    CASE WHEN ok AND NOT has_payload THEN 'Missing payload' END,
    CASE WHEN ok AND coalesce(event_type, '') <> '' AND event_type NOT IN {_TYPES} THEN 'Invalid event_type: ' || event_type END,
    CASE WHEN ok AND coalesce(source, '') <> '' AND source NOT IN {_SOURCES} THEN 'Invalid source: ' || source END,
    CASE WHEN ok AND coalesce(event_ts, '') <> '' AND NOT regexp_matches(event_ts, '{_ISO}') THEN 'Invalid timestamp: ' || event_ts END"""

RANKED = PARSED + """,
ranked AS (
  SELECT *, CASE WHEN ok AND coalesce(event_id, '') <> '' THEN
              row_number() OVER (PARTITION BY CASE WHEN ok AND coalesce(event_id, '') <> '' THEN event_id END
                                 ORDER BY arrival_ts DESC, seq DESC) END AS rn
  FROM parsed
)"""

VALIDATED = RANKED + f""",
validated AS (
  SELECT *, concat_ws('; ', {_RULES9},
    CASE WHEN rn > 1 THEN 'Duplicate event_id in batch' END) AS reasons
  FROM ranked
)"""

HISTORY = """
hist AS (SELECT DISTINCT 'evt-' || CAST(event_id AS VARCHAR) AS event_id FROM events WHERE event_id % 100 = 60)"""

VALIDATED_H = RANKED + "," + HISTORY + f""",
ranked_h AS (
  SELECT r.*, h.event_id IS NOT NULL AS in_hist FROM ranked r LEFT JOIN hist h ON r.event_id = h.event_id
),
validated_h AS (
  SELECT *, concat_ws('; ', {_RULES9},
    CASE WHEN rn > 1 THEN 'Duplicate event_id in batch' END,
    CASE WHEN ok AND in_hist THEN 'Duplicate event_id (already processed)' END) AS reasons
  FROM ranked_h
)"""

VALID = VALIDATED + """,
valid AS (
  SELECT event_id, event_type, event_ts, source, entity_id, sku_id, quantity_delta, current_stock_level,
         checkout_lane, price, seq
  FROM validated WHERE reasons = ''
)"""

REJECTS = VALIDATED + """,
rejects AS (
  SELECT json_string, reasons AS rejection_reason, event_id, event_type, event_ts, source, entity_id
  FROM validated WHERE reasons <> ''
)"""

CATALOG = """
catalog AS (
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku_id, p_name AS product_name, p_type AS category
  FROM part WHERE p_partkey % 10 <> 3
)"""

SKU_REF = """
sku_ref AS (
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku_id, p_retailprice AS price, CAST(p_size * 10 AS INTEGER) AS starting_stock
  FROM part WHERE p_partkey % 7 <> 2
)"""

# Valid rows with a parsed event time; the latest whole row per entity.
LATEST = VALID + """,
latest AS (
  SELECT * EXCLUDE (rn2) FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id
                                 ORDER BY try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') DESC NULLS LAST, event_id DESC) AS rn2
    FROM valid WHERE entity_id IS NOT NULL
  ) WHERE rn2 = 1
)"""

MOVES = """
moves0 AS (
  SELECT 'SKU-' || CAST(user_id AS VARCHAR) AS sku_id, ts, event_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS delta
  FROM events
),
moves AS (
  SELECT sku_id, ts, event_id, delta,
         CAST(100 + sum(delta) OVER (PARTITION BY sku_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              + CASE WHEN event_id % 100 = 77 THEN 1 ELSE 0 END AS INTEGER) AS level
  FROM moves0
),
ledger AS (
  SELECT sku_id, ts, event_id, delta, level AS reported_level,
         CAST(100 + sum(delta) OVER (PARTITION BY sku_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
           AS expected_level
  FROM moves
)"""


def with_(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip().rstrip(",") for b in blocks) + "\n"


_FLAT = ("event_id, event_type, event_ts, source, entity_id, sku_id, quantity_delta, current_stock_level, "
         "checkout_lane, price")

_HEALED = REJECTS + r""",
healed0 AS (
  SELECT json_string,
    CASE WHEN event_id IS NULL THEN md5(json_string) ELSE event_id END AS event_id,
    event_type,
    CASE WHEN regexp_matches(event_ts, '^\d{4}/\d{2}/\d{2}')
              THEN strftime(try_strptime(event_ts, '%Y/%m/%d %H:%M:%S'), '%Y-%m-%dT%H:%M:%SZ')
         WHEN event_ts IS NULL THEN '2026-07-09T12:00:00Z'
         ELSE event_ts END AS event_ts,
    CASE WHEN source = 'external-api' THEN 'app' ELSE source END AS source,
    entity_id,
    CASE WHEN has_payload THEN sku_id ELSE entity_id END AS sku_id,
    CASE WHEN has_payload THEN quantity_delta ELSE -1 END AS quantity_delta,
    CASE WHEN has_payload THEN current_stock_level ELSE 50 END AS current_stock_level,
    CASE WHEN has_payload THEN checkout_lane ELSE 'lane-1' END AS checkout_lane,
    CASE WHEN has_payload THEN price ELSE CAST(9.99 AS DOUBLE) END AS price,
    event_type AS stored_type, source AS stored_source
  FROM validated WHERE reasons <> ''
),
healed AS (
  SELECT * EXCLUDE (stored_type, stored_source) FROM healed0
  WHERE source IN """ + _SOURCES + " AND stored_type IN " + _TYPES + """ AND event_ts IS NOT NULL
),
healed_ranked AS (
  SELECT *, CASE WHEN coalesce(event_id, '') <> '' THEN
              row_number() OVER (PARTITION BY CASE WHEN coalesce(event_id, '') <> '' THEN event_id END
                                 ORDER BY event_ts DESC, json_string DESC) END AS hrn
  FROM healed
),
rec AS (
  SELECT json_string, """ + _FLAT + """ FROM healed_ranked h
  WHERE coalesce(event_id, '') <> '' AND coalesce(event_type, '') <> '' AND coalesce(source, '') <> ''
    AND coalesce(event_ts, '') <> '' AND regexp_matches(event_ts, '""" + _ISO + """')
    AND hrn = 1
    AND NOT EXISTS (SELECT 1 FROM validated v WHERE v.reasons = '' AND v.event_id = h.event_id)
)"""

_LATEST_CAT = with_(LATEST, CATALOG)


def _fallback(curated_threshold: int) -> str:
    return _LATEST_CAT + f""", cur AS (SELECT entity_id, current_stock_level FROM valid WHERE current_stock_level < {curated_threshold})
SELECT cur.entity_id, cur.current_stock_level, coalesce(c.product_name, cur.entity_id) AS display_name, 'curated' AS origin
FROM cur LEFT JOIN catalog c ON cur.entity_id = c.sku_id
UNION ALL
SELECT l.entity_id, l.current_stock_level, coalesce(c.product_name, l.entity_id) AS display_name, 'latest_state' AS origin
FROM latest l LEFT JOIN catalog c ON l.entity_id = c.sku_id
WHERE l.current_stock_level < 9 AND NOT EXISTS (SELECT 1 FROM cur)
"""


def _top_categories(facts: str) -> str:
    return f"""SELECT coalesce(c.category, 'Unknown') AS category, count(*) AS transactions
FROM {facts} f LEFT JOIN catalog c ON f.entity_id = c.sku_id
GROUP BY 1 ORDER BY transactions DESC, category LIMIT 10
"""


_LINEITEM_FACTS = "(SELECT l_orderkey, l_linenumber, 'SKU-' || CAST(l_partkey AS VARCHAR) AS entity_id FROM lineitem)"

_HOURS = f"""h AS (SELECT CAST(substring(event_ts, 12, 2) AS INTEGER) AS hour FROM parsed
       WHERE ok AND regexp_matches(event_ts, '{_ISO}'))"""

_RESTOCK = with_(MOVES) + """, st AS (
  SELECT sku_id,
    max({'t': ts, 'i': event_id}) FILTER (WHERE delta < 0 AND expected_level < 15) AS tr,
    max({'t': ts, 'i': event_id}) FILTER (WHERE delta > 0) AS re
  FROM ledger GROUP BY sku_id
)
"""

ORACLE_SQL: dict[str, str] = {
    "parse_envelope": with_(PARSED) + "SELECT seq, ok AS json_ok, " + _FLAT + " FROM parsed",
    "validate_errors": with_(VALIDATED) + "SELECT seq, event_id, reasons = '' AS is_valid, reasons FROM validated",
    "split_valid": with_(VALID) + f"SELECT {_FLAT} FROM valid",
    "split_rejects": with_(REJECTS) + "SELECT * FROM rejects",
    "history_duplicates": with_(VALIDATED_H)
    + "SELECT seq, event_id, reasons FROM validated_h WHERE contains(reasons, 'Duplicate event_id (already processed)')",
    "valid_with_history": with_(VALIDATED_H) + f"SELECT {_FLAT} FROM validated_h WHERE reasons = ''",
    "batch_metrics": with_(VALIDATED_H) + """SELECT count(*) AS total_records,
  count(*) FILTER (WHERE reasons = '') AS valid_records, count(*) FILTER (WHERE reasons <> '') AS rejected_records
FROM validated_h""",
    "feed_ratio": with_(PARSED) + f""", f AS (
  SELECT *, CASE WHEN ok AND coalesce(event_id, '') <> '' THEN
              row_number() OVER (PARTITION BY CASE WHEN ok AND coalesce(event_id, '') <> '' THEN event_id END ORDER BY seq) END AS fn,
            CASE WHEN ok AND json_type(json_extract(json_string, '$.payload')) = 'OBJECT'
                 THEN len(json_keys(json_extract(json_string, '$.payload'))) ELSE 0 END AS payload_keys
  FROM parsed
), g AS (
  SELECT coalesce(ok AND fn = 1 AND event_type IN {_TYPES} AND regexp_matches(event_ts, '{_ISO}')
                  AND source IN {_SOURCES} AND payload_keys > 0, false) AS good FROM f
)
SELECT count(*) AS total_lines, count(*) FILTER (WHERE good) AS valid_lines, count(*) FILTER (WHERE NOT good) AS bad_lines FROM g""",
    "event_key": with_(PARSED) + """SELECT seq, CASE WHEN ok THEN coalesce(nullif(json_extract_string(json_string, '$.entity_id'), ''),
                                   nullif(json_extract_string(json_string, '$.payload.sku_id'), '')) END AS event_key
FROM parsed""",
    "top_items": with_(VALID) + "SELECT event_id, event_type, entity_id FROM valid",
    "low_stock_events": with_(VALID) + """SELECT event_id, event_type, entity_id, sku_id, quantity_delta, current_stock_level,
  checkout_lane, price FROM valid WHERE current_stock_level < 9""",
    "latest_state": with_(LATEST) + """SELECT entity_id, event_id, event_type, event_ts, source, sku_id, quantity_delta,
  current_stock_level, checkout_lane, price FROM latest""",
    "low_stock_skus": _LATEST_CAT + """SELECT l.entity_id, l.event_id, l.current_stock_level,
  coalesce(c.product_name, l.entity_id) AS display_name, c.category
FROM latest l LEFT JOIN catalog c ON l.entity_id = c.sku_id WHERE l.current_stock_level < 9""",
    "low_stock_top5": _LATEST_CAT + """SELECT l.entity_id, l.event_id, l.current_stock_level,
  coalesce(c.product_name, l.entity_id) AS display_name
FROM latest l LEFT JOIN catalog c ON l.entity_id = c.sku_id WHERE l.current_stock_level < 9
ORDER BY l.current_stock_level, l.entity_id LIMIT 5""",
    "low_stock_events_top5": with_(VALID, CATALOG) + """SELECT v.event_id, v.entity_id, v.current_stock_level,
  coalesce(c.product_name, v.entity_id) AS display_name
FROM valid v LEFT JOIN catalog c ON v.entity_id = c.sku_id WHERE v.current_stock_level < 9
ORDER BY v.current_stock_level, v.event_id LIMIT 5""",
    "catalog_enrich": with_(CATALOG) + f"""SELECT f.l_orderkey, f.l_linenumber, f.entity_id, c.product_name, c.category
FROM {_LINEITEM_FACTS} f LEFT JOIN catalog c ON f.entity_id = c.sku_id""",
    "sku_reference_defaults": with_(CATALOG, SKU_REF) + """SELECT c.sku_id, c.product_name, c.category,
  coalesce(r.price, CAST(9.99 AS DOUBLE)) AS price, coalesce(r.starting_stock, 100) AS starting_stock
FROM catalog c LEFT JOIN sku_ref r ON c.sku_id = r.sku_id""",
    "unknown_skus": with_(VALID, CATALOG) + """SELECT sku_id, count(*) AS events FROM valid v
WHERE sku_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM catalog c WHERE c.sku_id = v.sku_id) GROUP BY sku_id""",
    "low_stock_or_fallback": _fallback(9),
    "low_stock_fallback_branch": _fallback(0),
    "top_categories": with_(VALID, CATALOG) + _top_categories("valid"),
    "top_categories_lineitem": with_(CATALOG) + _top_categories(_LINEITEM_FACTS),
    "kpis": with_(VALIDATED) + """SELECT count(*) FILTER (WHERE reasons = '') AS total_transactions,
  count(DISTINCT CASE WHEN reasons = '' THEN entity_id END) AS active_skus,
  count(*) FILTER (WHERE reasons = '' AND current_stock_level < 9) AS low_stock_events,
  count(*) FILTER (WHERE reasons <> '') AS quarantined_events
FROM validated""",
    "top_event_type": with_(VALID) + """SELECT event_type, count(*) AS events FROM valid WHERE event_type IS NOT NULL
GROUP BY event_type ORDER BY events DESC, event_type LIMIT 1""",
    "top_sku": with_(VALID, CATALOG) + """, t AS (SELECT entity_id, count(*) AS events FROM valid WHERE entity_id IS NOT NULL
  GROUP BY entity_id ORDER BY events DESC, entity_id LIMIT 1)
SELECT t.entity_id, coalesce(c.product_name, t.entity_id) AS display_name, t.events
FROM t LEFT JOIN catalog c ON t.entity_id = c.sku_id""",
    "insights": with_(VALIDATED, CATALOG) + """, v AS (SELECT * FROM validated WHERE reasons = '')
SELECT 'quarantine' AS kind, printf('%d event(s) quarantined, pending recovery', n) AS message
FROM (SELECT count(*) AS n FROM validated WHERE reasons <> '') WHERE n > 0
UNION ALL
SELECT 'low_stock', printf('%d low-stock event(s) below the threshold of %d', n, 9)
FROM (SELECT count(*) AS n FROM v WHERE current_stock_level < 9) WHERE n > 0
UNION ALL
SELECT 'top_event_type', printf('Most common event type: %s', event_type)
FROM (SELECT event_type, count(*) AS events FROM v WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY events DESC, event_type LIMIT 1)
UNION ALL
SELECT 'top_sku', printf('Top active SKU: %s (%s)', coalesce(c.product_name, t.entity_id), t.entity_id)
FROM (SELECT entity_id, count(*) AS events FROM v WHERE entity_id IS NOT NULL GROUP BY 1 ORDER BY events DESC, entity_id LIMIT 1) t
LEFT JOIN catalog c ON t.entity_id = c.sku_id""",
    "hourly_histogram": with_(PARSED, _HOURS) + "SELECT hour, count(*) AS events FROM h GROUP BY hour",
    "rush_vs_offpeak": with_(PARSED, _HOURS) + """SELECT count(*) FILTER (WHERE hour IN (12, 13)) AS lunch_rush,
  count(*) FILTER (WHERE hour IN (17, 18)) AS evening_rush,
  count(*) FILTER (WHERE hour IN (8, 9)) AS morning_off_peak,
  count(*) FILTER (WHERE hour IN (14, 15)) AS afternoon_off_peak
FROM h""",
    "stock_ledger": with_(MOVES) + """SELECT sku_id, event_id, delta, reported_level, expected_level,
  reported_level <> expected_level AS mismatch, expected_level < 0 AS below_zero FROM ledger""",
    "ledger_mismatches": with_(MOVES) + """SELECT sku_id, event_id, delta, reported_level, expected_level,
  true AS mismatch, expected_level < 0 AS below_zero FROM ledger WHERE reported_level <> expected_level""",
    "ledger_summary": with_(MOVES) + """SELECT count(*) AS moves, count(*) FILTER (WHERE reported_level <> expected_level) AS mismatches,
  count(*) FILTER (WHERE expected_level < 0) AS rows_below_zero FROM ledger""",
    "open_restocks": _RESTOCK + """SELECT sku_id, tr.i AS last_trigger_event_id, re.i AS last_restock_event_id
FROM st WHERE tr IS NOT NULL AND (re IS NULL OR tr > re)""",
    "restock_summary": _RESTOCK + """SELECT count(*) AS skus, count(*) FILTER (WHERE tr IS NOT NULL) AS skus_triggered,
  count(*) FILTER (WHERE tr IS NOT NULL AND (re IS NULL OR tr > re)) AS open_restocks FROM st""",
    "heal_rejects": with_(_HEALED) + f"SELECT json_string, {_FLAT} FROM healed",
    "recover": with_(_HEALED) + f"SELECT json_string, {_FLAT} FROM rec",
    "recover_pending": with_(_HEALED) + """SELECT * FROM rejects r
WHERE NOT EXISTS (SELECT 1 FROM rec WHERE md5(rec.json_string) = md5(r.json_string))""",
    "union_files": with_(VALIDATED) + """SELECT event_id, event_type, entity_id FROM validated WHERE reasons = ''
UNION ALL BY NAME
SELECT event_id, reasons AS rejection_reason, json_string FROM validated WHERE reasons <> ''""",
    "raw_after_recovery": with_(_HEALED) + f"""SELECT {_FLAT} FROM validated WHERE reasons = ''
UNION ALL SELECT {_FLAT} FROM rec""",
    "counts_by_type": with_(VALID) + "SELECT event_type, count(*) AS events FROM valid GROUP BY event_type",
    "counts_by_source": with_(PARSED) + "SELECT source, count(*) AS events FROM parsed WHERE ok GROUP BY source",
    "counts_by_hour": with_(VALID) + """, t AS (SELECT time_bucket(INTERVAL '1 hour', try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ')) AS b
  FROM valid WHERE try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') IS NOT NULL)
SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(b + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS events FROM t GROUP BY b""",
    "stream_sliding_counts": with_(VALID) + """, t AS (SELECT try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS t FROM valid),
w AS (SELECT time_bucket(INTERVAL '15 minutes', t) - to_minutes(CAST(15 * r.k AS BIGINT)) AS s
      FROM t, (SELECT range AS k FROM range(4)) r WHERE t IS NOT NULL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS events FROM w GROUP BY s""",
    "stream_ingest": with_(VALID) + f"SELECT {_FLAT} FROM valid",
    "output_gate": with_(VALID) + """SELECT 'top_items' AS output, count(*) AS row_count, true AS schema_ok, count(*) > 0 AS non_empty FROM valid
UNION ALL
SELECT 'low_stock_alerts', count(*), true, count(*) > 0 FROM valid WHERE current_stock_level < 9""",
    # Each line of a partition; some lines come twice, from another partition or the same one.
    "dedup_ties": with_(PARSED) + f""", delivered AS (
  SELECT *, 0 AS "partition" FROM parsed
  UNION ALL SELECT *, 1 FROM parsed WHERE seq % 100 BETWEEN 20 AND 24
  UNION ALL SELECT *, 0 FROM parsed WHERE seq % 100 = 25
), r AS (
  SELECT *, CASE WHEN ok AND coalesce(event_id, '') <> '' THEN
              row_number() OVER (PARTITION BY CASE WHEN ok AND coalesce(event_id, '') <> '' THEN event_id END
                                 ORDER BY arrival_ts DESC, "partition" DESC, seq DESC) END AS rn
  FROM delivered
), v AS (
  SELECT *, concat_ws('; ', {_RULES9}, CASE WHEN rn > 1 THEN 'Duplicate event_id in batch' END) AS reasons FROM r
)
SELECT seq, "partition", reasons = '' AS is_valid, reasons FROM v""",
    "recover_repeated_lines": with_(_HEALED) + f"SELECT json_string, {_FLAT} FROM rec",
    "history_two_ingests": with_(RANKED) + f""", h AS (
  SELECT DISTINCT 'evt-' || CAST(event_id AS VARCHAR) AS event_id FROM events WHERE event_id % 200 = 160
), v AS (
  SELECT r.seq, r.event_id, concat_ws('; ', {_RULES9.replace("event_id", "r.event_id").replace("Missing r.event_id", "Missing event_id")},
    CASE WHEN rn > 1 THEN 'Duplicate event_id in batch' END,
    CASE WHEN ok AND h.event_id IS NOT NULL THEN 'Duplicate event_id (already processed)' END) AS reasons
  FROM ranked r LEFT JOIN h ON r.event_id = h.event_id
)
SELECT * FROM v WHERE contains(reasons, 'Duplicate event_id (already processed)')""",
    "stream_two_batches": with_(PARSED) + f""", batched AS (
  SELECT *, CASE WHEN seq <= (SELECT floor(max(seq) / 2) FROM parsed) THEN 1 ELSE 2 END AS batch FROM parsed
), r AS (
  SELECT *, CASE WHEN ok AND coalesce(event_id, '') <> '' THEN
              row_number() OVER (PARTITION BY batch, CASE WHEN ok AND coalesce(event_id, '') <> '' THEN event_id END
                                 ORDER BY arrival_ts DESC, seq DESC) END AS rn
  FROM batched
), v AS (
  SELECT *, concat_ws('; ', {_RULES9}, CASE WHEN rn > 1 THEN 'Duplicate event_id in batch' END) AS reasons FROM r
)
SELECT {_FLAT} FROM v WHERE reasons = '' AND batch = 1
UNION ALL
SELECT {_FLAT} FROM v WHERE reasons = '' AND batch = 2
  AND event_id NOT IN (SELECT event_id FROM v WHERE reasons = '' AND batch = 1)""",
    "stream_rejects": with_(REJECTS) + "SELECT * FROM rejects",
    "stock_ledger_reference": with_(MOVES, SKU_REF) + """SELECT * , reported_level <> expected_level AS mismatch, expected_level < 0 AS below_zero
FROM (SELECT l.sku_id, event_id, delta, reported_level,
        CAST(expected_level - 100 + coalesce(r.starting_stock, 100) AS INTEGER) AS expected_level
      FROM ledger l LEFT JOIN sku_ref r ON l.sku_id = r.sku_id)""",
    "unknown_skus_reference": with_(VALID, SKU_REF) + """SELECT sku_id, count(*) AS events FROM valid v
WHERE sku_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sku_ref c WHERE c.sku_id = v.sku_id) GROUP BY sku_id""",
    "catalog_csv": with_(CATALOG) + "SELECT * FROM catalog",
    "sku_reference_file": with_(SKU_REF) + "SELECT * FROM sku_ref",
    "jsonl_lines": with_(LINES) + "SELECT json_string FROM lines",
    "union_mixed_files": with_(VALIDATED) + """SELECT event_id, event_type, entity_id, NULL::VARCHAR AS rejection_reason, NULL::VARCHAR AS json_string
FROM validated WHERE reasons = ''
UNION ALL
SELECT event_id, NULL, NULL, reasons, json_string FROM validated WHERE reasons <> ''""",
    "recover_second_run": with_(_HEALED) + """SELECT DISTINCT md5(r.json_string) AS reject_key,
  CASE WHEN EXISTS (SELECT 1 FROM rec WHERE md5(rec.json_string) = md5(r.json_string)) THEN 'recovered' ELSE 'kept' END AS outcome,
  '1' AS rule_version, 'r1' AS run
FROM rejects r""",
    "curated_counts": with_(VALID) + """, t AS (SELECT time_bucket(INTERVAL '1 hour', try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ')) AS b
  FROM valid WHERE try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') IS NOT NULL)
SELECT 'type' AS kind, event_type AS label, count(*) AS events FROM valid GROUP BY event_type
UNION ALL SELECT 'source', source, count(*) FROM valid GROUP BY source
UNION ALL SELECT 'hour', strftime(b, '%Y-%m-%d %H:%M:%S'), count(*) FROM t GROUP BY b""",
    "curated_kpis": with_(VALIDATED) + """SELECT count(*) FILTER (WHERE reasons = '') AS total_transactions,
  count(DISTINCT CASE WHEN reasons = '' THEN entity_id END) AS active_skus,
  count(*) FILTER (WHERE reasons = '' AND current_stock_level < 9) AS low_stock_events,
  count(*) FILTER (WHERE reasons <> '') AS quarantined_events
FROM validated""",
    "insights_fallback": with_(VALIDATED, CATALOG) + """, v AS (SELECT * FROM validated WHERE reasons = '')
SELECT 'quarantine' AS kind, printf('%d event(s) quarantined, pending recovery', n) AS message
FROM (SELECT count(*) AS n FROM validated WHERE reasons <> '') WHERE n > 0
UNION ALL SELECT 'low_stock', 'No immediate low-stock risk detected'
UNION ALL
SELECT 'top_event_type', printf('Most common event type: %s', event_type)
FROM (SELECT event_type, count(*) AS events FROM v WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY events DESC, event_type LIMIT 1)
UNION ALL
SELECT 'top_sku', printf('Top active SKU: %s (%s)', coalesce(c.product_name, t.entity_id), t.entity_id)
FROM (SELECT entity_id, count(*) AS events FROM v WHERE entity_id IS NOT NULL GROUP BY 1 ORDER BY events DESC, entity_id LIMIT 1) t
LEFT JOIN catalog c ON t.entity_id = c.sku_id""",
    "stream_windows": with_(VALID) + """, t AS (SELECT try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS t FROM valid),
w AS (SELECT time_bucket(INTERVAL '15 minutes', t) - to_minutes(CAST(15 * r.k AS BIGINT)) AS s
      FROM t, (SELECT range AS k FROM range(4)) r WHERE t IS NOT NULL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS events FROM w WHERE s + INTERVAL '1 hour' <= (SELECT max(t) FROM t) - INTERVAL '2 hours' GROUP BY s""",
}

# Other ways to the same rows.
ORACLE_SQL["stream_managed_batches"] = ORACLE_SQL["stream_two_batches"]
ORACLE_SQL["compacted_raw"] = ORACLE_SQL["split_valid"]
ORACLE_SQL["incremental_counts"] = ORACLE_SQL["curated_counts"]
ORACLE_SQL["incremental_kpis"] = ORACLE_SQL["curated_kpis"]
ORACLE_SQL["active_skus_by_day"] = with_(VALID) + """, t AS (SELECT try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') AS t, entity_id FROM valid)
SELECT strftime(t, '%Y-%m-%d') AS day, count(DISTINCT entity_id) AS active_skus, TRUE AS estimate_is_close
FROM t WHERE t IS NOT NULL AND entity_id IS NOT NULL GROUP BY 1"""
ORACLE_SQL["incremental_latest"] = ORACLE_SQL["latest_state_stored"] = ORACLE_SQL["latest_state"]
ORACLE_SQL["incremental_low_stock"] = ORACLE_SQL["low_stock_skus"]
ORACLE_SQL["heavy_entities"] = with_(VALID) + """SELECT entity_id, count(*) AS events FROM valid WHERE entity_id IS NOT NULL
GROUP BY entity_id ORDER BY events DESC, entity_id LIMIT 20"""
ORACLE_SQL["heavy_parts"] = """SELECT 'SKU-' || CAST(l_partkey AS VARCHAR) AS entity_id, count(*) AS events FROM lineitem
WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY events DESC, entity_id LIMIT 20"""
ORACLE_SQL["stream_keyed_dedup"] = with_(PARSED) + """, ids AS (
  SELECT seq, arrival_ts, nullif(event_id, '') AS event_id,
    CASE WHEN seq <= (SELECT floor(max(seq) / 2) FROM parsed) THEN 1 ELSE 2 END AS run FROM parsed
)
SELECT seq, event_id, event_id IS NOT NULL
  AND row_number() OVER (PARTITION BY event_id ORDER BY run, arrival_ts NULLS LAST, seq) > 1 AS is_duplicate FROM ids"""
