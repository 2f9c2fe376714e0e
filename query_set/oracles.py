"""DuckDB SQL that must give the rows of the query of the same name."""

from __future__ import annotations

from gridloom.functions.text import KEY_WORDS, WHITESPACE
from query_set.tables import ORDER_COLUMNS, PART_COLUMNS, PARTS_PER_FILE

SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
BLANKS = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)


def key_of(header: str) -> str:
    """SQL for the short form of a header."""
    key = f"regexp_replace(lower({header}), 'medicare{SPACE}+advantage', 'ma', 'g')"
    for word, short in KEY_WORDS:
        key = f"replace({key}, '{word}', '{short}')"
    return f"regexp_replace({key}, '{SPACE}+', '_', 'g')"


GRID = f"""
cells AS (
  SELECT doc_id, pos - 1 AS row_idx,
         list_filter(list_transform(string_split(lines[pos], ','), lambda x: trim(x, {BLANKS})), lambda x: x <> '') AS c
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
),
full_rows AS (
  SELECT doc_id, row_idx, c, len(c) AS n, len(c) = 1 AND regexp_matches(c[1], '[A-Za-z]') AS is_text, c[1] = 'BLANK' AS filler
  FROM cells WHERE len(c) > 0
),
heads AS (
  SELECT doc_id, min(row_idx) AS head_idx, arg_min(c, row_idx) AS h FROM full_rows WHERE n > 1 GROUP BY doc_id
),
below AS (
  SELECT r.*, h.h, h.head_idx,
         coalesce(last_value(CASE WHEN is_text THEN c[1] END IGNORE NULLS)
                  OVER (PARTITION BY r.doc_id ORDER BY r.row_idx ROWS UNBOUNDED PRECEDING), '') AS heading
  FROM full_rows r JOIN heads h ON r.doc_id = h.doc_id AND r.row_idx > h.head_idx
  WHERE NOT filler
),
data_rows AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY row_idx) - 1 AS table_row_index FROM below WHERE NOT is_text
),
overs AS (
  SELECT doc_id, min(row_idx) AS pos, arg_min(n, row_idx) AS width, any_value(len(h)) AS head_width
  FROM data_rows WHERE n > len(h) GROUP BY doc_id
),
pairs AS (
  SELECT doc_id, heading, table_row_index, h[j] AS table_key, c[j] AS table_val, h[1] AS first_col_key, c[1] AS first_col_val
  FROM (SELECT *, unnest(range(2, n + 1)) AS j FROM data_rows WHERE doc_id NOT IN (SELECT doc_id FROM overs))
  WHERE NOT list_contains(h[j + 1:n], h[j])
)"""


def unpivot(table: str, columns: list[str], extra: str = "") -> str:
    """Every column after the first as a key/value row."""
    rows = [
        f"SELECT {extra} CAST({columns[0]} AS VARCHAR) AS first_col_val, '{c}' AS table_key, "
        f"{key_of(chr(39) + c + chr(39))} AS table_key_simple, CAST({c} AS VARCHAR) AS table_val FROM {table}"
        for c in columns[1:]
    ]
    return " UNION ALL ".join(rows)


PART_FILE = f"(p_partkey // {PARTS_PER_FILE})"
SECONDS = "CAST(json_extract(props, '$.k') AS DOUBLE)"
MEASURES = {
    "total_seconds": f"sum({SECONDS})",
    "avg_total_seconds": f"avg({SECONDS})",
    "max_total_seconds": f"max({SECONDS})",
    "min_total_seconds": f"min({SECONDS})",
    "record_count": "count(*)",
}


def rollup(dimensions: dict[str, str], measures: list[str]) -> str:
    picked = [f"{sql} AS {name}" for name, sql in dimensions.items()] + [f"{MEASURES[m]} AS {m}" for m in measures]
    group = f" GROUP BY {', '.join(dimensions.values())}" if dimensions else ""
    return f"SELECT {', '.join(picked)} FROM events{group}"


METRIC, HOUR = {"metric_name": "event_type"}, {"date_trunc_hour": "date_trunc('hour', ts)"}
LATEST = "(SELECT user_id FROM events GROUP BY user_id ORDER BY max(ts) DESC, user_id DESC LIMIT 1)"

ORACLES: dict[str, str] = {
    "grid_kvp": f"WITH {GRID} SELECT doc_id, heading, table_row_index, first_col_key, first_col_val, table_key, "
    f"{key_of('table_key')} AS table_key_simple, table_val FROM pairs",
    "grid_headings": f"WITH {GRID} SELECT doc_id, row_idx, heading, h[1] AS first_header FROM data_rows",
    "grid_row_index": f"WITH {GRID} SELECT doc_id, count(*) AS data_rows, max(table_row_index) AS last_index "
    "FROM data_rows GROUP BY doc_id",
    "grid_status": f"""WITH {GRID}, counts AS (SELECT doc_id, count(*) AS n FROM pairs GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN o.doc_id IS NULL THEN 'loaded' ELSE 'failed' END AS status,
       coalesce(p.n, 0) AS row_count,
       CASE WHEN o.doc_id IS NOT NULL THEN
         'row ' || (o.pos + 1) || ': ' || o.width || ' cells, header has ' || o.head_width END AS error_message
FROM documents d LEFT JOIN overs o ON d.doc_id = o.doc_id LEFT JOIN counts p ON d.doc_id = p.doc_id""",
    "text_cells": f"""WITH {GRID} SELECT doc_id, CAST(sum(n) AS BIGINT) AS cells, count(*) FILTER (is_text) AS text_only_rows,
count(*) FILTER (filler) AS filler_rows FROM full_rows GROUP BY doc_id""",
    "wide_to_long": unpivot("orders", ORDER_COLUMNS),
    "key_normalise": "SELECT p_partkey, "
    + key_of(
        "'Medicare' || chr(9) || ' Advantage ' || p_name || ' Total Enrollment/' || p_type"
        " || '  Percentage Without Original ' || p_brand || ' medicare County YEAR'"
    )
    + " AS key FROM part",
    "format_decimals": r"""WITH codes AS (
  SELECT p_partkey, CASE WHEN p_size > 25 THEN '"' || p_name || '.00" #,##0' ELSE '[$.000]@' END
    || CASE WHEN p_retailprice > 950 THEN '.' || repeat('0', length(p_type) % 5) ELSE '' END || ';0.0000' AS code FROM part),
sections AS (
  SELECT p_partkey, code, regexp_replace(regexp_replace(string_split(code, ';')[1], '"[^"]*"', '', 'g'), '\[[^\]]*\]', '', 'g') AS s
  FROM codes)
SELECT p_partkey, CAST(CASE WHEN regexp_extract(s, '\.(0+)', 1) <> '' THEN length(regexp_extract(s, '\.(0+)', 1))
  WHEN regexp_matches(s, '[0#]') THEN 0 END AS BIGINT) AS decimals FROM sections""",
    "toc_sheets": """WITH turns AS (
  SELECT c.*, b.role = 'user' AS has_contents, 'turn ' || c.turn AS sheet_name
  FROM conversations c JOIN conversations b ON c.conv_id = b.conv_id AND b.turn = 0 WHERE c.turn > 0),
sheets AS (SELECT * FROM turns WHERE length(text) >= 200),
listed AS (
  SELECT conv_id, sheet_name, text AS description,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) - 1 AS sheet_index
  FROM turns WHERE has_contents)
SELECT l.conv_id, l.sheet_name, s.turn AS sheet_pos, l.sheet_index, l.description
FROM listed l LEFT JOIN sheets s ON l.conv_id = s.conv_id AND l.sheet_name = s.sheet_name
UNION ALL
SELECT conv_id, sheet_name, turn, turn, NULL FROM sheets WHERE NOT has_contents""",
    "pending_files": """WITH listed AS (
  SELECT doc_id, n_chars, 's3://in/' || doc_id || '%20v+1%.zip' AS path FROM documents
  UNION ALL SELECT doc_id, n_chars, 's3://in/' || doc_id || ' v+1%.zip' FROM documents WHERE doc_id % 3 = 0)
SELECT CASE WHEN doc_id % 3 = 0 THEN path ELSE 's3://in/' || doc_id || ' v+1%.zip' END AS zip_uri, path, n_chars AS length FROM listed l
WHERE NOT EXISTS (SELECT 1 FROM labels x WHERE x.quality = 1 AND x.doc_id = l.doc_id AND CASE
  WHEN x.doc_id % 2 = 0 THEN contains(l.path, '%20') WHEN x.doc_id % 3 = 0 THEN NOT contains(l.path, '%20') ELSE true END)""",
    "uri_names": """SELECT page_id, string_split(url, '?')[1] || '/a b+' || page_id || '.ZIP' AS uri,
'a b+' || page_id || '.ZIP' AS name, '.zip' AS extension FROM pages""",
    "sheet_titles": "SELECT doc_id, substring('.' || source || '_' || lang || CASE WHEN doc_id % 3 < 2 THEN '.claims_of_' || n_chars "
    "|| CASE WHEN doc_id % 3 = 0 THEN '.' ELSE '' END ELSE '' END, 1, 31) AS title FROM documents",
    "load_ids": """SELECT zip_uri, source, '20240131_2359_ABCD_' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
  || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS load_id, '20240131_2359_ABCD' AS stamp, true AS fresh
FROM (SELECT 's3://in/' || doc_id AS zip_uri, source, md5('run|s3://in/' || doc_id) AS h FROM documents)""",
    "file_listing": "SELECT 'doc ' || doc_id || '.txt' AS name, lang, strlen(text) AS length FROM documents",
    "zip_roundtrip": unpivot(
        "part",
        PART_COLUMNS,
        f"{PART_FILE} || '.zip' AS zip_name, {PART_FILE} || '.csv' AS unzipped_name, CAST({PART_FILE} AS VARCHAR) AS sheet_name, "
        f"CAST(0 AS BIGINT) AS sheet_index, '' AS heading, "
        f"row_number() OVER (PARTITION BY {PART_FILE} ORDER BY p_partkey) - 1 AS table_row_index, "
        f"'{PART_COLUMNS[0]}' AS first_col_key,",
    ),
    "xlsx_roundtrip": " UNION ALL ".join(
        f"SELECT 'Orders' AS sheet_name, CAST(0 AS BIGINT) AS sheet_index, CAST(o_orderkey AS VARCHAR) AS first_col_val, "
        f"'{name}' AS table_key, {key_of(chr(39) + name + chr(39))} AS table_key_simple, {value} AS table_val FROM orders"
        for name, value in {
            "Customer": "CAST(o_custkey AS VARCHAR)",
            "Status": "o_orderstatus",
            "Day": "strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'",
            "Whole": "CAST(CAST(round_even(o_totalprice, 0) AS BIGINT) AS VARCHAR)",
            "Exact": "CAST(o_totalprice AS VARCHAR)",
            "Flag": "'True'",
            "Order Total/Count": "o_orderpriority",
        }.items()
    ),
    "zip_ledger": f"""WITH lines AS (
  SELECT {PART_FILE} AS f, p_size = 50 AS wide, row_number() OVER (PARTITION BY {PART_FILE} ORDER BY p_partkey) + 2 AS pos FROM part),
files AS (SELECT f, bool_or(wide) AS bad, min(pos) FILTER (wide) AS pos, count(*) AS n FROM lines GROUP BY f)
SELECT f || '.zip' AS zip_name, 'mem:/in/' || f || '.zip' AS zip_uri, CASE WHEN bad THEN 'failed' ELSE 'loaded' END AS status,
  CASE WHEN bad THEN 'row ' || pos || ': {len(PART_COLUMNS) + 1} cells, header has {len(PART_COLUMNS)}' END AS error_message,
  CAST(CASE WHEN bad THEN 2 ELSE 1 END AS BIGINT) AS attempts, CAST(CASE WHEN bad THEN 0 ELSE 1 END AS BIGINT) AS sheets,
  CASE WHEN bad THEN 0 ELSE n * {len(PART_COLUMNS) - 1} END AS row_count,
  CASE WHEN NOT bad THEN n * {len(PART_COLUMNS) - 1} END AS facts
FROM files""",
    "csv_ingest": unpivot("part", PART_COLUMNS, f"'{PART_COLUMNS[0]}' AS first_col_key,"),
    "zip_ingest": unpivot(
        "part",
        PART_COLUMNS,
        f"'part ' || {PART_FILE} || '.zip' AS zip_name, {PART_FILE} || '.csv' AS unzipped_name, CAST({PART_FILE} AS VARCHAR) AS sheet_name, "
        f"CAST(0 AS BIGINT) AS sheet_index, row_number() OVER (PARTITION BY {PART_FILE} ORDER BY p_partkey) - 1 AS table_row_index, "
        f"count(*) OVER (PARTITION BY {PART_FILE}) * {len(PART_COLUMNS) - 1} AS row_count, "
        f"CAST(CASE WHEN {PART_FILE} % 7 = 3 THEN 2 ELSE 1 END AS BIGINT) AS attempts, CAST(1 AS BIGINT) AS loads, CAST(1 AS BIGINT) AS sheets, "
        f"'{PART_COLUMNS[0]}' AS first_col_key,",
    ),
    "book_ingest": unpivot(
        "part", PART_COLUMNS, f"'no zip' AS zip_name, 'unlisted' AS load_stamp, CAST(0 AS BIGINT) AS ledger_rows, '{PART_COLUMNS[0]}' AS first_col_key,"
    ),
    "stream_ingest": unpivot("part", PART_COLUMNS, f"'{PART_COLUMNS[0]}' AS first_col_key,")
    + " UNION ALL SELECT 'late', CAST(p_partkey AS VARCHAR), 'value', 'value', CAST(p_size AS VARCHAR) FROM part",
    "table_lifecycle": "SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier "
    "UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier "
    "UNION ALL SELECT -1, 'it''s \"one\"; -- `row`', NULL "
    "UNION ALL SELECT n_regionkey, n_name, NULL FROM nation",
    "latest_batch": f"SELECT user_id FROM {LATEST}",
    "batch_members": f"SELECT user_id, event_id, event_type FROM events WHERE user_id IN {LATEST}",
    "latest_row": "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 1",
    "metric_count": rollup({}, ["record_count"]),
    "metric_avg": rollup(METRIC, ["avg_total_seconds"]),
    "metric_detail": rollup(METRIC | HOUR, ["total_seconds", "avg_total_seconds", "max_total_seconds", "min_total_seconds"]),
    "metric_line": rollup(METRIC | HOUR, ["total_seconds"]),
    "metric_days": rollup({"date_trunc_day": "CAST(date_trunc('day', ts) AS TIMESTAMP)"}, list(MEASURES)),
    "metric_payload": "SELECT o_orderpriority AS metric_name, 'b1' AS metric_batch_id, o_orderstatus AS status, count(*) AS n, "
    "CAST(sum(o_custkey) AS DOUBLE) AS total_seconds FROM orders GROUP BY ALL",
    "metric_saved": """SELECT o_orderpriority AS metric_name, 'b1' AS metric_batch_id, CAST(sum(o_custkey) AS DOUBLE) AS total_seconds,
  count(*) AS rows_collected, CAST(count(*) AS DOUBLE) / CAST(sum(o_custkey) AS DOUBLE) AS rows_per_second FROM orders GROUP BY 1""",
    "derived_rates": """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_tax = 0 THEN 'inf'::DOUBLE ELSE l_quantity / l_tax END AS rows_per_second,
  CASE WHEN l_tax = 0 THEN 'inf'::DOUBLE ELSE l_quantity * 40 / CAST(1e6 AS DOUBLE) / l_tax END AS approx_mb_per_second,
  CASE WHEN l_quantity = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice / l_quantity END AS udf_overhead_ratio FROM lineitem""",
    "latency_summary": """WITH ranked AS (
  SELECT event_type, CAST(value AS DECIMAL(18, 2)) AS v, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r,
         count(*) OVER (PARTITION BY event_type) AS n FROM events),
sums AS (
  SELECT event_type, n AS iterations, CAST(sum(v) AS DOUBLE) AS total_seconds, CAST(min(v) AS DOUBLE) AS lo, CAST(max(v) AS DOUBLE) AS hi,
         CAST(max(v) FILTER (r = n // 2) AS DOUBLE) AS p50,
         CAST(max(v) FILTER (r = least(n - 1, CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT))) AS DOUBLE) AS p95
  FROM ranked GROUP BY event_type, n)
SELECT event_type, iterations, total_seconds, total_seconds / iterations * 1000 AS avg_ms, lo * 1000 AS min_ms, p50 * 1000 AS p50_ms,
       p95 * 1000 AS p95_ms, hi * 1000 AS max_ms FROM sums""",
    "range_sum": "SELECT CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem",
    "mod_group": "SELECT o_custkey % 1000 AS bucket, count(*) AS members, CAST(sum(o_custkey) AS BIGINT) AS bucket_sum FROM orders GROUP BY 1",
    "square_native": "SELECT CAST(sum(l_linenumber * l_linenumber) AS BIGINT) AS total FROM lineitem",
    "square_udf": "SELECT CAST(sum(l_linenumber * l_linenumber) AS BIGINT) AS total FROM lineitem",
    "md5_payload": "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS payload FROM orders",
}
