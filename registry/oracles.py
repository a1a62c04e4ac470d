"""SQL that DuckDB runs on the same tables, per query of `registry.queries`."""

from __future__ import annotations

# The two feeds, typed and as text.
MONTH = """
T AS (
    SELECT CAST(21 + user_id % 10 AS VARCHAR) AS plaza_id,
           CAST(ts AS DATE) AS date,
           CAST(hour(ts) AS VARCHAR) AS hour,
           CASE WHEN event_id % 2 = 0 THEN 'I' ELSE 'O' END AS direction,
           CAST(count(*) FILTER (WHERE event_type IN ('view', 'click')) AS INT)
               AS vehicles_e_zpass,
           CAST(count(*) FILTER (WHERE event_type NOT IN ('view', 'click')) AS INT)
               AS vehicles_vtoll
    FROM events GROUP BY ALL
)"""

YEARS = """
Y AS (
    SELECT CAST(21 + l_suppkey % 10 AS VARCHAR) AS plaza_id,
           CAST(l_shipdate AS DATE) AS date,
           CAST(l_partkey % 24 AS VARCHAR) AS hour,
           CASE WHEN l_orderkey % 2 = 0 THEN 'I' ELSE 'O' END AS direction,
           CAST(l_quantity AS INT) AS vehicles_e_zpass,
           CAST(round(l_discount * 100) AS INT) AS vehicles_vtoll,
           (l_orderkey * 7 + l_linenumber) % 97 = 0 AS unknown
    FROM lineitem
)"""

MONTH_COLUMNS = "plaza_id, date, hour, direction, vehicles_e_zpass, vehicles_vtoll"

WIRE_YEARS = """
    SELECT plaza_id, strftime(date, '%Y-%m-%dT00:00:00.000') AS date, hour, direction,
           CAST(vehicles_e_zpass AS VARCHAR) AS vehicles_e_zpass,
           CAST(vehicles_vtoll AS VARCHAR) AS vehicles_vtoll
    FROM Y"""

SUMS = """count(*) AS n_rows,
           CAST(sum(vehicles_e_zpass) AS BIGINT) AS e_zpass,
           CAST(sum(vehicles_vtoll) AS BIGINT) AS vtoll"""

PAGES = """
    SELECT page, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM (
        SELECT event_id,
               CAST((row_number() OVER (ORDER BY CAST(ts AS DATE), event_id) - 1) // 1000
                    AS BIGINT) AS page
        FROM events WHERE {keep}
    ) GROUP BY page"""

IN_WEEK = "ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'"

ORACLES = {
    "paged_scan": PAGES.format(keep="true"),
    "paged_scan_range": PAGES.format(keep=IN_WEEK),
    "paged_scan_filter": f"""
    SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n_rows
    FROM events WHERE {IN_WEEK} GROUP BY ALL""",
    "page_counts": f"SELECT page, n_rows FROM ({PAGES.format(keep='true')})",
    "limit_offset": "SELECT * FROM events ORDER BY event_id LIMIT 1000 OFFSET 3000",
    "limit_offset_deep": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 2000 OFFSET 12000",
    "json_stage_scan": f"WITH {YEARS} {WIRE_YEARS}",
    "published_stage": f"""WITH {YEARS}, staged AS ({WIRE_YEARS})
    SELECT *, 1 AS number FROM staged
    UNION ALL SELECT *, 2 AS number FROM staged WHERE direction = 'I'""",
    "json_decode": """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events""",
    "json_encode": """
    SELECT CAST(to_json(struct_pack(event_id := event_id, user_id := user_id,
                event_type := event_type, props := props)) AS VARCHAR) AS json
    FROM events""",
    "parquet_roundtrip": f"WITH {YEARS} {WIRE_YEARS}",
    "ctas_raw": f"WITH {YEARS} {WIRE_YEARS}",
    "typed_rows": f"WITH {YEARS} SELECT {MONTH_COLUMNS} FROM Y",
    "date_range": f"""WITH {YEARS}
    SELECT {MONTH_COLUMNS} FROM Y WHERE date >= DATE '1997-01-01' AND date < DATE '1998-01-01'""",
    "typed_date_range": f"""WITH {YEARS}
    SELECT {MONTH_COLUMNS} FROM Y WHERE date >= DATE '1997-01-01' AND date < DATE '1998-01-01'""",
    "storage_footprint": """
    SELECT format, (SELECT count(*) FROM lineitem) AS n_rows, format <> 'json' AS smaller_than_json
    FROM (VALUES ('json'), ('parquet'), ('table')) AS t(format)""",
    "record_total": """
    SELECT count(*) AS n_responses, CAST(sum(c_custkey % 3 + 1) AS BIGINT) AS n_records
    FROM customer""",
    "date_range_open": f"""WITH {YEARS}
    SELECT {MONTH_COLUMNS} FROM Y WHERE date >= DATE '2000-06-15'""",
    "iso_literal": """
    SELECT strftime(moment, '%Y-%m-%dT00:00:00.00') AS literal, count(*) AS n_rows
    FROM (SELECT o_orderdate AS moment FROM orders UNION ALL SELECT ts FROM events)
    GROUP BY ALL""",
    "day_parse": """
    SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_rows FROM orders GROUP BY ALL""",
    "default_window": f"""WITH {YEARS},
    span AS (SELECT min(date) AS lo, max(date) AS hi FROM Y),
    days AS (
        SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP) + INTERVAL 1 DAY,
                           CAST(hi AS TIMESTAMP) + INTERVAL 8 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM span),
    runs AS (SELECT d AS run_date FROM days WHERE isodow(d) = 1)
    SELECT run_date, CAST(run_date - 8 AS DATE) AS start_date,
           CAST(run_date - 1 AS DATE) AS stop_date,
           count(Y.date) AS n_rows,
           CAST(coalesce(sum(vehicles_e_zpass), 0) AS BIGINT) AS e_zpass,
           CAST(coalesce(sum(vehicles_vtoll), 0) AS BIGINT) AS vtoll
    FROM runs LEFT JOIN Y ON Y.date >= run_date - 8 AND Y.date < run_date - 1
    GROUP BY run_date""",
    "drilldown_measure": """
    SELECT n_name, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents,
           count(*) AS n_rows
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "measure_stage": """
    SELECT c_nationkey, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents,
           count(*) AS n_rows
    FROM customer GROUP BY c_nationkey""",
    "load_by_day": f"WITH {MONTH} SELECT date, {SUMS} FROM T GROUP BY date",
    "load_by_year": f"""WITH {YEARS}
    SELECT CAST(year(date) AS INT) AS year, {SUMS} FROM Y GROUP BY ALL""",
    "append_twice": f"""WITH {MONTH}
    SELECT date, {SUMS} FROM (SELECT * FROM T UNION ALL SELECT * FROM T) GROUP BY date""",
    "weekly_load": f"""WITH {MONTH}
    SELECT {MONTH_COLUMNS} FROM T WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-15'""",
    "weekly_load_counts": f"""WITH {MONTH},
    staged AS (SELECT CASE WHEN hour <> '7' THEN date END AS date FROM T)
    SELECT count(*) FILTER (WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-15')
               AS n_rows,
           count(*) FILTER (WHERE date IS NULL) AS n_without_date,
           count(*) FILTER (WHERE date < DATE '2024-01-08' OR date >= DATE '2024-01-15')
               AS n_outside,
           CAST(0 AS BIGINT) AS n_corrupt
    FROM staged""",
    "open_load": f"""WITH {MONTH}
    SELECT date, {SUMS} FROM T WHERE date >= DATE '2024-01-08' GROUP BY date""",
    "load_counts": f"""WITH {YEARS}
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE unknown) AS n_bad_values,
           CAST(0 AS BIGINT) AS n_corrupt
    FROM Y""",
    "load_rejects": f"""WITH {YEARS}
    SELECT plaza_id, strftime(date, '%Y-%m-%dT00:00:00.000') AS date, hour, direction,
           CAST(vehicles_e_zpass AS VARCHAR) AS vehicles_e_zpass, 'n/a' AS vehicles_vtoll,
           'vehicles_vtoll' AS field, 'n/a' AS raw_value
    FROM Y WHERE unknown""",
    "replace_window": f"WITH {MONTH} SELECT {MONTH_COLUMNS} FROM T",
    "replace_window_year": f"""WITH {YEARS}
    SELECT date, count(*) AS n_rows, CAST(sum(vehicles_e_zpass) AS BIGINT) AS e_zpass,
           CAST(sum(vehicles_vtoll + CASE WHEN date >= DATE '1997-12-20'
                AND date < DATE '1998-02-10' THEN 1 ELSE 0 END) AS BIGINT) AS vtoll
    FROM Y GROUP BY date""",
    "stage_drift": f"""WITH {YEARS},
    staged AS (SELECT CAST(hour AS INT) AS hour, CAST(plaza_id AS INT) AS plaza FROM Y)
    SELECT * FROM (
        SELECT 'plaza_id' AS field, 'string' AS kind, count(*) AS n_values, true AS declared,
               false AS conflict FROM staged
        UNION ALL SELECT 'date', 'string', count(*), true, false FROM staged WHERE hour >= 6
        UNION ALL SELECT 'hour', 'number', count(*), true, true FROM staged
        UNION ALL SELECT 'direction', 'boolean', count(*), true, true FROM staged
        UNION ALL SELECT 'vehicles_e_zpass', 'string', count(*), true, false FROM staged
        UNION ALL SELECT 'vehicles_vtoll', 'absent', 0, true, false
        UNION ALL SELECT 'note', 'string', count(*), false, false FROM staged WHERE hour < 12
        UNION ALL SELECT 'lane', 'object', count(*), false, false FROM staged WHERE plaza > 25)
    WHERE n_values > 0 OR kind = 'absent'""",
    "backfill_ledger": f"""WITH {YEARS},
    edges AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
                          INTERVAL 366 DAY)) AS DATE) AS start),
    spans AS (SELECT start, least(CAST(start + 366 AS DATE), DATE '2002-01-01') AS stop FROM edges)
    SELECT start, stop, count(Y.date) AS n_rows, count(Y.date) AS n_held
    FROM spans LEFT JOIN Y ON date >= start AND date < stop GROUP BY start, stop""",
    "upsert_window": f"""WITH {MONTH},
    corrected AS (
        SELECT * REPLACE (CAST(vehicles_vtoll + 1 AS INT) AS vehicles_vtoll) FROM T
        WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-15' AND direction = 'I')
    SELECT {MONTH_COLUMNS} FROM corrected
    UNION ALL SELECT {MONTH_COLUMNS}
    FROM (SELECT * REPLACE ('9' || plaza_id AS plaza_id) FROM corrected)
    UNION ALL SELECT {MONTH_COLUMNS} FROM T
    WHERE NOT (date >= DATE '2024-01-08' AND date < DATE '2024-01-15' AND direction = 'I')""",
    "kept_sums": f"""WITH {MONTH},
    held AS (
        SELECT {MONTH_COLUMNS} FROM T
        WHERE date < DATE '2024-01-13' OR date >= DATE '2024-01-18'
        UNION ALL SELECT {MONTH_COLUMNS} FROM T
        WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-13'
        UNION ALL SELECT * REPLACE (vehicles_vtoll + 1 AS vehicles_vtoll)
        FROM (SELECT {MONTH_COLUMNS} FROM T)
        WHERE date >= DATE '2024-01-13' AND date < DATE '2024-01-18' AND direction = 'I')
    SELECT date, plaza_id, direction, count(*) AS n_rows,
           CAST(sum(vehicles_e_zpass) AS BIGINT) AS vehicles_e_zpass,
           CAST(sum(vehicles_vtoll) AS BIGINT) AS vehicles_vtoll
    FROM held GROUP BY ALL""",
    "read_window_year": f"""WITH {YEARS}
    SELECT {MONTH_COLUMNS} FROM Y WHERE date >= DATE '1998-12-28' AND date < DATE '1999-01-04'""",
    "incremental_stage": f"WITH {MONTH} SELECT date, {SUMS} FROM T GROUP BY date",
    "sql_on_table": f"""WITH {MONTH}
    SELECT CAST(hour AS INT) AS hour, {SUMS} FROM T GROUP BY CAST(hour AS INT)""",
    "sql_plaza_day": f"""WITH {YEARS}
    SELECT plaza_id, direction, date, CAST(sum(vehicles_e_zpass) AS BIGINT) AS e_zpass,
           CAST(sum(vehicles_vtoll) AS BIGINT) AS vtoll
    FROM Y GROUP BY plaza_id, direction, date""",
    "sql_pass_share": f"""WITH {YEARS}
    SELECT plaza_id, CAST(year(date) AS INT) AS year,
           CAST(sum(vehicles_e_zpass) AS BIGINT) * 10000
               // CAST(sum(vehicles_e_zpass) + sum(vehicles_vtoll) AS BIGINT) AS share_bp
    FROM Y GROUP BY plaza_id, year(date)""",
    "missing_days": f"""WITH {YEARS},
    days AS (
        SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31',
                           INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT plaza_id, date FROM (SELECT DISTINCT plaza_id FROM Y), days
    EXCEPT SELECT plaza_id, date FROM Y""",
    "duplicate_keys": f"""WITH {YEARS}
    SELECT plaza_id, date, hour, direction, count(*) AS n_rows
    FROM Y GROUP BY plaza_id, date, hour, direction HAVING count(*) > 1""",
}
