"""DuckDB text of the registered queries, over the driver's tables."""

from __future__ import annotations

# The records of monthlake.fixtures, and each step of a batch over them.
_INCIDENTS = r"""
orders_tagged AS (
  SELECT *, o_orderkey AS k, o_custkey AS c, 'A' AS tag FROM orders
  UNION ALL
  SELECT *, o_orderkey AS k, o_custkey AS c, 'B' AS tag FROM orders WHERE o_orderkey % 53 = 0
),
incidents AS (
  SELECT
    CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS "ID",
    concat(tag, CAST(k AS VARCHAR)) AS "Case Number",
    CASE WHEN k % 89 = 0 THEN 'not a date'
         WHEN k % 101 = 0 THEN '1/5/1999 1:02:03 PM'
         WHEN k % 103 = 0 THEN '02/30/1999 01:00:00 AM'
         WHEN k % 107 = 0 THEN NULL
         ELSE strftime(o_orderdate + to_seconds(k % 86400), '%m/%d/%Y %I:%M:%S %p') END AS "Date",
    concat(lpad(CAST(k % 1000 AS VARCHAR), 3, '0'), 'XX W MAIN ST') AS "Block",
    lpad(CAST(c % 9999 AS VARCHAR), 4, '0') AS "IUCR",
    CASE WHEN k % 83 = 0 THEN NULL ELSE o_orderpriority END AS "Primary Type",
    concat('STATUS ', o_orderstatus) AS "Description",
    CASE WHEN k % 43 = 0 THEN NULL ELSE 'STREET' END AS "Location Description",
    o_orderstatus = 'F' AS "Arrest",
    k % 5 = 0 AS "Domestic",
    CAST(c % 2535 AS INT) AS "Beat",
    CAST(c % 25 + 1 AS INT) AS "District",
    CAST(c % 50 + 1 AS INT) AS "Ward",
    CAST(c % 77 + 1 AS INT) AS "Community Area",
    lpad(CAST(c % 26 AS VARCHAR), 2, '0') AS "FBI Code",
    CAST(1090000 + k % 110000 AS INT) AS "X Coordinate",
    CAST(1810000 + k % 140000 AS INT) AS "Y Coordinate",
    CAST(CASE WHEN k % 79 = 0 THEN year(o_orderdate) - 1
              WHEN k % 73 = 0 THEN NULL ELSE year(o_orderdate) END AS INT) AS "Year",
    '02/10/2018 03:50:01 PM' AS "Updated On",
    CASE WHEN k % 71 = 0 THEN NULL WHEN k % 67 = 0 THEN CAST(40.0 AS DOUBLE)
         WHEN k % 61 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE CAST(41.0 AS DOUBLE) + CAST(k % 2001 AS DOUBLE) / CAST(1000 AS DOUBLE)
         END AS "Latitude",
    CASE WHEN k % 59 = 0 THEN NULL WHEN k % 67 = 0 THEN CAST(-80.0 AS DOUBLE)
         WHEN k % 47 = 0 THEN CAST(-89.0 AS DOUBLE)
         ELSE CAST(-88.5 AS DOUBLE) + CAST(k % 1501 AS DOUBLE) / CAST(1000 AS DOUBLE)
         END AS "Longitude",
    concat('(', CAST(k % 2001 AS VARCHAR), ', ', CAST(k % 1501 AS VARCHAR), ')') AS "Location"
  FROM orders_tagged
)"""

# try_strptime alone would take dates without leading zeros.
_PARSED = r"""
parsed AS (
  SELECT *, CAST(year(event_time) AS INT) AS batch_year, CAST(month(event_time) AS INT) AS batch_month
  FROM (
    SELECT *, CASE WHEN regexp_full_match("Date", '\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2} [AaPp][Mm]')
                   THEN try_strptime("Date", '%m/%d/%Y %I:%M:%S %p') END AS event_time
    FROM incidents
  )
)"""


def _classified(
    rows: str = "parsed", order: str = '"Date", "Case Number"', id_rule: bool = True
) -> str:
    """Rules, then the first row per ID and batch among the valid rows."""
    id_null = """CASE WHEN "ID" IS NULL THEN 'ID_NULL' END,""" if id_rule else ""
    return f"""
checked AS (
  SELECT *, nullif(concat_ws(';',
      {id_null}
      CASE WHEN "Primary Type" IS NULL THEN 'PRIMARY_TYPE_NULL' END,
      CASE WHEN event_time IS NULL THEN 'INVALID_DATE'
           WHEN year(event_time) <> "Year" THEN 'YEAR_MISMATCH' END,
      CASE WHEN "Latitude" IS NULL OR "Longitude" IS NULL THEN 'NULL_GEO'
           WHEN "Latitude" < 41.0 OR "Latitude" > 43.0 THEN 'INVALID_LAT'
           WHEN "Longitude" < -88.5 OR "Longitude" > -87.0 THEN 'INVALID_LON' END
    ), '') AS rule_reason
  FROM {rows}
),
classified AS (
  SELECT * EXCLUDE (rule_reason), CASE
      WHEN rule_reason IS NOT NULL THEN rule_reason
      WHEN row_number() OVER (PARTITION BY batch_year, batch_month, rule_reason IS NULL, "ID"
                              ORDER BY {order}) > 1 THEN 'DUPLICATE_ID'
    END AS reject_reason
  FROM checked
)"""


# Columns that both engines write alike: all but the coordinates, which may be NaN.
_TEXT_COLUMNS = """"ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
  "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward", "Community Area",
  "FBI Code", "X Coordinate", "Y Coordinate", "Year", "Updated On", "Location\""""
_NO_YEAR = _TEXT_COLUMNS.replace('"Year", ', "")
_CURATED_COLUMNS = _NO_YEAR + ', "Latitude", "Longitude"'
# The coordinates with 0 for NaN, which engines do not compare alike, and where that is so.
_COORDINATES = """,
  CASE WHEN isnan("Latitude") THEN 0 ELSE "Latitude" END AS "Latitude",
  CASE WHEN isnan("Longitude") THEN 0 ELSE "Longitude" END AS "Longitude",
  coalesce(isnan("Latitude"), false) AS latitude_nan, coalesce(isnan("Longitude"), false) AS longitude_nan"""
_ALL_COLUMNS = _TEXT_COLUMNS + _COORDINATES
_SOURCE_COLUMNS = _ALL_COLUMNS.replace('"Year"', '"Year" AS "YearReported"')

_MONTH = "batch_year = 2001 AND batch_month = 5"
_LABEL = "printf('%04d-%02d', batch_year, batch_month)"
# What a batch over the source sees: undated rows stay in quarantine.
_DATED = "batch_year IS NOT NULL"

_WORDS = r"""
SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents
) GROUP BY word"""

_LINE_WORDS = r"""
SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+')) AS word FROM (
    SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents
  )
) GROUP BY word"""


def _on_incidents(select: str) -> str:
    return f"WITH {_INCIDENTS} {select}"


def _on_parsed(select: str) -> str:
    return f"WITH {_INCIDENTS}, {_PARSED} {select}"


def _on_classified(select: str, *args: str) -> str:
    return f"WITH {_INCIDENTS}, {_PARSED}, {_classified(*args)} {select}"


_MONTHLY = f"""
SELECT {_LABEL} AS batch_month, count(*) AS raw,
  count(*) FILTER (reject_reason IS NULL) AS curated,
  count(*) FILTER (reject_reason IS NOT NULL) AS rejected
FROM classified WHERE {_DATED} GROUP BY batch_year, batch_month"""

_VERIFIED = f"""
SELECT batch_month, raw, curated, rejected, curated AS visible
FROM ({_MONTHLY}) WHERE batch_month = '2001-05'"""

_LAKE = f"""
SELECT batch_month, raw, curated, rejected, curated AS visible, true AS sound FROM ({_MONTHLY})
UNION ALL
SELECT '0000-00', count(*), 0, 0, 0, true FROM parsed WHERE event_time IS NULL"""

_REASONS = 'SELECT "Case Number", batch_year, batch_month, reject_reason FROM classified'

_CURATED = f"FROM classified WHERE reject_reason IS NULL AND {_DATED}"
_REJECTED = f"FROM classified WHERE reject_reason IS NOT NULL AND {_DATED}"
_AS_KEYS = "batch_year AS year, batch_month AS month"


def _emptied(month: str, select: str) -> str:
    """The records with the primary types of one month taken away."""
    return f"""
WITH {_INCIDENTS}, {_PARSED},
changed AS (
  SELECT * REPLACE (CASE WHEN {month} THEN NULL ELSE "Primary Type" END AS "Primary Type")
  FROM parsed
), {_classified("changed")} {select}"""


# A raw slice: the month's rows and all undated ones, all of one batch.
_RAW_BATCH = f"""
WITH {_INCIDENTS}, {_PARSED},
slice AS (
  SELECT * EXCLUDE (batch_year, batch_month), 2001 AS batch_year, 5 AS batch_month
  FROM parsed WHERE event_time IS NULL OR ({_MONTH})
), {_classified("slice")}
SELECT {_NO_YEAR}{_COORDINATES}, reject_reason FROM classified"""


# Every month's slice of the CSV: its own rows, and all undated rows once more.
_RAW_MONTHS = f"""
WITH {_INCIDENTS}, {_PARSED},
slice AS (
  SELECT * FROM parsed WHERE event_time IS NOT NULL
  UNION ALL
  SELECT p.* REPLACE (m.batch_year AS batch_year, m.batch_month AS batch_month)
  FROM parsed p, (SELECT DISTINCT batch_year, batch_month FROM parsed WHERE event_time IS NOT NULL) m
  WHERE p.event_time IS NULL
), {_classified("slice")}
SELECT {_NO_YEAR}{_COORDINATES}, {_LABEL} AS batch_month, reject_reason FROM classified"""


def oracle_sql() -> dict[str, str]:
    return {
        "dq_classified": _on_classified(
            f"SELECT {_ALL_COLUMNS}, batch_year, batch_month, reject_reason FROM classified"
        ),
        "dq_reason_counts": _on_classified(
            "SELECT reject_reason, count(*) AS cnt FROM classified GROUP BY reject_reason"
        ),
        "dq_curated": _on_classified(
            f"SELECT {_CURATED_COLUMNS}, batch_year, batch_month "
            "FROM classified WHERE reject_reason IS NULL"
        ),
        "dq_rejected": _on_classified(
            f"SELECT {_ALL_COLUMNS}, batch_year, batch_month, reject_reason "
            "FROM classified WHERE reject_reason IS NOT NULL"
        ),
        "dq_month_counts": _on_classified(
            f"SELECT {_AS_KEYS}, count(*) AS cnt {_CURATED} GROUP BY ALL ORDER BY year, month"
        ),
        "dedupe_parts": _on_classified(_REASONS),
        "dedupe_null_keys": f"WITH {_INCIDENTS}, {_PARSED}, {_classified(id_rule=False)} {_REASONS}",
        "dedupe_by_time": (
            f"WITH {_INCIDENTS}, {_PARSED}, "
            f"{_classified(order='event_time, \"Case Number\"')} {_REASONS}"
        ),
        "dedupe_descending": (
            f"WITH {_INCIDENTS}, {_PARSED}, "
            f"{_classified(order='\"Date\" DESC, \"Case Number\" DESC')} {_REASONS}"
        ),
        "reconcile": _on_classified(
            """SELECT batch_year, batch_month, count(*) AS raw,
                 count(*) FILTER (reject_reason IS NULL) AS curated,
                 count(*) FILTER (reject_reason IS NOT NULL) AS rejected, true AS balanced
               FROM classified GROUP BY batch_year, batch_month"""
        ),
        "source_quarantine": _on_parsed(
            f"""SELECT {_SOURCE_COLUMNS},
                  CASE WHEN event_time IS NULL THEN 'INVALID_DATE' END AS _source_error,
                  coalesce(batch_year, 0) AS year, coalesce(batch_month, 0) AS month
                FROM parsed"""
        ),
        "source_reconcile": _on_parsed(
            """SELECT count(*) AS total, count(event_time) AS valid,
                 count(*) - count(event_time) AS quarantined FROM parsed"""
        ),
        "source_partitions": _on_parsed(
            """SELECT DISTINCT coalesce(batch_year, 0) AS year, coalesce(batch_month, 0) AS month
               FROM parsed"""
        ),
        "verify_source": _on_parsed(
            """SELECT coalesce(batch_year, 0) AS year, coalesce(batch_month, 0) AS month,
                 count(*) AS rows FROM parsed GROUP BY ALL"""
        ),
        "read_month": _on_parsed(f"SELECT {_ALL_COLUMNS} FROM parsed WHERE {_MONTH}"),
        "require_month": _on_parsed(f"SELECT count(*) AS rows FROM parsed WHERE {_MONTH}"),
        "raw_month_slice": _on_parsed(
            f"SELECT {_ALL_COLUMNS} FROM parsed WHERE event_time IS NULL OR ({_MONTH})"
        ),
        "raw_month_batch": _RAW_BATCH,
        "raw_months": _RAW_MONTHS,
        "csv_scan": _on_incidents(f"SELECT {_ALL_COLUMNS} FROM incidents"),
        "batch_counts": _on_classified(_MONTHLY),
        "curated_rows": _on_classified(f"SELECT {_CURATED_COLUMNS}, {_AS_KEYS} {_CURATED}"),
        "rejected_rows": _on_classified(
            f"SELECT {_ALL_COLUMNS}, reject_reason, {_LABEL} AS batch_month {_REJECTED}"
        ),
        "curated_rerun": _on_classified(f"SELECT {_CURATED_COLUMNS}, {_AS_KEYS} {_CURATED}"),
        "rejected_rerun": _on_classified(
            f"SELECT {_ALL_COLUMNS}, reject_reason, {_LABEL} AS batch_month {_REJECTED}"
        ),
        "emptied_month_rerun": _emptied(_MONTH, _LAKE),
        "verify_empty_month": _emptied(_MONTH, _VERIFIED),
        "month_slice": _on_classified(
            f"SELECT {_CURATED_COLUMNS}, {_AS_KEYS} {_CURATED} AND {_MONTH}"
        ),
        "catalog_total": _on_classified(f"SELECT count(*) AS total {_CURATED}"),
        "catalog_month_counts": _on_classified(
            f"SELECT {_AS_KEYS}, count(*) AS cnt {_CURATED} GROUP BY ALL ORDER BY year, month"
        ),
        "catalog_partitions": _on_classified(
            f"SELECT DISTINCT {_AS_KEYS} {_CURATED} ORDER BY year, month"
        ),
        "cumulative_months": _on_classified(
            f"""SELECT year, month, cnt,
                  CAST(sum(cnt) OVER (ORDER BY year, month) AS BIGINT) AS total
                FROM (SELECT {_AS_KEYS}, count(*) AS cnt {_CURATED} GROUP BY ALL)"""
        ),
        "verify_month": _on_classified(_VERIFIED),
        "explain_month": _on_parsed(
            f"SELECT {_AS_KEYS}, count(*) AS rows FROM parsed WHERE {_MONTH} GROUP BY ALL"
        ),
        "verify_lake": _on_classified(_LAKE),
        "verify_content": _on_classified(f"SELECT batch_month, raw, sound FROM ({_LAKE})"),
        "top_categories": """
            SELECT o_orderpriority AS category, count(*) AS cnt FROM orders
            GROUP BY o_orderpriority ORDER BY 2 DESC""",
        "preview": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority
            FROM orders ORDER BY o_orderkey LIMIT 10""",
        "csv_schema": """
            SELECT position, "column", type, true AS nullable
            FROM (VALUES (1, 'o_orderkey', 'int'), (2, 'o_custkey', 'int'),
                         (3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'),
                         (5, 'o_orderdate', 'timestamp'), (6, 'o_orderpriority', 'string'))
                 AS fields(position, "column", type)""",
        "preview_all": """
            SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate)
            FROM orders ORDER BY o_orderkey LIMIT 10""",
        "csv_nulls": """
            SELECT "column", CAST(0 AS BIGINT) AS nulls
            FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'),
                         ('o_orderdate'), ('o_orderpriority')) AS fields("column")""",
        "csv_total": "SELECT count(*) AS total_rows FROM orders",
        "csv_sql": """
            SELECT o_orderstatus, count(*) AS cnt, CAST(sum(o_custkey) AS BIGINT) AS custkeys
            FROM orders GROUP BY o_orderstatus""",
        "word_count": _WORDS,
        "word_count_lines": _LINE_WORDS,
        "report_csv": _WORDS,
        "report_csv_parts": _WORDS,
    }
