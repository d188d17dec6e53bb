"""The same answers in plain SQL over the same tables.

CSV queries are stated over the text the files were written from; JSON queries over
``orders`` itself, as closed-form predicates on the injected faults.
"""

from __future__ import annotations

from schemagate.billing import FLAT
from schemagate.suite.fixtures import FLAT_SQL, JSON_SQL

WITH_F = f"WITH f AS ({FLAT_SQL})"

# Rebuilt rows: gates, casts and the failure mark, on the flat text.
WITH_T = f"""{WITH_F},
t AS (
  SELECT *,
    invoice_month IS NOT NULL AND invoice_publisher_type IS NOT NULL AS has_invoice,
    service_id IS NOT NULL AND service_description IS NOT NULL AS has_service,
    sku_id IS NOT NULL AND sku_description IS NOT NULL AS has_sku,
    usage_amount IS NOT NULL AS has_usage,
    CASE WHEN labels LIKE '[{{%' THEN labels END AS good_labels,
    TRY_CAST(currency_conversion_rate AS DECIMAL(38,10)) AS rate,
    TRY_CAST(invoice_month AS BIGINT) AS month_number,
    TRY_CAST(usage_amount_in_pricing_units AS DOUBLE) AS units
  FROM f
),
m AS (
  SELECT *,
    billing_account_id IS NULL OR cost IS NULL OR NOT has_invoice OR NOT has_service
      OR NOT has_sku OR NOT has_usage AS failed
  FROM t
)"""

LEAVES = """
  billing_account_id, cost, currency, rate AS currency_conversion_rate, export_time,
  CASE WHEN has_invoice THEN month_number END AS invoice_month,
  CASE WHEN has_invoice THEN invoice_publisher_type END AS invoice_publisher_type,
  good_labels AS labels, location, project,
  CASE WHEN has_service THEN service_description END AS service_description,
  CASE WHEN has_service THEN service_id END AS service_id,
  CASE WHEN has_sku THEN sku_description END AS sku_description,
  CASE WHEN has_sku THEN sku_id END AS sku_id,
  usage_amount,
  CASE WHEN has_usage THEN units END AS usage_amount_in_pricing_units,
  CASE WHEN has_usage THEN usage_pricing_unit END AS usage_pricing_unit,
  CASE WHEN has_usage THEN usage_unit END AS usage_unit,
  usage_end_time, usage_start_time"""

COMPAT_MESSAGE = """concat_ws(', ',
    CASE WHEN billing_account_id IS NULL THEN 'billing_account_id: null' ELSE '' END,
    CASE WHEN NOT has_invoice THEN 'invoice: reconstruction failed' ELSE '' END,
    CASE WHEN NOT has_service THEN 'service: reconstruction failed' ELSE '' END,
    CASE WHEN NOT has_sku THEN 'sku: reconstruction failed' ELSE '' END,
    CASE WHEN NOT has_usage THEN 'usage: reconstruction failed' ELSE '' END)"""

CLEAN_PARTS = """
    CASE WHEN billing_account_id IS NULL THEN 'billing_account_id: null' END,
    CASE WHEN cost IS NULL THEN 'cost: null' END,
    CASE WHEN NOT has_invoice THEN 'invoice: reconstruction failed' END,
    CASE WHEN NOT has_service THEN 'service: reconstruction failed' END,
    CASE WHEN NOT has_sku THEN 'sku: reconstruction failed' END,
    CASE WHEN NOT has_usage THEN 'usage: reconstruction failed' END"""

CAST_PARTS = """
    CASE WHEN currency_conversion_rate IS NOT NULL AND rate IS NULL THEN 'currency_conversion_rate: cast failed' END,
    CASE WHEN invoice_month IS NOT NULL AND month_number IS NULL THEN 'invoice.month: cast failed' END,
    CASE WHEN labels IS NOT NULL AND labels <> '[]' AND good_labels IS NULL THEN 'labels: cast failed' END,
    CASE WHEN usage_amount_in_pricing_units IS NOT NULL AND units IS NULL THEN 'usage.amount_in_pricing_units: cast failed' END"""

ANY_CAST = """(currency_conversion_rate IS NOT NULL AND rate IS NULL
    OR invoice_month IS NOT NULL AND month_number IS NULL
    OR labels IS NOT NULL AND labels <> '[]' AND good_labels IS NULL
    OR usage_amount_in_pricing_units IS NOT NULL AND units IS NULL)"""

RULE_COLUMNS = """rec_id, billing_account_id, cost,
  CASE WHEN has_invoice THEN month_number END AS invoice_month, usage_start_time, usage_end_time"""
BAD_NUMBER = "cost IS NOT NULL AND NOT regexp_full_match(cost, '-?[0-9]+(\\.[0-9]+)?')"
BAD_ORDER = "usage_start_time > usage_end_time"
BAD_TIMES = "TRY_CAST(usage_start_time AS TIMESTAMP) > TRY_CAST(usage_end_time AS TIMESTAMP)"
BAD_RANGE = "has_invoice AND month_number NOT BETWEEN 202201 AND 209912"
BAD_MONTH = (
    "has_invoice AND (month_number NOT BETWEEN 202201 AND 209912"
    " OR month_number % 100 NOT BETWEEN 1 AND 12)"
)

# JSON records: what each leaf reads as, given the faults.
WITH_J = f"""WITH raw AS ({JSON_SQL}),
k AS (SELECT *, o_orderkey AS n FROM orders),
r AS (
  SELECT k.n, raw.raw,
    k.n % 103 = 0 OR k.n % 107 = 0 AS unreadable,
    k.n % 103 = 0 OR k.n % 107 = 0 OR k.n % 83 = 0 OR k.n % 73 = 0 OR k.n % 11 = 0
      OR k.n % 59 = 0 AS corrupt,
    CASE WHEN n % 101 = 0 THEN NULL ELSE 'BA-' || CAST(o_custkey AS VARCHAR) END AS account,
    CASE WHEN n % 89 = 0 THEN 'n/a'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS cost_text,
    CASE WHEN n % 83 = 0 THEN NULL ELSE CAST(1 AS DECIMAL(38,10)) END AS rate,
    CASE WHEN n % 73 = 0 THEN NULL WHEN n % 71 = 0 THEN 209913
         ELSE CAST(year(o_orderdate) * 100 + month(o_orderdate) + 2700 AS BIGINT) END AS month_number,
    CASE WHEN n % 11 = 0 THEN NULL WHEN n % 7 = 0 THEN '[]'
         ELSE '[{{"key":"priority","value":"' || o_orderpriority || '"}}]' END AS label_text,
    CASE WHEN n % 5 = 0 THEN NULL
         ELSE 'a }}{{ " b ' || CAST(o_custkey % 10 AS VARCHAR) END AS project_text,
    CASE WHEN n % 67 = 0 THEN NULL ELSE o_orderstatus END AS service_code,
    CASE WHEN n % 59 = 0 THEN NULL ELSE CAST(2 AS DOUBLE) END AS units,
    CASE WHEN n % 43 = 0 THEN '1990-01-01 00:00:00'
         ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 10) || ' 23:59:59' END AS end_text,
    CAST(o_orderdate AS VARCHAR) AS start_text
  FROM k JOIN raw ON raw.rec_id = k.n
),
j AS (
  SELECT n, raw, corrupt,
    CASE WHEN NOT unreadable THEN account END AS billing_account_id,
    CASE WHEN NOT unreadable THEN cost_text END AS cost,
    CASE WHEN NOT unreadable THEN 'USD' END AS currency,
    CASE WHEN NOT unreadable THEN rate END AS currency_conversion_rate,
    CAST(NULL AS VARCHAR) AS export_time,
    CASE WHEN NOT unreadable THEN month_number END AS invoice_month,
    CASE WHEN NOT unreadable THEN 'DIRECT' END AS invoice_publisher_type,
    CASE WHEN NOT unreadable THEN label_text END AS labels,
    CAST(NULL AS VARCHAR) AS location,
    CASE WHEN NOT unreadable THEN project_text END AS project,
    CASE WHEN NOT unreadable THEN 'Service ' || service_code END AS service_description,
    CASE WHEN NOT unreadable THEN 'svc-' || service_code END AS service_id,
    CAST(NULL AS VARCHAR) AS sku_description,
    CAST(NULL AS VARCHAR) AS sku_id,
    CASE WHEN NOT unreadable THEN '1' END AS usage_amount,
    CASE WHEN NOT unreadable THEN units END AS usage_amount_in_pricing_units,
    CASE WHEN NOT unreadable THEN 'hour' END AS usage_pricing_unit,
    CASE WHEN NOT unreadable THEN 'seconds' END AS usage_unit,
    CASE WHEN NOT unreadable THEN end_text END AS usage_end_time,
    CASE WHEN NOT unreadable THEN start_text END AS usage_start_time,
    CASE WHEN corrupt THEN raw END AS corrupt_record
  FROM r
)"""

JSON_RULES = """
  count(*) FILTER (NOT corrupt AND billing_account_id IS NULL) AS n1,
  count(*) FILTER (NOT corrupt AND cost = 'n/a') AS n2,
  count(*) FILTER (NOT corrupt AND usage_start_time > usage_end_time) AS n3,
  count(*) FILTER (NOT corrupt AND invoice_month NOT BETWEEN 202201 AND 209912) AS n4"""

SUMMARY = """total_records, valid_records, invalid_records,
  CASE WHEN total_records > 0 THEN round(valid_records / total_records * 100, 2) ELSE 0.0 END AS valid_pct,
  CASE WHEN total_records > 0 THEN round(invalid_records / total_records * 100, 2) ELSE 0.0 END AS invalid_pct"""
COUNTS = """count(*) AS total_records, count(*) FILTER (NOT {0}) AS valid_records,
  count(*) FILTER ({0}) AS invalid_records"""

FLAT_COLUMNS = """billing_account_id, cost, currency, currency_conversion_rate, export_time,
  invoice_month, invoice_publisher_type, labels, location, project, service_id,
  service_description, sku_id, sku_description, usage_amount, usage_amount_in_pricing_units,
  usage_pricing_unit, usage_unit, usage_end_time"""

# A ragged line as it was written: every present field quoted, quotes doubled.
QUOTED_LINE = "concat_ws(',', " + ", ".join(
    f"""coalesce('"' || replace({c.strip()}, '"', '""') || '"', '')"""
    for c in FLAT_COLUMNS.split(",")
) + ")"

CSV_SUMMARY = f"{WITH_T}, c AS (SELECT {COUNTS.format('failed')} FROM m) SELECT {SUMMARY} FROM c"


def _nest(gate: str, *members: str) -> str:
    picked = ", ".join(
        f"CASE WHEN {gate} THEN {source} END AS {name}"
        for name, source in (m.split("=") for m in members)
    )
    return f"{WITH_T} SELECT rec_id, NOT {gate} AS is_null, {picked} FROM m"


def _rule(violation: str) -> str:
    return f"{WITH_T} SELECT {RULE_COLUMNS} FROM m WHERE {violation}"


def _violations(source: str, *rules: tuple[str, str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, {n} AS violations, CAST({n} AS VARCHAR) || '{text}' AS message"
        f" FROM c WHERE {n} > 0"
        for name, n, text in rules
    )
    return f"{source} {rows}"


RULE_TEXTS = (
    ("required", "n1", " valid records with null billing_account_id"),
    ("numeric_cost", "n2", " records with non-numeric cost"),
    ("time_order", "n3", " records with end_time < start_time"),
    ("month_range", "n4", " records with invalid invoice month"),
)

JSON_COLUMNS = """billing_account_id, cost, currency, currency_conversion_rate, export_time,
  invoice_month, invoice_publisher_type, labels, location, project, service_description,
  service_id, sku_description, sku_id, usage_amount, usage_amount_in_pricing_units,
  usage_pricing_unit, usage_unit, usage_end_time, usage_start_time"""

NULL_FIELDS = {
    "billing_account_id": "billing_account_id",
    "cost": "cost",
    "currency": "currency",
    "project": "project",
    "service": "service_id",
    "sku": "sku_id",
}

TEXT_PATTERNS = """count(*) FILTER (corrupt) AS invalid_records,
  count(*) FILTER (corrupt AND (contains(raw, '{') OR contains(raw, '}') OR contains(raw, '[')
    OR contains(raw, ']'))) AS structure"""

ORACLES: dict[str, str] = {
    "csv_scan": FLAT_SQL,
    "csv_strict_header": FLAT_SQL,
    "csv_ragged_permissive": f"""{WITH_F} SELECT {FLAT_COLUMNS},
      CASE WHEN rec_id % 3 <> 0 THEN usage_start_time END AS usage_start_time FROM f""",
    "csv_ragged_rejected": f"""{WITH_F} SELECT {FLAT_COLUMNS},
      CASE WHEN rec_id % 3 <> 0 THEN usage_start_time END AS usage_start_time,
      CASE rec_id % 3 WHEN 0 THEN {QUOTED_LINE}
        WHEN 2 THEN {QUOTED_LINE} || ',"' || usage_start_time || '",surplus' END AS corrupt_record
      FROM f""",
    "csv_ragged_headers": f"""{WITH_F} SELECT {FLAT_COLUMNS}, usage_start_time, CAST(NULL AS VARCHAR) AS corrupt_record FROM f
      UNION ALL SELECT {", ".join(f"'{c}'" for c in FLAT)}, NULL FROM f WHERE rec_id % 1009 = 0""",
    "json_lines_scan": f"{WITH_J} SELECT {JSON_COLUMNS}, corrupt_record FROM j",
    "json_document_scan": f"{WITH_J} SELECT {JSON_COLUMNS}, corrupt_record FROM j",
    "json_document_blocks": f"{WITH_J} SELECT {JSON_COLUMNS}, corrupt_record FROM j",
    "json_bare_documents": f"{WITH_J} SELECT {JSON_COLUMNS}, corrupt_record FROM j",
    "json_string_coercion": f"""{WITH_J} SELECT cost, TRY_CAST(cost AS DOUBLE) AS cost_number
      FROM j WHERE NOT corrupt""",
    "nest_invoice": _nest(
        "has_invoice", "month=month_number", "publisher_type=invoice_publisher_type"
    ),
    "nest_service": _nest("has_service", "description=service_description", "id=service_id"),
    "nest_sku": _nest("has_sku", "description=sku_description", "id=sku_id"),
    "nest_usage": _nest(
        "has_usage",
        "amount=usage_amount",
        "amount_in_pricing_units=units",
        "pricing_unit=usage_pricing_unit",
        "unit=usage_unit",
    ),
    "parse_labels": f"""{WITH_F} SELECT rec_id, labels IS NULL OR labels NOT LIKE '[{{%' AS is_null,
      CASE WHEN labels LIKE '[{{%' THEN 'priority' END AS first_key,
      CASE WHEN labels LIKE '[{{%' THEN regexp_extract(labels, '"value":"([^"]*)"', 1) END AS first_value
      FROM f""",
    "cast_decimal": f"""{WITH_F} SELECT rec_id,
      TRY_CAST(currency_conversion_rate AS DECIMAL(38,10)) AS currency_conversion_rate FROM f""",
    "cast_long": f"{WITH_T} SELECT rec_id, CASE WHEN has_invoice THEN month_number END AS month FROM m",
    "cast_double": f"""{WITH_T} SELECT rec_id,
      CASE WHEN has_usage THEN units END AS amount_in_pricing_units FROM m""",
    "row_id_counts": "SELECT count(*) AS total_rows, count(*) AS distinct_ids FROM orders",
    "validation_flag": f"{WITH_T} SELECT rec_id, failed FROM m",
    "corrupt_message": f"""{WITH_T} SELECT rec_id, CASE WHEN failed THEN {COMPAT_MESSAGE} END AS message
      FROM m""",
    "corrupt_message_clean": f"""{WITH_T} SELECT rec_id,
      CASE WHEN failed THEN concat_ws(', ', {CLEAN_PARTS}) END AS message FROM m""",
    "target_projection": f"{WITH_T} SELECT rec_id, {LEAVES} FROM m",
    "csv_valid": f"""{WITH_T} SELECT rec_id, {LEAVES}, CAST(NULL AS VARCHAR) AS corrupt_record
      FROM m WHERE NOT failed""",
    "csv_invalid": f"""{WITH_T} SELECT rec_id, {LEAVES}, {COMPAT_MESSAGE} AS corrupt_record
      FROM m WHERE failed""",
    "json_valid": f"{WITH_J} SELECT {JSON_COLUMNS} FROM j WHERE NOT corrupt",
    "json_invalid": f"{WITH_J} SELECT corrupt_record FROM j WHERE corrupt",
    "csv_summary": CSV_SUMMARY,
    "json_summary": f"{WITH_J}, c AS (SELECT {COUNTS.format('corrupt')} FROM j) SELECT {SUMMARY} FROM c",
    "null_profile": f"""{WITH_J}, v AS (SELECT * FROM j WHERE NOT corrupt)
      """ + " UNION ALL ".join(
        f"""SELECT '{field}' AS field, count(*) FILTER ({column} IS NULL) AS null_count,
        CASE WHEN count(*) > 0 THEN round(count(*) FILTER ({column} IS NULL) / count(*) * 100, 2)
          ELSE 0.0 END AS null_percentage FROM v"""
        for field, column in NULL_FIELDS.items()
    ),
    "rule_required": _rule("billing_account_id IS NULL"),
    "rule_numeric_cost": _rule(BAD_NUMBER),
    "rule_time_order": _rule(BAD_ORDER),
    "rule_month_range": _rule(BAD_RANGE),
    "rule_violations": _violations(
        f"{WITH_J}, c AS (SELECT {JSON_RULES} FROM j)", *RULE_TEXTS
    ),
    "csv_rule_violations": _violations(
        f"""{WITH_T}, c AS (SELECT
          count(*) FILTER (NOT failed AND billing_account_id IS NULL) AS n1,
          count(*) FILTER (NOT failed AND {BAD_NUMBER}) AS n2,
          count(*) FILTER (NOT failed AND {BAD_TIMES}) AS n3,
          count(*) FILTER (NOT failed AND {BAD_MONTH}) AS n4 FROM m)""",
        *RULE_TEXTS,
    ),
    "pattern_counts": f"""{WITH_J} SELECT {TEXT_PATTERNS},
      count(*) FILTER (corrupt AND (contains(raw, chr(92)) OR contains(raw, 'u'))) AS encoding FROM j""",
    "pattern_counts_strict": f"""{WITH_J} SELECT {TEXT_PATTERNS},
      count(*) FILTER (corrupt AND (regexp_matches(raw, '\\\\u[0-9a-fA-F]{{4}}')
        OR contains(raw, chr(65533)))) AS encoding FROM j""",
    "invalid_sample": f"""{WITH_J}, s AS (
        SELECT raw FROM j WHERE corrupt ORDER BY raw LIMIT 5)
      SELECT CASE WHEN length(raw) > 200 THEN left(raw, 200) || '...' ELSE raw END AS corrupt_record
      FROM s""",
    "csv_invalid_sample": f"""{WITH_T} SELECT rec_id, billing_account_id, project,
      {COMPAT_MESSAGE} AS corrupt_record FROM m WHERE failed ORDER BY rec_id LIMIT 5""",
    "truncated_text": f"""{WITH_J} SELECT
      CASE WHEN length(raw) > 200 THEN left(raw, 200) || '...' ELSE raw END AS corrupt_record
      FROM j WHERE corrupt""",
    "load_valid_table": f"{WITH_T} SELECT rec_id, {LEAVES} FROM m WHERE NOT failed",
    "load_nothing": f"{WITH_T} SELECT rec_id, {LEAVES} FROM m WHERE NOT failed",
    "quarantine_table": f"""{WITH_T} SELECT rec_id, {LEAVES}, {COMPAT_MESSAGE} AS corrupt_record
      FROM m WHERE failed""",
    "load_both_tables": f"{WITH_J} SELECT {JSON_COLUMNS}, corrupt_record FROM j",
    "load_tables_in_place": f"{WITH_J} SELECT {JSON_COLUMNS}, corrupt_record FROM j",
    "table_preview": f"""{WITH_T} SELECT rec_id, {LEAVES} FROM m WHERE NOT failed
      ORDER BY rec_id LIMIT 3""",
    "report_roundtrip": CSV_SUMMARY,
    "verdict_csv": f"""{WITH_T}, c AS (SELECT {COUNTS.format('failed')} FROM m)
      SELECT total_records, valid_records, invalid_records,
        CASE WHEN invalid_records = 0 THEN 'VALIDATION PASSED' ELSE 'VALIDATION ISSUES' END AS status,
        'implicit_spark_casting' AS validation_method FROM c""",
    "verdict_json": f"""{WITH_J}, c AS (SELECT {COUNTS.format('corrupt')}, {TEXT_PATTERNS.split(',', 1)[1]},
        {JSON_RULES} FROM j)
      SELECT total_records, valid_records, invalid_records,
        concat_ws('; ', """ + ", ".join(
        f"CASE WHEN {n} > 0 THEN CAST({n} AS VARCHAR) || '{text}' END" for _, n, text in RULE_TEXTS
    ) + """) AS violations, structure,
        CASE WHEN invalid_records = 0 AND n1 + n2 + n3 + n4 = 0 THEN 'VALIDATION PASSED'
          WHEN invalid_records = 0 THEN 'VALIDATION PASSED WITH WARNINGS'
          WHEN n1 + n2 + n3 + n4 = 0 THEN 'VALIDATION PARTIAL'
          ELSE 'VALIDATION ISSUES' END AS status FROM c""",
    "strict_cast_failures": f"""{WITH_T} SELECT rec_id,
      concat_ws(', ', {CLEAN_PARTS}, {CAST_PARTS}) AS message FROM m WHERE failed OR {ANY_CAST}""",
    "strict_time_order": _rule(BAD_TIMES),
    "strict_month": _rule(BAD_MONTH),
}
