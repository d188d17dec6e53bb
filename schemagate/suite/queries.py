"""One query per operator.

Each takes (spark, sf_dir), derives its input from the whole ``orders`` table and gives
flat columns only: nested fields come out as their leaves, labels as JSON text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemagate.billing import BILLING, FLAT, billing_rules
from schemagate.contract import CORRUPT, FAILED, ROW_ID
from schemagate.functions.messages import shortened
from schemagate.functions.nesting import target_column
from schemagate.operators import (
    invalid_rows,
    invalid_sample,
    load_valid,
    mark,
    mark_corrupt,
    null_profile,
    pattern_counts,
    quarantine,
    rebuild,
    rule_violations,
    summary,
    valid_rows,
    write_report,
)
from schemagate.operators.profile import report
from schemagate.plans import load_in_place, load_split, validate_csv, validate_json
from schemagate.plans.validation import CSV_METHOD
from schemagate.sources import preview, read_csv, read_json
from schemagate.storage import scratch_path, setting
from schemagate.suite import fixtures

Query = Callable[[SparkSession, str], DataFrame]

KEY = ("rec_id",)
REC_ID = "CAST(rec_id AS BIGINT) AS rec_id"


LEAVES = (
    "billing_account_id",
    "cost",
    "currency",
    "currency_conversion_rate",
    "export_time",
    "invoice.month AS invoice_month",
    "invoice.publisher_type AS invoice_publisher_type",
    "to_json(labels) AS labels",
    "location",
    "project",
    "service.description AS service_description",
    "service.id AS service_id",
    "sku.description AS sku_description",
    "sku.id AS sku_id",
    "usage.amount AS usage_amount",
    "usage.amount_in_pricing_units AS usage_amount_in_pricing_units",
    "usage.pricing_unit AS usage_pricing_unit",
    "usage.unit AS usage_unit",
    "usage_end_time",
    "usage_start_time",
)
BLOCK_BYTES = "131072"
"""Split size for documents that are to span blocks."""
REASON = f"{CORRUPT} AS corrupt_record"


def leaves(df: DataFrame, *more: str, key: bool = False) -> DataFrame:
    """Target fields as flat columns."""
    return df.selectExpr(*([REC_ID] if key else []), *LEAVES, *more)


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, fixtures.flat_csv(spark, sf_dir), BILLING, carry=KEY)


def marked_csv(spark: SparkSession, sf_dir: str, **switches: str) -> DataFrame:
    return mark(landed(spark, sf_dir), BILLING, carry=KEY, **switches)


def marked_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_corrupt(read_json(spark, fixtures.json_lines(spark, sf_dir), BILLING))


def new_table(spark: SparkSession, label: str) -> dict[str, str]:
    """A fresh table name, with its data in the shared folder."""
    return {
        "table": f"schemagate_{label}_{uuid.uuid4().hex[:12]}",
        "path": scratch_path(spark, f"table-{label}"),
    }


# ---- scans


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir).selectExpr(REC_ID, *FLAT)


def csv_strict_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.flat_csv(spark, sf_dir)
    rows = read_csv(spark, path, BILLING, carry=KEY, strict_header=True)
    return rows.selectExpr(REC_ID, *FLAT)


def csv_ragged_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, fixtures.ragged_csv(spark, sf_dir), BILLING)


def csv_ragged_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_csv(spark, fixtures.ragged_csv(spark, sf_dir), BILLING, ragged="reject")
    return rows.selectExpr(*FLAT, REASON)


def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaves(read_json(spark, fixtures.json_lines(spark, sf_dir), BILLING), REASON)


def json_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.json_documents(spark, sf_dir, compressed=True)
    return leaves(read_json(spark, path, BILLING, layout="document"), REASON)


def json_document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in blocks far smaller than one of them."""
    path = fixtures.json_documents(spark, sf_dir)
    with setting(spark, "spark.sql.files.maxPartitionBytes", BLOCK_BYTES):
        rows = read_json(spark, path, BILLING, layout="document")
    return leaves(rows, REASON)


def json_bare_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_json(spark, fixtures.json_bare_parts(spark, sf_dir), BILLING, layout="document")
    return leaves(rows, REASON)


def csv_ragged_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_csv(spark, fixtures.headed_csv(spark, sf_dir), BILLING, ragged="reject")
    return rows.selectExpr(*FLAT, REASON)


def json_string_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_rows(marked_json(spark, sf_dir), placeholder=False)
    return rows.selectExpr("cost", "try_cast(cost AS DOUBLE) AS cost_number")


# ---- projections


def nest(field: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = landed(spark, sf_dir).selectExpr(REC_ID, target_column(BILLING, field))
        members = BILLING.target[field].dataType.names
        return built.selectExpr(
            "rec_id", f"{field} IS NULL AS is_null", *[f"{field}.{m} AS {m}" for m in members]
        )

    return query


def parse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = landed(spark, sf_dir).selectExpr(REC_ID, target_column(BILLING, "labels"))
    return parsed.selectExpr(
        "rec_id",
        "labels IS NULL AS is_null",
        "try_element_at(labels, 1).key AS first_key",
        "try_element_at(labels, 1).value AS first_value",
    )


def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = "currency_conversion_rate"
    return landed(spark, sf_dir).selectExpr(REC_ID, target_column(BILLING, field))


def cast_member(field: str, member: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = landed(spark, sf_dir).selectExpr(REC_ID, target_column(BILLING, field))
        return built.selectExpr("rec_id", f"{field}.{member} AS {member}")

    return query


def row_id_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = mark(landed(spark, sf_dir), BILLING, carry=KEY, row_id=True)
    return ids.selectExpr("count(1) AS total_rows", f"count(DISTINCT {ROW_ID}) AS distinct_ids")


def validation_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_csv(spark, sf_dir).selectExpr(REC_ID, f"{FAILED} AS failed")


def corrupt_message(style: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = marked_csv(spark, sf_dir, message_style=style)
        return rows.selectExpr(REC_ID, f"{CORRUPT} AS message")

    return query


def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaves(rebuild(landed(spark, sf_dir), BILLING, carry=KEY), key=True)


# ---- splits


def csv_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_rows(marked_csv(spark, sf_dir))
    return leaves(rows, REASON, key=True)


def csv_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = invalid_rows(marked_csv(spark, sf_dir))
    return leaves(rows, REASON, key=True)


def json_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaves(valid_rows(marked_json(spark, sf_dir), placeholder=False))


def json_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_rows(marked_json(spark, sf_dir)).selectExpr(REASON)


def strict_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marked_csv(spark, sf_dir, cast_policy="strict", message_style="clean")
    return invalid_rows(rows).selectExpr(REC_ID, f"{CORRUPT} AS message")


# ---- rules


def breaking(rule_name: str, **switches: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule = {r.name: r for r in billing_rules(**switches)}[rule_name]
        rows = rebuild(landed(spark, sf_dir), BILLING, carry=KEY).where(rule.violation)
        return rows.selectExpr(
            REC_ID,
            "billing_account_id",
            "cost",
            "invoice.month AS invoice_month",
            "usage_start_time",
            "usage_end_time",
        )

    return query


# ---- profile and report


def csv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.contract_csv(spark, sf_dir)
    return summary(mark(read_csv(spark, path, BILLING), BILLING))


def json_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(marked_json(spark, sf_dir))


def null_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(marked_json(spark, sf_dir), BILLING)


def rule_violations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_violations(marked_json(spark, sf_dir), billing_rules())


def csv_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = billing_rules(time_order="timestamp", month_check="calendar")
    return rule_violations(marked_csv(spark, sf_dir), rules)


def patterns(encoding: str) -> Query:
    return lambda spark, sf_dir: pattern_counts(marked_json(spark, sf_dir), encoding)


def invalid_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = invalid_sample(marked_json(spark, sf_dir))
    return rows.withColumnRenamed(CORRUPT, "corrupt_record")


def csv_invalid_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = invalid_sample(
        marked_csv(spark, sf_dir).withColumn("rec_id", F.col("rec_id").cast("bigint")),
        columns=("rec_id", "billing_account_id", "project"),
        order_by=("rec_id",),
    )
    return rows.withColumnRenamed(CORRUPT, "corrupt_record")


def truncated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = invalid_rows(marked_json(spark, sf_dir))
    return rows.selectExpr(f"{shortened(CORRUPT)} AS corrupt_record")


def verdict_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.contract_csv(spark, sf_dir)
    return validate_csv(spark, path).report.select(
        "total_records", "valid_records", "invalid_records", "status", "validation_method"
    )


def verdict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate_json(spark, fixtures.json_lines(spark, sf_dir))
    return checked.report.selectExpr(
        "total_records",
        "valid_records",
        "invalid_records",
        "array_join(business_rule_violations, '; ') AS violations",
        "reject_patterns.structure AS structure",
        "status",
    )


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.contract_csv(spark, sf_dir)
    marked = mark(read_csv(spark, path, BILLING), BILLING)
    written = report(marked, BILLING, file_path=path, method=CSV_METHOD)
    target = scratch_path(spark, "report")
    write_report(written, target)
    return spark.read.schema(written.schema).json(target).select(
        "total_records", "valid_records", "invalid_records", "valid_pct", "invalid_pct"
    )


# ---- tables


def load_valid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_table(spark, "valid")
    load_valid(valid_rows(marked_csv(spark, sf_dir)), **target)
    return leaves(spark.table(target["table"]), key=True)


def load_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without rows leaves the table as it was."""
    target = new_table(spark, "kept")
    rows = valid_rows(marked_csv(spark, sf_dir))
    load_valid(rows, **target)
    load_valid(rows.where("false"), **target)
    return leaves(spark.table(target["table"]), key=True)


def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_table(spark, "invalid")
    quarantine(invalid_rows(marked_csv(spark, sf_dir)), **target)
    return leaves(
        spark.table(target["table"]), REASON, key=True
    )


def load_both_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, invalid = new_table(spark, "valid"), new_table(spark, "invalid")
    load_split(
        marked_json(spark, sf_dir),
        valid["table"],
        invalid["table"],
        valid_path=valid["path"],
        invalid_path=invalid["path"],
    )
    return both_sides(spark, valid["table"], invalid["table"])


def load_tables_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, invalid = new_table(spark, "valid"), new_table(spark, "invalid")
    load_in_place(marked_json(spark, sf_dir), valid["path"], valid["table"], invalid["table"])
    return both_sides(spark, valid["table"], invalid["table"])


def both_sides(spark: SparkSession, valid: str, invalid: str) -> DataFrame:
    good = leaves(spark.table(valid), "CAST(NULL AS STRING) AS corrupt_record")
    return good.unionByName(leaves(spark.table(invalid), REASON))


def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_table(spark, "preview")
    rows = valid_rows(marked_csv(spark, sf_dir))
    load_valid(rows.withColumn("rec_id", F.col("rec_id").cast("bigint")), **target)
    return leaves(preview(spark, target["table"], "rec_id"), key=True)


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_strict_header": csv_strict_header,
    "csv_ragged_permissive": csv_ragged_permissive,
    "csv_ragged_rejected": csv_ragged_rejected,
    "csv_ragged_headers": csv_ragged_headers,
    "json_lines_scan": json_lines_scan,
    "json_document_scan": json_document_scan,
    "json_document_blocks": json_document_blocks,
    "json_bare_documents": json_bare_documents,
    "json_string_coercion": json_string_coercion,
    "nest_invoice": nest("invoice"),
    "nest_service": nest("service"),
    "nest_sku": nest("sku"),
    "nest_usage": nest("usage"),
    "parse_labels": parse_labels,
    "cast_decimal": cast_decimal,
    "cast_long": cast_member("invoice", "month"),
    "cast_double": cast_member("usage", "amount_in_pricing_units"),
    "row_id_counts": row_id_counts,
    "validation_flag": validation_flag,
    "corrupt_message": corrupt_message("compat"),
    "corrupt_message_clean": corrupt_message("clean"),
    "target_projection": target_projection,
    "csv_valid": csv_valid,
    "csv_invalid": csv_invalid,
    "json_valid": json_valid,
    "json_invalid": json_invalid,
    "csv_summary": csv_summary,
    "json_summary": json_summary,
    "null_profile": null_profile_query,
    "rule_required": breaking("required"),
    "rule_numeric_cost": breaking("numeric_cost"),
    "rule_time_order": breaking("time_order"),
    "rule_month_range": breaking("month_range"),
    "rule_violations": rule_violations_query,
    "csv_rule_violations": csv_rule_violations,
    "pattern_counts": patterns("compat"),
    "pattern_counts_strict": patterns("strict"),
    "invalid_sample": invalid_sample_query,
    "csv_invalid_sample": csv_invalid_sample,
    "truncated_text": truncated_text,
    "load_valid_table": load_valid_table,
    "load_nothing": load_nothing,
    "quarantine_table": quarantine_table,
    "load_both_tables": load_both_tables,
    "load_tables_in_place": load_tables_in_place,
    "table_preview": table_preview,
    "report_roundtrip": report_roundtrip,
    "verdict_csv": verdict_csv,
    "verdict_json": verdict_json,
    "strict_cast_failures": strict_cast_failures,
    "strict_time_order": breaking("time_order", time_order="timestamp"),
    "strict_month": breaking("month_range", month_check="calendar"),
}
