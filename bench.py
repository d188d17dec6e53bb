"""Times the headline queries; prints one JSON line.

Inputs are written before the clock starts, so a query's time is reading, judging and
aggregating or writing.  Each figure is the median of ``BENCH_RUNS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from functools import cache
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemagate.billing import BILLING, billing_rules
from schemagate.contract import CORRUPT, FAILED
from schemagate.operators import mark, mark_corrupt
from schemagate.plans import validate_csv, validate_json
from schemagate.sources import read_csv, read_json
from schemagate.storage import scratch_path
from schemagate.suite import fixtures
from schemagate.suite.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drop_tables(spark: SparkSession) -> None:
    for table in spark.catalog.listTables():
        if not table.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def csv_report(spark: SparkSession) -> None:
    run_all(validate_csv(spark, fixtures.contract_csv(spark, SF_DIR)).report)


def json_report(spark: SparkSession) -> None:
    run_all(validate_json(spark, fixtures.json_lines(spark, SF_DIR)).report)


def document_report(spark: SparkSession) -> None:
    path = fixtures.json_documents(spark, SF_DIR)
    run_all(validate_json(spark, path, layout="document").report)


def zipped_report(spark: SparkSession) -> None:
    run_all(validate_json(spark, zipped(spark), layout="document").report)


@cache
def zipped(spark: SparkSession) -> str:
    """The documents once more, compressed."""
    path = scratch_path(spark, "zipped")
    texts = spark.read.text(fixtures.json_documents(spark, SF_DIR), wholetext=True)
    texts.write.options(compression="gzip", maxRecordsPerFile=1).text(path)
    return path


def count_per_rule(spark: SparkSession) -> None:
    """What ``json_report`` does in one pass, as one pass per count."""
    rows = mark_corrupt(read_json(spark, fixtures.json_lines(spark, SF_DIR), BILLING))
    good, bad = rows.where(~F.col(FAILED)), rows.where(FAILED)
    frames = [rows, good, bad, bad.where(F.col(CORRUPT).rlike("[{}]")), bad.where(F.col(CORRUPT).rlike("u"))]
    frames += [good.where(F.col(f).isNull()) for f in BILLING.key_fields]
    frames += [good.where(rule.violation) for rule in billing_rules()]
    for frame in frames:
        run_all(frame.agg(F.count(F.lit(1))))


def rejects(spark: SparkSession) -> None:
    rows = mark(read_csv(spark, fixtures.contract_csv(spark, SF_DIR), BILLING), BILLING)
    run_all(rows.where(FAILED))


def query(name: str):
    return lambda spark: run_all(QUERIES[name](spark, SF_DIR))


BENCHES = {
    "csv_scan": query("csv_scan"),
    "csv_report": csv_report,
    "csv_valid": query("csv_valid"),
    "csv_invalid": rejects,
    "csv_ragged_rejected": query("csv_ragged_rejected"),
    "json_lines_scan": query("json_lines_scan"),
    "json_report": json_report,
    "json_report_one_pass_per_count": count_per_rule,
    "json_document_report": document_report,
    "json_document_gz_report": zipped_report,
    "json_document_blocks": query("json_document_blocks"),
    "null_profile": query("null_profile"),
    "rule_violations": query("rule_violations"),
    "invalid_sample": query("invalid_sample"),
    "load_valid_table": query("load_valid_table"),
    "quarantine_table": query("quarantine_table"),
    "load_both_tables": query("load_both_tables"),
    "load_tables_in_place": query("load_tables_in_place"),
}


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        measure(shared)


def measure(shared: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("schemagate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{shared}/files")
        .config("spark.sql.warehouse.dir", f"{shared}/tables")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, bench in BENCHES.items():
        bench(spark)
        took = []
        for _ in range(RUNS):
            drop_tables(spark)
            start = time.perf_counter()
            bench(spark)
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took), 3)
    counted = sum(s for n, s in seconds.items() if n != "json_report_one_pass_per_count")
    records = fixtures.flat(spark, SF_DIR).count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "validation_suite_total",
                "value": round(counted, 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {
                    n: round(records / seconds[n])
                    for n in ("csv_report", "json_report", "json_document_report")
                },
                "one_pass_speedup": round(
                    seconds["json_report_one_pass_per_count"] / seconds["json_report"], 2
                ),
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
