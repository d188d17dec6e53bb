"""Validate a file set and load it, as one Spark job.

    spark-submit --py-files schemagate.zip schemagate/__main__.py csv /data/billing.csv \\
        --valid-table billing --invalid-table billing_rejects --report /data/report
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from schemagate.operators import invalid_sample, write_report
from schemagate.plans import Validation, lay_tables, load_tables, staged_report, validate_csv, validate_json
from schemagate.sources import preview
from schemagate.sources.documents import taken_apart


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="schemagate", description=__doc__.split("\n")[0])
    parser.add_argument("layout", choices=["csv", "lines", "document"])
    parser.add_argument("path", nargs="+")
    parser.add_argument("--valid-table", help="load valid rows into this table")
    parser.add_argument("--invalid-table", help="load rejects into this table")
    parser.add_argument(
        "--folder", help="write the valid rows here, once, and lay --valid-table over them"
    )
    parser.add_argument("--report", help="write the report here, as JSON")
    parser.add_argument("--cast-policy", choices=["compat", "strict"], default="compat")
    parser.add_argument("--message-style", choices=["compat", "clean"], default="compat")
    parser.add_argument("--ragged", choices=["permissive", "reject"], default="permissive")
    parser.add_argument("--strict-header", action="store_true")
    parser.add_argument("--multi-line", nargs="?", const=True, default=False, choices=["split"])
    parser.add_argument("--escape", default='"')
    parser.add_argument("--encoding", choices=["compat", "strict"], default="compat")
    return parser.parse_args(argv)


SAMPLE_COLUMNS = ("billing_account_id", "project")
"""Shown with the reason of a rejected CSV row."""


def run(spark: SparkSession, options: argparse.Namespace) -> dict:
    """One parse of the input, which counts for the report; sample and tables are taken from the staged rows."""
    if options.layout == "document":
        with taken_apart(spark, options.path) as lines:
            checked = validate_json(spark, lines, layout="cut", encoding=options.encoding, shown=",".join(options.path))
            return _finished(spark, checked, options, ())
    if options.layout == "lines":
        return _finished(spark, validate_json(spark, options.path, encoding=options.encoding), options, ())
    checked = validate_csv(
        spark,
        options.path,
        cast_policy=options.cast_policy,
        message_style=options.message_style,
        ragged=options.ragged,
        strict_header=options.strict_header,
        multi_line=options.multi_line,
        escape=options.escape,
    )
    return _finished(spark, checked, options, SAMPLE_COLUMNS)


def _finished(spark: SparkSession, checked: Validation, options: argparse.Namespace, columns: tuple[str, ...]) -> dict:
    with staged_report(checked, options.folder) as (rows, outcome):
        if options.report:
            write_report(outcome, options.report)
        found = outcome.first().asDict(recursive=True)
        sample = invalid_sample(rows, columns=columns) if columns else invalid_sample(rows)
        found["sample"] = [tuple(r) if columns else r[0] for r in sample.collect()]
        if options.folder:
            lay_tables(rows, options.folder, options.valid_table, options.invalid_table)
        else:
            load_tables(rows, options.valid_table, options.invalid_table)
    for name in ("valid_table", "invalid_table"):
        table = getattr(options, name)
        if table and spark.catalog.tableExists(table):
            found[f"{name}_preview"] = [r.asDict(recursive=True) for r in preview(spark, table).collect()]
    return found


def main() -> None:
    spark = SparkSession.builder.appName("schemagate").getOrCreate()
    for key, value in run(spark, arguments()).items():
        print(f"{key}: {value}")


if __name__ == "__main__":
    main()
