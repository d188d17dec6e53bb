"""Counts over a marked frame.

Every function is one global aggregate over one scan: tasks send one partial row each,
and the reshaping afterwards works on a single row.  ``report`` takes all counts at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from schemagate.contract import CORRUPT, FAILED, Contract
from schemagate.functions import sql
from schemagate.functions.messages import reject_patterns
from schemagate.functions.rules import Rule
from schemagate.operators.verdicts import status_of

COUNTS = (
    "count(1) AS total_records",
    f"count_if(NOT {FAILED}) AS valid_records",
    f"count_if({FAILED}) AS invalid_records",
)
SHARES = (
    f"{sql.percent('valid_records', 'total_records')} AS valid_pct",
    f"{sql.percent('invalid_records', 'total_records')} AS invalid_pct",
)


def _null_counts(fields: Iterable[str]) -> list[str]:
    return [
        f"count_if(NOT {FAILED} AND {sql.name(f)} IS NULL) AS {sql.name('null_' + f)}" for f in fields
    ]


def _rule_counts(rules: Iterable[Rule]) -> list[str]:
    return [
        f"count_if(NOT {FAILED} AND ({r.violation})) AS {sql.name('rule_' + r.name)}" for r in rules
    ]


def _pattern_counts(patterns: Mapping[str, str]) -> list[str]:
    return [f"count_if({FAILED} AND {test}) AS {sql.name(n)}" for n, test in patterns.items()]


def _null_stats(field: str) -> str:
    n = sql.name("null_" + field)
    return f"{n} AS null_count, {sql.percent(n, 'valid_records')} AS null_percentage"


def _violation_rows(rules: Iterable[Rule]) -> str:
    rows = []
    for rule in rules:
        n = sql.name("rule_" + rule.name)
        before, after = map(sql.text, rule.message.split("{n}"))
        message = f"concat({before}, CAST({n} AS STRING), {after})"
        rows.append(f"struct({sql.text(rule.name)} AS rule, {n} AS violations, {message} AS message)")
    return f"filter(array({', '.join(rows)}), row -> row.violations > 0)"


def summary(marked: DataFrame) -> DataFrame:
    """One row: total, valid and invalid records and their shares."""
    return marked.selectExpr(*COUNTS).selectExpr("*", *SHARES)


def null_profile(marked: DataFrame, contract: Contract) -> DataFrame:
    """One row per key field: nulls among the valid rows."""
    fields = contract.key_fields
    counts = marked.selectExpr(f"count_if(NOT {FAILED}) AS valid_records", *_null_counts(fields))
    rows = ", ".join(f"struct({sql.text(f)} AS field, {_null_stats(f)})" for f in fields)
    return counts.selectExpr(f"inline(array({rows}))")


def rule_violations(marked: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule that some valid row breaks."""
    rules = tuple(rules)
    return marked.selectExpr(*_rule_counts(rules)).selectExpr(f"inline({_violation_rows(rules)})")


def pattern_counts(marked: DataFrame, encoding: str = "compat") -> DataFrame:
    """One row: rejects in total, and how many show each text pattern."""
    return marked.selectExpr(
        f"count_if({FAILED}) AS invalid_records",
        *_pattern_counts(reject_patterns(CORRUPT, encoding)),
    )


class ReportPlan(NamedTuple):
    """A report as counts over marked rows, and its columns over these counts."""

    counts: tuple[str, ...]
    columns: tuple[str, ...]

    def over(self, marked: DataFrame) -> DataFrame:
        """The report from one pass over ``marked``."""
        return marked.selectExpr(*self.counts).selectExpr(*self.columns)

    def observed(self, marked: DataFrame) -> tuple[DataFrame, Observation]:
        """``marked`` with the counts taken as its rows pass by, in whatever job they are used first.

        Spark adds a task's counts once it has succeeded, so tasks that are run again don't
        count twice, as long as no exchange comes after this in the job.
        """
        seen = Observation()
        return marked.observe(seen, *map(F.expr, self.counts)), seen

    def of_counts(self, spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
        """The report from counts that were taken before, by name."""
        schema = ", ".join(f"{sql.name(n)} BIGINT" for n in counts)
        return spark.createDataFrame([tuple(counts.values())], schema).selectExpr(*self.columns)


def report(marked: DataFrame, contract: Contract, **settings) -> DataFrame:
    """The whole validation record as one row, from one pass; settings as of ``report_plan``."""
    return report_plan(contract, **settings).over(marked)


def report_plan(
    contract: Contract,
    *,
    file_path: str,
    method: str | None = None,
    rules: Iterable[Rule] = (),
    patterns: Mapping[str, str] | None = None,
) -> ReportPlan:
    """What the report of marked rows counts and says.

    Without rules the verdict has no violations to weigh, and the profile columns stay out.
    """
    rules, patterns = tuple(rules), dict(patterns or {})
    counts = [*COUNTS, *_pattern_counts(patterns)]
    columns = ["total_records", "valid_records", "invalid_records", *SHARES]
    problems = "0"
    if rules:
        counts += _null_counts(contract.key_fields) + _rule_counts(rules)
        problems = f"size({_violation_rows(rules)})"
        stats = [f"struct({_null_stats(f)}) AS {sql.name(f)}" for f in contract.key_fields]
        columns += [
            f"struct({', '.join(stats)}) AS null_value_stats",
            f"transform({_violation_rows(rules)}, row -> row.message) AS business_rule_violations",
        ]
    if patterns:
        columns.append(f"struct({', '.join(map(sql.name, patterns))}) AS reject_patterns")
    columns += [
        f"{status_of('invalid_records', problems, partial=method is None)} AS status",
        "date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss') AS validation_timestamp",
    ]
    if method:
        columns += [
            f"{sql.text(method)} AS validation_method",
            # Errors end the job, so a report never has any to show.
            "CAST(array() AS ARRAY<STRING>) AS reconstruction_errors",
        ]
    columns.append(f"{sql.text(file_path)} AS file_path")
    return ReportPlan(tuple(counts), tuple(columns))
