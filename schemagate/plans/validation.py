"""Read, judge and summarise, for both input layouts.  Nothing runs until asked for,
except that JSON documents are first turned into lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from schemagate.billing import BILLING, billing_rules
from schemagate.contract import CORRUPT, Contract
from schemagate.functions.messages import reject_patterns
from schemagate.functions.rules import Rule
from schemagate.operators.marking import invalid_rows, mark, mark_corrupt, valid_rows
from schemagate.operators.profile import ReportPlan, report_plan
from schemagate.sources.csv_files import read_csv
from schemagate.sources.json_files import read_json

# Fixed value: how the CSV report names its method.
CSV_METHOD = "implicit_spark_casting"


@dataclass(frozen=True)
class Validation:
    marked: DataFrame
    """All rows with their verdict."""
    valid: DataFrame
    invalid: DataFrame
    report_plan: ReportPlan
    """What the report counts and says."""

    def report_on(self, rows: DataFrame) -> DataFrame:
        """The report over ``marked`` or a stored copy of it."""
        return self.report_plan.over(rows)

    @property
    def report(self) -> DataFrame:
        """One row of counts and verdict, from one pass over the input."""
        return self.report_on(self.marked)


def validate_csv(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract = BILLING,
    *,
    carry: tuple[str, ...] = (),
    cast_policy: str = "compat",
    message_style: str = "compat",
    ragged: str = "permissive",
    strict_header: bool = False,
    multi_line: bool = False,
    escape: str = '"',
    row_id: bool = False,
) -> Validation:
    landed = read_csv(
        spark,
        path,
        contract,
        carry=carry,
        ragged=ragged,
        strict_header=strict_header,
        multi_line=multi_line,
        escape=escape,
    )
    marked = mark(
        landed, contract, carry=carry, cast_policy=cast_policy, message_style=message_style, row_id=row_id
    )
    return Validation(
        marked,
        valid_rows(marked),
        invalid_rows(marked),
        report_plan(contract, file_path=_shown(path), method=CSV_METHOD),
    )


def validate_json(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract = BILLING,
    *,
    layout: str = "lines",
    lines_path: str | None = None,
    rules: tuple[Rule, ...] | None = None,
    encoding: str = "compat",
    shown: str | None = None,
) -> Validation:
    """``shown`` is the path that the report names.  ``rules`` are weighed in the report; pass ``()`` to leave the quality profile out."""
    parsed = read_json(
        spark,
        path,
        contract,
        layout=layout,
        lines_path=lines_path,
    )
    marked = mark_corrupt(parsed)
    return Validation(
        marked,
        valid_rows(marked, placeholder=False),
        invalid_rows(marked),
        report_plan(
            contract,
            file_path=shown or _shown(path),
            rules=billing_rules() if rules is None else rules,
            patterns=reject_patterns(CORRUPT, encoding),
        ),
    )


def _shown(path: str | list[str]) -> str:
    return path if isinstance(path, str) else ",".join(path)
