from schemagate.operators.marking import invalid_rows, mark, mark_corrupt, rebuild, valid_rows
from schemagate.operators.profile import (
    null_profile,
    pattern_counts,
    report,
    rule_violations,
    summary,
)
from schemagate.operators.sampling import invalid_sample
from schemagate.operators.sinks import load_valid, quarantine, write_report

__all__ = [
    "invalid_rows",
    "invalid_sample",
    "load_valid",
    "mark",
    "mark_corrupt",
    "null_profile",
    "pattern_counts",
    "quarantine",
    "rebuild",
    "report",
    "rule_violations",
    "summary",
    "valid_rows",
    "write_report",
]
