"""From counts to a verdict."""

from __future__ import annotations

from schemagate.functions import sql

# The verdicts.
PASSED = "VALIDATION PASSED"
WARNINGS = "VALIDATION PASSED WITH WARNINGS"
PARTIAL = "VALIDATION PARTIAL"
ISSUES = "VALIDATION ISSUES"


def status_of(invalid: str, problems: str, *, partial: bool) -> str:
    """SQL text for the verdict on two counts.

    ``partial`` tells rejects alone (PARTIAL) from rejects with problems (ISSUES).
    Without it, any reject gives ISSUES.
    """
    rejects_alone = PARTIAL if partial else ISSUES
    return f"""CASE
      WHEN {invalid} = 0 AND {problems} = 0 THEN {sql.text(PASSED)}
      WHEN {invalid} = 0 THEN {sql.text(WARNINGS)}
      WHEN {problems} = 0 THEN {sql.text(rejects_alone)}
      ELSE {sql.text(ISSUES)} END"""
