"""Business rules as violation predicates: SQL text, true where a row breaks the rule,
and never null.
"""

from __future__ import annotations

from typing import NamedTuple

from schemagate.functions import sql

# Fixed value: what counts as a plain number.
PLAIN_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"


Field = str | tuple[str, ...]
"""A column, or the path to a struct's member."""


class Rule(NamedTuple):
    name: str
    message: str
    """Text for a count of violations, with ``{n}`` standing for the count."""
    violation: str


def present(field: Field) -> str:
    return f"{sql.name(field)} IS NULL"


def numeric_text(field: Field) -> str:
    column = sql.name(field)
    return f"{column} IS NOT NULL AND NOT {column} RLIKE {sql.text(PLAIN_NUMBER)}"


def ordered(first: Field, last: Field, compare: str = "string") -> str:
    """``first`` must not come after ``last``; rows missing either are left alone."""
    if compare not in ("string", "timestamp"):
        raise ValueError(f"compare must be 'string' or 'timestamp', not {compare!r}")
    a, b = sql.name(first), sql.name(last)
    if compare == "timestamp":
        a, b = f"try_to_timestamp({a})", f"try_to_timestamp({b})"
    return f"coalesce({a} > {b}, false)"


def within_months(field: Field, low: int, high: int, check: str = "range") -> str:
    """A ``yyyymm`` number must lie in a range, and for ``calendar`` be a real month."""
    if check not in ("range", "calendar"):
        raise ValueError(f"check must be 'range' or 'calendar', not {check!r}")
    month = sql.name(field)
    good = f"{month} BETWEEN {low} AND {high}"
    if check == "calendar":
        good += f" AND {month} % 100 BETWEEN 1 AND 12"
    return f"coalesce(NOT ({good}), false)"
