"""Small pieces of SQL text.

Expressions made from a contract are written as SQL and handed to Spark whole: built
call by call, a wide contract costs seconds of driver time before any job starts.
"""

from __future__ import annotations

from collections.abc import Iterable


def name(column: str | tuple[str, ...]) -> str:
    """A column, or the path to a struct's member, quoted; dots in names stay part of them."""
    parts = (column,) if isinstance(column, str) else column
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def text(value: str) -> str:
    """A text as a constant that reads the same under every parser setting."""
    if "\\" in value or "'" in value:
        return f"decode(unhex('{value.encode().hex()}'), 'UTF-8')"
    return f"'{value}'"


def every(tests: Iterable[str]) -> str:
    return " AND ".join(f"({t})" for t in tests)


def some(tests: Iterable[str]) -> str:
    return " OR ".join(f"({t})" for t in tests)


def percent(part: str, whole: str) -> str:
    """Share in percent to two places; zero of zero is zero."""
    return f"coalesce(round(try_divide({part}, {whole}) * 100, 2), 0.0D)"
