"""Reject messages and the text tests run over rejected records, as SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from schemagate.functions import sql

# Separator of the message parts, sample width and its mark, and the
# two patterns looked for in rejected text.
SEPARATOR = ", "
SAMPLE_WIDTH = 200
CUT_MARK = "..."
STRUCTURE_PATTERN = r"[{}\[\]]"
ENCODING_PATTERN = r"[\\u]"

# A written-out unicode escape, or the replacement character left by a bad decode.
STRICT_ENCODING_PATTERN = r"\\u[0-9a-fA-F]{4}|\x{FFFD}"


def slots(parts: Mapping[str, str], blanks: bool) -> list[str]:
    """Each text where its test holds, else null, or an empty text with ``blanks``."""
    otherwise = " ELSE ''" if blanks else ""
    return [f"CASE WHEN {test} THEN {sql.text(t)}{otherwise} END" for t, test in parts.items()]


def joined(texts: Iterable[str]) -> str:
    """Joins what is not null; empty texts keep their place."""
    return f"concat_ws({', '.join([sql.text(SEPARATOR), *texts])})"


def shortened(column: str, width: int = SAMPLE_WIDTH) -> str:
    c = sql.name(column)
    cut = f"concat(substring({c}, 1, {width}), {sql.text(CUT_MARK)})"
    return f"CASE WHEN length({c}) > {width} THEN {cut} ELSE {c} END"


def reject_patterns(column: str, encoding: str = "compat") -> dict[str, str]:
    """``compat`` flags any backslash or letter u; ``strict`` wants a real escape."""
    if encoding not in ("compat", "strict"):
        raise ValueError(f"encoding must be 'compat' or 'strict', not {encoding!r}")
    wanted = ENCODING_PATTERN if encoding == "compat" else STRICT_ENCODING_PATTERN
    return {
        "structure": f"{sql.name(column)} RLIKE {sql.text(STRUCTURE_PATTERN)}",
        "encoding": f"{sql.name(column)} RLIKE {sql.text(wanted)}",
    }
