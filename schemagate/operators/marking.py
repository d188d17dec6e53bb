"""Marking rows as failed or not, and splitting on the mark.

All of it is narrow: one projection per scan, no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemagate.contract import CORRUPT, FAILED, ROW_ID, Contract
from schemagate.functions import sql
from schemagate.functions.messages import joined, slots
from schemagate.functions.nesting import absent, checked_casts, target_column


def rebuild(landed: DataFrame, contract: Contract, carry: tuple[str, ...] = ()) -> DataFrame:
    """Flat columns to the target's fields, in the target's order."""
    return landed.selectExpr(*map(sql.name, carry), *_target(contract))


def _target(contract: Contract) -> list[str]:
    return [target_column(contract, field) for field in contract.target.names]


def mark(
    landed: DataFrame,
    contract: Contract,
    *,
    carry: tuple[str, ...] = (),
    cast_policy: str = "compat",
    message_style: str = "compat",
    row_id: bool = False,
) -> DataFrame:
    """Rebuild flat rows and say which of them fail, and why.

    Adds ``_corrupt_record`` (the reason, null on good rows) and ``_validation_failed``.
    A row fails when a required field comes out null; with ``cast_policy="strict"``
    also when a text does not read as its field's type.  A landing ``_corrupt_record``
    (a ragged line) fails the row too and is kept as the reason.  ``message_style``
    ``"compat"`` leaves an empty slot for each field that is fine and has no text for
    some fields; ``"clean"`` lists only what is wrong.
    """
    if cast_policy not in ("compat", "strict"):
        raise ValueError(f"cast_policy must be 'compat' or 'strict', not {cast_policy!r}")
    if message_style not in ("compat", "clean"):
        raise ValueError(f"message_style must be 'compat' or 'clean', not {message_style!r}")

    missing = {name: absent(contract, name) for name in contract.required}
    texts = dict(contract.messages)
    if message_style == "clean":
        texts.update(contract.unnamed)
    reasons = slots(
        {texts[name]: test for name, test in missing.items() if name in texts},
        blanks=message_style == "compat",
    )
    tests = list(missing.values())
    if cast_policy == "strict":
        casts = checked_casts(contract)
        reasons += slots({f"{leaf}: cast failed": test for leaf, test in casts.items()}, blanks=False)
        tests += casts.values()

    reason = f"CASE WHEN {sql.some(tests)} THEN {joined(reasons)} END"
    if CORRUPT in landed.columns:
        tests.append(f"{CORRUPT} IS NOT NULL")
        reason = f"coalesce({CORRUPT}, {reason})"

    return landed.selectExpr(
        *map(sql.name, carry),
        *_target(contract),
        f"{reason} AS {CORRUPT}",
        f"{sql.some(tests)} AS {FAILED}",
        *([f"monotonically_increasing_id() AS {ROW_ID}"] if row_id else []),
    )


def mark_corrupt(parsed: DataFrame) -> DataFrame:
    """Mark parsed JSON: a record fails when its raw text was kept as corrupt."""
    return parsed.withColumn(FAILED, F.col(CORRUPT).isNotNull())


def valid_rows(marked: DataFrame, *, placeholder: bool = True) -> DataFrame:
    """Rows that passed; ``placeholder`` keeps an all-null ``_corrupt_record`` column."""
    rows = marked.where(~F.col(FAILED)).drop(FAILED, ROW_ID, CORRUPT)
    return rows.withColumn(CORRUPT, F.lit(None).cast("string")) if placeholder else rows


def invalid_rows(marked: DataFrame) -> DataFrame:
    return marked.where(FAILED).drop(FAILED, ROW_ID)
