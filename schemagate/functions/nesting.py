"""Rebuilding typed, nested fields from flat text columns, as SQL text.

Parsing casts are ``try_cast`` throughout: with ANSI mode on, a plain cast of bad
text would end the job instead of yielding null.
"""

from __future__ import annotations

from pyspark.sql import types as T

from schemagate.contract import Contract, Nest
from schemagate.functions import sql

# Fixed value: label texts that stand for "no labels".
NO_ARRAY = ("", "[]")


def typed(column: str, data_type: T.DataType) -> str:
    source = sql.name(column)
    if isinstance(data_type, T.StringType):
        return source
    return f"try_cast({source} AS {data_type.simpleString()})"


def cast_failed(column: str, data_type: T.DataType) -> str:
    """Text is there but does not read as ``data_type``."""
    return f"{sql.name(column)} IS NOT NULL AND {typed(column, data_type)} IS NULL"


def gate_open(nest: Nest) -> str:
    return sql.every(f"{sql.name(c)} IS NOT NULL" for c in nest.gate)


def nest_struct(nest: Nest, data_type: T.StructType) -> str:
    members = ", ".join(
        f"{typed(nest.members[f.name], f.dataType)} AS {sql.name(f.name)}" for f in data_type.fields
    )
    return f"CASE WHEN {gate_open(nest)} THEN struct({members}) END"


def holds_array(column: str) -> str:
    nothing = ", ".join(sql.text(t) for t in NO_ARRAY)
    return f"{sql.name(column)} IS NOT NULL AND {sql.name(column)} NOT IN ({nothing})"


def parse_json_array(column: str, data_type: T.ArrayType) -> str:
    """JSON text to an array; absent, empty and unreadable text all give null."""
    parsed = f"from_json({sql.name(column)}, {sql.text(data_type.simpleString())})"
    return f"CASE WHEN {holds_array(column)} THEN {parsed} END"


def target_column(contract: Contract, field: str) -> str:
    """The expression that yields target field ``field`` from the flat columns."""
    data_type = contract.target[field].dataType
    if field in contract.nests:
        built = nest_struct(contract.nests[field], data_type)
    elif isinstance(data_type, T.ArrayType):
        built = parse_json_array(field, data_type)
    else:
        built = typed(field, data_type)
    return f"{built} AS {sql.name(field)}"


def absent(contract: Contract, field: str) -> str:
    """True where the rebuilt field would be null.

    Stated on the flat columns rather than on the rebuilt struct, so a filter on it
    reaches the scan and never builds the struct.
    """
    if field in contract.nests:
        return f"NOT ({gate_open(contract.nests[field])})"
    return f"{sql.name(field)} IS NULL"


def checked_casts(contract: Contract) -> dict[str, str]:
    """Failed-cast test per parsed leaf, keyed by its path in the target."""
    tests: dict[str, str] = {}
    for f in contract.target.fields:
        if f.name in contract.nests:
            for member in f.dataType.fields:
                if not isinstance(member.dataType, T.StringType):
                    source = contract.nests[f.name].members[member.name]
                    tests[f"{f.name}.{member.name}"] = cast_failed(source, member.dataType)
        elif isinstance(f.dataType, T.ArrayType):
            tests[f.name] = (
                f"{holds_array(f.name)} AND ({parse_json_array(f.name, f.dataType)}) IS NULL"
            )
        elif not isinstance(f.dataType, T.StringType):
            tests[f.name] = cast_failed(f.name, f.dataType)
    return tests
