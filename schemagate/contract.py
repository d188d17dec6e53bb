"""What a validated layout looks like, held as plain data.

A :class:`Contract` names the nested target, the flat landing columns it is
rebuilt from, and which fields must be present.  Everything else in the package
is generic over it; ``schemagate.billing`` is the one instance shipped.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FAILED = "_validation_failed"
ROW_ID = "_row_id"

Layout = Mapping[str, object]


def as_type(spec: object) -> T.DataType:
    """``"long"`` -> LongType, ``{...}`` -> struct, ``[spec]`` -> array."""
    if isinstance(spec, Mapping):
        return as_struct(spec)
    if isinstance(spec, list):
        return T.ArrayType(as_type(spec[0]))
    return T.StructType().add("x", spec)["x"].dataType


def as_struct(layout: Layout) -> T.StructType:
    return T.StructType([T.StructField(name, as_type(spec)) for name, spec in layout.items()])


@dataclass(frozen=True)
class Nest:
    """One struct rebuilt from flat columns; null unless every ``gate`` column is set."""

    members: Mapping[str, str]
    gate: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    target_layout: Layout
    flat_columns: tuple[str, ...]
    nests: Mapping[str, Nest]
    required: tuple[str, ...]
    """Fields whose absence rejects a flat row."""
    messages: Mapping[str, str]
    """Reject text per required field, in message order."""
    unnamed: Mapping[str, str] = field(default_factory=dict)
    """Reject texts only the ``clean`` message style knows, per required field."""
    key_fields: tuple[str, ...] = ()
    """Fields whose null rate is profiled."""

    @cached_property
    def target(self) -> T.StructType:
        return as_struct(self.target_layout)

    @cached_property
    def target_with_corrupt(self) -> T.StructType:
        return as_struct({**self.target_layout, CORRUPT: "string"})

    def flat(self, carry: tuple[str, ...] = ()) -> T.StructType:
        """All-string landing schema; ``carry`` columns lead the contract's own."""
        return T.StructType([T.StructField(c, T.StringType()) for c in (*carry, *self.flat_columns)])
