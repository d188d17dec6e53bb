from schemagate.plans.loading import (
    Loaded,
    lay_tables,
    load_in_place,
    load_split,
    load_tables,
    load_validated,
    staged,
    staged_report,
)
from schemagate.plans.validation import Validation, validate_csv, validate_json

__all__ = [
    "Loaded",
    "Validation",
    "lay_tables",
    "load_in_place",
    "load_split",
    "load_tables",
    "load_validated",
    "staged",
    "staged_report",
    "validate_csv",
    "validate_json",
]
