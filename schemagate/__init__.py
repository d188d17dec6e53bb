"""Schema validation, quarantine and quality profiles for incoming data on Spark."""

from schemagate.billing import BILLING, billing_rules
from schemagate.contract import Contract, Nest
from schemagate.plans import Validation, load_in_place, load_split, load_validated, validate_csv, validate_json

__all__ = [
    "BILLING",
    "Contract",
    "Nest",
    "Validation",
    "billing_rules",
    "load_in_place",
    "load_split",
    "load_validated",
    "validate_csv",
    "validate_json",
]
