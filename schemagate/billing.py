"""The billing-export contract."""

from __future__ import annotations

from schemagate.contract import Contract, Nest
from schemagate.functions.rules import Rule, numeric_text, ordered, present, within_months

# Field names, types and order of the two layouts, the required and
# profiled fields, the reject texts, the rule texts and their bounds.
TARGET = {
    "billing_account_id": "string",
    "cost": "string",
    "currency": "string",
    "currency_conversion_rate": "decimal(38,10)",
    "export_time": "string",
    "invoice": {"month": "long", "publisher_type": "string"},
    "labels": [{"key": "string", "value": "string"}],
    "location": "string",
    "project": "string",
    "service": {"description": "string", "id": "string"},
    "sku": {"description": "string", "id": "string"},
    "usage": {
        "amount": "string",
        "amount_in_pricing_units": "double",
        "pricing_unit": "string",
        "unit": "string",
    },
    "usage_end_time": "string",
    "usage_start_time": "string",
}

FLAT = (
    "billing_account_id",
    "cost",
    "currency",
    "currency_conversion_rate",
    "export_time",
    "invoice_month",
    "invoice_publisher_type",
    "labels",
    "location",
    "project",
    "service_id",
    "service_description",
    "sku_id",
    "sku_description",
    "usage_amount",
    "usage_amount_in_pricing_units",
    "usage_pricing_unit",
    "usage_unit",
    "usage_end_time",
    "usage_start_time",
)

NESTS = {
    "invoice": Nest(
        {"month": "invoice_month", "publisher_type": "invoice_publisher_type"},
        gate=("invoice_month", "invoice_publisher_type"),
    ),
    "service": Nest(
        {"description": "service_description", "id": "service_id"},
        gate=("service_id", "service_description"),
    ),
    "sku": Nest(
        {"description": "sku_description", "id": "sku_id"},
        gate=("sku_id", "sku_description"),
    ),
    "usage": Nest(
        {
            "amount": "usage_amount",
            "amount_in_pricing_units": "usage_amount_in_pricing_units",
            "pricing_unit": "usage_pricing_unit",
            "unit": "usage_unit",
        },
        gate=("usage_amount",),
    ),
}

REQUIRED = ("billing_account_id", "cost", "invoice", "service", "sku", "usage")

MESSAGES = {
    "billing_account_id": "billing_account_id: null",
    "invoice": "invoice: reconstruction failed",
    "service": "service: reconstruction failed",
    "sku": "sku: reconstruction failed",
    "usage": "usage: reconstruction failed",
}

KEY_FIELDS = ("billing_account_id", "cost", "currency", "project", "service", "sku")

FIRST_MONTH, LAST_MONTH = 202201, 209912

RULE_MESSAGES = {
    "required": "{n} valid records with null billing_account_id",
    "numeric_cost": "{n} records with non-numeric cost",
    "time_order": "{n} records with end_time < start_time",
    "month_range": "{n} records with invalid invoice month",
}
# End of fixed values.

BILLING = Contract(
    target_layout=TARGET,
    flat_columns=FLAT,
    nests=NESTS,
    required=REQUIRED,
    messages=MESSAGES,
    unnamed={"cost": "cost: null"},
    key_fields=KEY_FIELDS,
)


def billing_rules(time_order: str = "string", month_check: str = "range") -> tuple[Rule, ...]:
    """The four business rules.

    ``time_order="timestamp"`` compares parsed times instead of their text;
    ``month_check="calendar"`` also wants a month number of 1 to 12.
    """
    checks = {
        "required": present("billing_account_id"),
        "numeric_cost": numeric_text("cost"),
        "time_order": ordered("usage_start_time", "usage_end_time", compare=time_order),
        "month_range": within_months(("invoice", "month"), FIRST_MONTH, LAST_MONTH, check=month_check),
    }
    return tuple(Rule(name, RULE_MESSAGES[name], check) for name, check in checks.items())
