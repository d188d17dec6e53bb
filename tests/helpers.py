from schemagate.billing import FLAT


def write_file(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def quoted(value):
    return "" if value is None else '"' + value.replace('"', '""') + '"'


GOOD = {
    "billing_account_id": "BA-1",
    "cost": "10.50",
    "currency": "USD",
    "currency_conversion_rate": "0.92",
    "export_time": "2024-01-01 00:00:00",
    "invoice_month": "202401",
    "invoice_publisher_type": "DIRECT",
    "labels": '[{"key":"k","value":"v"}]',
    "location": "us-east1",
    "project": "p",
    "service_id": "s1",
    "service_description": "Service",
    "sku_id": "k1",
    "sku_description": "Sku",
    "usage_amount": "3",
    "usage_amount_in_pricing_units": "2.5",
    "usage_pricing_unit": "hour",
    "usage_unit": "seconds",
    "usage_end_time": "2024-01-01 01:00:00",
    "usage_start_time": "2024-01-01 00:00:00",
}


def flat_row(**changes):
    return {**GOOD, **changes}


def flat_frame(spark, *rows):
    schema = ", ".join(f"{c} STRING" for c in FLAT)
    return spark.createDataFrame([tuple(r[c] for c in FLAT) for r in rows], schema)


def csv_text(*rows, header=FLAT):
    lines = [",".join(header)]
    lines += [",".join(quoted(r[c]) for c in FLAT) for r in rows]
    return "\n".join(lines) + "\n"
