"""Every registered query against its SQL counterpart, over whole tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from schemagate.storage import setting
from schemagate.suite.oracles import ORACLES
from schemagate.suite.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return format(value, "f")
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(comparable(row[i]) for i in order) for row in rows), key=lambda r: repr(r)
    )


KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "decimal(38,10)": "DECIMAL(38,10)",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    kinds = {c: KINDS[t] for c, t in got.dtypes}
    assert kinds == dict(zip(want.columns, map(str, want.types)))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) > 0
    assert canonical(got.columns, rows) == canonical(want.columns, want.fetchall())


def test_all_have_sql_and_are_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("pair", [("rule_time_order", "strict_time_order"), ("rule_month_range", "strict_month"), ("pattern_counts", "pattern_counts_strict")])
def test_switches_change_the_answer(duck, pair):
    first, second = (duck.sql(ORACLES[name]).fetchall() for name in pair)
    assert sorted(map(repr, first)) != sorted(map(repr, second)) and len(second) > 0


@pytest.mark.parametrize("name", ["rule_numeric_cost", "pattern_counts", "pattern_counts_strict", "csv_invalid", "parse_labels"])
def test_parser_settings_change_nothing(spark, duck, name):
    with setting(spark, "spark.sql.parser.escapedStringLiterals", "true"):
        rows = [tuple(r) for r in QUERIES[name](spark, SF).collect()]
        columns = QUERIES[name](spark, SF).columns
    want = duck.sql(ORACLES[name])
    assert canonical(columns, rows) == canonical(want.columns, want.fetchall())


def test_entry(spark):
    row = driver.entry(spark).first()
    assert row.total_records == row.valid_records + row.invalid_records == 1500
