"""Flat rows: casts, labels, marks, messages, CSV dialect."""

from decimal import Decimal

import pytest
from helpers import GOOD, csv_text, flat_frame, flat_row, write_file
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemagate.billing import BILLING, FLAT, billing_rules
from schemagate.contract import CORRUPT, FAILED, ROW_ID, Contract
from schemagate.functions.messages import reject_patterns, shortened
from schemagate.functions.nesting import target_column, typed
from schemagate.operators import invalid_rows, mark, rebuild, rule_violations, summary, valid_rows
from schemagate.plans import validate_csv
from schemagate.sources import read_csv

LONG, DOUBLE, DECIMAL = T.LongType(), T.DoubleType(), T.DecimalType(38, 10)


@pytest.mark.parametrize(
    "text, as_long, as_double, as_decimal",
    [
        ("202401", 202401, 202401.0, Decimal("202401")),
        (" 202401 ", 202401, 202401.0, Decimal("202401")),
        ("+5", 5, 5.0, Decimal("5")),
        ("202401.5", None, 202401.5, Decimal("202401.5")),
        ("1.23456789012345", None, 1.23456789012345, Decimal("1.2345678901")),
        ("1e3", None, 1000.0, Decimal("1000")),
        ("1e40", None, 1e40, None),
        ("Infinity", None, float("inf"), None),
        ("1d", None, 1.0, None),
        ("1,000", None, None, None),
        ("0x1F", None, None, None),
        ("abc", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
    ],
)
def test_text_to_number(spark, text, as_long, as_double, as_decimal):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.selectExpr(typed("t", LONG), typed("t", DOUBLE), typed("t", DECIMAL)).first()
    assert tuple(row) == (as_long, as_double, as_decimal)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"key":"k","value":"v"}]', [("k", "v")]),
        ('[{"key":"k"}]', [("k", None)]),
        ('{"key":"k","value":"v"}', [("k", "v")]),
        ('[{"key":1,"value":{"a":2}}]', [("1", '{"a":2}')]),
        ('[{"zzz":1}]', [(None, None)]),
        ("[null]", [None]),
        ("[]", None),
        ("", None),
        (" ", None),
        (None, None),
        ("null", None),
        ("not json", None),
        ("[1,2]", None),
        ('[{"key":"k"', None),
        ('[{"key":"k"},3]', None),
        ('"str"', None),
    ],
)
def test_labels(spark, text, expected):
    df = flat_frame(spark, flat_row(labels=text)).selectExpr(target_column(BILLING, "labels"))
    got = df.first()[0]
    assert (None if got is None else [None if e is None else tuple(e) for e in got]) == expected


def test_good_row_is_rebuilt(spark):
    row = mark(flat_frame(spark, GOOD), BILLING).first().asDict(recursive=True)
    assert row["invoice"] == {"month": 202401, "publisher_type": "DIRECT"}
    assert row["service"] == {"description": "Service", "id": "s1"}
    assert row["usage"]["amount_in_pricing_units"] == 2.5
    assert row[CORRUPT] is None and row[FAILED] is False


def test_columns_come_in_target_order(spark):
    rebuilt = rebuild(flat_frame(spark, GOOD), BILLING)
    assert rebuilt.schema == BILLING.target
    marked = mark(flat_frame(spark, GOOD), BILLING, row_id=True)
    assert marked.columns == [*BILLING.target.names, CORRUPT, FAILED, ROW_ID]
    assert valid_rows(marked).columns == [*BILLING.target.names, CORRUPT]
    assert invalid_rows(marked).columns == [*BILLING.target.names, CORRUPT]


@pytest.mark.parametrize(
    "column, failed",
    [(c, c in {
        "billing_account_id", "cost", "invoice_month", "invoice_publisher_type", "service_id",
        "service_description", "sku_id", "sku_description", "usage_amount",
    }) for c in FLAT],
)
def test_which_nulls_fail(spark, column, failed):
    row = mark(flat_frame(spark, flat_row(**{column: None})), BILLING).first()
    assert row[FAILED] is failed


def test_bad_casts_pass_unless_strict(spark):
    bad = flat_row(invoice_month="x", currency_conversion_rate="y", labels="z")
    df = flat_frame(spark, bad)
    compat = mark(df, BILLING).first()
    assert compat[FAILED] is False and compat.invoice.month is None
    strict = mark(df, BILLING, cast_policy="strict", message_style="clean").first()
    assert strict[FAILED] is True
    assert strict[CORRUPT] == (
        "currency_conversion_rate: cast failed, invoice.month: cast failed, labels: cast failed"
    )


def test_messages(spark):
    df = flat_frame(spark, flat_row(cost=None), flat_row(sku_id=None, billing_account_id=None))
    compat = [r[CORRUPT] for r in mark(df, BILLING).collect()]
    clean = [r[CORRUPT] for r in mark(df, BILLING, message_style="clean").collect()]
    assert compat == [
        ", , , , ",
        "billing_account_id: null, , , sku: reconstruction failed, ",
    ]
    assert clean == ["cost: null", "billing_account_id: null, sku: reconstruction failed"]


@pytest.mark.parametrize("switch", ["cast_policy", "message_style"])
def test_unknown_switch_is_refused(spark, switch):
    with pytest.raises(ValueError):
        mark(flat_frame(spark, GOOD), BILLING, **{switch: "other"})


@pytest.mark.parametrize(
    "cost, breaks",
    [
        ("10", False), ("-1.5", False), ("1\n", False), (None, False),
        ("1e-5", True), ("+3", True), (".5", True), ("1.", True), ("", True), ("n/a", True),
    ],
)
def test_numeric_cost(spark, cost, breaks):
    rule = billing_rules()[1]
    df = spark.createDataFrame([(cost,)], "cost string")
    assert df.selectExpr(rule.violation).first()[0] is breaks


@pytest.mark.parametrize(
    "start, end, as_text, as_time",
    [
        ("2024-01-02 00:00:00", "2024-01-01 00:00:00", True, True),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:00", False, False),
        ("2024-9-01", "2024-10-01", True, False),
        (None, "2024-01-01", False, False),
        ("x", "2024-01-01", True, False),
    ],
)
def test_time_order(spark, start, end, as_text, as_time):
    df = spark.createDataFrame([(start, end)], "usage_start_time string, usage_end_time string")
    text, time = billing_rules()[2], billing_rules(time_order="timestamp")[2]
    assert tuple(df.selectExpr(text.violation, time.violation).first()) == (as_text, as_time)


@pytest.mark.parametrize(
    "month, in_range, in_calendar",
    [
        (202201, False, False), (209912, False, False), (202213, False, True),
        (202200, True, True), (209913, True, True), (None, False, False),
    ],
)
def test_month(spark, month, in_range, in_calendar):
    df = spark.createDataFrame([((month,),)], "invoice struct<month: bigint>")
    plain, calendar = billing_rules()[3], billing_rules(month_check="calendar")[3]
    assert tuple(df.selectExpr(plain.violation, calendar.violation).first()) == (in_range, in_calendar)


def test_patterns_and_shortening(spark):
    texts = ["menu", "a\\b", '{"x"', "plain", "\\u00e9", "x" * 201, "x" * 200]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    compat, strict = reject_patterns("t"), reject_patterns("t", "strict")
    rows = df.selectExpr(
        compat["structure"], compat["encoding"], strict["encoding"], shortened("t")
    ).collect()
    assert [r[0] for r in rows] == [False, False, True, False, False, False, False]
    assert [r[1] for r in rows] == [True, True, False, False, True, False, False]
    assert [r[2] for r in rows] == [False, False, False, False, True, False, False]
    assert [r[3] for r in rows] == [*texts[:5], "x" * 200 + "...", "x" * 200]


def test_csv_round_trip(spark, tmp_path):
    rows = [GOOD, flat_row(labels=None, project=""), flat_row(project='say "hi", ok', cost=" 1 ")]
    path = write_file(tmp_path / "in", "a.csv", csv_text(*rows))
    got = [r.asDict() for r in read_csv(spark, path, BILLING).collect()]
    # An empty text and no text at all cannot be told apart in CSV.
    assert got == [GOOD, flat_row(labels=None, project=None), rows[2]]


def test_csv_header_binds_by_position(spark, tmp_path):
    swapped = (FLAT[1], FLAT[0], *FLAT[2:])
    path = write_file(tmp_path / "in", "a.csv", csv_text(GOOD, header=swapped))
    assert read_csv(spark, path, BILLING).first().billing_account_id == "BA-1"
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path, BILLING, strict_header=True).collect()


def test_csv_backslash_dialect(spark, tmp_path):
    line = ",".join('"' + (v.replace('"', '\\"')) + '"' for v in GOOD.values())
    path = write_file(tmp_path / "in", "a.csv", ",".join(FLAT) + "\n" + line + "\n")
    assert read_csv(spark, path, BILLING, escape="\\").first().labels == GOOD["labels"]


def test_csv_blank_lines_and_line_breaks(spark, tmp_path):
    text = csv_text(GOOD, flat_row(project="two\nlines"))
    path = write_file(tmp_path / "in", "a.csv", text.replace("\n", "\n\n", 1))
    assert [r.project for r in read_csv(spark, path, BILLING, multi_line=True).collect()] == [
        "p", "two\nlines",
    ]
    assert read_csv(spark, path, BILLING).count() == 3


@pytest.mark.parametrize("columns", [FLAT, ("project",)])
def test_ragged_rows(spark, tmp_path, columns):
    short = ",".join(["a"] * 19)
    long = ",".join(["b"] * 21)
    path = write_file(tmp_path / "in", "a.csv", csv_text(GOOD) + short + "\n" + long + "\n")
    padded = read_csv(spark, path, BILLING).select(*columns).collect()
    assert len(padded) == 3
    rejecting = read_csv(spark, path, BILLING, ragged="reject")
    good = rejecting.where(F.col(CORRUPT).isNull()).select(*columns).collect()
    assert len(good) == 1
    bad = rejecting.where(F.col(CORRUPT).isNotNull()).select(CORRUPT).collect()
    assert sorted(r[0] for r in bad) == sorted([short, long])
    checked = validate_csv(spark, path, ragged="reject")
    assert checked.valid.count() == 1
    assert sorted(r[0] for r in checked.invalid.select(CORRUPT).collect()) == sorted([short, long])


def test_ragged_reject_drops_one_header_per_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        write_file(tmp_path / "in", name, csv_text(GOOD, GOOD))
    assert read_csv(spark, str(tmp_path / "in"), BILLING, ragged="reject").count() == 4


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "nothing"), BILLING)


def test_empty_and_all_invalid(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.csv", csv_text())
    report = validate_csv(spark, path).report.first()
    assert (report.total_records, report.valid_pct, report.invalid_pct) == (0, 0.0, 0.0)
    assert report.status == "VALIDATION PASSED"
    path = write_file(tmp_path / "bad", "a.csv", csv_text(flat_row(cost=None)))
    report = validate_csv(spark, path).report.first()
    assert (report.valid_records, report.invalid_pct, report.status) == (0, 100.0, "VALIDATION ISSUES")
    assert validate_csv(spark, path).valid.count() == 0


def test_no_rule_broken_gives_no_rows(spark):
    assert rule_violations(mark(flat_frame(spark, GOOD), BILLING), billing_rules()).collect() == []


def test_counts_do_not_depend_on_partitions_or_order(spark):
    import __spark_entry__  # noqa: F401
    from schemagate.suite.queries import landed

    rows = landed(spark, "/root/testdata/sf0.001")
    counts = {
        tuple(summary(mark(df, BILLING)).first())
        for df in (rows, rows.repartition(1), rows.repartition(13), rows.orderBy(F.rand(7)))
    }
    assert len(counts) == 1


def test_split_is_total_and_disjoint(spark):
    from schemagate.suite.queries import marked_csv

    marked = marked_csv(spark, "/root/testdata/sf0.001")
    good, bad = valid_rows(marked), invalid_rows(marked)
    assert good.count() + bad.count() == marked.count()
    assert good.join(bad, "rec_id", "left_semi").count() == 0
    assert good.select("project").count() == good.count()


def test_any_first_line_is_the_header_and_no_other(spark, tmp_path):
    header = [c.upper() for c in FLAT]
    text = csv_text(flat_row(), flat_row(cost="2"), header=header) + ",".join(FLAT) + "\n" + csv_text(flat_row(), header=header)
    path = write_file(tmp_path / "in", "a.csv", text)
    counts = set()
    for size in ("134217728", "200"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            rows = read_csv(spark, path, BILLING, ragged="reject")
            counts.add((rows.count(), rows.where(F.col(CORRUPT).isNull()).select("cost").count()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert counts == {(5, 5)}


def test_strict_header_fails_whatever_is_read(spark, tmp_path):
    swapped = ["project" if c == "location" else "location" if c == "project" else c for c in FLAT]
    path = write_file(tmp_path / "in", "a.csv", csv_text(flat_row(), header=swapped))
    checked = validate_csv(spark, path, strict_header=True)
    for read in (checked.report.collect, checked.valid.count, checked.valid.select("cost").collect):
        with pytest.raises(Exception, match="(?i)header"):
            read()


def test_names_with_dots_and_backticks(spark):
    odd = Contract({"a.b": "string", "c`d": "long"}, ("a.b", "c`d"), {}, ("a.b",), {"a.b": "it's \\ gone"})
    landed = spark.createDataFrame([("x", "1"), (None, "2")], odd.flat())
    rows = mark(landed, odd).collect()
    assert [tuple(r)[:2] for r in rows] == [("x", 1), (None, 2)]
    assert [r[CORRUPT] for r in rows] == [None, "it's \\ gone"]
