"""Nested JSON: record verdicts, and documents cut into records."""

import bz2
import gzip
import json
from collections import Counter
from contextlib import contextmanager
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pytest
from helpers import write_file
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from schemagate.billing import BILLING
from schemagate.contract import CORRUPT
from schemagate.operators.verdicts import status_of
from schemagate.plans import validate_json
from schemagate.sources import cutting, documents, read_json
from schemagate.sources.documents import taken_apart
from schemagate.storage import setting

CASES = [
    ('{"invoice":{"month":202401}}', ("invoice", (202401, None)), False),
    ('{"invoice":{"month":"202401","publisher_type":"D"}}', ("invoice", (None, "D")), True),
    ('{"invoice":{"month":202401.0}}', ("invoice", (None, None)), True),
    ('{"invoice":"x"}', ("invoice", None), True),
    ('{"invoice":null}', ("invoice", None), False),
    ('{"currency_conversion_rate":"1.25"}', ("currency_conversion_rate", Decimal("1.25")), False),
    ('{"currency_conversion_rate":"zz"}', ("currency_conversion_rate", None), True),
    ('{"currency_conversion_rate":""}', ("currency_conversion_rate", None), True),
    (
        '{"currency_conversion_rate":1.123456789012345}',
        ("currency_conversion_rate", Decimal("1.1234567890")),
        False,
    ),
    ('{"usage":{"amount_in_pricing_units":"2.5"}}', ("usage", (None, None, None, None)), True),
    ('{"usage":{"amount_in_pricing_units":3}}', ("usage", (None, 3.0, None, None)), False),
    ('{"cost":{"a": 1}}', ("cost", '{"a": 1}'), False),
    ('{"cost":true}', ("cost", "true"), False),
    ('{"cost":100.50}', ("cost", "100.50"), False),
    ('{"cost":12345678.90}', ("cost", "12345678.90"), False),
    ('{"cost":1e-5}', ("cost", "1e-5"), False),
    ('{"cost":007}', ("cost", None), True),
    ('{"labels":{"key":"a"}}', ("labels", None), True),
    ('{"labels":"x"}', ("labels", None), True),
    ('{"labels":[{"key":"a"},7]}', ("labels", None), True),
    ('{"labels":[]}', ("labels", []), False),
    ("{}", ("cost", None), False),
    ('{"extra":1}', ("cost", None), False),
    ('{"_corrupt_record":"boo"}', ("cost", None), False),
    ('{"cost":"1","cost":"2"}', ("cost", "2"), False),
    ("7", ("cost", None), True),
    ("null", ("cost", None), True),
    ('{"cost":"1"', ("cost", None), True),
]


def value_of(row, name):
    value = row[name]
    return tuple(value) if hasattr(value, "asDict") else value


@pytest.mark.parametrize("layout", ["lines", "document"])
def test_records(spark, tmp_path, layout):
    # In an array a cut-off record would take the text behind it along.
    cases = CASES if layout == "lines" else [c for c in CASES if c[0] != '{"cost":"1"']
    texts = [text for text, _, _ in cases]
    text = "\n".join(texts) if layout == "lines" else f"[{','.join(texts)}]"
    path = write_file(tmp_path / "in", "a.json", text)
    rows = read_json(spark, path, BILLING, layout=layout).collect()
    assert len(rows) == len(cases)
    for row, (text, (name, value), bad) in zip(rows, cases):
        assert row[CORRUPT] == (text if bad else None)
        assert value_of(row, name) == value


def test_verdict_does_not_depend_on_the_columns_read(spark, tmp_path):
    lines = '{"cost":"1"}\n{"cost":"2","invoice":{"month":"x"}}\n\n{"cost":"3"}\n'
    path = write_file(tmp_path / "in", "a.json", lines)
    rows = read_json(spark, path, BILLING)
    good = rows.where(F.col(CORRUPT).isNull())
    assert good.count() == 2
    assert sorted(r.cost for r in good.select("cost").collect()) == ["1", "3"]
    assert rows.where(F.col(CORRUPT).isNotNull()).count() == 1


def test_one_scan_of_all_columns_on_the_jvm(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", "{}\n")
    checked = validate_json(spark, path)
    for df in (checked.valid.select("cost"), checked.invalid, checked.report):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "PushedFilters: []" in plan
        assert "Python" not in plan and "Arrow" not in plan


DOCUMENTS = {
    "array": ('[{"cost":"1"},\n {"cost":"2"}]', ["1", "2"], []),
    "object": ('\n{"cost":\n"1"}\n', ["1"], []),
    "one bad element": ('[{"cost":"1"},{"invoice":7},{"cost":"3"}]', ["1", "3"], ['{"invoice":7}']),
    "empty array": (" [ ] ", [], []),
    "empty file": ("", [], []),
    "blank file": (" \n", [], []),
    "scalars between": (
        '[7, {"cost":"1"}, "a,]}{", [1,2], {"cost":"2"}, null]',
        ["1", "2"],
        ["7", '"a,]}{"', "[1,2]", "null"],
    ),
    "marks in strings": ('[{"cost":"}{][\\"},"},{"cost":"\\\\"}]', ['}{]["},', "\\"], []),
    "deep": ('[{"extra":{"a":[{"b":{}}]},"cost":"1"},{"cost":"2"}]', ["1", "2"], []),
    "number text": ('[{"cost":12345678901234567890.10}]', ["12345678901234567890.10"], []),
    "cut off": ('[{"cost":"1"},{"cost":"2"', ["1"], ['{"cost":"2"']),
    "missing comma": ('[{"cost":"1"} {"cost":"2"}]', ["1"], ['{"cost":"2"}']),
    "text behind": ('[{"cost":"1"}] {"cost":"2"}', ["1"], ['] {"cost":"2"}']),
    "nested object": (
        '\n{"cost":"1","invoice":{"month":202401},"labels":[{"key":"a","value":"}"},{"key":"]"}],\n"usage":{"unit":"s"}}\n',
        ["1"],
        [],
    ),
    "object and more": ('{"cost":"1","usage":{}}\n{"cost":"2"}\n,7', ["1"], ['{"cost":"2"}', ",7"]),
    "object cut off": ('{"cost":"1","usage":{"unit":"a"}', [], ['{"cost":"1","usage":{"unit":"a"}']),
    "scalar": (" 7 ", [], ["7"]),
    "comma last": ('[{"cost":"1"},', ["1"], []),
    "escapes outside": ('[{"cost":"1"\\},{"cost":"2"}]', [], ['{"cost":"1"\\},{"cost":"2"}]']),
    "stray quote": ('[{"cost":"1"},{"cost":""2"},{"cost":"3"}]', ["1"], ['{"cost":""2"},{"cost":"3"}]']),
}


@contextmanager
def splits_of(spark, size):
    """Have files read in blocks of so many bytes."""
    options = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in options:
            spark.conf.unset(key)


def cut_rows(spark, path, size):
    with splits_of(spark, size):
        return read_json(spark, path, BILLING, layout="document").select("cost", CORRUPT).collect()


@pytest.mark.parametrize("size", [1 << 20, 16, 5])
def test_documents(spark, tmp_path, size):
    """All in one folder, whatever blocks they are read in."""
    for number, (text, _, _) in enumerate(DOCUMENTS.values()):
        path = write_file(tmp_path / "in", f"{number}.json", text)
    rows = cut_rows(spark, path, size)
    assert sorted(r.cost for r in rows if r[CORRUPT] is None) == sorted(c for _, costs, _ in DOCUMENTS.values() for c in costs)
    assert sorted(r[CORRUPT] for r in rows if r[CORRUPT] is not None) == sorted(c for _, _, bad in DOCUMENTS.values() for c in bad)


ODD_BYTES = {
    "mark": b'\xef\xbb\xbf[{"cost":"1"}]',
    "two marks": b'\xef\xbb\xbf\xef\xbb\xbf{"cost":"1"}',
    "only a mark": b"\xef\xbb\xbf",
    "bad bytes": b'[{"cost":"1\xff"},{"cost":"\xc3\xa0"}]\n',
    "comma": b",",
    "commas": b",,",
    "comma behind": b'{"cost":"1"},',
    "frame marks": b'[{"cost":"\x1e"},\x1d,{"cost":"2"}]',
    "long": b"[" + b",".join(b'{"cost":"%d","project":"}{\\""}' % k for k in range(400)) + b"]",
}


@pytest.mark.parametrize("opening", [1, 40, 1 << 20])
def test_small_files_are_read_whole(spark, tmp_path, opening):
    """All files as fragments, some, or none: the rows are the same."""
    (tmp_path / "in").mkdir()
    known = {name: text.encode() for name, (text, _, _) in DOCUMENTS.items()} | ODD_BYTES
    for number, text in enumerate(known.values()):
        (tmp_path / "in" / f"{number}.json").write_bytes(text)
    (tmp_path / "in" / "packed.json.gz").write_bytes(gzip.compress(b'[{"cost":"1"},7]'))
    path, rows = str(tmp_path / "in"), []
    for cost in (1, opening):
        with setting(spark, "spark.sql.files.openCostInBytes", str(cost)), documents._small_files_together(spark):
            taken = documents._whole(spark, path)[0].count()
            rows.append(read_json(spark, path, BILLING, layout="document").selectExpr("cost", f"hex({CORRUPT}) AS bad").collect())
    assert taken == sum(0 < len(text) <= opening for text in known.values())
    assert Counter(rows[0]) == Counter(rows[1]) and len(rows[0]) > 400


def test_small_files_named_by_two_paths_are_an_error(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", '[{"cost":"1"},{"cost":"2"}]')
    large = write_file(tmp_path / "more", "b.json", "[" + ",".join(['{"cost":"1"}'] * 100) + "]")
    with setting(spark, "spark.sql.files.openCostInBytes", "40"):
        assert read_json(spark, [path, path, large], BILLING, layout="document").count() == 102
        with pytest.raises(ValueError, match="named by more than one path"):
            read_json(spark, [path, path + "/a.json", large], BILLING, layout="document")


def test_a_folder_named_like_a_column(spark, tmp_path):
    for k in "12":
        write_file(tmp_path / "in" / f"content={k}", "a.json", f'{{"cost":"{k}"}}')
    rows = read_json(spark, str(tmp_path / "in"), BILLING, layout="document").collect()
    assert sorted(r.cost for r in rows) == ["1", "2"]


def test_paths_in_turn(spark, tmp_path):
    asked = []

    def paths():
        for k in range(3):
            asked.append(k)
            path = write_file(tmp_path / "in", "a.json", f'[{{"cost":"{k}"}},7]')
            yield [path]
            (tmp_path / "in" / "a.json").unlink()

    rows = read_json(spark, paths(), BILLING, layout="document")
    assert asked == [0, 1, 2] and list((tmp_path / "in").iterdir()) == []
    assert sorted(r.cost for r in rows.collect() if r.cost) == ["0", "1", "2"] and rows.count() == 6
    assert read_json(spark, iter([]), BILLING, layout="document").count() == 0


def test_nothing_is_left_of_the_lines(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", '[{"cost":"1"},{"cost":"2"}]')
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    for size in (1 << 20, 5):
        with splits_of(spark, size), taken_apart(spark, path) as lines:
            assert read_json(spark, lines, BILLING, layout="cut").count() == 2
    with pytest.raises(Exception, match="named by more than one path"), splits_of(spark, 5):
        with taken_apart(spark, [path, path + "/a.json"]):
            pass
    assert set(shared.iterdir()) == before


def test_large_document_over_many_blocks(spark, tmp_path):
    records = [
        json.dumps({"cost": f"{i}", "project": 'a"}{][,\\' * (i % 50), "extra": [{"x": {}}] * (i % 4)})
        for i in range(3000)
    ]
    records[1234] = '{"cost":"1234","invoice":"}"}'
    for name, joint in (("a.json", ","), ("b.json", ",\n  ")):
        write_file(tmp_path / "in", name, "[" + joint.join(records) + "]\n")
    got = cut_rows(spark, str(tmp_path / "in"), 20000)
    assert sorted(r.cost for r in got) == sorted(str(i) for i in range(3000) for _ in "ab")
    assert [r[CORRUPT] for r in got if r[CORRUPT]] == [records[1234]] * 2


@pytest.mark.parametrize("size", [1 << 20, 5])
def test_a_path_named_twice_is_read_once(spark, tmp_path, size):
    path = write_file(tmp_path / "in", "a.json", '[{"cost":"1"},{"cost":"2"}]')
    assert sorted(r.cost for r in cut_rows(spark, [path, path], size)) == ["1", "2"]


@pytest.mark.parametrize("size", [1 << 20, 5])
def test_compressed_document(spark, tmp_path, size):
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.json.gz", "wt") as f:
        f.write('[{"cost":"1"},\n{"cost":"2"}]\n')
    rows = cut_rows(spark, str(tmp_path / "in"), size)
    assert sorted((r.cost, r[CORRUPT]) for r in rows) == [("1", None), ("2", None)]


@pytest.mark.parametrize("size", [1 << 20, 5])
@pytest.mark.parametrize("ending, opener", [("gz", gzip.open), ("bz2", bz2.open)])
@pytest.mark.parametrize(
    "text, rejects",
    [
        ('[{"cost":"1"},{"cost":"2"}]', []),
        ('[{"cost":"1"},{"cost":"2"},{"cost":"3"', ['{"cost":"3"']),
        ('[{"cost":"1"},{"cost":"2"}', []),
    ],
)
def test_compressed_ends(spark, tmp_path, size, ending, opener, text, rejects):
    (tmp_path / "in").mkdir()
    with opener(tmp_path / "in" / f"a.json.{ending}", "wt") as f:
        f.write(text)
    rows = cut_rows(spark, str(tmp_path / "in"), size)
    assert sorted(r.cost for r in rows if r[CORRUPT] is None) == ["1", "2"]
    assert [r[CORRUPT] for r in rows if r[CORRUPT] is not None] == rejects


@pytest.mark.parametrize("size", [1 << 20, 5])
@pytest.mark.parametrize("end", [b"]", b"]\n", b""])
@pytest.mark.parametrize("start", [b"", b"\xef\xbb\xbf"])
def test_bytes_of_any_kind(spark, tmp_path, size, end, start):
    """Bad bytes spoil their record only, as they do in a scan of lines."""
    (tmp_path / "in").mkdir()
    bad, good = b'{"cost":"1\xff"}', '{"cost":"\u00e0\u20ac\U0001f600"}'.encode()
    document = start + b"[" + bad + b",\n" + good + b"," + b"{}" + end
    (tmp_path / "in" / "a.json").write_bytes(document)
    with splits_of(spark, size):
        rows = read_json(spark, str(tmp_path / "in"), BILLING, layout="document")
    found = rows.select("cost", F.expr(f"hex({CORRUPT}) AS bad")).collect()
    assert sorted((r.cost or "", r.bad or "") for r in found) == [
        ("", ""), ("", bad.hex().upper()), ("\u00e0\u20ac\U0001f600", ""),
    ]


def test_text_without_end_is_one_reject_or_an_error(spark, tmp_path, monkeypatch):
    text = '[{"cost":"1"},{"cost":""2"},' + ",".join(f'{{"cost":"{i}"}}' for i in range(300)) + "]"
    path = write_file(tmp_path / "in", "a.json", text)
    assert sorted(map(repr, cut_rows(spark, path, 500))) == sorted(map(repr, cut_rows(spark, path, 1 << 20)))
    monkeypatch.setattr("schemagate.sources.documents.RECORD_LIMIT", 1000)
    with pytest.raises(Exception, match="too large"):
        cut_rows(spark, path, 500)


def test_lines_can_be_kept(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", '[{"cost":"1"},7]')
    kept = str(tmp_path / "lines")
    for _ in range(2):
        if not (tmp_path / "lines").exists():
            validate_json(spark, path, layout="document", lines_path=kept)
        else:
            with pytest.raises(Exception, match="already exists"):
                validate_json(spark, path, layout="document", lines_path=kept)


values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text('a"\\{}[],: \né'),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('k"}'), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(values, max_size=8), st.sampled_from([None, 1]), st.integers(1, 40))
def test_cutting_equals_a_full_parse(elements, indent, block):
    text = json.dumps(elements, indent=indent, ensure_ascii=False)
    whole = in_blocks(text, 10**6)
    assert [json.loads(line.lstrip(cutting.SET_APART)) for line in whole] == elements
    assert [line[0] == "{" for line in whole] == [isinstance(e, dict) for e in elements]
    assert sorted(in_blocks(text, block)) == sorted(whole)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text('k"}'), values, max_size=4), st.integers(1, 10))
def test_a_bare_object_is_one_line(value, block):
    text = json.dumps(value)
    assert in_blocks(text, 10**6) == in_blocks(text, block) == [text]


@settings(max_examples=400, deadline=None)
@given(st.text('[]{}",\\ a\n', max_size=60), st.sampled_from(["", "["]), st.integers(1, 3))
def test_no_text_is_lost_from_broken_documents(text, start, block):
    """Only blanks and the commas and brackets around elements may go, wherever text is split."""
    whole = in_blocks(start + text, 10**6)
    assert sorted(in_blocks(start + text, block)) == sorted(whole)
    assert no_frame("".join(whole).replace(cutting.SET_APART, "")) == no_frame(text)


@settings(max_examples=400, deadline=None)
@given(st.text('[]{}",\\ a\n', max_size=60), st.sampled_from(["", "[", "{"]))
def test_a_document_in_one_row_gives_the_same_lines(text, start):
    """With brackets found one by one or in arrays."""
    text = start + text
    whole = in_blocks(text, 10**6)
    assert list(cutting.document_lines(text)) == whole
    short, cutting.SHORT = cutting.SHORT, -1
    try:
        assert list(cutting.document_lines(text)) == whole
    finally:
        cutting.SHORT = short


def no_frame(text):
    return "".join(c for c in text if c not in "[], \n")


GUESSED = Counter()


def stands(cuts, guess, in_string, level, closing, depth, block, least, quotes, **_):
    """``cutting.STANDS`` in plain Python."""
    if cuts:
        return guess == in_string and level == closing - depth and (block == 0 or closing == 1)
    return (guess == in_string and (least is None or least > closing - depth)) or (quotes == 0 and in_string == 1)


def in_blocks(text, fragments_per_block):
    """The steps in plain Python, with blocks of a few fragments."""
    fragments = text.split(",")
    if fragments[-1] == "":
        fragments.pop()
    parts = [fragments[k : k + fragments_per_block] for k in range(0, len(fragments), fragments_per_block)]
    key = {"file": 1, "size": 9, "alone": len(parts) == 1}
    batches = [
        pa.RecordBatch.from_pylist([{**key, "block": k, "value": value} for value in part]) for k, part in enumerate(parts)
    ]
    taken = mixed(cutting.take_apart(iter(batches)))
    found, states = taken[cutting.LINE], [json.loads(s) for s in taken[cutting.STATE]]
    quotes = depth = 0
    placed, right = [], True
    for k, (s, batch) in enumerate(zip(states, batches)):
        begins = {"in_string": quotes % 2, "depth": depth, "closing": states[0]["closing"]}
        right = right and stands(**{**s, **begins})
        ends = {"first": k == 0, "last": k == len(states) - 1}
        chunks = [r for b in cutting.pack_blocks(iter([batch])) for r in b.to_pylist()]
        placed += [{**chunk, **begins, **ends} for chunk in chunks]
        depth += s["net_in"] if quotes % 2 else s["net_out"]
        quotes += s["quotes"]
    GUESSED[right] += bool(states)
    if right:
        edges = [json.loads(e) for e in taken[cutting.EDGE]]
        for edge in edges:
            edge["closing"], edge["ends"] = states[0]["closing"], edge["ends"] and edge["block"] == len(states) - 1
            if edge["ends"]:
                edge["text"] = edge["text"][:-1]
    else:
        cuts = mixed(cutting.cut_blocks(iter(pa.Table.from_pylist(placed).to_batches())))
        found, edges = cuts[cutting.LINE], [json.loads(e) for e in cuts[cutting.RECUT_EDGE]]
    held = []
    for edge in edges:
        held.append(edge)
        if edge["closes"] or edge is edges[-1]:
            text = "".join(e["text"] for e in held)
            found = found + cutting.lines(
                text, edge["closing"], any(e["opens"] for e in held), any(e["ends"] for e in held)
            )
            held = []
    return found


def mixed(batches):
    rows = [r for b in batches for r in b.to_pylist()]
    return {k: [r["value"] for r in rows if r["kind"] == k] for k in (cutting.LINE, cutting.STATE, cutting.EDGE, cutting.RECUT_EDGE)}


def test_report_of_json(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", '{"billing_account_id":"a","cost":"x"}\n{}\n')
    row = validate_json(spark, path).report.first()
    assert (row.total_records, row.valid_records, row.status) == (
        2, 2, "VALIDATION PASSED WITH WARNINGS",
    )
    assert row.business_rule_violations == [
        "1 valid records with null billing_account_id",
        "1 records with non-numeric cost",
    ]
    plain = validate_json(spark, path, rules=()).report.first()
    assert plain.status == "VALIDATION PASSED" and "null_value_stats" not in plain.asDict()


def test_report_takes_one_pass(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", "{}\n")
    plan = validate_json(spark, path).report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize(
    "invalid, problems, of_two, of_four",
    [
        (0, 0, "VALIDATION PASSED", "VALIDATION PASSED"),
        (0, 2, "VALIDATION PASSED WITH WARNINGS", "VALIDATION PASSED WITH WARNINGS"),
        (3, 0, "VALIDATION ISSUES", "VALIDATION PARTIAL"),
        (3, 2, "VALIDATION ISSUES", "VALIDATION ISSUES"),
    ],
)
def test_verdicts(spark, invalid, problems, of_two, of_four):
    row = spark.range(1).selectExpr(
        *[status_of(str(invalid), str(problems), partial=p) for p in (False, True)]
    ).first()
    assert tuple(row) == (of_two, of_four)
