"""Inputs of the suite: how many files and bytes they take, and what they hold."""

import gzip
from collections import Counter
from pathlib import Path

import pytest

from schemagate.sources import documents
from schemagate.suite import fixtures
from schemagate.suite.queries import QUERIES


@pytest.fixture
def orders(spark, tmp_path):
    """A folder with orders of keys that repeat, and one without a customer."""
    rows = spark.range(1, 3001).selectExpr(
        "id % 2500 + 1 AS o_orderkey", "if(id = 5, null, id % 7) AS o_custkey", "id * 1.5D AS o_totalprice",
        "timestamp'2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority", "'O' AS o_orderstatus",
    )
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def texts(spark, sf_dir):
    return [r.raw for r in fixtures._from_orders(spark, sf_dir, fixtures.JSON_SQL).select("raw").collect()]


def files(path):
    return [f for f in Path(path).iterdir() if not f.name.startswith(("_", "."))]


def test_bare_documents_take_one_file_each_and_nothing_beside_it(spark, orders):
    path = fixtures.json_bare_documents(spark, orders)
    held = [f.read_text() for f in Path(path).iterdir()]
    assert Counter(held) == Counter((t or "") + "\n" for t in texts(spark, orders))


def test_bare_documents_are_there_some_at_a_time(spark, orders, monkeypatch):
    monkeypatch.setattr(fixtures, "BARE_FILES", 700)
    monkeypatch.setattr(fixtures, "FILES_PER_FOLDER", 100)
    held, roots, counts = Counter(), set(), []
    for folders in fixtures.json_bare_parts(spark, orders):
        own = [f for folder in folders for f in Path(folder).iterdir()]
        held.update(f.read_text() for f in own)
        counts.append(len(own))
        assert max(Counter(f.parent for f in own).values()) <= 100
        roots |= {Path(folder).parent for folder in folders}
        assert sum(f.is_file() for root in roots for f in root.rglob("*")) <= 700
    assert len(counts) > 4 and counts[-1] < counts[0] <= 700
    assert held == Counter((t or "") + "\n" for t in texts(spark, orders))
    assert len(roots) == 1 and not any(root.exists() for root in roots)


def test_a_folder_that_another_run_of_a_task_took_is_made_anew(spark, tmp_path):
    values = spark.createDataFrame([("a",), (None,)], "value string").coalesce(1)
    folders, spare = fixtures._in_folders(values, str(tmp_path), [])
    (tmp_path / "gone").mkdir()
    (tmp_path / "gone" / "0.txt").write_text("a text that is longer")
    for before in ["gone"], ["gone"], folders + ["more"]:
        folders, spare = fixtures._in_folders(values, str(tmp_path), before)
        assert sorted(f.read_text() for f in (tmp_path / folders[0]).iterdir()) == ["\n", "a\n"]
    assert spare == ["more"] and len(folders) == 1


def test_bare_documents_take_the_disk_of_some_files(spark, orders, monkeypatch):
    """However many records there are, so many files are there at most while they are read."""
    monkeypatch.setattr(fixtures, "BARE_FILES", 700, raising=False)
    monkeypatch.setattr(fixtures, "FILES_PER_FOLDER", 100, raising=False)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    there = lambda: sum(f.suffix == ".txt" and f.parent.parent.name != "kind=line" for f in shared.rglob("*"))
    before, seen, write = there(), [], documents._write
    monkeypatch.setattr(documents, "_write", lambda *a: (seen.append(there() - before), write(*a)))
    rows = QUERIES["json_bare_documents"](spark, orders)
    assert 0 < max(seen) <= 700 and there() == before
    assert Counter(rows.collect()) == Counter(QUERIES["json_lines_scan"](spark, orders).collect())


def test_nothing_is_left_of_bare_documents_that_cannot_be_read(spark, orders, monkeypatch):
    monkeypatch.setattr(fixtures, "BARE_FILES", 700)
    monkeypatch.setattr(fixtures, "FILES_PER_FOLDER", 100)
    folders = lambda: {f.name for f in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}
    before, seen, write = folders(), [], documents._write

    def failing(*args):
        if len(seen) == 2:
            raise OSError("no more")
        seen.append(write(*args))

    monkeypatch.setattr(documents, "_write", failing)
    with pytest.raises(OSError, match="no more"):
        QUERIES["json_bare_documents"](spark, orders)
    assert len(seen) == 2 and [f for f in folders() - before if "bare-texts" not in f] == []


def test_many_tiny_files_share_tasks(spark, tmp_path):
    for n in range(2200):
        (tmp_path / f"{n}.json").write_text('{"cost":"1"}')
    with documents._small_files_together(spark):
        fragments = documents._fragments(spark, str(tmp_path))
        tasks = documents._in_fewer_tasks(fragments).rdd.getNumPartitions()
    assert tasks <= 4 * spark.sparkContext.defaultParallelism


def test_array_documents_have_nothing_beside_them(spark, orders):
    path = fixtures.json_documents(spark, orders)
    cut_off = [t for t in texts(spark, orders) if t and not t.endswith("}") and t != "7"]
    assert len(list(Path(path).iterdir())) == len(cut_off) + 2, "two documents of whole records"
    whole = [f.read_text() for f in files(path) if f.read_text().endswith("]\n")]
    assert sum(t.count("currency_conversion_rate") for t in whole) == sum("}" in (t or "") and "{" in t for t in texts(spark, orders))


def test_documents_read_whole_are_compressed(spark, orders, tmp_path):
    plain, packed = fixtures.json_documents(spark, orders), fixtures.json_documents(spark, orders, compressed=True)
    bytes_of = lambda path: sum(f.stat().st_size for f in files(path))
    assert bytes_of(packed) * 2 < bytes_of(plain)
    whole = lambda path, opened: sorted("".join(sorted(opened(f).decode())) for f in files(path))
    assert whole(packed, lambda f: gzip.decompress(f.read_bytes())) == whole(plain, Path.read_bytes)
    assert QUERIES["json_document_scan"](spark, orders).count() == QUERIES["json_document_blocks"](spark, orders).count()


def test_json_lines_are_compressed(spark, orders):
    path = fixtures.json_lines(spark, orders)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert Counter(lines) == Counter(t or "" for t in texts(spark, orders))
    assert 3 * sum(f.stat().st_size for f in files(path)) < sum(len(x) for x in lines)
