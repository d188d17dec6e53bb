"""Multi-line CSV read in blocks against reading each file whole."""

import random

import pytest
from helpers import GOOD, csv_text, flat_row, write_file

from schemagate.billing import BILLING, FLAT
from schemagate.contract import CORRUPT
from schemagate.sources import read_csv
from schemagate.sources.csv_blocks import records_to_lines
from schemagate.storage import scratch_path

TEXTS = ["plain", "two\nlines", 'a ""b"" c'.replace('""', '"'), "\n", "\n\n\nx", '"', '""', ",", 'x,"\n",y', " ", "é\nü", "\t\n", "end\n"]


def rows_of(seed, n):
    rng = random.Random(seed)
    return [flat_row(project=rng.choice(TEXTS), location=rng.choice(TEXTS), cost=rng.choice(["1", None, "x"]), sku_id=str(i)) for i in range(n)]


def read(spark, path, size, **options):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return sorted(map(repr, read_csv(spark, path, BILLING, **options).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [1 << 20, 700, 61])
def test_blocks_give_the_rows_of_whole_files(spark, tmp_path, size):
    bare = ",".join(f"v{n}" for n in range(20))
    files = {
        "a.csv": csv_text(*rows_of(1, 12)),
        "crlf.csv": csv_text(*rows_of(2, 6)).replace("\n", "\r\n"),
        "blank.csv": "\n\n" + csv_text(*rows_of(3, 3)).replace("\n", "\n\n", 1) + "\n   \n",
        "open.csv": csv_text(GOOD) + '"never closed,\n' + bare + "\n",
        "header only.csv": ",".join(FLAT) + "\n",
        "header lines.csv": csv_text(GOOD, header=['"billing\naccount"', *FLAT[1:]]),
        "no end.csv": csv_text(GOOD).rstrip("\n"),
        "stray.csv": csv_text(*rows_of(4, 3)) + 'in"side,' + bare + "\n" + '"q"uoted,"' + bare + "\n",
        "empty.csv": "",
    }
    for name, text in files.items():
        path = write_file(tmp_path / "in", name, text)
    for ragged in ("permissive", "reject"):
        want = read(spark, path, 1 << 20, multi_line=True, ragged=ragged)
        assert read(spark, path, size, multi_line="split", ragged=ragged) == want and len(want) > 25


def test_backslash_dialect(spark, tmp_path):
    lines = ['"a \\" b\n c",' + ",".join(["1"] * 19), '"\\\\",' + ",".join(["2"] * 19), '"x\\\ny",' + ",".join(["3"] * 19)] * 4
    path = write_file(tmp_path / "in", "a.csv", "\n".join([",".join(FLAT), *lines]) + "\n")
    for size in (1 << 20, 40):
        assert read(spark, path, size, multi_line="split", escape="\\") == read(spark, path, 1 << 20, multi_line=True, escape="\\")


def test_only_files_with_stray_quotes_are_read_whole(spark, tmp_path):
    write_file(tmp_path / "in", "a.csv", csv_text(*rows_of(5, 4)))
    path = write_file(tmp_path / "in", "b.csv", csv_text(GOOD) + 'x"y\n')
    taken = records_to_lines(spark, path, '"', scratch_path(spark, "csv"))
    assert [p.rsplit("/", 1)[1] for p in taken.others] == ["b.csv"]


def test_a_large_file_is_shared_by_tasks(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.csv", csv_text(*rows_of(6, 400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = spark.read.text(path)
        assert lines.rdd.getNumPartitions() > 2
        rows = read_csv(spark, path, BILLING, multi_line="split")
        assert rows.count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_strict_header(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.csv", csv_text(GOOD))
    assert read_csv(spark, path, BILLING, multi_line="split", strict_header=True).count() == 1
    path = write_file(tmp_path / "in", "b.csv", csv_text(GOOD, header=["other", *FLAT[1:]]))
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, path, BILLING, multi_line="split", strict_header=True)
    with pytest.raises(ValueError, match="multi_line"):
        read_csv(spark, path, BILLING, multi_line="some")
    assert CORRUPT in read_csv(spark, path, BILLING, multi_line="split", ragged="reject").columns
