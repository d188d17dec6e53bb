"""The registered queries against SQL, and the pipeline against plain versions of its stages."""

import __spark_entry__ as driver
import brute
import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from schemagate.llm.queries import ORACLES, QUERIES
from schemagate.llm.repetition import MAX_COVERED, MAX_LONGEST, MIN_REPEAT

SF, WHOLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{WHOLE}/{name}.parquet'")
    yield con
    con.close()


def test_each_operator_has_one_query():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = QUERIES[name](spark, WHOLE), duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_stages_do_what_their_plain_versions_do(spark, tmp_path):
    source = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "best-fit packing":
            assert docs.columns == columns
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
            rows[name] = [tuple(r) for r in docs.select("doc_id", "text").collect()]

    def kept(text):
        q = brute.quality(text, MIN_REPEAT)
        n, longest = q["n_words"], q["longest_repeat"]
        bad = q["n_covered"] > MAX_COVERED * n or (longest >= MIN_REPEAT and longest > MAX_LONGEST * n)
        return not q["base_failed"] and not bad

    good = [(i, t) for i, t in source if len(t) < 6_000 and kept(t)]
    assert sorted(good) == sorted((i, t) for i, t in rows["quality rules"] if len(t) < 6_000)
    classes = brute.near_duplicates(rows["quality rules"], width=5)
    assert {i for i, *_, k in classes if k} == {i for i, _ in rows["near duplicates"]}
    cut = {i: (n, gone) for i, n, gone, _ in brute.substring_dedup(rows["near duplicates"])}
    assert {i: len(brute.words(t)) for i, t in rows["substring dedup"]} == {i: n - gone for i, (n, gone) in cut.items()}
    sizes = {i: len(brute.words(t)) for i, t in rows["substring dedup"]}
    taken = {}
    for i, t in rows["source mix"]:
        taken[i] = taken.get(i, 0) + len(brute.words(t))
    assert all(n <= 3 * sizes[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - sum(sizes.values())) <= 8 * 21
    assert docs.agg(F.sum("length")).first()[0] >= sum(taken.values())
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def through(spark, docs, folder):
    """The columns and rows that each stage gives, written and read again."""
    found = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name.replace(" ", "-"))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append((docs.columns, docs.count()))
    return found


def test_stages_of_odd_rows_with_clashing_columns(spark, wide_docs, docs, tmp_path):
    wide = through(spark, wide_docs, tmp_path / "wide")
    assert all(columns == wide_docs.columns for columns, _ in wide[:-1])
    plain = through(spark, docs, tmp_path / "plain")
    assert [n for _, n in wide[:3]] == [n for _, n in plain[:3]] and plain[0][1] > plain[1][1] > 0


def test_stages_of_nothing(spark, no_docs, tmp_path):
    found = through(spark, no_docs, tmp_path)
    assert [n for _, n in found] == [0] * len(found)
    assert all(columns == no_docs.columns for columns, _ in found[:-1])
