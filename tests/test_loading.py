"""Tables, the report file, and where intermediate files go."""

import subprocess
import sys
import threading
import uuid
from pathlib import Path

import pytest
from helpers import GOOD, csv_text, flat_frame, flat_row, write_file
from pyspark.sql import functions as F

from schemagate import storage
from schemagate.__main__ import arguments, run
from schemagate.billing import BILLING
from schemagate.contract import CORRUPT, FAILED
from schemagate.operators import (
    invalid_rows,
    invalid_sample,
    load_valid,
    mark,
    quarantine,
    summary,
    valid_rows,
    write_report,
)
from schemagate.operators import sinks
from schemagate.operators.sinks import lay_table
from schemagate.plans import load_in_place, load_split, load_validated, loading, staged, validate_csv, validate_json
from schemagate.plans.loading import Steps
from schemagate.sources import preview


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex}"


def marked(spark, good=3, bad=2):
    rows = [flat_row(project=f"p{i}") for i in range(good)]
    rows += [flat_row(cost=None, project=f"q{i}") for i in range(bad)]
    return mark(flat_frame(spark, *rows), BILLING)


def test_load_replaces_the_table(spark, table):
    assert load_valid(valid_rows(marked(spark, good=2)), table) == 2
    assert load_valid(valid_rows(marked(spark, good=5)), table) == 5
    assert spark.table(table).columns == BILLING.target.names
    assert [r.project for r in preview(spark, table, "project").collect()] == ["p0", "p1", "p2"]


def test_nothing_to_load_leaves_the_old_table(spark, table):
    assert load_valid(valid_rows(marked(spark, good=2)), table) == 2
    assert load_valid(valid_rows(marked(spark, good=0)), table) == 0
    assert spark.table(table).count() == 2
    assert quarantine(invalid_rows(marked(spark, bad=0)), table + "_q") == 0
    assert not spark.catalog.tableExists(table + "_q")


def test_quarantine_keeps_the_reason(spark, table):
    assert quarantine(invalid_rows(marked(spark)), table) == 2
    assert spark.table(table).columns == [*BILLING.target.names, CORRUPT]
    assert {r[0] for r in spark.table(table).select(CORRUPT).collect()} == {", , , , "}


def test_errors_propagate(spark):
    with pytest.raises(Exception):
        load_valid(valid_rows(marked(spark)), "no_such_database.t")
    with pytest.raises(Exception):
        quarantine(invalid_rows(marked(spark)), "no_such_database.t")


def test_load_split(spark, tmp_path, table):
    text = "\n".join(['{"cost":"1"}', "7", '{"cost":"2"}', '{"invoice":1}', "{}"])
    path = write_file(tmp_path / "in", "a.json", text)
    loaded = load_split(validate_json(spark, path).marked, table, table + "_bad")
    assert loaded == (3, 2)
    assert spark.table(table).columns == BILLING.target.names
    assert {r[0] for r in spark.table(table + "_bad").select(CORRUPT).collect()} == {
        "7", '{"invoice":1}',
    }


def test_load_in_place(spark, tmp_path, table):
    for n, (good, bad) in enumerate([(2, 1), (5, 3)]):
        folder = str(tmp_path / str(n))
        loaded = load_in_place(marked(spark, good, bad), folder, table, table + "_bad")
        assert loaded == (good, bad)
        assert spark.table(table).columns == BILLING.target.names
        assert {r.project for r in spark.table(table).collect()} == {f"p{i}" for i in range(good)}
        assert {r.project for r in spark.table(table + "_bad").collect()} == {f"q{i}" for i in range(bad)}
        assert not (tmp_path / str(n) / f"{FAILED}=true").exists()
    assert (tmp_path / "0" / f"{FAILED}=false").exists(), "the older rows are the caller's"
    with pytest.raises(Exception, match="already exists"):
        load_in_place(marked(spark), str(tmp_path / "1"), table, None)
    assert spark.table(table).count() == 5


def test_load_in_place_of_one_side(spark, tmp_path, table):
    assert load_in_place(marked(spark, bad=0), str(tmp_path / "a"), table, table + "_bad") == (3, 0)
    assert not spark.catalog.tableExists(table + "_bad")
    assert load_in_place(marked(spark, good=0), str(tmp_path / "b"), table, table + "_bad") == (0, 2)
    assert spark.table(table).count() == 3
    assert load_in_place(marked(spark), str(tmp_path / "c"), table, None) == (3, 0)
    rejects = spark.read.parquet(str(tmp_path / "c" / f"{FAILED}=true"))
    assert rejects.count() == 2, "kept, as no table took them"


def test_stage_is_split_by_verdict_and_removed(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(
        "schemagate.plans.loading.scratch_path",
        lambda s, label: seen.append(str(tmp_path / label)) or seen[-1],
    )
    with staged(marked(spark)) as stage:
        assert tuple(summary(stage).first())[:3] == (5, 3, 2)
        plan = invalid_rows(stage)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_validation_failed" in plan
        assert {r.project for r in invalid_rows(stage).collect()} == {"q0", "q1"}
    assert seen and not (tmp_path / "stage").exists()


def test_stage_of_nothing(spark):
    with staged(marked(spark, good=0, bad=0)) as stage:
        assert stage.count() == 0 and valid_rows(stage).count() == 0


def test_report_file(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.csv", csv_text(GOOD, flat_row(cost=None)))
    report = validate_csv(spark, path).report
    target = str(tmp_path / "report")
    write_report(report, target)
    row = spark.read.json(target).first()
    assert (row.total_records, row.valid_records, row.invalid_records) == (2, 1, 1)
    assert (row.validation_method, row.file_path) == ("implicit_spark_casting", path)
    assert len(row.validation_timestamp) == 19


def test_runs_do_not_add_up(spark, tmp_path):
    path = write_file(tmp_path / "in", "a.json", '{"cost":"x"}\n')
    first, second = (validate_json(spark, path).report.first() for _ in range(2))
    assert first.business_rule_violations == second.business_rule_violations


def test_sample_is_ordered_and_cut(spark):
    rows = [flat_row(billing_account_id=None, project=f"p{i}") for i in range(9, 0, -1)]
    sample = invalid_sample(
        mark(flat_frame(spark, *rows), BILLING), columns=("project",), order_by=("project",), width=5
    ).collect()
    assert [r.project for r in sample] == ["p1", "p2", "p3", "p4", "p5"]
    assert sample[0][CORRUPT] == "billi..."


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        storage.shared_folder(Session(spark_master="yarn"))
    assert storage.shared_folder(Session(spark_master="local[2]"))
    assert storage.shared_folder(Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"


def test_marking_needs_no_exchange(spark):
    frame = marked(spark)
    for df in (frame, valid_rows(frame), invalid_rows(frame).select(F.col(CORRUPT))):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("in_place", [False, True])
@pytest.mark.parametrize("layout", ["csv", "lines", "document"])
def test_whole_job(spark, tmp_path, table, layout, in_place):
    if layout == "csv":
        text = csv_text(GOOD, flat_row(cost=None), GOOD)
    else:
        text = {"lines": "{}\n7\n{}\n", "document": "[{},7,{}]"}[layout]
    path = write_file(tmp_path / "in", "a.txt", text)
    options = arguments(
        [layout, path, "--valid-table", table, "--invalid-table", f"{table}_bad"]
        + ["--report", str(tmp_path / "report")]
        + (["--folder", str(tmp_path / "rows")] if in_place else [])
    )
    found = run(spark, options)
    assert (found["total_records"], found["valid_records"], found["invalid_records"]) == (3, 2, 1)
    assert found["sample"] == [("BA-1", "p", ", , , , ") if layout == "csv" else "7"]
    assert len(found["valid_table_preview"]) == 2 and len(found["invalid_table_preview"]) == 1
    assert spark.table(table).count() == 2 and spark.table(f"{table}_bad").count() == 1
    stored = spark.read.json(str(tmp_path / "report")).first()
    assert stored.invalid_records == 1
    if layout != "csv":
        assert stored.null_value_stats.cost.null_count == 2


def test_a_table_that_cannot_be_laid_leaves_the_old_one(spark, table, tmp_path, monkeypatch):
    load_valid(valid_rows(marked(spark, good=2)), table)
    with pytest.raises(Exception):
        lay_table(spark, BILLING.target, table, str(tmp_path / "nothing" / "there*["))
    assert spark.table(table).count() == 2


def test_a_failed_load_in_place_can_be_run_again(spark, table, tmp_path):
    folder = str(tmp_path / "rows")
    bad = marked(spark).withColumn("project", F.when(F.col("project") == "p1", F.raise_error(F.lit("broken"))).otherwise("p"))
    with pytest.raises(Exception, match="broken"):
        load_in_place(bad, folder, table, None)
    assert load_in_place(marked(spark), folder, table, None).valid_rows == 3
    with pytest.raises(ValueError, match="already exists"):
        load_in_place(marked(spark), folder, table, None)


def test_staging_does_not_sort(spark, table):
    before = spark.conf.getAll.get("spark.sql.maxConcurrentOutputFileWriters")
    with staged(marked(spark)) as rows:
        store = spark._jsparkSession.sharedState().statusStore()
        runs = store.executionsList()
        assert "Sort" not in runs.apply(runs.size() - 1).physicalPlanDescription()
        assert rows.count() == 5
    assert spark.conf.getAll.get("spark.sql.maxConcurrentOutputFileWriters") == before


def scans_of(spark, path, done):
    """How many of Spark's runs during ``done`` read files below ``path``, and the bytes that runs wrote."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = store.executionsList().size()
    done()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = store.executionsList()
    plans = [runs.apply(n).physicalPlanDescription() for n in range(before, runs.size())]
    return sum(any("Location:" in line and str(path) in line for line in p.splitlines()) for p in plans), plans


@pytest.mark.parametrize("good", [0, 3])
def test_the_input_is_parsed_once_whatever_it_holds(spark, tmp_path, table, good):
    rows = [flat_row(project=f"p{i}") for i in range(good)] + [flat_row(cost=None)]
    path = write_file(tmp_path / "in", "a.csv", csv_text(*rows))
    checked = validate_csv(spark, path)
    n, _ = scans_of(spark, tmp_path / "in", lambda: load_valid(checked.valid, table))
    assert n == 1 and spark.catalog.tableExists(table) == bool(good)
    n, plans = scans_of(spark, tmp_path / "in", lambda: quarantine(checked.invalid, f"{table}_bad"))
    assert n == 1 and sum("InsertIntoHadoopFsRelation" in p for p in plans) == 1, "rejects are written once"


def test_a_reader_never_misses_the_table(spark, table):
    load_valid(valid_rows(marked(spark, good=2)), table)
    seen, stop = [], threading.Event()

    def poll():
        while not stop.is_set():
            seen.append(spark.table(table).count())

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for n in (3, 4, 5, 6):
            load_valid(valid_rows(marked(spark, good=n)), table)
    finally:
        stop.set()
        reader.join()
    assert seen == sorted(seen) and set(seen) <= {2, 3, 4, 5, 6}


@pytest.mark.parametrize("broken", ["lay_table", "write_text", "_discard_before"])
def test_a_load_broken_off_leaves_old_or_new_rows(spark, table, monkeypatch, broken):
    load_valid(valid_rows(marked(spark, good=2)), table)
    load_valid(valid_rows(marked(spark, good=3)), table)

    def fail(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, broken, fail)
        with pytest.raises(RuntimeError, match="killed"):
            load_valid(valid_rows(marked(spark, good=4)), table)
    assert spark.table(table).count() == (4 if broken == "_discard_before" else 3)
    assert load_valid(valid_rows(marked(spark, good=5)), table) == 5


def test_two_versions_are_kept(spark, table, tmp_path):
    for n in range(1, 6):
        load_valid(valid_rows(marked(spark, good=n)), table, path=str(tmp_path / "v"))
        assert len(list((tmp_path / "v").iterdir())) == min(n, 2)
    assert spark.table(table).count() == 5


def test_other_columns_or_a_view_give_way(spark, table):
    spark.range(3).createOrReplaceTempView("some_rows")
    spark.sql(f"CREATE TABLE {table} USING csv AS SELECT id FROM some_rows")
    assert load_valid(valid_rows(marked(spark, good=2)), table) == 2
    assert spark.table(table).columns == BILLING.target.names
    spark.sql(f"CREATE VIEW {table}_view AS SELECT project FROM {table}")
    assert load_valid(valid_rows(marked(spark, good=4)), f"{table}_view") == 4
    assert spark.table(f"{table}_view").columns == BILLING.target.names
    assert spark.table(table).count() == 2


@pytest.mark.parametrize("in_place", [False, True])
def test_the_report_comes_with_the_load(spark, tmp_path, table, in_place):
    text = "\n".join(['{"cost":"1"}', "7", '{"cost":"x"}', '{"invoice":1}', "{}"] * 20)
    path = write_file(tmp_path / "in", "a.json", text)
    checked = validate_json(spark, path)
    found = {}

    def load():
        folder = str(tmp_path / "rows") if in_place else None
        found["loaded"], found["report"] = load_validated(checked, table, f"{table}_bad", folder=folder)
        found["report"].collect()

    n, plans = scans_of(spark, tmp_path / "in", load)
    assert n == 1 and found["loaded"] == (60, 40)
    over_stage = [p for p in plans if "count_if" in p and "FileScan parquet" in p]
    assert over_stage == [], "the report reads nothing"
    drop = "validation_timestamp"
    assert found["report"].drop(drop).collect() == checked.report.drop(drop).collect()
    assert found["report"].dtypes == checked.report.dtypes


def test_tasks_run_again_do_not_count_twice(tmp_path):
    code = f"""
import os, sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession, functions as F
from schemagate.plans import load_validated, validate_csv
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r})
    .config("spark.sql.warehouse.dir", {str(tmp_path / "tables")!r}).config("spark.sql.files.maxPartitionBytes", "2k").getOrCreate())
checked = validate_csv(spark, {str(tmp_path / "in")!r})
mark = {str(tmp_path / "failed")!r}
@F.udf("string")
def once(project):
    if project == "p7" and not os.path.exists(mark):
        open(mark, "w").close()
        raise RuntimeError("lost")
    return project
from dataclasses import replace
checked = replace(checked, marked=checked.marked.withColumn("project", once("project")))
loaded, outcome = load_validated(checked, "good", "bad")
print("RESULT", *loaded, *outcome.first()[:3], os.path.exists(mark))
"""
    write_file(tmp_path / "in", "a.csv", csv_text(*[flat_row(project=f"p{i}") for i in range(30)], flat_row(cost=None)))
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=False)
    assert "RESULT 30 1 31 30 1 True" in ran.stdout, ran.stderr[-2000:]


def test_a_load_goes_on_from_what_is_done(spark, tmp_path, table, monkeypatch):
    path = write_file(tmp_path / "in", "a.csv", csv_text(*[flat_row(project=f"p{i}") for i in range(4)], flat_row(cost=None)))
    checked, folder = validate_csv(spark, path), str(tmp_path / "rows")

    class Killed(BaseException):
        pass

    def killed(*_, **__):
        raise Killed

    def attempt():
        return load_validated(checked, table, f"{table}_bad", folder=folder)

    # Killed while rows are written: what is there is written anew.
    Steps(spark, folder).mark(Steps.BEGUN, columns=checked.marked.schema.simpleString())
    (tmp_path / "rows" / "part-of-a-file.parquet").write_text("x")
    with monkeypatch.context() as patch:
        patch.setattr(loading, "load_tables", killed)
        with pytest.raises(Killed):
            attempt()
    assert not (tmp_path / "rows" / "part-of-a-file.parquet").exists()
    with monkeypatch.context() as patch:
        patch.setattr(loading, "lay_table", killed)
        n, _ = scans_of(spark, tmp_path / "in", lambda: pytest.raises(Killed, attempt))
        assert n == 0, "the stage is there"
    assert not spark.catalog.tableExists(table) and spark.table(f"{table}_bad").count() == 1
    found = []
    n, plans = scans_of(spark, tmp_path / "in", lambda: found.append(attempt()))
    assert n == 0 and not any("InsertIntoHadoopFsRelation" in p for p in plans), "neither are rejects written again"
    loaded, outcome = found[0]
    assert loaded == (4, 1) and outcome.first()[:3] == (5, 4, 1)
    with pytest.raises(ValueError, match="already exists"):
        attempt()


def test_a_folder_begun_with_other_columns_is_left_alone(spark, tmp_path):
    Steps(spark, str(tmp_path / "rows")).mark(Steps.BEGUN, columns="struct<a:int>")
    with pytest.raises(ValueError, match="other columns"):
        load_in_place(marked(spark), str(tmp_path / "rows"), None, None)
    (tmp_path / "mine").mkdir()
    with pytest.raises(ValueError, match="already exists"):
        load_in_place(marked(spark), str(tmp_path / "mine"), None, None)


def test_small_texts_are_whole_or_absent(spark, tmp_path):
    path = str(tmp_path / "a" / "note")
    storage.write_text(spark, path, "é\n1")
    assert storage.read_text(spark, path) == "é\n1"
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["note"]
