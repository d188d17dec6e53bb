"""Validate once, then load both sides."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from schemagate.contract import FAILED
from schemagate.operators.marking import invalid_rows, valid_rows
from schemagate.operators.profile import ReportPlan
from schemagate.operators.sinks import lay_table, load_valid, quarantine
from schemagate.plans.validation import Validation
from schemagate.storage import delete_path, path_exists, read_text, scratch_path, setting, write_text


class Loaded(NamedTuple):
    valid_rows: int
    invalid_rows: int


class Steps:
    """What of a load in place is done: a small file per step, beside the rows.

    Spark's readers pass over names that begin as these do.
    """

    BEGUN, STAGED, REJECTS, LOADED = "begun", "staged", "rejects", "loaded"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _file(self, step: str) -> str:
        return f"{self.folder}/_steps/{step}"

    def done(self, step: str) -> bool:
        return path_exists(self.spark, self._file(step))

    def said(self, step: str) -> dict:
        return json.loads(read_text(self.spark, self._file(step)))

    def mark(self, step: str, **facts) -> None:
        write_text(self.spark, self._file(step), json.dumps(facts))


@contextmanager
def staged(marked: DataFrame, folder: str | None = None) -> Iterator[DataFrame]:
    """The marked rows as Parquet in the shared folder, one directory per verdict.

    Parsing text is the costly step, so it runs once here.  What follows reads columns
    from files: it skips the side it does not want, counts from file footers, and does
    not depend on the executors that parsed the text.  Both sides are written as they come,
    without sorting rows by verdict.  The files are removed at the end, unless they go to a
    ``folder`` of the caller's, which must be new and is removed only if writing it fails.

    A folder whose load was broken off goes on from what is done: rows that are all there are
    not written again, and others are removed and written anew.
    """
    with _staged(marked, folder, None) as (stage, _):
        yield stage


@contextmanager
def staged_report(checked: Validation, folder: str | None = None) -> Iterator[tuple[DataFrame, DataFrame]]:
    """``staged``, with the report, whose counts are taken while the rows are written."""
    with _staged(checked.marked, folder, checked.report_plan) as (stage, counts):
        if counts is None:
            yield stage, checked.report_on(stage)
        else:
            yield stage, checked.report_plan.of_counts(stage.sparkSession, counts)


@contextmanager
def _staged(marked: DataFrame, folder: str | None, plan: ReportPlan | None) -> Iterator[tuple[DataFrame, dict[str, int] | None]]:
    spark = marked.sparkSession
    path = folder or scratch_path(spark, "stage")
    steps = Steps(spark, path)
    counts = None
    if folder and _goes_on(steps, marked):
        counts = steps.said(Steps.STAGED)["counts"]
    else:
        try:
            if folder:
                steps.mark(Steps.BEGUN, columns=marked.schema.simpleString())
            counts = _write(marked, path, plan)
            if folder:
                steps.mark(Steps.STAGED, counts=counts)
        except BaseException:
            delete_path(spark, path)
            raise
    try:
        yield spark.read.schema(marked.schema).parquet(path), counts if plan else None
    finally:
        if not folder:
            delete_path(spark, path)


def _goes_on(steps: Steps, marked: DataFrame) -> bool:
    """Whether a broken-off load left all its rows in the folder; unfinished ones are removed."""
    if not path_exists(steps.spark, steps.folder):
        return False
    if not steps.done(Steps.BEGUN) or steps.done(Steps.LOADED):
        raise ValueError(f"{steps.folder} already exists")
    if steps.said(Steps.BEGUN)["columns"] != marked.schema.simpleString():
        raise ValueError(f"{steps.folder} was begun with other columns")
    if steps.done(Steps.STAGED):
        return True
    delete_path(steps.spark, steps.folder)
    return False


def _write(marked: DataFrame, path: str, plan: ReportPlan | None) -> dict[str, int] | None:
    rows, seen = plan.observed(marked) if plan else (marked, None)
    with setting(marked.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        rows.write.mode("append").partitionBy(FAILED).parquet(path)
    # A plan found to be empty beforehand has nothing to observe; its report is taken from the stage.
    return (seen.get or None) if seen else None


def load_split(
    marked: DataFrame,
    valid_table: str | None,
    invalid_table: str | None,
    *,
    valid_path: str | None = None,
    invalid_path: str | None = None,
) -> Loaded:
    """Parse the input once and fill the table of valid rows and the table of rejects."""
    with staged(marked) as stage:
        return load_tables(
            stage, valid_table, invalid_table, valid_path=valid_path, invalid_path=invalid_path
        )


def load_in_place(
    marked: DataFrame, folder: str, valid_table: str | None, invalid_table: str | None
) -> Loaded:
    """Parse the input once and write the valid rows once, to ``folder``, which must be new.

    The table of valid rows is laid over them there; an older table of that name is
    replaced only when they are all written.  Rejects, mostly few and scattered, go on to
    their own table as in ``load_split``.  Called again after it was broken off, it goes on
    from the last step that is done.
    """
    with staged(marked, folder) as stage:
        return lay_tables(stage, folder, valid_table, invalid_table)


def load_validated(
    checked: Validation, valid_table: str | None, invalid_table: str | None, *, folder: str | None = None
) -> tuple[Loaded, DataFrame]:
    """Load both sides and report, from one job over the input.

    With a ``folder`` as ``load_in_place``, else as ``load_split``.
    """
    with staged_report(checked, folder) as (stage, outcome):
        if folder:
            return lay_tables(stage, folder, valid_table, invalid_table), outcome
        loaded = load_tables(stage, valid_table, invalid_table)
        # The stage goes; what the report says must not depend on it.
        return loaded, stage.sparkSession.createDataFrame(outcome.collect(), outcome.schema)


def lay_tables(
    stage: DataFrame, folder: str, valid_table: str | None, invalid_table: str | None
) -> Loaded:
    """``load_in_place`` for rows that are staged in ``folder`` already."""
    spark = stage.sparkSession
    steps = Steps(spark, folder)
    if steps.done(Steps.REJECTS):
        loaded = Loaded(0, steps.said(Steps.REJECTS)["rows"])
    else:
        loaded = load_tables(stage, None, invalid_table, invalid_path=f"{folder}/_rejects")
        steps.mark(Steps.REJECTS, rows=loaded.invalid_rows)
    if invalid_table:
        delete_path(spark, f"{folder}/{FAILED}=true")
    kept = f"{folder}/{FAILED}=false"
    if valid_table and path_exists(spark, kept):
        schema = valid_rows(stage, placeholder=False).schema
        loaded = loaded._replace(valid_rows=lay_table(spark, schema, valid_table, kept))
    steps.mark(Steps.LOADED, **loaded._asdict())
    return loaded


def load_tables(
    stage: DataFrame,
    valid_table: str | None,
    invalid_table: str | None,
    *,
    valid_path: str | None = None,
    invalid_path: str | None = None,
) -> Loaded:
    """``load_split`` for rows that are staged already; a table without a name is left out."""
    loaded = Loaded(0, 0)
    if valid_table:
        loaded = loaded._replace(valid_rows=load_valid(valid_rows(stage), valid_table, path=valid_path))
    if invalid_table:
        kept = quarantine(invalid_rows(stage), invalid_table, path=invalid_path)
        loaded = loaded._replace(invalid_rows=kept)
    return loaded
