"""Writing the outcome: tables for both sides of the split, and the report.

A table's data is written as a new version, in a folder of its own, and the table is pointed to
it when all is there.  What was written tells whether there is anything to load, so the input is
parsed once.  Pointing is one change in the catalog: a reader sees the older rows or the new ones,
never no table, and whoever reads the older version meanwhile still finds its files.  A version is
removed when the one after its successor is taken into use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from schemagate.contract import CORRUPT, FAILED, ROW_ID
from schemagate.functions import sql
from schemagate.storage import delete_path, path_exists, read_text, write_text

VERSION = "version-"
PREVIOUS = "_previous"
"""A file in a version's folder that names the version before it."""


def load_valid(valid: DataFrame, table: str, *, path: str | None = None) -> int:
    """Replace ``table`` with the valid rows; gives the row count read back from the files.

    With no rows nothing stays written and an older table stays.  ``path`` is the folder that
    versions go to, in place of one beside the database's tables.
    """
    return _replace(valid.drop(CORRUPT, FAILED, ROW_ID), table, path)


def quarantine(invalid: DataFrame, table: str, *, path: str | None = None) -> int:
    """Replace ``table`` with the rejects, raw text or reason included.

    Rejects are mostly few per task, so they are gathered into files of a fair size; where
    a task holds very many they are spread out.  They are written once.
    """
    return _replace(invalid.drop(FAILED, ROW_ID).hint("rebalance"), table, path)


def lay_table(spark: SparkSession, schema: StructType, table: str, path: str) -> int:
    """Have ``table`` show the Parquet files at ``path``; gives their row count.

    A Parquet table of these columns is pointed there in one change.  One of other columns, another
    format or a view gives way to a new table, which is made under another name first; only then is
    there a moment between dropping the one and renaming the other.
    """
    rows = spark.read.schema(schema).parquet(path).count()
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
    elif _alike(spark, schema, table):
        spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION {sql.text(path)}")
        spark.catalog.refreshTable(table)
    else:
        _exchange(spark, schema, table, path)
    return rows


def _exchange(spark: SparkSession, schema: StructType, table: str, path: str) -> None:
    fresh = f"{table}_{uuid.uuid4().hex[:8]}"
    kind = "VIEW" if _facts(spark, table).get("Type") == "VIEW" else "TABLE"
    spark.catalog.createTable(fresh, path=path, source="parquet", schema=schema)
    try:
        spark.sql(f"DROP {kind} IF EXISTS {_quoted(table)}")
        spark.sql(f"ALTER TABLE {_quoted(fresh)} RENAME TO {_quoted(table)}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(fresh)}")
        raise


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table besides its columns."""
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect()}


def _alike(spark: SparkSession, schema: StructType, table: str) -> bool:
    facts = _facts(spark, table)
    plain = facts.get("Provider", "").lower() == "parquet" and "# Partition Information" not in facts
    columns = [[(f.name, f.dataType.simpleString()) for f in s.fields] for s in (schema, spark.table(table).schema)]
    return plain and facts.get("Type") == "EXTERNAL" and columns[0] == columns[1]


def _quoted(table: str) -> str:
    return sql.name(tuple(table.split(".")))


def _versions(spark: SparkSession, table: str) -> str:
    """Where a table's versions go: a folder beside its database's own tables."""
    *database, own = table.split(".")
    found = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{found.locationUri.rstrip('/')}/_versions/{own}"


def write_report(report: DataFrame, path: str) -> None:
    """One JSON file; the report is a single row."""
    report.coalesce(1).write.mode("overwrite").json(path)


def _replace(rows: DataFrame, table: str, path: str | None) -> int:
    """Write, see what is there, and take it into use or discard it."""
    spark = rows.sparkSession
    folder = (path or _versions(spark, table)).rstrip("/")
    version = f"{folder}/{VERSION}{uuid.uuid4().hex}"
    try:
        rows.write.parquet(version)
        written = spark.read.schema(rows.schema).parquet(version).count()
        if written:
            older = _facts(spark, table).get("Location") if spark.catalog.tableExists(table) else None
            if older:
                write_text(spark, f"{version}/{PREVIOUS}", older)
            lay_table(spark, rows.schema, table, version)
    except BaseException:
        delete_path(spark, version)
        raise
    if not written:
        delete_path(spark, version)
    elif older:
        _discard_before(spark, older, folder)
    return written


def _discard_before(spark: SparkSession, version: str, folder: str) -> None:
    """Remove the version before ``version``, if it is one of ``folder``."""
    note = f"{version}/{PREVIOUS}"
    gone = read_text(spark, note) if path_exists(spark, note) else ""
    if gone.rpartition("/")[2].startswith(VERSION) and gone.rpartition("/")[0].endswith(folder.partition(":")[2] or folder):
        delete_path(spark, gone)
