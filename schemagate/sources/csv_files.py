"""Flat CSV in the contract's all-string landing layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from schemagate.contract import CORRUPT, Contract
from schemagate.functions import sql
from schemagate.sources.csv_blocks import records_to_lines
from schemagate.sources.cutting import RECORD_END
from schemagate.storage import path_exists, removed_at_exit, scratch_path


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    *,
    carry: tuple[str, ...] = (),
    ragged: str = "permissive",
    strict_header: bool = False,
    multi_line: bool | str = False,
    escape: str = '"',
) -> DataFrame:
    """Scan CSV files with a header line, every column a string.

    ``carry`` names extra columns that lead the contract's own and are kept.
    Columns bind by position; ``strict_header`` fails the read on other names.
    ``ragged="permissive"`` pads short rows with nulls and cuts long ones;
    ``"reject"`` marks both in a ``_corrupt_record`` column holding the line.
    The first line of a file with text is its header, whatever it says, and no other is.
    ``escape`` is the file's dialect: ``"`` for doubled quotes, ``\\`` for backslashes.
    ``multi_line`` admits line breaks inside quotes, at the price of one task per file;
    ``"split"`` has tasks share files: their records are written out first, at once, to the
    shared folder until Python ends.  Files with stray quotes are read by one task still.
    """
    if ragged not in ("permissive", "reject"):
        raise ValueError(f"ragged must be 'permissive' or 'reject', not {ragged!r}")
    if multi_line not in (True, False, "split"):
        raise ValueError(f"multi_line must be True, False or 'split', not {multi_line!r}")
    schema = contract.flat(carry)
    if ragged == "reject":
        schema = schema.add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "escape": escape, "columnNameOfCorruptRecord": CORRUPT}
    if multi_line == "split":
        rows = _split(spark, path, schema, options, strict_header)
    else:
        reader = spark.read.schema(schema).options(header=True, enforceSchema=not strict_header, multiLine=multi_line, **options)
        rows = reader.csv(path)
    if ragged == "permissive" and not strict_header:
        return rows
    # Left to itself the scan parses, and checks in the header, only columns that are asked
    # for.  A generator takes in all of them, and no filter is pushed below it.
    return rows.select(F.inline(F.array(F.struct(*map(sql_column, rows.columns)))))


def _split(spark: SparkSession, path: str | list[str], schema: StructType, options: dict[str, str], strict_header: bool) -> DataFrame:
    """Multi-line files by records written out before, and those whose quotes don't allow that as they are."""
    taken = records_to_lines(spark, path, options["escape"], removed_at_exit(spark, scratch_path(spark, "csv-records")))
    lines = spark.read.schema(schema).options(lineSep=RECORD_END, recursiveFileLookup=True, **options)
    names = [c for c in schema.names if c != CORRUPT]
    if strict_header and path_exists(spark, taken.headers):
        other = F.lit(False)
        for name in names:
            other = other | ~F.lower(F.col(name)).eqNullSafe(F.lit(name.lower()))
        wrong = lines.csv(taken.headers).select(*names).where(other).first()
        if wrong:
            raise ValueError(f"the header is not that of the contract: {', '.join(map(str, wrong))}")
    rows = lines.csv(taken.records)
    if CORRUPT in rows.columns:
        # A line of blanks was put in quotes, or the scan would pass over it.
        rows = rows.withColumn(CORRUPT, F.regexp_replace(CORRUPT, r'^"(\s+)"$', "$1"))
    if taken.others:
        whole = spark.read.schema(schema).options(header=True, enforceSchema=not strict_header, multiLine=True, **options)
        rows = rows.unionByName(whole.csv(taken.others))
    return rows


def sql_column(column: str) -> Column:
    return F.col(sql.name(column))
