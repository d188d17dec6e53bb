"""Nested JSON in the contract's target layout, judged record by record."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemagate.contract import CORRUPT, Contract
from schemagate.sources.cutting import SET_APART
from schemagate.sources.documents import RECORD_END, documents_to_lines, parts_to_lines
from schemagate.storage import removed_at_exit, scratch_path


def read_json(
    spark: SparkSession,
    path: str | list[str] | Iterator[str | list[str]],
    contract: Contract,
    *,
    layout: str = "lines",
    lines_path: str | None = None,
) -> DataFrame:
    """Target columns plus ``_corrupt_record``, which holds a bad record's text.

    ``lines``: one record per line; blank lines are skipped.
    ``document``: each file holds one object or one array of records, which may be spread
    over lines.  Their records are written out as lines first, at once, to ``lines_path``,
    which is yours, or else to the shared folder until Python ends.  An iterator gives paths in
    turn: the files of one are not needed any more when it is asked for the next.
    ``cut``: the folder that ``taken_apart`` gives, for which it says how long it stays.
    """
    if layout == "lines":
        return _scan(spark, path, contract)
    if layout not in ("document", "cut"):
        raise ValueError(f"layout must be 'lines', 'document' or 'cut', not {layout!r}")
    written = path
    if layout == "document":
        target = lines_path or removed_at_exit(spark, scratch_path(spark, "records"))
        written = (parts_to_lines if isinstance(path, Iterator) else documents_to_lines)(spark, path, target)
    # Lines of one file lie in a folder of their own.
    records = _scan(spark, written, contract, lineSep=RECORD_END, recursiveFileLookup="true")
    corrupt = F.col(CORRUPT)
    restored = F.translate(F.substring(corrupt, 2, 2147483647), SET_APART, RECORD_END)
    return records.withColumn(
        CORRUPT, F.when(F.startswith(corrupt, F.lit(SET_APART)), restored).otherwise(corrupt)
    )


def _scan(spark: SparkSession, path: str | list[str], contract: Contract, **options: str) -> DataFrame:
    """JSON scan whose verdict does not depend on what a query goes on to select.

    Left to itself the scan parses only the columns asked for, and a record that is bad
    elsewhere passes as valid.  A generator takes in all columns, so all are parsed; nor
    does the optimizer push a filter on the verdict below it.
    """
    rows = (
        spark.read.schema(contract.target_with_corrupt)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
        .json(path)
    )
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))
