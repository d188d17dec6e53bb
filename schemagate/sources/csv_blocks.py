"""Multi-line CSV in blocks: records with line breaks inside quotes, from files that are split for reading.

Whether a line begins inside quotes depends on how many quotes stand before it, odd or even.  A first
pass over the blocks that Spark splits files into counts that per block, on the JVM; summed up in
order it says how each block begins.  A second pass puts the lines of each block together to records
and writes them as lines that end in ``RECORD_END``; records that reach across blocks are joined from
their pieces.  So any number of tasks shares a file.

Counting holds where quotes stand around whole fields.  A file with a record where they don't, or
with a ``RECORD_END`` in it, is left to a reader that takes it from its start: ``others`` names it.
Lines end in LF, or all in CR LF, which is LF inside a field then, as a reader of whole files has it.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schemagate.sources.cutting import RECORD_END
from schemagate.storage import delete_path, path_exists, scratch_path, setting

LINE, HEADER, IMPROPER, EDGE = "line", "header", "improper", "edge"
ROWS = "value string, kind string, of long"
PIECE = "file long, block long, tail boolean, opens boolean, text string"

# The helpers travel with the plan, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCKS = 1_000_000
"""Most blocks of files whose states are broadcast, some 100 MB."""


class Taken(NamedTuple):
    records: str
    """Folder of the records, in a folder per file."""
    headers: str
    """Folder of the files' header records, which may be missing."""
    others: list[str]
    """Files that have to be read whole."""


def records_to_lines(spark: SparkSession, path: str | list[str], escape: str, target: str) -> Taken:
    """Write the records of multi-line CSV files as lines below ``target``, which must be new."""
    if path_exists(spark, target):
        raise ValueError(f"{target} already exists")
    records, headers, improper, edges = (f"{target}/kind={kind}" for kind in (LINE, HEADER, IMPROPER, EDGE))
    try:
        lines = _lines(spark, path, escape)
        states = scratch_path(spark, "states")
        try:
            _states(lines).write.parquet(states)
            begun = spark.read.parquet(states)
            if begun.count() > BLOCKS:
                raise ValueError(f"more than {BLOCKS} blocks; set spark.sql.files.maxPartitionBytes higher")
            placed = lines.drop("quotes").join(F.broadcast(begun), ["file", "block"])
            _write(placed.mapInArrow(_records_of(escape), ROWS), target)
        finally:
            delete_path(spark, states)
        if path_exists(spark, edges):
            _write(_joined(_read(spark, edges)).mapInArrow(_records_joined(escape), ROWS), target)
        wrong = []
        if path_exists(spark, improper):
            rows = spark.read.option("recursiveFileLookup", True).text(improper, lineSep=RECORD_END)
            wrong = [int(r.value) for r in rows.distinct().collect()]
            for file in wrong:
                delete_path(spark, f"{records}/of={file}")
                delete_path(spark, f"{headers}/of={file}")
        others = lines.where(F.col("file").isin(wrong)).select("path").distinct().collect() if wrong else []
        if not path_exists(spark, records):
            spark.createDataFrame([], "value string").write.text(records)
        return Taken(records, headers, sorted(r.path for r in others))
    except BaseException:
        delete_path(spark, target)
        raise


def _lines(spark: SparkSession, path: str | list[str], escape: str) -> DataFrame:
    meta = F.col("_metadata")
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    lines = spark.read.option("lineSep", "\n").text(list(dict.fromkeys([path] if isinstance(path, str) else path))).select(
        meta["file_path"].alias("path"), F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("block"), text.alias("value")
    )
    return lines.withColumn("quotes", _quotes(F.col("value"), escape))


def _quotes(text: Column, escape: str) -> Column:
    """Quotes that open or close, as far as odd or even goes: a doubled one does both."""
    if escape != '"':
        text = F.regexp_replace(text, f"(?s){re.escape(escape)}.", "")
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))).cast("long")


def _states(lines: DataFrame) -> DataFrame:
    """Of each block, whether it begins inside quotes and whether no text comes before it: one small row."""
    text = F.max(F.trim(F.replace(F.col("value"), F.lit("\r"), F.lit(""))) != "")
    blocks = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"), text.alias("text"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return blocks.select("file", "block", inside.alias("inside"), (~F.coalesce(F.max("text").over(before), F.lit(False))).alias("fresh"))


def _write(rows: DataFrame, target: str) -> None:
    value = F.encode("value", "ISO-8859-1").cast("string").alias("value")
    writer = rows.select(value, "kind", "of").write.mode("append").options(lineSep=RECORD_END, compression="snappy")
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "32"):
        writer.partitionBy("kind", "of").text(target)


def _read(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).text(path, lineSep=RECORD_END)
    return rows.select(F.inline(F.array(F.from_json("value", PIECE, {"mode": "FAILFAST"}))))


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that reach across blocks: a tail, whole blocks maybe, and the head that closes it."""
    order = Window.partitionBy("file").orderBy("block", "tail")
    begun = F.sum(F.col("tail").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = F.array_sort(F.collect_list(F.struct("block", "tail", "text")))
    grouped = pieces.withColumn("joint", begun).groupBy("file", "joint").agg(parts.alias("parts"), F.max("opens").alias("opens"))
    return grouped.select("file", "opens", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))


def proper(escape: str) -> str:
    """A record of fields that have quotes around them or none."""
    inside = r'(?:[^"]|"")*' if escape == '"' else rf'(?:[^"{re.escape(escape)}]|{re.escape(escape)}.)*'
    field = rf'(?:"{inside}"|[^",]*)'
    return rf"(?s)\A{field}(?:,{field})*\z"


class _Out:
    """Records on their way out, checked and without the breaks that only end them."""

    def __init__(self, escape: str):
        self.proper = proper(escape)

    def batch(self, file: int, records: pa.Array, headers: int = 0) -> Iterator[pa.RecordBatch]:
        """``headers``: how many of the first records with text are headers."""
        records = pc.replace_substring(pc.replace_substring_regex(records, "\r\\z", ""), "\r\n", "\n")
        good = pc.and_(pc.match_substring_regex(records, self.proper), pc.invert(pc.match_substring(records, RECORD_END)))
        if not pc.all(good, min_count=0).as_py():
            yield self._rows([str(file)], IMPROPER, file)
        records = records.filter(pc.not_equal(records, ""))
        if headers and len(records):
            texts = np.flatnonzero(pc.not_equal(pc.utf8_trim_whitespace(records), "").to_numpy(zero_copy_only=False))
            if len(texts):
                yield self._rows(records.slice(texts[0], 1), HEADER, file)
                records = records.slice(texts[0] + 1)
        # A line of blanks alone is a record to a reader of whole files; unquoted, others pass over it.
        blank = pc.equal(pc.utf8_trim_whitespace(records), "")
        records = pc.if_else(blank, pc.binary_join_element_wise('"', records, '"', ""), records)
        if len(records):
            yield self._rows(records, LINE, file)

    @staticmethod
    def _rows(values, kind: str, file: int) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([kind] * n), pa.array([file] * n, pa.int64())], ["value", "kind", "of"])

    @staticmethod
    def piece(file: int, block: int, tail: bool, opens: bool, text: str) -> pa.RecordBatch:
        return _Out._rows([json.dumps({"file": file, "block": block, "tail": tail, "opens": opens, "text": text})], EDGE, file)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array]]:
    """Runs of lines of one block, in row order, some to a block."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
        change = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for start, stop in zip([0, *change], [*change, batch.num_rows], strict=True):
            if stop > start:
                key = tuple(batch.column(c)[int(start)].as_py() for c in ("file", "block", "inside", "fresh"))
                yield key, batch.column("value").slice(start, stop - start)


def _records_of(escape: str):
    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(escape)
        for (file, block, inside, fresh), run in groupby(_runs(batches), key=lambda x: x[0]):
            held: list[str] = []
            begun_before, odd = inside, int(inside)
            for _, lines in run:
                quotes = _count(lines, escape)
                after = (odd + np.cumsum(quotes)) & 1
                ends = np.flatnonzero(after == 0) + 1
                odd = int(after[-1])
                if not len(ends):
                    held += lines.to_pylist()
                    continue
                first = "\n".join([*held, *lines.slice(0, ends[0]).to_pylist()])
                rest = lines.slice(ends[0], ends[-1] - ends[0])
                held = lines.slice(ends[-1]).to_pylist()
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), rest), "\n")
                if begun_before:
                    # It closes what an earlier block began.
                    yield out.piece(file, block, False, False, first)
                    begun_before = False
                else:
                    joined = pa.concat_arrays([pa.array([first], pa.string()), joined])
                for batch in out.batch(file, joined, int(fresh)):
                    fresh = fresh and HEADER not in batch.column("kind").to_pylist()[:1]
                    yield batch
            if held:
                yield out.piece(file, block, not begun_before, bool(fresh) and not begun_before, "\n".join(held))

    return records


def _count(lines: pa.Array, escape: str) -> np.ndarray:
    if escape != '"':
        lines = pc.replace_substring_regex(lines, f"(?s){re.escape(escape)}.", "")
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)


def _records_joined(escape: str):
    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(escape)
        for batch in batches:
            for row in batch.to_pylist():
                yield from out.batch(row["file"], pa.array([row["text"]], pa.string()), int(row["opens"]))

    return records
