"""Whole-document JSON: one object, or one array of records, per file.

The documents are turned into lines, one record each, with its text unchanged.  All files
are read once, in the blocks that Spark splits them into.  A file of a single block is cut where
it is read; small ones are read as a whole, as a reader of lines takes longer to set up than to
read them.  A block of a larger file does not know how it begins, in a string or not and how deep,
so it is cut as it most likely begins, and tells what it would take for that to be right: a small row.
In order, these rows tell how each block does begin.  What is left then are the pieces around
block edges, which are put together across tasks.  Files with a block that was cut wrongly, as
in the middle of a very long record, are cut a second time, as each block is then known to begin.
The rules are the same, so rows do not depend on file size, compression or split size.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from schemagate.sources import cutting
from schemagate.sources.cutting import (
    CHUNKS, EDGE, EDGES, LINE, MIXED, RECORD_END, RECUT_EDGE, STANDS, STATE, STATES, cut_blocks, cut_joined, pack_blocks, take_apart,
    take_whole,
)
from schemagate.storage import delete_path, path_exists, scratch_path, setting

# Largest record put together across blocks, in bytes, below what a row can hold.
RECORD_LIMIT = 1 << 30

# States of so many blocks are broadcast, a few MB; of more, text is shuffled to them.
BROADCAST_STATES = 100_000

# Text that a task cuts, about, where blocks are smaller than that and more than the cores need.
TASK_BYTES = 128 << 20

# Files that cost more to open than to read are read as a whole if they have no more bytes.
WHOLE_BYTES = 1 << 20

# Compressed text files cannot be split for reading, so none may grow without bound.
LINES_PER_FILE = 500_000

# The helpers travel with the plan, so executors need no installed package.
cloudpickle.register_pickle_by_value(cutting)

_FILE = ["file", "size"]
_BLOCK = [*_FILE, "block"]


@contextmanager
def taken_apart(spark: SparkSession, path: str | list[str]) -> Iterator[str]:
    """A folder with the documents' lines, for ``read_json(layout="cut")``; gone afterwards."""
    target = scratch_path(spark, "records")
    try:
        yield documents_to_lines(spark, path, target)
    finally:
        delete_path(spark, target)


def documents_to_lines(spark: SparkSession, path: str | list[str], target: str) -> str:
    """Write the records of all documents as lines that end in ``RECORD_END``.

    Text that is no record is a line too, behind a ``SET_APART`` mark that no JSON parser
    lets pass.  A path named twice is read once.  Gives the folder of the lines, which is
    below ``target``; that is removed if this fails.
    """
    if path_exists(spark, target):
        raise ValueError(f"{target} already exists")
    try:
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "8"), _small_files_together(spark):
            return _write_lines(spark, path, target)
    except BaseException:
        delete_path(spark, target)
        raise


def parts_to_lines(spark: SparkSession, parts: Iterator[str | list[str]], target: str) -> list[str]:
    """As ``documents_to_lines``, for paths that are there one after the other; gives a folder of lines for each."""
    if path_exists(spark, target):
        raise ValueError(f"{target} already exists")
    try:
        done = [documents_to_lines(spark, path, f"{target}/{number}") for number, path in enumerate(parts)]
        return done or [_no_lines(spark, f"{target}/0")]
    except BaseException:
        delete_path(spark, target)
        raise
    finally:
        if hasattr(parts, "close"):
            parts.close()


def _small_files_together(spark: SparkSession) -> AbstractContextManager[None]:
    """Opening a file counts as a small part of a split, however small splits are."""
    split, opening = (_size_of(spark, f"spark.sql.files.{x}") for x in ("maxPartitionBytes", "openCostInBytes"))
    return setting(spark, "spark.sql.files.openCostInBytes", str(min(opening, max(1, split // 32))))


def _size_of(spark: SparkSession, key: str) -> int:
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def _write_lines(spark: SparkSession, path: str | list[str], target: str) -> str:
    done, states, edges, recut = (f"{target}/kind={kind}" for kind in (LINE, STATE, EDGE, RECUT_EDGE))
    whole, small, files = _whole(spark, path)
    read = 0
    if _blocks(whole):
        counted = Observation()
        texts = _in_fewer_tasks(whole).observe(counted, F.count(F.lit(1)).alias("read"))
        _write(texts.mapInArrow(take_whole, MIXED), target)
        read = counted.get["read"]
    if read < files:
        fragments = _fragments(spark, path, ~small)
        _write(_in_fewer_tasks(fragments).mapInArrow(take_apart, MIXED), target)
    if path_exists(spark, states):
        stored = scratch_path(spark, "states")
        try:
            _beginnings(_read(spark, states, STATES)).write.parquet(stored)
            begun = spark.read.parquet(stored)
            wrong = [r.file for r in begun.where("NOT stands").select("file").distinct().collect()]
            right = begun.where(~F.col("file").isin(wrong)) if wrong else begun
            pieces = _settled(_read(spark, edges, EDGES), right)
            if wrong:
                for file in wrong:
                    delete_path(spark, f"{done}/of={file}")
                again = begun.where(F.col("file").isin(wrong))
                _write(_placed(fragments.where(F.col("file").isin(wrong)), again).mapInArrow(cut_blocks, MIXED), target)
                if path_exists(spark, recut):
                    pieces = pieces.unionByName(_read(spark, recut, EDGES))
            _write(_joined(pieces).mapInArrow(cut_joined, MIXED), target)
        finally:
            delete_path(spark, stored)
    return done if path_exists(spark, done) else _no_lines(spark, done)


def _no_lines(spark: SparkSession, path: str) -> str:
    _writer(spark.createDataFrame([], "value string")).text(path)
    return path


def _blocks(fragments: DataFrame) -> int:
    return fragments._jdf.queryExecution().toRdd().getNumPartitions()


def _leaf(files: DataFrame):
    return files._jdf.queryExecution().analyzed().collectLeaves().head()


def _in_fewer_tasks(fragments: DataFrame) -> DataFrame:
    """Small blocks one after the other in a task, so that no more files are written than text is worth."""
    spark = fragments.sparkSession
    blocks = _blocks(fragments)
    split, opening = (_size_of(spark, f"spark.sql.files.{x}") for x in ("maxPartitionBytes", "openCostInBytes"))
    # What opening counts for is no text: a split of tiny files holds next to nothing.
    text = _leaf(fragments).stats().sizeInBytes()
    worth = min(blocks * split, text + blocks * opening) // TASK_BYTES
    return fragments.coalesce(max(1, min(blocks, max(worth, 4 * spark.sparkContext.defaultParallelism))))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).text(path, lineSep=RECORD_END)
    return rows.select(F.inline(F.array(F.from_json("value", schema, {"mode": "FAILFAST"}))))


def _settled(edges: DataFrame, begun: DataFrame) -> DataFrame:
    """The pieces at the edges of blocks that were cut rightly, knowing now which block is a file's last.

    That one ends with a comma which its file did not have.
    """
    states = begun.select(*_BLOCK, "closing", "last")
    states = F.broadcast(states) if begun.count() <= BROADCAST_STATES else states
    ends = F.col("ends") & F.col("last")
    text = F.when(ends, F.substring("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    return edges.drop("closing").join(states, _BLOCK).select(*_BLOCK, "piece", text.alias("text"), "closing", "closes", "opens", ends.alias("ends"))


def _whole(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, Column, int]:
    """The text of files read as a whole; what is true for these: small, and not compressed; and how many files there are.

    Such a file is a single block in any case, as blocks are no smaller than what opening counts for.
    """
    meta = F.col("_metadata")
    files = spark.read.format("binaryFile").load(_paths(path))
    small = meta["file_size"] <= min(WHOLE_BYTES, _size_of(spark, "spark.sql.files.openCostInBytes"))
    for ending in _compressed(spark):
        small &= ~F.endswith(meta["file_name"], F.lit(ending))
    there = len(_leaf(files).relation().location().inputFiles())
    if there > len(files._jdf.inputFiles()):  # which has no file twice
        raise ValueError("a document is named by more than one path")
    if files.schema["content"].dataType != BinaryType():  # a folder is named content=...
        files, small = files.withColumn("content", F.lit(b"")), F.lit(False)
    return files.where(small).select(_as_characters("content").alias("value")), small, there


def _compressed(spark: SparkSession) -> list[str]:
    """The endings of files that Spark unpacks where it reads lines."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return [jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs]


def _paths(path: str | list[str]) -> list[str]:
    return list(dict.fromkeys([path] if isinstance(path, str) else path))


def _fragments(spark: SparkSession, path: str | list[str], of: Column | None = None) -> DataFrame:
    """Text up to each comma, with its file, block, and whether the block is the whole file."""
    meta = F.col("_metadata")
    files = spark.read.option("lineSep", ",").text(_paths(path))
    return (files if of is None else files.where(of)).select(
        F.xxhash64(meta["file_path"]).alias("file"),
        meta["file_size"].alias("size"),
        meta["file_block_start"].alias("block"),
        ((meta["file_block_start"] == 0) & (meta["file_block_length"] >= meta["file_size"])).alias("alone"),
        _as_characters("value"),
    )


def _as_characters(value: str) -> Column:
    """One character per byte, so that bytes that are no UTF-8 get through to their record."""
    return F.decode(F.col(value).cast("binary"), "ISO-8859-1").alias(value)


def _writer(lines: DataFrame) -> DataFrameWriter:
    return lines.write.options(lineSep=RECORD_END, compression="snappy", maxRecordsPerFile=LINES_PER_FILE)


def _write(mixed: DataFrame, target: str) -> None:
    value = F.encode("value", "ISO-8859-1").cast("string").alias("value")
    _writer(mixed.select(value, "kind", "of")).mode("append").partitionBy("kind", "of").text(target)


def _beginnings(states: DataFrame) -> DataFrame:
    """How each block begins, which depends on all blocks before it: one small row each; and if it was cut so."""
    in_order = Window.partitionBy(*_FILE).orderBy("block")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    copies = F.count(F.lit(1)).over(Window.partitionBy(*_BLOCK))
    once = F.when(copies > 1, F.raise_error(F.lit("a document is named by more than one path"))).otherwise(F.col("block"))
    net = F.when(F.col("in_string") == 0, F.col("net_out")).otherwise(F.col("net_in"))
    return (
        states.withColumn("block", once.cast("long"))
        .withColumn("in_string", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
        .withColumn("net", net)
        .withColumn("depth", F.coalesce(F.sum("net").over(earlier), F.lit(0)))
        .withColumn("closing", F.first("closing").over(in_order))
        .select(
            *_BLOCK,
            "in_string",
            "depth",
            "closing",
            F.lag("block").over(in_order).isNull().alias("first"),
            F.lead("block").over(in_order).isNull().alias("last"),
            F.expr(STANDS).alias("stands"),
        )
    )


def _placed(fragments: DataFrame, states: DataFrame) -> DataFrame:
    """The blocks that have a state, with it."""
    chunks = fragments.where(~F.col("alone")).mapInArrow(pack_blocks, CHUNKS)
    states = states.drop("stands")
    if states.count() <= BROADCAST_STATES:
        return chunks.join(F.broadcast(states), _BLOCK)
    return chunks.join(states.hint("shuffle_merge"), _BLOCK).sortWithinPartitions(*_BLOCK, "chunk")


def _joined(edges: DataFrame) -> DataFrame:
    """Records that reach across blocks, put together from their pieces.

    Which pieces belong together is found without their text, at two small rows a block.
    """
    piece = [*_BLOCK, "piece"]
    earlier = Window.partitionBy(*_FILE).orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    size = F.sum("chars").over(Window.partitionBy(*_FILE, "joint"))
    too_large = F.raise_error(F.concat(F.lit("a record or text without end is too large, in bytes: "), size.cast("string")))
    joints = (
        edges.select(*piece, "closes", F.length("text").alias("chars"))
        .withColumn("joint", F.coalesce(F.sum(F.col("closes").cast("int")).over(earlier), F.lit(0)))
        .select(*piece, F.when(size > RECORD_LIMIT, too_large.cast("long")).otherwise(F.col("joint")).alias("joint"))
    )
    return (
        edges.join(joints, piece)
        .groupBy(*_FILE, "joint", "closing")
        .agg(
            F.array_sort(F.collect_list(F.struct("block", "piece", "text"))).alias("parts"),
            F.max("opens").alias("opens"),
            F.max("ends").alias("ends"),
        )
        .select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "closing", "opens", "ends")
    )
