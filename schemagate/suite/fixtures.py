"""Inputs with known faults, derived from the whole ``orders`` table.

The SQL runs unchanged on Spark and DuckDB.  Faults sit on ``o_orderkey`` modulo primes,
so what a query must answer is a closed-form predicate.  The files Spark reads back are
written once per session into the shared folder.
"""

from __future__ import annotations

import gzip
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemagate.billing import FLAT
from schemagate.storage import delete_path, mounted_path, scratch_path, setting

FLAT_SQL = """
SELECT
  o_orderkey AS rec_id,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('BA-', CAST(o_custkey AS STRING)) END AS billing_account_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 'n/a' WHEN o_orderkey % 31 = 0 THEN '1e-05'
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS cost,
  CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
  CASE WHEN o_orderkey % 83 = 0 THEN 'bad' WHEN o_orderkey % 3 = 1 THEN '0.92' ELSE '1' END AS currency_conversion_rate,
  CAST(o_orderdate AS STRING) AS export_time,
  CASE WHEN o_orderkey % 79 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 'abc' WHEN o_orderkey % 71 = 0 THEN '209913'
       WHEN o_orderkey % 37 = 0 THEN '202213' WHEN o_orderkey % 41 = 0 THEN '202400'
       ELSE CAST(year(o_orderdate) * 100 + month(o_orderdate) + 2700 AS STRING) END AS invoice_month,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 'DIRECT' END AS invoice_publisher_type,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'not json' WHEN o_orderkey % 7 = 0 THEN '[]'
       ELSE concat('[{"key":"priority","value":"', o_orderpriority, '"}]') END AS labels,
  'us-east1' AS location,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('proj-', CAST(o_custkey % 10 AS STRING)) END AS project,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE concat('svc-', o_orderstatus) END AS service_id,
  concat('Service ', o_orderstatus) AS service_description,
  concat('sku-', substr(o_orderpriority, 1, 1)) AS sku_id,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE o_orderpriority END AS sku_description,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS usage_amount,
  CASE WHEN o_orderkey % 59 = 0 THEN 'x' ELSE '2.5' END AS usage_amount_in_pricing_units,
  'hour' AS usage_pricing_unit,
  'seconds' AS usage_unit,
  CASE WHEN o_orderkey % 43 = 0 THEN '1990-01-01 00:00:00'
       WHEN o_orderkey % 29 = 0 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 4), '-9-01 00:00:00')
       ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 23:59:59') END AS usage_end_time,
  CAST(o_orderdate AS STRING) AS usage_start_time
FROM orders
"""

JSON_SQL = """
SELECT o_orderkey AS rec_id,
  CASE WHEN o_orderkey % 206 = 0 THEN concat('{"cost":"', CAST(o_custkey AS STRING))
       WHEN o_orderkey % 103 = 0 THEN concat('{"billing_account_id":"BA-', CAST(o_custkey AS STRING), chr(92), 'u00e9')
       WHEN o_orderkey % 107 = 0 THEN '7'
       ELSE concat(
    '{"billing_account_id":', CASE WHEN o_orderkey % 101 = 0 THEN 'null' ELSE concat('"BA-', CAST(o_custkey AS STRING), '"') END,
    ',"cost":', CASE WHEN o_orderkey % 89 = 0 THEN '"n/a"' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END,
    ',"currency":"USD","currency_conversion_rate":', CASE WHEN o_orderkey % 83 = 0 THEN '"bad"' ELSE '1.0' END,
    ',"invoice":{"month":', CASE WHEN o_orderkey % 73 = 0 THEN '"202401"' WHEN o_orderkey % 71 = 0 THEN '209913'
                                 ELSE CAST(year(o_orderdate) * 100 + month(o_orderdate) + 2700 AS STRING) END, ',"publisher_type":"DIRECT"}',
    ',"labels":', CASE WHEN o_orderkey % 11 = 0 THEN '"x"' WHEN o_orderkey % 7 = 0 THEN '[]' ELSE concat('[{"key":"priority","value":"', o_orderpriority, '"}]') END,
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(',"project":"a }{ ', chr(92), '" b ', CAST(o_custkey % 10 AS STRING), '"') END,
    ',"service":', CASE WHEN o_orderkey % 67 = 0 THEN 'null' ELSE concat('{"description":"Service ', o_orderstatus, '","id":"svc-', o_orderstatus, '"}') END,
    ',"usage":{"amount":"1","amount_in_pricing_units":', CASE WHEN o_orderkey % 59 = 0 THEN '"2.5"' ELSE '2' END, ',"pricing_unit":"hour","unit":"seconds"}',
    ',"usage_end_time":"', CASE WHEN o_orderkey % 43 = 0 THEN '1990-01-01 00:00:00' ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 23:59:59') END,
    '","usage_start_time":"', CAST(o_orderdate AS STRING), '"}') END AS raw
FROM orders
"""

DOCUMENT_RECORDS = 2000
"""Keys per JSON document: documents grow in number with the data, not in size."""

LINES_PER_FILE = 20_000
"""Records per file of JSON lines: these are compressed, so a file is read by one task."""

BARE_FILES = 100_000
"""One-record files that there are at a time: each takes a block of the disk, some 4 KB, however little it holds."""

FILES_PER_FOLDER = 2000

_written: dict[tuple[str, str, str], str] = {}


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_orders(spark, sf_dir, FLAT_SQL)


def flat_csv(spark: SparkSession, sf_dir: str) -> str:
    """The flat fixture as CSV, ``rec_id`` leading."""
    return _once(
        spark, sf_dir, "flat",
        lambda path: flat(spark, sf_dir).write.csv(path, header=True, escape='"'),
    )


def contract_csv(spark: SparkSession, sf_dir: str) -> str:
    """The flat fixture as CSV in the contract's own 20 columns."""
    return _once(
        spark, sf_dir, "contract",
        lambda path: flat(spark, sf_dir).drop("rec_id").write.csv(path, header=True, escape='"'),
    )


def ragged_csv(spark: SparkSession, sf_dir: str) -> str:
    """Lines of 19, 20 and 21 fields in turn, each file under a header line."""

    def write(path: str) -> None:
        columns = [_quoted(c) for c in FLAT]
        short, full = F.concat_ws(",", *columns[:-1]), F.concat_ws(",", *columns)
        line = (
            F.when(F.col("rec_id") % 3 == 0, short)
            .when(F.col("rec_id") % 3 == 1, full)
            .otherwise(F.concat(full, F.lit(",surplus")))
        )
        # A one-column CSV whose name is the header line; no separator or quote applies.
        rows = flat(spark, sf_dir).select(line.alias(",".join(FLAT)))
        rows.write.csv(path, header=True, sep="\u0001", quote="\u0000", escape="\u0000")

    return _once(spark, sf_dir, "ragged", write)


def json_lines(spark: SparkSession, sf_dir: str) -> str:
    """One record a line; compressed, as the text is many times the size of its table."""

    def write(path: str) -> None:
        lines = _from_orders(spark, sf_dir, JSON_SQL).select("raw")
        lines.write.option("maxRecordsPerFile", LINES_PER_FILE).text(path, compression="snappy")

    return _once(spark, sf_dir, "lines", write)


def json_documents(spark: SparkSession, sf_dir: str, *, compressed: bool = False) -> str:
    """Array files; a truncated record, which would take all behind it along, is a file's only one.

    Compressed files are read whole, by one task each; the others in blocks.
    """

    def write(path: str) -> None:
        rows = _from_orders(spark, sf_dir, JSON_SQL)
        cut_off = F.col("rec_id") % 103 == 0
        arrays = (
            rows.where(~cut_off)
            .groupBy(F.floor(F.col("rec_id") / DOCUMENT_RECORDS))
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("raw"), ",\n"), F.lit("]")).alias("value"))
            .select("value")
        )
        alone = rows.where(cut_off).select(F.concat(F.lit("["), "raw").alias("value"))
        _a_file_each(arrays.union(alone), path, compressed)

    return _once(spark, sf_dir, "documents-gz" if compressed else "documents", write)


def json_bare_documents(spark: SparkSession, sf_dir: str) -> str:
    """Each record a file of its own, without an array around it; all in one folder, for small tables."""

    def write(path: str) -> None:
        rows = _from_orders(spark, sf_dir, JSON_SQL).select(F.col("raw").alias("value"))
        _a_file_each(rows.repartition(4 * spark.sparkContext.defaultParallelism), path)

    return _once(spark, sf_dir, "bare", write)


def json_bare_parts(spark: SparkSession, sf_dir: str) -> Iterator[list[str]]:
    """The same files, ``BARE_FILES`` of them at a time: the folders of these, gone when the next are asked for."""

    def write(path: str) -> None:
        rows = _from_orders(spark, sf_dir, JSON_SQL).select(F.col("raw").alias("value"))
        rows.write.option("maxRecordsPerFile", FILES_PER_FOLDER).parquet(path)

    texts = _once(spark, sf_dir, "bare-texts", write)
    name = F.col("_metadata.file_name").alias("name")
    counts = spark.read.schema("value string").parquet(texts).groupBy(name).count().orderBy("name").collect()
    before = 0
    parts: list[tuple[int, str]] = []
    for name, count in counts:
        # What would go beyond a part begins the next one.
        if before % BARE_FILES + count > BARE_FILES:
            before += -before % BARE_FILES
        parts.append((before // BARE_FILES, f"{texts}/{name}"))
        before += count
    path = scratch_path(spark, "bare")
    spare: list[str] = []
    try:
        for _, files in groupby(parts, key=lambda x: x[0]):
            own = [file for _, file in files]
            # A task for each file of texts, which are far smaller than a split.
            with setting(spark, "spark.sql.files.minPartitionNum", str(len(own))):
                values = spark.read.schema("value string").parquet(*own)
                folders, spare = _in_folders(values, path, spare)
            yield [f"{path}/{name}" for name in folders]
            spare = folders + spare
    finally:
        _remove(spark, path)


def _in_folders(values: DataFrame, path: str, spare: list[str]) -> tuple[list[str], list[str]]:
    """Each ``value`` as a file that ends with a line break, in folders of ``FILES_PER_FOLDER``; and what is left of ``spare``.

    The files in ``spare`` folders are no longer needed.  On a mounted folder they are written over,
    as making and deleting files takes most of the time.  A task gives a folder a name of its own,
    so what one wrote that is run again is not among the folders given.
    """
    spark, most = values.sparkSession, FILES_PER_FOLDER
    folder = mounted_path(spark, path)
    if folder is None:
        for name in spare:
            delete_path(spark, f"{path}/{name}")
        _a_file_each(values, f"{path}/{(name := uuid.uuid4().hex)}")
        return [name], []
    os.makedirs(folder, exist_ok=True)
    tasks = values._jdf.queryExecution().toRdd().getNumPartitions()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, inside = TaskContext.get(), 0, ""
        old, taken, made = iter(spare[task.partitionId() :: tasks]), [], []
        for batch in batches:
            for value in batch.column("value").cast(pa.binary()).to_pylist():
                if count % most == 0:
                    made.append(f"{task.taskAttemptId()}-{len(made)}")
                    inside = f"{folder}/{made[-1]}"
                    taken.append(next(old, None))
                    try:
                        os.rename(f"{folder}/{taken[-1]}", inside)
                    except FileNotFoundError:
                        os.mkdir(inside)
                with os.fdopen(os.open(f"{inside}/{count % most}.txt", os.O_WRONLY | os.O_CREAT, 0o666), "wb") as file:
                    file.write((value or b"") + b"\n")
                    file.truncate()
                count += 1
        surplus = count % most
        while surplus and os.path.exists(f"{inside}/{surplus}.txt"):
            os.unlink(f"{inside}/{surplus}.txt")
            surplus += 1
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()), pa.array(taken, pa.string())], ["made", "taken"])

    rows = values.mapInArrow(write, "made string, taken string").collect()
    taken = {row.taken for row in rows}
    return [row.made for row in rows], [name for name in spare if name not in taken]


def _remove(spark: SparkSession, path: str) -> None:
    """The folders in ``path``, by tasks if they are mounted, and then ``path``."""
    folder = mounted_path(spark, path)
    inside = [f"{folder}/{name}" for name in os.listdir(folder)] if folder and os.path.isdir(folder) else []
    if inside:
        spark.sparkContext.parallelize(inside, len(inside)).foreach(lambda x: shutil.rmtree(x, ignore_errors=True))
    delete_path(spark, path)


def _a_file_each(values: DataFrame, path: str, compressed: bool = False) -> None:
    """Each ``value`` as a file that ends with a line break.

    Without its native library Hadoop starts two processes for each local file, so on a mounted
    folder the tasks write the files themselves.  A task that is run again writes the same names.
    """
    folder = mounted_path(values.sparkSession, path)
    if folder is None:
        codec = "gzip" if compressed else "none"
        values.write.option("maxRecordsPerFile", 1).text(path, compression=codec)
        return
    os.makedirs(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get(), 0
        # Spark's readers pass over hidden files.
        part = f"{folder}/.{task.partitionId()}-{task.taskAttemptId()}"
        for batch in batches:
            for value in batch.column("value").cast(pa.binary()):
                text = (value.as_py() or b"") + b"\n"
                with open(part, "wb") as file:
                    file.write(gzip.compress(text, 1) if compressed else text)
                os.replace(part, f"{folder}/{task.partitionId():05d}-{count}.txt{'.gz' if compressed else ''}")
                count += 1
        yield pa.RecordBatch.from_pydict({"files": [count]})

    values.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def headed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Files whose header has other names, with the contract's own header as a line among the rows."""

    def write(path: str) -> None:
        header = ",".join(FLAT)
        line = F.concat_ws(",", *[_quoted(c) for c in FLAT])
        lines = F.when(F.col("rec_id") % 1009 == 0, F.array(F.lit(header), line)).otherwise(F.array(line))
        rows = flat(spark, sf_dir).select(F.explode(lines).alias(header.upper()))
        rows.write.csv(path, header=True, sep="\u0001", quote="\u0000", escape="\u0000")

    return _once(spark, sf_dir, "headed", write)


def _from_orders(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("schemagate_orders")
    return spark.sql(sql.replace("FROM orders", "FROM schemagate_orders"))


def _quoted(column: str):
    text = F.concat(F.lit('"'), F.replace(F.col(column), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(text, F.lit(""))


def _once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]
