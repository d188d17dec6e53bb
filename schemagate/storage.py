"""Where intermediate files go."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_folders: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without one; it gets a throw-away folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="schemagate-"))
    return _local_folders[0].name


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/schemagate-{label}-{uuid.uuid4().hex}"


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as any program on this machine names it, if it is in a mounted file system."""
    target, files = _located(spark, path)
    return target.toUri().getPath() if files.getUri().getScheme() == "file" else None


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """``path``, to be deleted when Python ends, if the session still runs then."""

    def remove() -> None:
        if spark.sparkContext._jsc is not None:
            delete_path(spark, path)

    atexit.register(remove)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target, files = _located(spark, path)
    files.delete(target, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs run inside."""
    before = spark.conf.getAll.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _located(spark, path)
    return files.exists(target)


def bytes_under(spark: SparkSession, path: str) -> int:
    """Bytes of all files in ``path``, which may be a pattern."""
    target, files = _located(spark, path)
    return sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(target) or [])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    target, files = _located(spark, path)
    part = target.suffix(f".{uuid.uuid4().hex}")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(part, target):
        raise OSError(f"{path} can't be written")


def read_text(spark: SparkSession, path: str) -> str:
    target, files = _located(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
