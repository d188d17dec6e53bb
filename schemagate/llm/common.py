"""What several operators share: walking Arrow batches, hashing words, spreading ranks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schemagate.storage import delete_path, scratch_path

pa.set_memory_pool(pa.system_memory_pool())  # workers give back what a batch took


def give_back_arrays() -> None:
    """Have glibc map arrays of some MB in this process, so that a worker gives them back when freed.

    By itself it stops mapping blocks as large as those freed before, and keeps them in its heap.
    """
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        map_threshold, trim_threshold = -3, -1
        libc.mallopt(map_threshold, 4 << 20)
        libc.mallopt(trim_threshold, 8 << 20)


WORD = r"[^\x20\x09-\x0D]+"
"""A word, as Spark's and DuckDB's patterns write it; ``bytes.split()`` cuts at the same six bytes."""

CHUNK_BYTES = 2 << 20
"""Text that a task holds as words at a time; a longer text is a chunk of its own."""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 8 << 20
"""Most bytes that Spark sends a Python worker at a time; results do not depend on it."""


class Scratch:
    """Stored tables that are removed once what they lead to has been stored."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, label))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def remove(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, so that their names can't clash with an operator's."""
    return F.struct(*(F.col(quoted(c)).alias(c) for c in df.columns))


def small_batches(spark: SparkSession) -> None:
    """Have whole texts and sets reach Python in smaller batches than 64 MB, unless the session says how large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def text_chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose ``text`` columns hold about ``limit`` bytes each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LOWEST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LANE_BYTES = 64
"""Longer words are hashed one by one, the others eight bytes at a time, all together."""
RUN_BYTES = 1 << 20
"""Text whose words are hashed together, about: their places take several times its size."""


def hashed_words(texts: list[bytes | None], lower: bool = False, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in one row, and where each text ends in it.

    A hash depends on the bytes of its word alone.  ``blank`` says of each byte whether words end there,
    as they must at a space.
    """
    parts, begin, size = [], 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text or b"")
        if size >= RUN_BYTES or i == len(texts):
            parts.append(_hashed_run(texts[begin:i], lower, blank))
            begin, size = i, 0
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    before = np.cumsum([0, *(len(hashes) for hashes, _ in parts)])
    return np.concatenate([hashes for hashes, _ in parts]), np.concatenate([ends + n for (_, ends), n in zip(parts, before)])


def _hashed_run(texts: list[bytes | None], lower: bool, blanks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    joined = b" ".join([text or b"" for text in texts] + [b" " * 8])
    joined = joined.lower() if lower else joined
    data = np.frombuffer(joined, np.uint8)
    blank = blanks[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    edges = edges if blank[0] else np.insert(edges, 0, 0)
    begin, size = edges[::2], edges[1::2] - edges[::2]
    upto = np.cumsum([len(text or b"") + 1 for text in texts], dtype=np.int64)
    lanes = np.ndarray(len(data) - 7, "<u8", joined, strides=(1,))
    hashes = mixed(size.astype(np.uint64))
    word, at = np.flatnonzero(size <= LANE_BYTES), 0
    while len(word):
        lane = lanes[begin[word] + at] & _LOWEST_BYTES[np.minimum(size[word] - at, 8)]
        hashes[word] = mixed(hashes[word] ^ lane)
        at += 8
        word = word[size[word] > at]
    for long in np.flatnonzero(size > LANE_BYTES).tolist():
        hashes[long] = xxhash.xxh3_64_intdigest(joined[begin[long] : begin[long] + size[long]])
    return hashes, np.searchsorted(begin, upto)


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers that spreads them evenly."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each ``width`` neighbouring word hashes, built by joining halves."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    count = len(words) - width + 1
    power, size = words, 1  # hashes of all windows of ``size`` words
    result, done = None, 0
    while True:
        if width & size:
            piece = power[done : done + count]
            result = piece if result is None else result * _power(size) + piece
            done += size
        if done == width:
            return mixed(result)
        power = power[:-size] * _power(size) + power[size:]
        size *= 2


def owners(ends: np.ndarray) -> np.ndarray:
    """The index of the text that each word belongs to."""
    return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


def covered(starts: np.ndarray, lengths: np.ndarray | int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def ranked(df: DataFrame, keys: list[str], order: list[Column], rank: str, per_bucket: int = 50_000) -> DataFrame:
    """Number the rows of each key from 0 without bringing a key's rows to one task.

    Rows are dealt into hash buckets by their order columns; a row's number is what the
    earlier buckets of its key hold plus its place in its own.  Order is by bucket first.
    """
    buckets = max(1, -(-df.count() // per_bucket))
    b, before = f"__{rank}_bucket", f"__{rank}_before"
    dealt = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    by = keys or [F.lit(1)]
    counts = dealt.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, b, F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias(before))
    inside = Window.partitionBy(*keys, b).orderBy(*order)
    joined = dealt.join(counts, [*keys, b])
    return joined.withColumn(rank, F.row_number().over(inside) - 1 + F.col(before)).drop(b, before)
