"""How filters interact: what each order of five filters removes, counted on a stream that retracts.

The files of a table are read as a stream of micro-batches that ends when all files present have
been read.  Each document becomes a small row: the hash of its text and a mask of the filters A to
D that it fails.  State is kept per text: the smallest id so far and how many documents of which
part have it.  They alone pass filter E.  When a smaller id arrives the state takes it over, and the
earlier documents' mask is retracted from the counters of their part and put back with E in it.
The counters are sums of such changes, so neither the order of files nor the size of
micro-batches shows in the result.  Every order of filters is then answered from the masks' counts.

Copies are combined within each task before they move: what arrives at a text's state is one row
per task, part and label, however many documents have the text, and the state is one id with a
count per part and label.  Changes are summed within each task too.  State, offsets and counters
are in the shared folder, so a lost executor costs the repetition of a task.

A document without text has an empty one.  Equal are texts of equal SHA-256.  A null id is smaller than none and
has no smaller one, so its document passes E and fails nobody.  Rows repeated with their id have no
smaller id either and count once each.  Parts are the values of ``source``, null being the empty
one.  A document is good or toxic if any row of labels says so.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from schemagate.llm.common import small_batches, stored
from schemagate.storage import bytes_under, delete_path, path_exists, scratch_path

FILTERS = "ABCDE"
LEAST_WORDS = 200
SYMBOLS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")

COMBINE_ROWS = 50_000
"""Rows that a task holds combined before it sends them on."""
MICRO_BATCHES = 2
"""What files are read in, about, however many there are; each one rewrites the states that it meets."""
BUCKET_ROWS = 1_000
"""Documents whose texts share a state, about; a call of a state function costs as much as 100 texts in it."""

DOCUMENT = "doc_id long, text string, source string"
JUDGED = "key binary, doc_id long, part string, mask int"
COMBINED = "key binary, mask int, part string, good boolean, toxic boolean, least long, at_least long, above long, without long"
CHANGES = "part string, mask int, good boolean, toxic boolean, change long"
STATE = "texts binary"
_COMBINED, _CHANGES = ([column.split()[0] for column in schema.split(", ")] for schema in (COMBINED, CHANGES))

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_NOT_FIRST = bytes(range(0x80, 0xC0))  # UTF-8 bytes that don't begin a character


def mask_of(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    characters = len(text.translate(None, _NOT_FIRST))
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < 50 * len(words),
        100 * capitals > 2 * characters,
        len(text) != len(text.translate(None, SYMBOLS)),
    )
    return sum(bit << n for n, bit in enumerate(failed))


def audited(spark: SparkSession, path: str, labels: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """``part``, ``filter_order``, ``step`` and what the step's filter does there, for all orders.

    ``path`` holds documents as Parquet.  ``batch_bytes`` bounds the files of a micro-batch; left
    out, it is what all cores read at once, or a few of the files' bytes if that is more.
    """
    return orders_of(mask_counts(spark, path, labels, batch_bytes))


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and ``n``, the documents that are so."""
    small_batches(spark)
    changes, progress = scratch_path(spark, "changes"), scratch_path(spark, "progress")
    try:
        _streamed(spark, path, flags_of(labels), batch_bytes or _batch_bytes(spark, path), changes, progress)
        if path_exists(spark, changes):
            found = spark.read.schema(CHANGES).parquet(changes)
        else:
            found = spark.createDataFrame([], CHANGES)
        counts = found.groupBy("part", "mask", "good", "toxic").agg(F.sum("change").alias("n"))
        return stored(counts.where("n != 0"), "masks")
    finally:
        delete_path(spark, changes)
        delete_path(spark, progress)


def flags_of(labels: DataFrame) -> DataFrame:
    """The labelled documents, one row each."""
    said = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    flags = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(said("quality"), said("toxic"))
    return stored(flags.select("doc_id", F.col("quality").alias("good"), "toxic", F.lit(0).cast("long").alias("salt")), "flags")


def _batch_bytes(spark: SparkSession, path: str) -> int:
    """A share of all files, so that the number of micro-batches does not follow the input."""
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    of_split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split)
    return max(of_split * spark.sparkContext.defaultParallelism, -(-bytes_under(spark, path) // MICRO_BATCHES))


def _streamed(spark: SparkSession, path: str, flags: DataFrame, batch_bytes: int, changes: str, progress: str) -> None:
    """Read all files in micro-batches and write what each changes in the counters."""
    # A path that is a pattern may be a file as well as a folder.
    at = path.rstrip("/")
    files = spark.readStream.schema(DOCUMENT).option("maxBytesPerTrigger", batch_bytes).parquet(f"{at[:-1]}[{at[-1]}]")
    judged = files.mapInArrow(_judged, JUDGED)
    # Rows without an id find no label; they are spread out by text.
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("key")).otherwise(F.lit(0).cast("long"))
    flagged = judged.withColumn("salt", salt).join(flags, ["doc_id", "salt"], "left")
    unless = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    sent = flagged.select("key", "mask", "part", unless("good"), unless("toxic"), "doc_id").mapInArrow(_combined, COMBINED)
    buckets = max(1, -(-spark.read.schema(DOCUMENT).parquet(path).count() // BUCKET_ROWS))
    bucketed = sent.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    changed = bucketed.groupBy("bucket").applyInPandasWithState(_retracted, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout)
    query = (
        changed.mapInArrow(_summed, CHANGES)
        .writeStream.format("parquet")
        .options(path=changes, checkpointLocation=progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary()),
                batch.column("doc_id"),
                batch.column("source").fill_null(""),
                pa.array(map(mask_of, texts), pa.int32()),
            ],
            ["key", "doc_id", "part", "mask"],
        )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _combined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text, part and label: the smallest id, and how many have it, a larger one, or none.

    Where none has an id, ``least`` is 0 and ``at_least`` too: pandas can't hold null beside whole numbers.
    """
    kinds = [pa.binary(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), *[pa.int64()] * 4]

    def sent() -> pa.RecordBatch:
        columns = zip(*((*key, least or 0, *n) for key, (least, *n) in held.items()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _COMBINED)

    held: dict[tuple, list] = {}
    for *key, doc_id in _rows(batches):
        value = held.setdefault(tuple(key), [None, 0, 0, 0])
        least = value[0]
        if doc_id is None:
            value[3] += 1
        elif least is None or doc_id < least:
            value[:3] = doc_id, 1, value[1] + value[2]
        elif doc_id == least:
            value[1] += 1
        else:
            value[2] += 1
        if len(held) >= COMBINE_ROWS:
            yield sent()
            held = {}
    if held:
        yield sent()


def taken_over(least: int | None, holders: dict[tuple, int], rows: list[tuple]) -> tuple[int | None, dict[tuple, int], dict[tuple, int]]:
    """The new state of a text, and what ``rows`` of ``COMBINED`` change in the counters.

    ``holders`` are the documents that have the smallest id: how many of which part and label.
    """
    smallest = min((r[5] for r in rows if r[6]), default=None)
    change: dict[tuple, int] = defaultdict(int)
    if least is None or (smallest is not None and smallest < least):
        for (part, good, toxic), n in holders.items():
            change[part, rows[0][1], good, toxic] -= n
            change[part, rows[0][1] | COPY, good, toxic] += n
        least, holders = smallest, {}
    else:
        holders = dict(holders)
    for _, mask, part, good, toxic, own, at_least, above, without in rows:
        late = above
        if at_least and own == least:
            holders[part, good, toxic] = holders.get((part, good, toxic), 0) + at_least
            without += at_least
        else:
            late += at_least
        change[part, mask, good, toxic] += without
        change[part, mask | COPY, good, toxic] += late
    return least, holders, change


def _retracted(bucket: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Bring the bucket's texts up to date; give what changes, summed over them."""
    texts: dict[bytes, tuple] = pickle.loads(state.get[0]) if state.exists else {}
    arrived: dict[bytes, list[tuple]] = defaultdict(list)
    for frame in frames:
        for row in pa.Table.from_pandas(frame, preserve_index=False).to_pylist():
            arrived[row["key"]].append(tuple(row[c] for c in _COMBINED))
    total: dict[tuple, int] = defaultdict(int)
    for key, rows in arrived.items():
        least, holders, change = taken_over(*texts.get(key, (None, {})), rows)
        if least is not None:
            texts[key] = least, holders
        for what, n in change.items():
            total[what] += n
    state.update((pickle.dumps(texts),))
    yield pd.DataFrame([(*what, n) for what, n in total.items()], columns=_CHANGES)


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple, int] = defaultdict(int)
    for *key, change in _rows(batches):
        total[tuple(key)] += change
    rows = [(*key, n) for key, n in total.items() if n]
    if rows:
        kinds = [pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, _CHANGES)


def _bits(letters: Column) -> Column:
    """The mask of the filters named."""
    bits = (F.when(F.contains(letters, F.lit(x)), F.lit(1 << n)).otherwise(F.lit(0)) for n, x in enumerate(FILTERS))
    return sum(bits, F.lit(0))


def orders_of(counts: DataFrame) -> DataFrame:
    """Each part's masks as what every step of every order keeps, removes and loses.

    A part has at most 32 masks, each with labels or not; all orders are read from these.
    """
    n = F.col("n")
    labelled = lambda c: F.sum(F.when(F.col(c), n).otherwise(F.lit(0))).alias(c)
    cells = counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), labelled("good"), labelled("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    steps = parts.select("part", "cells", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumn("own", _bits(F.substring("filter_order", F.col("step"), F.lit(1))))
    steps = steps.withColumn("before", _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))

    def total(of: str, name: str, test) -> Column:
        zero = F.lit(0).cast("long")
        add = lambda sum_, x: sum_ + F.when(test(x["mask"]), x[of]).otherwise(zero)
        return F.aggregate("cells", zero, add).alias(name)

    own, before = F.col("own"), F.col("before")
    fails = lambda m: m.bitwiseAND(own) != 0
    here = lambda m: fails(m) & (m.bitwiseAND(before) == 0)
    # Of a mask's filters each comes first in the same number of orders.
    first_in = lambda m: (F.lit(120) / F.bit_count(m)).cast("long")
    share = lambda sum_, x: sum_ + F.when(fails(x["mask"]), x["n"] * first_in(x["mask"])).otherwise(F.lit(0).cast("long"))
    return steps.select(
        "part", "filter_order", "step",
        total("n", "kept", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0),
        total("n", "removed", here),
        total("n", "redundant", lambda m: fails(m) & (m.bitwiseAND(before) != 0)),
        total("n", "unique_fails", lambda m: m == own),
        total("good", "good_lost", here),
        total("toxic", "toxic_lost", here),
        F.aggregate("cells", F.lit(0).cast("long"), share).alias("shapley"),
    )


ORACLE = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
fails AS (SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM texts t LEFT JOIN said s ON t.doc_id = s.doc_id),
long AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
    || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed FROM fails),
cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM long GROUP BY part, failed),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before
    FROM orders, range(1, 6) r(step)),
outcome AS (SELECT part, filter_order, step, own, failed, n, good, toxic, contains(failed, own) AS hit,
    length(translate(failed, before, '')) < length(failed) AS gone FROM cells, steps),
rows AS (SELECT part, filter_order, step, own, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
    sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (failed = own) AS unique_fails,
    sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(toxic) FILTER (hit AND NOT gone) AS toxic_lost
    FROM outcome GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM rows
"""
