"""WARC records and a Merkle fixity audit of their replicas.

``manifest`` lays pages out as WARC records, each with its file and offset.  The audit hashes
every record, then groups of neighbouring records by offset range, level by level, up to one
root per file.  Roots of two replicas are joined; only children of nodes that differ are looked
at further, down to the records.  Hashing is spread over all records; what is joined after that
are digests, and below the roots only those on damaged branches.

Both replicas are read at the offsets of one manifest, so a record that is gone or changed
differs by itself and does not shift the others.  A null page is a record with an empty body.
Records that repeat an offset of a file are compared in order of digest.  Empty tables have no damage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemagate.llm.common import Scratch, stored

FILE_RECORDS = 2_000
"""Records of a WARC file, about."""
LEAF_BYTES = 1 << 18
"""Offset range of the lowest inner nodes."""
FANOUT = 8
"""Neighbouring ranges that a node of the next level covers."""
LEVELS = 5
"""Levels above the records: ranges of 256 KB, 2 MB, 16 MB, 128 MB, and the whole file."""
END = "\r\n\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """One response record in WARC 1.0, as text."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
    )
    return F.concat(head, F.lit(END), body, F.lit(END))


def manifest(pages: DataFrame, replicas: dict[str, Callable[[Column], Column]], file_records: int = FILE_RECORDS) -> DataFrame:
    """``file``, ``offset``, ``length``, ``page_id`` and ``url`` of each page's record, and per replica its SHA-256.

    A replica is what it makes of a record; null is a record that it has lost.  Pages are dealt
    to files by a hash of id and address, so that a file holds a bounded number.  Contents are
    hashed where they are read; lengths and digests are all that moves.
    """
    files = max(1, -(-pages.count() // file_records))
    content = record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages.select(
        F.pmod(F.xxhash64("page_id", "url"), F.lit(files)).alias("file"), "page_id", "url", content.alias("content")
    ).select(
        "file", "page_id", "url", F.octet_length("content").cast("long").alias("length"), F.sha2("content", 256).alias("__digest"),
        *(F.sha2(copy(F.col("content")), 256).alias(name) for name, copy in replicas.items()),
    )
    before = Window.partitionBy("file").orderBy("page_id", "__digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return rows.select("file", offset.alias("offset"), "length", "page_id", "url", *replicas)


def leaves(of: DataFrame, replica: str) -> DataFrame:
    """The records that a replica has: ``file``, ``offset`` and ``digest``."""
    return of.where(F.col(replica).isNotNull()).select("file", "offset", F.col(replica).alias("digest"))


def trees(records: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """A frame per level, records first: ``file``, ``node``, its ``parent`` and ``digest``.

    A node's digest covers its children's offsets and digests in order; one without any is absent.
    Each level is written once and the next one made from it, so that no level is made twice.
    """
    parent = F.floor(F.col("offset") / LEAF_BYTES)
    levels = [scratch.stored(records.select("file", F.col("offset").alias("node"), parent.alias("parent"), "digest"), "records")]
    for level in range(1, LEVELS + 1):
        inner = levels[-1].groupBy("file", "parent").agg(F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("below"))
        joined = F.array_join(F.transform("below", lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"])), "\n")
        above = F.floor(F.col("parent") / FANOUT) if level < LEVELS - 1 else F.lit(0)
        nodes = inner.select("file", F.col("parent").alias("node"), above.cast("long").alias("parent"), F.sha2(joined, 256).alias("digest"))
        levels.append(scratch.stored(nodes, "nodes"))
    return levels


def audited(first: DataFrame, second: DataFrame) -> DataFrame:
    """``file``, ``offset`` and both digests of each record that differs between two replicas' leaves.

    What differs on a level is written before the next is looked at.
    """
    scratch = Scratch(first.sparkSession)
    left, right = trees(first, scratch), trees(second, scratch)
    differing: DataFrame | None = None
    for a, b in zip(reversed(left), reversed(right), strict=True):
        if differing is not None:
            suspects = differing.select("file", F.col("node").alias("parent")).distinct()
            a, b = (x.join(suspects, ["file", "parent"], "left_semi") for x in (a, b))
        pairs = _numbered(a, "first").join(_numbered(b, "second"), ["file", "node", "copy"], "full")
        differing = scratch.stored(pairs.where(~F.col("first").eqNullSafe(F.col("second"))), "differing")
    found = stored(differing.select("file", F.col("node").alias("offset"), "first", "second"), "damage")
    scratch.remove()
    return found


def _numbered(nodes: DataFrame, name: str) -> DataFrame:
    copy = F.row_number().over(Window.partitionBy("file", "node").orderBy("digest"))
    return nodes.select("file", "node", copy.alias("copy"), F.col("digest").alias(name))


def damaged(content: Column) -> Column:
    """A copy with faults planted by page: a byte changed, the end cut off, the record lost."""
    fault = F.pmod(F.col("page_id"), F.lit(97))
    changed = F.concat(F.lit("w"), F.substring(content, 2, (1 << 31) - 1))
    cut = F.substring(content, F.lit(1), F.length(content) - 5)
    return F.when(fault == 3, changed).when(fault == 5, cut).when(fault == 7, F.lit(None)).otherwise(content)


ORACLE = """
SELECT page_id, url, CASE WHEN page_id % 97 = 7 THEN 'lost' ELSE 'changed' END AS fault
FROM pages WHERE page_id % 97 IN (3, 5, 7)
"""
