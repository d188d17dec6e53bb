"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code holds the signs of its components.  Codes are cut into m segments of about log2 of
their number in bits; two codes within Hamming distance m * (r + 1) - 1 of each other agree up to r
bits in one of the segments at least.  Round r looks, for the queries not done yet, at all segment values
that differ in r bits, and verifies the whole distance of the codes under them.  A query is done
when its k-th best verified distance is covered by the rounds so far, and the radius grows until
that is so: nothing is ever compared with all codes instead.

The index of a segment is dealt by the first bits of its values, and by a hash of the code where
many codes share them, into groups of about ``GROUP_CODES``; open queries, in blocks, go to the groups whose first bits
are near enough.  A group gives a query's best codes back, ``top + 1`` at most and none beyond its present
k-th distance, so what moves grows with groups and queries and not with codes met.

Equal codes are one entry that keeps its k + 1 smallest ids, all that can ever be answered, so
a group of copies costs as much as one vector.  Queries with equal codes are one query.

A query never answers itself; ties go to the smaller id.  Null vectors and null ids are neither
found nor asked; zero and null components count as not positive.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemagate.llm.common import Scratch, stored

BITS = 64
TOP = 10
QUERY_EVERY = 100
"""Rows whose id this divides are queries, against all rows."""
GROUP_CODES = 4_096
"""Codes of a segment that are looked through together, about."""
QUERY_BLOCK = 4_096
"""Queries that come to a group together."""
FOUND = "query long, code long, least long, n int, distance int"


def codes(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``code``: bit i is set where component i is positive, folded into 64 bits."""
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (i % BITS).cast("int"))).otherwise(F.lit(0).cast("long"))
    packed = F.aggregate(F.transform("embedding", bit), F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))
    return vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", packed.alias("code"))


def entries(coded: DataFrame, top: int) -> DataFrame:
    """Each code once, with its ``top + 1`` smallest ids.

    A code's rows are first cut down within hash buckets, so that no code's come together.
    """
    def least(rows: DataFrame, *by: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("code", *by).orderBy("vec_id"))
        return rows.withColumn("place", place).where(F.col("place") <= top + 1).drop("place")

    dealt = coded.distinct().withColumn("bucket", F.pmod(F.xxhash64("vec_id"), F.lit(256)))
    few = least(least(dealt, "bucket"))
    return few.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def segments_of(size: int) -> list[tuple[int, int]]:
    """Where each segment starts and how many bits it has, for so many codes."""
    number = min(8, max(2, round(BITS / math.log2(max(size, 2)))))
    ends = [BITS * n // number for n in range(number + 1)]
    return [(start, end - start) for start, end in zip(ends, ends[1:], strict=False)]


def searched(vectors: DataFrame, top: int = TOP, every: int = QUERY_EVERY) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``distance`` of each query's nearest."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    coded = scratch.stored(codes(vectors), "codes")
    known = scratch.stored(entries(coded, top), "entries")
    size = known.count()
    segments = segments_of(size)
    index = scratch.stored(_indexed(known, segments, size), "index")
    buckets = scratch.stored(index.select("segment", "bucket", "parts").distinct(), "buckets")
    queries = coded.where(F.col("vec_id") % every == 0).distinct()
    open_ = queries.select(F.col("code").alias("query"), F.lit(BITS).alias("within")).distinct()
    open_ = scratch.stored(open_, "queries")
    best = answers = spark.createDataFrame([], FOUND)
    radius, left = 0, open_.count() if size else 0
    while left:
        found = _met(open_, index, buckets, segments, radius, size, left, top)
        best = scratch.stored(_nearest(best.join(open_, "query", "left_semi").unionByName(found), top), "found")
        # An id may be the query's own, so one more than asked for has to be covered.
        reach = len(segments) * (radius + 1) - 1
        whole = radius == max(bits for _, bits in segments)
        covered = F.sum(F.when(F.col("distance") <= reach, F.col("n")).otherwise(0))
        enough = F.sum("n") > top
        state = best.groupBy("query").agg(((covered > top) | F.lit(whole)).alias("done"), F.when(enough, F.max("distance")).alias("last"))
        state = scratch.stored(state, "state")
        answers = answers.unionByName(best.join(state.where("done"), "query", "left_semi"))
        still = open_.join(state, "query", "left").where(~F.coalesce("done", F.lit(whole)))
        open_ = scratch.stored(still.select("query", F.coalesce("last", "within").alias("within")), "queries")
        left, radius = open_.count(), radius + 1
    with_ids = answers.join(known, "code").select("query", "distance", "ids")
    pairs = queries.select(F.col("vec_id").alias("query_id"), F.col("code").alias("query")).join(with_ids, "query")
    rows = pairs.select("query_id", "distance", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    result = rows.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "distance")
    result = stored(result, "nearest")
    scratch.remove()
    return result


def _segment(code: str, start: int, bits: int) -> Column:
    return F.shiftrightunsigned(code, start).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _first_bits(size: int, segments: list[tuple[int, int]]) -> int:
    """How many first bits of a segment's value tell its bucket."""
    return min(max(0, math.ceil(math.log2(max(1, size) / GROUP_CODES))), min(bits for _, bits in segments))


def _in_segments(code: str, segments: list[tuple[int, int]], first: int) -> Column:
    """``segment``, ``value`` and ``bucket`` of a code, once for each segment."""
    parts = (
        F.struct(F.lit(n).alias("segment"), _segment(code, *at).alias("value"), F.shiftrightunsigned(_segment(code, *at), at[1] - first).alias("bucket"))
        for n, at in enumerate(segments)
    )
    return F.inline(F.array(*parts))


def _indexed(known: DataFrame, segments: list[tuple[int, int]], size: int) -> DataFrame:
    """Every code under each of its segments' values; ``part`` deals buckets of many codes, ``parts`` is into how many."""
    spread = known.select("code", F.element_at("ids", 1).alias("least"), F.size("ids").alias("n"), _in_segments("code", segments, _first_bits(size, segments)))
    many = spread.groupBy("segment", "bucket").agg(F.ceil(F.count(F.lit(1)) / (2 * GROUP_CODES)).alias("parts"))
    part = F.pmod(F.xxhash64("code"), F.col("parts")).alias("part")
    return spread.join(many, ["segment", "bucket"]).select("segment", "bucket", part, "parts", "value", "code", "least", "n")


def _met(
    open_: DataFrame, index: DataFrame, buckets: DataFrame, segments: list[tuple[int, int]], radius: int, size: int, n_queries: int, top: int
) -> DataFrame:
    """The best codes of each query, per group, among those whose nearest segment differs in ``radius`` bits."""
    first, blocks = _first_bits(size, segments), -(-n_queries // QUERY_BLOCK)
    masks = [sum(1 << b for b in bits) for r in range(min(radius, first) + 1) for bits in combinations(range(first), r)]
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block")
    near = open_.select("query", "within", block, _in_segments("query", segments, first))
    near = near.withColumn("mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))))
    near = near.withColumn("bucket", F.col("bucket").bitwiseXOR(F.col("mask"))).drop("mask")
    near = near.join(buckets, ["segment", "bucket"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    codes_ = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    group = ["segment", "bucket", "part", "block"]

    def met(queries: pa.Table, held: pa.Table) -> pa.Table:
        rows = [np.empty((5, 0), np.int64)]
        if len(queries) and len(held):
            segment = queries.column("segment")[0].as_py()
            value, code, least, n = (held.column(c).to_numpy() for c in ("value", "code", "least", "n"))
            for query, own, within in zip(*(queries.column(c).to_pylist() for c in ("query", "value", "within")), strict=True):
                at = np.flatnonzero(np.bitwise_count(value ^ own) == radius)
                apart = code[at] ^ np.int64(query)
                distance = np.bitwise_count(apart.view(np.uint64)).astype(np.int64)
                keep = (distance <= within) & first_met(apart, segment, segments, radius)
                at, distance = at[keep], distance[keep]
                order = np.lexsort((least[at], distance))[: top + 1]
                at = at[order]
                rows.append(np.stack([np.full(len(at), query), code[at], least[at], n[at], distance[order]]))
        query, code, least, n, distance = np.hstack(rows)
        return pa.table({"query": query, "code": code, "least": least, "n": n.astype(np.int32), "distance": distance.astype(np.int32)})

    return near.groupBy(*group).cogroup(codes_.groupBy(*group)).applyInArrow(met, FOUND)


def first_met(apart: np.ndarray, segment: int, segments: list[tuple[int, int]], radius: int) -> np.ndarray:
    """Keep a code for one segment only: the first that differs in ``radius`` bits, none in fewer."""
    keep = np.ones(len(apart), bool)
    for n, (start, bits) in enumerate(segments):
        differ = np.bitwise_count((apart.view(np.uint64) >> np.uint64(start)) & np.uint64((1 << bits) - 1))
        keep &= differ > radius if n < segment else differ >= radius
    return keep


def _nearest(found: DataFrame, top: int) -> DataFrame:
    """The codes nearest to each query, as many as can hold its answers."""
    ordered = Window.partitionBy("query").orderBy("distance", "least")
    return found.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= top + 1).drop("place")


ORACLE = f"""
WITH codes AS (SELECT DISTINCT vec_id, list_reduce(list_transform(range(len(embedding)), lambda i:
    CASE WHEN embedding[i + 1] > 0 THEN (1::UBIGINT << (i % {BITS})::UBIGINT) ELSE 0::UBIGINT END), lambda a, b: xor(a, b)) AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(bit_count(xor(q.code, c.code)) AS INTEGER) AS distance
    FROM codes q JOIN codes c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id != c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {TOP}
"""
