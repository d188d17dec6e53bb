"""Near-duplicates by bottom-k sketches from one hash function.

A document is the set of the hashes of its word shingles.  Its sketch are its k smallest, with
k = 2 * (1 - t) * n + 2 of n, and what is listed are neighbours in it: each value with the next
one.  Two sets with a Jaccard similarity of t share such a pair: if a holds x values that b
lacks, and b has y that a lacks, at most 2x + y pairs of a are broken, and by t that is no more
than 2 * (1 - t) * n.  So no link is missed, while a passage that documents share gives few
common pairs, as their own values come between.  Shingles that very many documents hold are put
last in the order, for whichever order, the bound is the same.

1. ``sets``: each document's set, written once.  Equal sets are one node from here on.
2. ``lists``: pairs of sketch values dealt by ranges of hashes; those of a single node are dropped.
3. Families: each list has a centre, and each node goes with the centre that it shares most
   lists with, or else joins the family that it shares most lists with.  A family is dealt into
   blocks; tasks compare two blocks on full sets and give what is connected, not the pairs.
4. Across families: lists that hold several give the pairs between these.  Pairs that can't reach
   t by the bound above are left out.  Where neither set holds a frequent shingle, sketches are
   random draws and their overlap estimates the similarity: pairs more than seven standard
   deviations below t are left out as well.  The others are verified on full sets.

Hashes are 64 bits for a set and 48 for a shingle: two shingles of compared documents are
mistaken with probability 2**-48, any two of N sets with N * N / 2**65.

Null texts and texts without words have no shingle and are linked with nothing.  Repeated rows
are documents of their own with equal sets.  A null ``doc_id`` counts as larger than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemagate.llm.common import WORD, Scratch, as_row, byte_texts, give_back_arrays, hashed_words, mixed, small_batches, stored, text_chunks, window_hashes
from schemagate.llm.components import components

give_back_arrays()

WIDTH = 4
PERCENT = 80
"""Shingle width in words and least similarity in percent; the corpus pipeline takes 5 words."""

HOT_VALUES = 1 << 16
"""At most so many of the most frequent shingles are put last; an order, so it changes no result."""
HOT_IN_TASK, HOT_IN_ALL = 3, 24
"""Documents that must hold a shingle, in a task and in all, before it counts as frequent."""
LIST_ENTRIES = 750_000
"""Sketch values per bucket of inverted lists: what a task sorts at a time."""
FILTER_BITS = 1 << 26
"""Size of the bitmap of nodes to verify; it lets too many nodes through, never too few."""
BLOCK_NODES, BLOCK_VALUES = 1024, 500_000
"""Nodes and shingles of a family's block, about; two blocks are in a task's memory at a time."""
GUEST_SHARE = 4000
"""A node joins a family that is met in one 80th of what is listed of it: 200 / GUEST_SHARE of a sketch."""
DENSE = 32
"""Nodes of two blocks that hold a shingle before it gets a matrix column of its own."""


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Each row's ``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` and ``kept``."""
    small_batches(docs.sparkSession)
    used = Scratch(docs.sparkSession)
    try:
        sets = used.stored(shingle_sets(docs, width), "sets")
        lists = used.stored(inverted_lists(sets, percent), "lists")
        families = used.stored(_families(used.stored(_stars(lists), "stars"), percent), "families")
        members = used.stored(_members(sets, families), "members")
        within = used.stored(_within_families(members, percent), "edges")
        rest = used.stored(_between_families(lists, families, percent), "pairs")
        edges = within.union(used.stored(verified(sets, rest, percent), "edges"))
        labels = components(edges)
        nodes = stored(sets.drop("shingles"), "nodes")
    finally:
        used.remove()
    return _per_document(nodes, labels)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``node``: a hash of the set; ``shingles``: its values, 6 bytes each, ascending."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for chunk in text_chunks(batches):
            words, ends = hashed_words(byte_texts(chunk), lower=True)
            windows = window_hashes(words, width)
            nodes, sizes, sets, begin = [], [], [], 0
            for end in ends.tolist():
                if end - begin >= width:
                    values = np.unique(windows[begin : end - width + 1])
                else:
                    values = window_hashes(words[begin:end], end - begin) if end > begin else windows[:0]
                node = xxhash.xxh3_64_intdigest(values.tobytes(), end - begin if end - begin < width else width)
                nodes.append(node - (1 << 63) if len(values) else None)
                sizes.append(len(values))
                # A set met before in this task is there already.
                sets.append(_stored_set(values) if len(values) and node not in seen else None)
                seen.add(node)
                begin = end
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("text_key"), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "node", "shingles"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(work, "doc_id long, text_key long, n_shingles long, node long, shingles binary")


def _stored_set(values: np.ndarray) -> bytes:
    return (values >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _values(stored_set: bytes) -> np.ndarray:
    wide = np.zeros((len(stored_set) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(stored_set, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _sketch_size(n: int, percent: int) -> int:
    return min(n, n * 2 * (100 - percent) // 100 + 2)


def _pairs_in_common(a: Column, b: Column, percent: int) -> Column:
    """The fewest listed pairs that sets of sizes ``a`` and ``b`` share if they are similar enough.

    With x and y as above, 2x + y is at most ((2 - t) a + (1 - 2t) b) / (1 + t).
    """

    def least(a: Column, b: Column) -> Column:
        broken = F.floor(((200 - percent) * a + (100 - 2 * percent) * b) / (100 + percent))
        return F.least(a, F.floor(a * 2 * (100 - percent) / 100) + 2) - 1 - broken

    return F.least(least(a, b), least(b, a))


def _frequent(sets: DataFrame) -> np.ndarray:
    """The most frequent shingles among the smaller two thirds of the sets, ascending."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            some = [_values(s)[: len(s) // 9 + 1] for s in batch.column("shingles").to_pylist() if s]
            values, times = np.unique(np.concatenate([held[:0], *some]), return_counts=True)
            keys, at = np.unique(np.concatenate([held, values]), return_inverse=True)
            held, counts = keys, np.bincount(at, np.concatenate([counts, times]), len(keys)).astype(np.int64)
        often = counts >= HOT_IN_TASK
        yield pa.RecordBatch.from_arrays(
            [pa.array(held[often].view(np.int64)), pa.array(counts[often])], names=["value", "n"]
        )

    sums = sets.select("shingles").mapInArrow(count, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    rows = sums.where(F.col("n") >= HOT_IN_ALL).orderBy(F.desc("n"), "value").limit(HOT_VALUES).collect()
    return np.sort(np.array([r.value for r in rows], np.int64).view(np.uint64))


def _dealt(values: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket that the entries meet.

    Buckets are ranges of values, and a row's values are gaps in ascending order.  An entry takes about
    four bytes for its gap, eight for the node and two for the size, once Spark has compressed empty
    planes, into however many buckets a node's entries are dealt.
    """
    order = np.argsort(values, kind="stable")
    values = values[order]
    bucket = (values >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(24)
    found, begin = np.unique(bucket, return_index=True)
    gaps, sizes = np.diff(values, prepend=np.uint64(0)), sizes[order]
    gaps[begin] = values[begin]
    spans = list(zip(begin, [*begin[1:], len(values)]))
    return pa.RecordBatch.from_arrays(
        [pa.array(found.astype(np.int64)),
         pa.array([_planes(gaps[a:b], 6) for a, b in spans], pa.binary()),
         pa.array([nodes[order[a:b]].tobytes() for a, b in spans], pa.binary()),
         pa.array([_planes(sizes[a:b], 4) for a, b in spans], pa.binary())],
        names=["bucket", "value", "nodes", "sizes"],
    )


def _entries(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, nodes and sizes of a bucket's rows."""
    values = [np.cumsum(_from_planes(row, 6)) for row in rows.column("value").to_pylist()]
    sizes = [_from_planes(row, 4) for row in rows.column("sizes").to_pylist()]
    nodes = np.frombuffer(b"".join(rows.column("nodes").to_pylist()), np.int64)
    return np.concatenate(values), nodes, np.concatenate(sizes).astype(np.int64)


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The lowest bytes of all numbers, then the next ones, up to ``width`` bytes of each."""
    return numbers.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(planes: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(planes) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return wide.view(np.uint64).ravel()


def inverted_lists(sets: DataFrame, percent: int) -> DataFrame:
    """``bucket``, and per list entry ``value``, ``node``, its size ``n``, whether it holds frequent
    shingles, ``late``, and the smallest node of its list, ``centre``, for lists of two nodes or more.
    ``fits`` says whether the sizes of both allow for a link."""
    frequent = _frequent(sets)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total * 2 * (100 - percent) // (100 * LIST_ENTRIES)))

    def listed(stored_set: bytes) -> tuple[np.ndarray, bool]:
        """A hash for each value of the sketch with the next one; whether frequent shingles were put last."""
        values = _values(stored_set)
        size, moved = _sketch_size(len(values), percent), False
        if len(frequent):
            late = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] == values
            moved = bool(late.any())
            if moved:
                values = np.concatenate([values[~late], values[late]])
        return window_hashes(values[:size], 2) >> np.uint64(16), moved

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.filter(batch.column("shingles").is_valid())
            if not whole.num_rows:
                continue
            sketches, moved = zip(*(listed(s) for s in whole.column("shingles").to_pylist()))
            lengths = [len(s) for s in sketches]
            values = np.concatenate(sketches)
            nodes = np.repeat(whole.column("node").to_numpy(), lengths)
            # Twice the size, and one more for a set with frequent shingles.
            sizes = np.repeat(whole.column("n_shingles").to_numpy() * 2 + np.array(moved), lengths)
            yield _dealt(values, nodes, sizes, buckets)

    def gather(rows: pa.Table) -> pa.Table:
        values, nodes, sizes = _entries(rows)
        order = np.lexsort((nodes, values))
        values, nodes, sizes = values[order], nodes[order], sizes[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (nodes[1:] != nodes[:-1])
        values, nodes, sizes = values[new], nodes[new], sizes[new]
        same = values[1:] == values[:-1]
        several = np.append(same, False) | np.insert(same, 0, False)
        values, nodes, sizes = values[several], nodes[several], sizes[several]
        n = sizes >> 1
        # Nodes are hashes and in order within a list, so its first one is a random node of it.
        first = _begins(values)
        return pa.table({
            "bucket": pa.array(np.full(len(values), rows.column("bucket")[0].as_py())),
            "value": pa.array(values.view(np.int64)),
            "node": pa.array(nodes),
            "n": pa.array(n),
            "late": pa.array(sizes & 1),
            "centre": pa.array(nodes[first]),
            "fits": pa.array(np.minimum(n, n[first]) * 100 >= np.maximum(n, n[first]) * percent),
        })

    dealt = sets.select("node", "n_shingles", "shingles").mapInArrow(
        deal, "bucket long, value binary, nodes binary, sizes binary"
    )
    return dealt.groupBy("bucket").applyInArrow(
        gather, "bucket long, value long, node long, n long, late long, centre long, fits boolean"
    )


def _begins(values: np.ndarray) -> np.ndarray:
    """For each of the values, which come in order, where the run of values equal to it begins."""
    place = np.arange(len(values))
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(new, place, 0))


def _buckets(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Buckets of lists, one after the other, from entries that come in order of bucket and value."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(bucket)] if len(bucket) else [0]
        rows = [batch.column(c).to_numpy() for c in columns]
        for begin, end in zip(edges, edges[1:]):
            if held and (begin or bucket[0] != last):
                yield [np.concatenate(x) for x in zip(*held)]
                held = []
            held.append([x[begin:end] for x in rows])
            last = bucket[end - 1]
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _pairs(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, late: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with how often they come, those of too different sizes left out."""
    fit = np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent
    a, b, na, nb, late = a[fit], b[fit], na[fit], nb[fit], late[fit]
    if len(a):
        order = np.lexsort((b, a))
        a, b, na, nb, late = a[order], b[order], na[order], nb[order], late[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        times = np.diff(np.append(first, len(a)))
        columns = [a[first], b[first], na[first], nb[first], late[first], times]
        names = ["a", "b", "na", "nb", "late", "o"]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)


PAIR = "a long, b long, na long, nb long, late long, o long"


def _stars(lists: DataFrame) -> DataFrame:
    """How many lists, ``o``, a node ``a`` of size ``n`` shares with each of their centres, ``b``."""
    entries = lists.where("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b"), "n", "fits")
    # Dealt as they are: rows follow the entries, however many tasks and buckets these come from.
    return entries.repartition("a").groupBy("a", "b", "n", "fits").agg(F.count(F.lit(1)).alias("o"))


def _families(stars: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``label`` of nodes that go with a centre, and of those that join such a family.

    A node goes with the centre that it shares most lists with, if these are an eighth of what is
    listed of it.  A node without a family then joins the one whose nodes are centres of most of its
    lists: its pairs with all of that family are compared in blocks, not given out one by one.  It
    joins alone, so no two families become one.
    """
    near = stars.where(F.col("fits") & (F.col("o") * 400 >= F.col("n") * (100 - percent)))
    families = stored(components(near.groupBy("a").agg(F.max_by("b", F.struct("o", "b")).alias("b"))), "families")
    alone = stars.join(families.select(F.col("node").alias("a")), "a", "left_anti")
    met = alone.join(families.select(F.col("node").alias("b"), "label"), "b").groupBy("a", "label", "n").agg(F.sum("o").alias("o"))
    guests = met.where(F.col("o") * GUEST_SHARE >= F.col("n") * (100 - percent))
    joined = guests.groupBy("a").agg(F.max_by("label", F.struct("o", "label")).alias("label"))
    return families.unionByName(joined.withColumnRenamed("a", "node"))


def _members(sets: DataFrame, families: DataFrame) -> DataFrame:
    """The sets of nodes in families, each once, with the family's ``label``."""
    found = _chosen(sets, families.select("node"), ["node", "n_shingles", "shingles"])
    return found.join(families, "node").dropDuplicates(["node"])


def _within_families(members: DataFrame, percent: int) -> DataFrame:
    """Edges that connect what similar pairs of a family connect, as ``a``, ``b``."""
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("n_shingles") / BLOCK_VALUES)).cast("int")
    blocks = members.groupBy("label").agg(parts.alias("blocks"))
    dealt = members.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("label", "node", "shingles", "block", other).select(
        "label", "node", "shingles", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )

    def compare(rows: pa.Table) -> pa.Table:
        left, right = rows.column("left")[0].as_py(), rows.column("right")[0].as_py()
        first = rows.column("block").to_numpy() == left
        nodes = rows.column("node").to_numpy()
        linked = _linked([_values(s) for s in rows.column("shingles").to_pylist()], percent)
        if left != right:
            linked &= first[:, None] != first[None, :]
        label = _connected(linked)
        moved = label != np.arange(len(label))
        return pa.table({"a": pa.array(nodes[moved]), "b": pa.array(nodes[label[moved]])})

    return pairs.groupBy("label", "left", "right").applyInArrow(compare, "a long, b long")


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets are similar enough, as a matrix."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(count), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((count, count), np.float32)
    # Shingles that many hold: a column each, counted by products of matrices.
    dense = np.flatnonzero(held >= DENSE)
    number = np.full(len(held), -1)
    number[dense] = np.arange(len(dense))
    in_dense = number[column]
    for begin in range(0, len(dense), 1024):
        some = (in_dense >= begin) & (in_dense < begin + 1024)
        marks = np.zeros((count, min(1024, len(dense) - begin)), np.float32)
        marks[owner[some], in_dense[some] - begin] = 1
        shared += marks @ marks.T
    # The others: entries of one column at each distance from each other.
    few = (held[column] > 1) & (held[column] < DENSE)
    order = np.argsort(column[few], kind="stable")
    column, owner = column[few][order], owner[few][order]
    pairs = shared.reshape(-1)
    for step in range(1, DENSE):
        same = np.flatnonzero(column[step:] == column[:-step])
        if not len(same):
            break
        a, b = owner[same], owner[same + step]
        cells, times = np.unique(np.concatenate([a * count + b, b * count + a]), return_counts=True)
        pairs[cells] += times
    linked = np.empty((count, count), bool)
    for begin in range(0, count, 256):
        some = shared[begin : begin + 256]
        linked[begin : begin + 256] = 100 * some >= percent * (sizes[begin : begin + 256, None] + sizes[None, :] - some)
    return linked


def _connected(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the first one that its marks lead to."""
    label = np.arange(len(linked), dtype=np.int32)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], np.int32(len(linked))).min(axis=1, initial=len(linked)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _in_order(entries: DataFrame, *columns: str) -> DataFrame:
    return entries.repartition("bucket").sortWithinPartitions("bucket", "value", *columns)


def _ends(*columns: np.ndarray) -> np.ndarray:
    """For each entry, where the run of entries ends that are equal to it in all columns."""
    new = np.zeros(len(columns[0]), bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    begin = np.flatnonzero(np.insert(new[1:], 0, True)) if len(new) else np.empty(0, np.int64)
    end = np.append(begin[1:], len(new))
    return np.repeat(end, end - begin)


CROSS_STEP = 1 << 20
"""Pairs of a bucket that are counted together before they are given out."""


def _between_families(lists: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list from different families that may be similar enough."""

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value, label, node, n, late in _buckets(batches, ["value", "label", "node", "n", "late"]):
            stop = _ends(value)
            other = _ends(value, label)
            left = np.arange(len(value))
            # Each entry with the first one of its list's later families, then the next one.
            held, count = [], 0
            while len(left := left[other[left] < stop[left]]):
                held.append((left, other[left]))
                count += len(left)
                other[left] += 1
                if count >= CROSS_STEP:
                    yield from counted(node, n, late, held)
                    held, count = [], 0
            yield from counted(node, n, late, held)

    def counted(node: np.ndarray, n: np.ndarray, late: np.ndarray, held: list) -> Iterator[pa.RecordBatch]:
        if held:
            i, j = (np.concatenate(x) for x in zip(*held))
            i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
            yield from _pairs(node[i], node[j], n[i], n[j], late[i] | late[j], percent)

    entries = lists.join(families, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ordered = _in_order(entries, "label", "node")
    pairs = ordered.mapInArrow(cross, PAIR).groupBy("a", "b", "na", "nb", "late").agg(F.sum("o").alias("o"))
    a, b = F.col("na"), F.col("nb")
    # With frequent shingles last, a sketch is filled first with what two sets differ in: no estimate.
    estimate = F.when(F.col("late") == 0, F.least(_expected(a, percent), _expected(b, percent)))
    return pairs.where(F.col("o") >= F.greatest(_pairs_in_common(a, b, percent), estimate))


def _expected(n: Column, percent: int) -> Column:
    """Seven standard deviations below the pairs expected of two sets that are just similar enough.

    Holds for sketches in the order of hashes alone.
    A pair stays if both values are shared and no other comes between: t squared of them in the
    worst case, which is that of a set with all of the other one in it.
    """
    t = percent / 100
    k = F.least(n, F.floor(n * 2 * (100 - percent) / 100) + 2) - 1
    return k * t * t - 7 * F.sqrt(2 * k * t * t * (1 - t * t))


def verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, as ``a``, ``b``."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    full = _chosen(sets, needed, ["node", "shingles"])
    full = full.groupBy("node").agg(F.first("shingles").alias("shingles"))
    left = full.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = full.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = _values(sa.as_py()), _values(sb.as_py())
                merged = np.concatenate([x, y])
                merged.sort()
                shared = int((merged[1:] == merged[:-1]).sum())
                similar.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def _chosen(sets: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """The sets of the nodes, and a few others, picked out where they are read."""
    wanted = _bitmap(nodes)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint64)
        for batch in batches:
            place = batch.column("node").fill_null(0).to_numpy().view(np.uint64) & np.uint64(FILTER_BITS - 1)
            found = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
            yield batch.filter(pa.array(found.astype(bool) & batch.column("shingles").is_valid().to_numpy(False)))

    narrow = sets.select(*columns)
    return narrow.mapInArrow(choose, narrow.schema)


def _bitmap(nodes: DataFrame):
    """A bit for each node's lowest bits: 8 MB at most, whatever the number of nodes."""
    place = F.col("node").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = nodes.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((node & {FILTER_BITS - 1}) % 64 as int))")).alias("bits")
    )
    found = words.toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return nodes.sparkSession.sparkContext.broadcast(bits.tobytes())


def _per_document(docs: DataFrame, labels: DataFrame) -> DataFrame:
    nodes = docs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    linked = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    known = linked.join(smallest, "label").select("node", "component_id")
    return docs.join(known, "node", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.col("component_id").isNull()).alias("kept"),
    )


def one_of_each(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``docs`` that their class keeps; of rows equal in id and text, one."""
    def keys(id: Column, key: Column) -> list[Column]:
        """Plain keys, so that join and distinct share one shuffle of the texts."""
        return [F.coalesce(id, F.lit(0)).alias("id"), id.isNull().alias("bare"), key.alias("key")]

    found = classes(docs, width, percent).where("kept")
    kept = found.select(*keys(F.col("doc_id"), F.col("text_key")))
    rows = docs.select(as_row(docs).alias("row"), *keys(F.col("doc_id").cast("long"), F.xxhash64("text")))
    by = ["id", "bare", "key"]
    return rows.join(kept, by, "left_semi").dropDuplicates(by).select("row.*")


ORACLE = f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS words FROM documents),
shingles AS (SELECT DISTINCT k, array_to_string(words[s : s + {WIDTH - 1}], ' ') AS shingle
    FROM (SELECT k, words, unnest(range(1, greatest(len(words) - {WIDTH - 2}, 2))) AS s FROM texts WHERE len(words) > 0)),
sizes AS (SELECT k, count(*) AS n FROM shingles GROUP BY k),
shared AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM shingles a JOIN shingles b USING (shingle) WHERE a.k < b.k GROUP BY a.k, b.k),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.k = x JOIN sizes q ON q.k = y WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT k, k AS r FROM texts UNION SELECT reach.k, y FROM reach JOIN edges ON r = x),
components AS (SELECT reach.k, min(doc_id) AS component_id FROM reach JOIN texts ON texts.k = r GROUP BY reach.k)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(doc_id = component_id, component_id IS NULL) AS kept
FROM texts JOIN components USING (k) LEFT JOIN sizes USING (k)
"""
