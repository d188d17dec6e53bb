"""Substring dedup with prefix-partitioned suffix trees.

A suffix is a document from one of its words on.  Suffixes are dealt to groups by their first
words: a prefix that too many suffixes share is replaced by the longer ones that extend it, so
a group holds a memory-sized number of them.  A group's subtree is cut off at ``width`` words:
its nodes at that depth with leaves in several documents are the repeats asked for, and longer
maximal repeats come out as runs of neighbouring windows.

Text is dealt into blocks by ``doc_id`` once, and the three steps over it share that shuffle:

1. each block sends each group the 32-bit labels of its depth-``width`` nodes, each once; the
   group answers with a bit per label: seen in another block or not;
2. of those seen elsewhere, the block sends the 64-bit label and its smallest ``doc_id``; the
   group answers whether a smaller one holds the node as well;
3. the block drops the words that its answers, and its own documents, say.

A node that half the corpus shares is one label per block, so no group is hot.  Two windows are
taken for equal if they agree in prefix group and 64-bit label; as groups hold a bounded number
of suffixes F, windows mistaken for another are expected to be below N * F / 2**64 in all.

Null text has no words.  A null ``doc_id`` comes after all others.  Rows that share a ``doc_id``
are no copies of each other.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemagate.llm.common import WORD, byte_texts, covered, give_back_arrays, hashed_words, mixed, owners, quoted, text_chunks, window_hashes

give_back_arrays()

WIDTH = 13
GROUP_SUFFIXES = 2_000_000
"""Suffixes from which a prefix is replaced by longer ones, and about what a group holds."""
BLOCK_BYTES = 4 << 20
"""Text of a block, about: what one task has in memory at a time."""

NO_ID = np.iinfo(np.int64).max

NODES = "__group long, __block long, labels binary, firsts binary"
RESULT = (
    "text string, n_words long, n_removed long, kept_text string, removed array<struct<start:long,length:long>>"
)
ANSWERS = "__group long, __block long, bits binary"


def deduplicated(
    docs: DataFrame, width: int = WIDTH, group_suffixes: int = GROUP_SUFFIXES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, with ``n_words``, ``n_removed``, ``kept_text`` and ``removed`` spans.

    Columns of ``docs`` come as the fields of ``row``.  A word goes if it is in a window of
    ``width`` words that also starts in a document with a smaller id.
    """
    plan = _prefixes(docs, width, group_suffixes)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("__block"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("__id"),
        F.col("text").alias("text"),
        F.struct(*(F.col(quoted(c)) for c in docs.columns if c != "text")).alias("__row"),
    )

    def sent(block: pa.Table) -> pa.Table:
        return _table(_Block(block, width, plan).labels())

    def sent_again(block: pa.Table, answers: pa.Table) -> pa.Table:
        return _table(_Block(block, width, plan).candidates(_bits(answers)))

    def cut(block: pa.Table, answers: pa.Table, seen: pa.Table) -> pa.Table:
        return _Block(block, width, plan).cut(_bits(answers), _bits(seen))

    def cut_by(block: pa.Table, answers: pa.Table) -> pa.Table:
        first = pc.equal(answers.column("step"), 1)
        return cut(block, answers.filter(first), answers.filter(pc.invert(first)))

    by_block = dealt.groupBy("__block")
    seen = by_block.applyInArrow(sent, NODES).groupBy("__group").applyInArrow(_shared, ANSWERS)
    known = by_block.cogroup(seen.groupBy("__block")).applyInArrow(sent_again, NODES)
    earlier = known.groupBy("__group").applyInArrow(_earlier, ANSWERS)
    answers = seen.withColumn("step", F.lit(1)).unionByName(earlier.withColumn("step", F.lit(2)))
    schema = T.StructType([dealt.schema["__row"], *T._parse_datatype_string(RESULT).fields])
    result = by_block.cogroup(answers.groupBy("__block")).applyInArrow(cut_by, schema)
    fields = [F.col("text") if c == "text" else F.col(f"__row.{quoted(c)}") for c in docs.columns]
    return result.select(
        F.struct(*(f.alias(c) for f, c in zip(fields, docs.columns, strict=True))).alias("row"),
        "n_words", "n_removed", "kept_text", "removed",
    )


def shortened(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with repeated words cut from ``text``; ``n_chars``, where it is a column, follows.

    A text that keeps all its words keeps its white space as well.
    """
    found = deduplicated(docs, **settings)
    changed, fields = F.col("n_removed") > 0, []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.when(changed, F.col("kept_text")).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length("kept_text").cast(docs.schema[c].dataType)).otherwise(value)
        fields.append(value.alias(c))
    return found.select(*fields)


class _Prefixes:
    """How many leading words decide a suffix's group."""

    def __init__(self, frequent: list[np.ndarray], groups: int):
        self.frequent, self.groups = frequent, groups

    def groups_of(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        prefix = window_hashes(words, 1)[starts]
        for length, common in enumerate(self.frequent, 2):
            long = np.flatnonzero(np.isin(prefix, common))
            prefix[long] = window_hashes(words, length)[starts[long]]
        return (mixed(prefix) % np.uint64(self.groups)).astype(np.int64)


def _prefixes(docs: DataFrame, width: int, group_suffixes: int) -> _Prefixes:
    """Count prefixes of one word, then of those too frequent the ones a word longer, and so on.

    A task reports a prefix only if it holds more than its even share of a group.  One not
    reported in full has less than a group's worth unreported, so a group ends below twice that.
    At most one prefix per group's worth of suffixes comes to the driver for each length.
    """
    texts = docs.select("text")
    least = max(1, group_suffixes // max(1, texts.rdd.getNumPartitions()))
    frequent: list[np.ndarray] = []
    suffixes = None
    for length in range(1, width):
        known = _Prefixes(list(frequent), 1)

        def count(batches: Iterator[pa.RecordBatch], length=length, known=known) -> Iterator[pa.RecordBatch]:
            total = 0
            held, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
            for chunk in text_chunks(batches):
                words, ends = hashed_words(byte_texts(chunk))
                starts = _starts(ends, width)
                total += len(starts)
                prefix = window_hashes(words, length)[starts] if len(starts) else np.empty(0, np.uint64)
                if length > 1 and len(starts):
                    shorter = window_hashes(words, length - 1)[starts]
                    prefix = prefix[np.isin(shorter, known.frequent[-1])]
                found, times = np.unique(prefix, return_counts=True)
                held, counts = _added(held, counts, found, times)
            some = counts >= least
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[some].view(np.int64)), pa.array(counts[some])], names=["prefix", "n"]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), pa.array([total], pa.int64())], names=["prefix", "n"]
            )

        sums = texts.mapInArrow(count, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
        rows = sums.where((F.col("n") >= group_suffixes) | F.col("prefix").isNull()).collect()
        suffixes = sum(r.n for r in rows if r.prefix is None)
        too_many = np.sort(np.array([r.prefix for r in rows if r.prefix is not None], np.int64).view(np.uint64))
        if not len(too_many):
            break
        frequent.append(too_many)
    return _Prefixes(frequent, max(1, -(-(suffixes or 0) // group_suffixes)))


def _added(held: np.ndarray, counts: np.ndarray, found: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([held, found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([counts, times]), len(keys)).astype(np.int64)


def _starts(ends: np.ndarray, width: int) -> np.ndarray:
    """Where windows of ``width`` words can start."""
    size = int(ends[-1]) if len(ends) else 0
    place = np.arange(size)
    return place[place + width <= ends[owners(ends)]] if size else place


class _Block:
    """The documents of one block in order of id, and the distinct windows among them."""

    def __init__(self, block: pa.Table, width: int, plan: _Prefixes):
        self.width = width
        ids = block.column("__id").to_numpy()
        self.block = block.column("__block")[0].as_py() if len(block) else None
        order = np.argsort(ids, kind="stable")
        self.rows = block.take(pa.array(order))
        self.ids = ids[order]
        self.texts = self.rows.column("text").cast(pa.binary()).to_pylist()
        words, self.ends = hashed_words(self.texts)
        self.starts = _starts(self.ends, width)
        labels = window_hashes(words, width)[self.starts] if len(self.starts) else np.empty(0, np.uint64)
        # Documents are in order of id, so a window's first place has the smallest.
        self.nodes, first, self.node_of = np.unique(labels, return_index=True, return_inverse=True)
        self.owner = self.ids[owners(self.ends)[self.starts]] if len(self.starts) else np.empty(0, np.int64)
        self.first = self.owner[first]
        groups = plan.groups_of(words, self.starts[first]) if len(first) else np.empty(0, np.int64)
        self.by_group = np.argsort(groups, kind="stable")
        self.groups, begin = np.unique(groups[self.by_group], return_index=True)
        self.parts = np.split(self.by_group, begin[1:]) if len(begin) else []

    def labels(self) -> list[tuple]:
        return [
            (int(g), self.block, packed(np.unique(self.nodes[part].astype(np.uint32))), None)
            for g, part in zip(self.groups, self.parts, strict=True)
        ]

    def elsewhere(self, seen: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """Group by group, the nodes whose short label another block has as well."""
        for g, part in zip(self.groups, self.parts, strict=True):
            if int(g) in seen:
                _, at = np.unique(self.nodes[part].astype(np.uint32), return_inverse=True)
                found = part[seen[int(g)][at]]
                if len(found):
                    yield int(g), found

    def candidates(self, seen: dict[int, np.ndarray]) -> list[tuple]:
        return [
            (g, self.block, packed(self.nodes[part]), packed(self.first[part].view(np.uint64), False))
            for g, part in self.elsewhere(seen)
        ]

    def cut(self, seen: dict[int, np.ndarray], earlier: dict[int, np.ndarray]) -> pa.Table:
        gone = np.zeros(len(self.nodes), bool)
        for g, part in self.elsewhere(seen):
            if g in earlier:
                gone[part] = earlier[g][: len(part)]
        repeated = gone[self.node_of] | (self.owner > self.first[self.node_of])
        total = int(self.ends[-1]) if len(self.ends) else 0
        removed = covered(self.starts[repeated], self.width, total)
        begins = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        kept_texts, spans, counts = [], [], []
        for text, begin, end in zip(self.texts, begins, self.ends, strict=True):
            marks = removed[begin:end]
            words = text.split() if text else []
            edges = np.flatnonzero(np.diff(marks.astype(np.int8), prepend=0, append=0)) if len(marks) else []
            spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            last, kept = 0, []
            for span in spans[-1]:
                kept += words[last : span["start"]]
                last = span["start"] + span["length"]
            kept += words[last:]
            kept_texts.append(b" ".join(kept))
            counts.append(len(words) - len(kept))
        return pa.table({
            "__row": self.rows.column("__row"),
            "text": self.rows.column("text"),
            "n_words": pa.array(self.ends - begins),
            "n_removed": pa.array(counts, pa.int64()),
            "kept_text": pa.array(kept_texts, pa.binary()).cast(pa.string()),
            "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        })


def _shared(nodes: pa.Table) -> pa.Table:
    """A bit for each label sent: whether another block has sent it too."""
    sent = [unpacked(x.as_py()) for x in nodes.column("labels")]
    ends = np.cumsum([len(x) for x in sent])
    values = np.concatenate(sent)
    del sent
    order = np.argsort(values)
    values = values[order]
    same = values[1:] == values[:-1]
    several = np.empty(len(values), bool)
    several[order] = np.append(same, False) | np.insert(same, 0, False)
    return _answers(nodes, np.split(several, ends[:-1]))


def _earlier(nodes: pa.Table) -> pa.Table:
    """A bit for each node sent: whether a smaller document than the block's has it too."""
    sent = [unpacked(x.as_py()) for x in nodes.column("labels")]
    firsts = np.concatenate([unpacked(x.as_py(), False) for x in nodes.column("firsts")]).view(np.int64)
    values, at = np.unique(np.concatenate(sent), return_inverse=True)
    least = np.full(len(values), NO_ID)
    np.minimum.at(least, at, firsts)
    return _answers(nodes, np.split(least[at] < firsts, np.cumsum([len(x) for x in sent])[:-1]))


def _answers(nodes: pa.Table, bits: list[np.ndarray]) -> pa.Table:
    return pa.table({
        "__group": nodes.column("__group"),
        "__block": nodes.column("__block"),
        "bits": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
    })


def _bits(answers: pa.Table) -> dict[int, np.ndarray]:
    groups = answers.column("__group").to_pylist()
    return {
        g: np.unpackbits(np.frombuffer(x.as_py(), np.uint8)).astype(bool)
        for g, x in zip(groups, answers.column("bits"), strict=True)
    }


def _table(rows: list[tuple]) -> pa.Table:
    group, block, labels, firsts = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({
        "__group": pa.array(group, pa.int64()),
        "__block": pa.array(block, pa.int64()),
        "labels": pa.array(labels, pa.binary()),
        "firsts": pa.array(firsts, pa.binary()),
    })


def packed(values: np.ndarray, ascending: bool = True) -> bytes:
    """Numbers as the bytes of equal weight together, gaps in place of ascending ones, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0)) if ascending else values
    planes = steps.view(np.uint8).reshape(len(steps), values.itemsize).T
    return bytes([values.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, ascending: bool = True) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    steps = np.ascontiguousarray(planes.T).view({4: np.uint32, 8: np.uint64}[data[0]]).ravel()
    return np.cumsum(steps, dtype=steps.dtype) if ascending else steps


ORACLE = f"""
WITH texts AS (SELECT row_number() OVER () AS k, coalesce(doc_id, {NO_ID}) AS id, doc_id,
    coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents),
windows AS (SELECT k, id, s, array_to_string(words[s : s + {WIDTH - 1}], ' ') AS w
    FROM (SELECT k, id, words, unnest(range(1, len(words) - {WIDTH - 2})) AS s FROM texts)),
firsts AS (SELECT w, min(id) AS first FROM windows GROUP BY w),
gone AS (SELECT DISTINCT k, s + i AS p FROM windows JOIN firsts USING (w), range({WIDTH}) AS t(i) WHERE first < id),
words AS (SELECT k, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM texts),
kept AS (SELECT k, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS joined FROM words ANTI JOIN gone USING (k, p) GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(joined, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (k)
"""
