"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to three bytes counts what follows them.  A
byte is coded in the longest context that is known; where it is new there, an escape leads to
the next shorter one, from which the bytes seen before are excluded.  Counts are frozen after
training, so the code length of four bytes in a row is a constant: lengths of all runs seen in
training are tabulated for all languages, others are worked out by the same rule when met.  A
text belongs to the language that codes it shortest; the score is that language's share of the
probability that all give it.

Training takes labelled documents up to about ``TRAIN_BYTES`` of text for each language, and one
at least, chosen by a hash of id and text; the table and the driver hold what these can contain.  Texts are
scored whole, in the task that reads them; nothing is shuffled.

Null texts and those without a letter are ``und`` with score 0, and so is everything when no
row is there to learn from.  Ties go to the language first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemagate.llm.common import byte_texts, text_chunks

ORDER = 3
TRAIN_BYTES = 4 << 20
"""Longest context in bytes; labelled text per language to learn from, about."""
DRAWS = 1 << 62
HELD_OUT = 2
FOLDS = 4
UNKNOWN = "und"
START = b"\n" * ORDER
"""What stands before each text."""


def held_out() -> Column:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def predicted(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    model = trained(docs, train_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            languages, scores = shared.value.best(byte_texts(chunk), chunk.column("letters").to_numpy(False))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("held_out"), pa.array(languages), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held_out().alias("held_out"), letters)
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def trained(docs: DataFrame, train_bytes: int) -> Model:
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # 62 bits: the languages' shares of them are exact, and one more is no overflow.
    labelled = labelled.where("text != ''").withColumn("draw", F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit("train")), 2))
    sizes = labelled.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"), F.min("draw").alias("least")).collect()
    languages = sorted((r.lang for r in sizes), key=str.encode)
    if not languages:
        return Model([], [])
    # The language's first draw is taken, however small the share.
    bound = {r.lang: max(r.least + 1, min(DRAWS, DRAWS * train_bytes // r.n)) for r in sizes}
    share = F.create_map(*(x for lang, most in bound.items() for x in (F.lit(lang), F.lit(most).cast("long"))))
    chosen = F.col("draw") < F.element_at(share, F.col("lang"))
    number = {language: i for i, language in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            texts, named = byte_texts(chunk), np.array([number[x] for x in chunk.column("lang").to_pylist()], np.int64)
            grams, ends = byte_runs(texts)
            keys = (np.repeat(named, np.diff(ends, prepend=0)) << 32) | grams
            found, times = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], names=["run", "n"])

    sample = labelled.where(chosen).select("text", "lang")
    counts = sample.mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).toArrow()
    runs, times = counts.column("run").to_numpy(), counts.column("n").to_numpy()
    trees = []
    for i in range(len(languages)):
        own = runs >> 32 == i
        trees.append(Tree((runs[own] & 0xFFFFFFFF).astype(np.uint32), times[own]))
    return Model(languages, trees)


def byte_runs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte after the three before it, as one number; where each text ends."""
    raw = np.frombuffer(b"".join([START + (t or b"") for t in texts]) or b"", np.uint8).astype(np.uint32)
    ends = np.cumsum([len(t or b"") for t in texts], dtype=np.int64)
    if not len(raw):
        return np.empty(0, np.uint32), ends
    runs = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    inside = np.ones(len(runs) + ORDER, bool)
    begins = np.concatenate(([0], ends[:-1])) + ORDER * np.arange(len(ends))
    for step in range(ORDER):
        inside[begins + step] = False
    return runs[inside[ORDER:]], ends


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, counts, len(found))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key is, and whether it is."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """One language's contexts of 3, 2, 1 and no bytes with what followed them how often."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray):
        self.runs, self.counts, self.contexts, self.total, self.kinds = {}, {}, {}, {}, {}
        for order in range(ORDER, -1, -1):
            mask = np.uint32((1 << 8 * (order + 1)) - 1)
            self.runs[order], self.counts[order] = _summed(runs & mask, counts)
            self.contexts[order], self.total[order] = _summed(self.runs[order] >> np.uint32(8), self.counts[order])
            self.kinds[order] = _summed(self.runs[order] >> np.uint32(8), np.ones(len(self.runs[order])))[1]
        # What is left of a context once the bytes known in the one a byte longer are excluded.
        self.left_total, self.left_kinds = {}, {}
        for order in range(ORDER):
            shorter = np.uint32((1 << 8 * (order + 1)) - 1)
            at, _ = _find(self.runs[order], self.runs[order + 1] & shorter)
            _, gone = _summed(self.runs[order + 1] >> np.uint32(8), self.counts[order][at])
            context, _ = _find(self.contexts[order], self.contexts[order + 1] & np.uint32((1 << 8 * order) - 1))
            self.left_total[order] = self.total[order][context] - gone
            self.left_kinds[order] = self.kinds[order][context] - self.kinds[order + 1]

    def bits(self, runs: np.ndarray) -> np.ndarray:
        """The code length of the last byte of each run after the others."""
        bits, open_ = np.zeros(len(runs)), np.arange(len(runs))
        longer, longer_known = np.zeros(len(runs), np.int64), np.zeros(len(runs), bool)
        for order in range(ORDER, -1, -1):
            run = runs[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
            context, known = _find(self.contexts[order], run >> np.uint32(8))
            total = np.where(known, self.total[order][context] if len(self.total[order]) else 0.0, 0.0)
            kinds = np.where(known, self.kinds[order][context] if len(self.kinds[order]) else 0.0, 0.0)
            if order < ORDER and len(self.left_total[order]):
                total = np.where(longer_known, self.left_total[order][longer], total)
                kinds = np.where(longer_known, self.left_kinds[order][longer], kinds)
            place, found = _find(self.runs[order], run)
            if found.any():
                bits[open_[found]] += np.log2((total[found] + kinds[found]) / self.counts[order][place[found]])
            escapes = ~found & known & (kinds > 0)
            bits[open_[escapes]] += np.log2((total[escapes] + kinds[escapes]) / kinds[escapes])
            open_, longer, longer_known = open_[~found], context[~found], known[~found]
        bits[open_] += np.log2(256 - np.where(longer_known, len(self.runs[0]), 0))
        return bits


class Model:
    def __init__(self, languages: list[str], trees: list[Tree]):
        self.languages, self.trees = languages, trees
        self.runs = np.unique(np.concatenate([t.runs[ORDER] for t in trees] or [np.empty(0, np.uint32)]))
        self.bits = [t.bits(self.runs).astype(np.float32) for t in trees]

    def lengths(self, texts: list[bytes | None]) -> np.ndarray:
        """Code lengths in bits, a row for each text and a column for each language."""
        runs, ends = byte_runs(texts)
        at, found = _find(self.runs, runs)
        new, where = np.unique(runs[~found], return_inverse=True)
        result = np.zeros((len(texts), len(self.trees)))
        filled = np.flatnonzero(np.diff(ends, prepend=0))
        if not len(filled):
            return result
        begins = np.concatenate(([0], ends[:-1]))[filled]
        for i, tree in enumerate(self.trees):
            bits = self.bits[i][at]
            if len(new):
                bits[~found] = tree.bits(new)[where]
            result[filled, i] = np.add.reduceat(bits, begins, dtype=np.float64)
        return result

    def best(self, texts: list[bytes | None], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.trees:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        lengths = self.lengths(texts)
        choice = lengths.argmin(axis=1)
        more = np.minimum(lengths - lengths.min(axis=1, keepdims=True), 1000.0)
        scores = np.where(letters, 1 / np.exp2(-more).sum(axis=1), 0.0)
        return [self.languages[c] if known else UNKNOWN for c, known in zip(choice, letters, strict=True)], scores
