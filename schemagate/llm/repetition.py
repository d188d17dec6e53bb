"""Quality rules by repetition within a text, found with suffix arrays.

Every document is judged by itself, in the task that reads it: nothing is shuffled.  The
suffixes of all documents of a chunk are sorted together by prefix doubling, a document's
number leading, so that one set of array operations serves many short texts.  Neighbours'
longest common prefixes give, for each place, how far the text from there on is found a
second time; the spans of maximal repeats are the union of those.

Null text has no words; without words a document fails the base rule.  Rows are judged one by
one, so repeated rows, repeated ids and further columns make no difference.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from schemagate.llm.common import WORD, covered, owners, text_chunks

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3
MAX_WINDOW_SHARE = (50, 100)
"""Fixed values of the base rule: shortest text, window, most words in repeated windows."""

MIN_REPEAT = 10
"""Words from which a repeated passage counts for the method's own verdict."""
MAX_COVERED = 0.40
"""Most of a text's words that maximal repeats may cover, first occurrences included."""
MAX_LONGEST = 0.30
"""Longest maximal repeat, as a share of the text's words."""

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, n_covered long, longest_repeat long"
)


def suffix_array(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, those of one text together, and what each shares with the one before.

    ``ids`` are the words of texts that end at ``ends``.  A suffix ends with its text.
    """
    size = len(ids)
    if not size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text = owners(ends)
    stop = ends[text]
    place = np.arange(size)
    names, shared = _refined(np.zeros(size, np.int64), text * (int(ids.max()) + 1) + ids)
    levels, width = [names], 1
    active = place[shared]
    while len(active):
        after = active + width
        tail = np.where(after < stop[active], names[np.minimum(after, size - 1)] + 1, 0)
        names = names.copy()
        names[active], shared = _refined(names[active], tail)
        levels.append(names)
        width *= 2
        active = active[shared]
    order = np.empty(size, np.int64)
    order[names] = place
    common = np.zeros(size, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        here, before = order[1:] + common[1:], order[:-1] + common[1:]
        open_ = (here < stop[order[1:]]) & (before < stop[order[:-1]])
        last = size - 1
        same = open_ & (levels[level][np.minimum(here, last)] == levels[level][np.minimum(before, last)])
        common[1:][same] += 1 << level
    return order, common


def _refined(names: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of places that shared one, told apart by what follows, and which are still shared.

    A name is the number of places with a smaller one, so each group keeps its range.
    """
    order = np.lexsort((tail, names)) if names.any() else np.argsort(tail)
    ranked, group = tail[order], names[order]
    place = np.arange(len(tail))
    new_group = np.concatenate(([True], group[1:] != group[:-1]))
    new = new_group | np.concatenate(([True], ranked[1:] != ranked[:-1]))
    first = np.maximum.accumulate(np.where(new, place, 0))
    begin = np.maximum.accumulate(np.where(new_group, place, 0))
    refined, shared = np.empty(len(tail), np.int64), np.empty(len(tail), bool)
    refined[order] = group + first - begin
    shared[order] = ~(new & np.append(new[1:], True))
    return refined, shared


def repeat_lengths(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place, the longest run of words from there that its text holds elsewhere as well."""
    order, common = suffix_array(ids, ends)
    lengths = np.zeros(len(ids), np.int64)
    lengths[order] = np.maximum(common, np.append(common[1:], 0))
    return lengths


def _per_text(marks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks)))
    return total[ends] - total[np.concatenate(([0], ends[:-1]))]


def measured(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The base measures, the method's and both verdicts, one entry per text."""
    raw = [t.encode() if t else b"" for t in texts]
    words = [t.split() for t in raw]
    counts = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(counts)
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids = np.fromiter((number(w, len(known)) for w in chain.from_iterable(words)), np.int64, int(counts.sum()))
    repeats = repeat_lengths(ids, ends)

    def in_repeats(least: int) -> np.ndarray:
        starts = np.flatnonzero(repeats >= least)
        return _per_text(covered(starts, repeats[starts], len(ids)), ends)

    longest = np.zeros(len(texts), np.int64)
    if len(ids):
        filled = counts > 0
        longest[filled] = np.maximum.reduceat(repeats, (ends - counts)[filled])
    repeated, in_long = in_repeats(WINDOW), in_repeats(MIN_REPEAT)
    share, of = MAX_WINDOW_SHARE
    failed = (counts < MIN_WORDS) | (of * repeated > share * counts)
    too_long = (longest >= MIN_REPEAT) & (longest > MAX_LONGEST * counts)
    return {
        "n_words": counts,
        "word_chars": np.array([len(t or "") - len(b) + sum(map(len, w)) for t, b, w in zip(texts, raw, words, strict=True)], np.int64),
        "n_symbols": np.array([len(b) - len(b.translate(None, SYMBOLS)) for b in raw], np.int64),
        "n_dup_lines": np.array([_duplicate_lines(b) for b in raw], np.int64),
        "n_repeat_words": repeated,
        "base_failed": failed,
        "kept": ~(failed | too_long | (in_long > MAX_COVERED * counts)),
        "n_covered": in_long,
        "longest_repeat": longest,
    }


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id`` of every row with its measures and verdicts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            found = measured(chunk.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), *map(pa.array, found.values())], names=["doc_id", *found]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, {MEASURES}")


def passed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            yield chunk.filter(pa.array(measured(chunk.column("text").to_pylist())["kept"]))

    plain = docs.toDF(*("text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)))
    return plain.mapInArrow(work, plain.schema).toDF(*docs.columns)


def _covered_sql(name: str, width: int) -> str:
    """Words in windows of ``width`` that a text holds twice or more."""
    return f"""
{name}_w AS (SELECT k, s, array_to_string(words[s : s + {width - 1}], ' ') AS w
    FROM (SELECT k, words, unnest(range(1, len(words) - {width - 2})) AS s FROM texts)),
{name}_r AS (SELECT k, s FROM {name}_w QUALIFY count(*) OVER (PARTITION BY k, w) > 1),
{name} AS (SELECT k, count(DISTINCT s + i) AS n FROM {name}_r, range({width}) AS t(i) GROUP BY k)"""


ORACLE = f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents),
{_covered_sql("windows", WINDOW)},
{_covered_sql("passages", MIN_REPEAT)},
least AS (SELECT k, words, greatest({MIN_REPEAT}, CAST(floor(CAST({MAX_LONGEST} AS DOUBLE) * len(words)) AS BIGINT) + 1) AS m
    FROM texts JOIN passages USING (k)),
longest AS (SELECT DISTINCT k FROM (SELECT k, array_to_string(words[s : s + m - 1], ' ') AS w
    FROM (SELECT k, words, m, unnest(range(1, len(words) - m + 2)) AS s FROM least)) QUALIFY count(*) OVER (PARTITION BY k, w) > 1),
lines AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '{WORD}') GROUP BY k),
measured AS (SELECT texts.k, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(windows.n, 0) AS n_repeat_words, coalesce(passages.n, 0) AS n_covered,
    longest.k IS NOT NULL AS too_long
    FROM texts LEFT JOIN lines USING (k) LEFT JOIN windows USING (k) LEFT JOIN passages USING (k) LEFT JOIN longest USING (k)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR {MAX_WINDOW_SHARE[1]} * n_repeat_words > {MAX_WINDOW_SHARE[0]} * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_covered,
    NOT (base_failed OR too_long OR n_covered > CAST({MAX_COVERED} AS DOUBLE) * n_words) AS kept
FROM judged
"""
