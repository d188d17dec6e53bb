"""Cutting JSON document text where its records end.

Bracket depth and string state run through a text from its start, which no column
expression can follow at a fair price; these helpers do it over Arrow batches.  Text
comes as fragments that were split at commas, put together again here.  A backslash takes
the character behind it along, in strings and outside, so what one character means never
depends on where text was split.  Each character stands for one byte, as all marks that
matter here are ASCII; what is cut off is the record's own text, byte for byte.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Control characters, which JSON text cannot hold: after each line, and before a line that
# is no record.
RECORD_END = "\x1e"
SET_APART = "\x1d"

# What JSON takes for blank, and a byte order mark.
BLANKS = " \t\r\n"
BYTE_ORDER_MARK = "\xef\xbb\xbf"

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"?|\\.|[{}\[\],]', re.DOTALL)

# What tells how deep a text is; what the backslash takes along and strings are passed over.
_BRACKET = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"?|\\.|[{}\[\]]', re.DOTALL)

# Up to so many characters marks are found one by one, as arrays cost more to set up.
SHORT = 4096

# How deep a text is where its records end.
IN_ARRAY, BARE = 1, 0

Cut = tuple[str, bool]
"""A text, and whether a record ends with it."""


def closing_depth(text: str) -> int:
    """By a document's first character: an array's records end within it."""
    return IN_ARRAY if text.removeprefix(BYTE_ORDER_MARK).lstrip(BLANKS).startswith("[") else BARE


def cut(texts: Iterable[str], closing: int, in_string: int = 0, depth: int = 0) -> Iterator[Cut]:
    """Cuts the text that ``texts`` make up in a row; what is left over comes last."""
    held: list[str] = []
    for text in texts:
        marks, start = Marks([text]), 0
        places, depths = marks.objects(in_string)
        for end in places[depths + depth <= closing].tolist():
            yield "".join([*held, text[start:end]]), True
            held, start = [], end
        depth += marks.net(in_string)
        in_string ^= marks.quotes & 1
        if start < len(text):
            held.append(text[start:])
    if held:
        yield "".join(held), False


def cut_short(text: str, closing: int) -> Iterator[Cut]:
    """What ``cut`` gives for one short text from a document's start."""
    start = depth = 0
    for token in _BRACKET.finditer(text):
        mark = text[token.start()]
        if mark in "{[":
            depth += 1
        elif mark in "}]":
            depth -= 1
            if mark == "}" and depth <= closing:
                yield text[start : token.end()], True
                start = token.end()
    if start < len(text):
        yield text[start:], False


def elements(text: str) -> list[str]:
    """Top-level parts of the inside of an array; a ``]`` that closes it may come last."""
    found, start, depth = [], 0, 0
    for token in _TOKEN.finditer(text):
        mark = text[token.start()]
        if mark in "{[":
            depth += 1
        elif mark in "}]":
            depth -= 1
            if depth < 0 and mark == "]" and not text[token.end():].strip(BLANKS):
                text = text[: token.start()]
                break
        elif mark == "," and depth == 0:
            found.append(text[start : token.start()].strip(BLANKS))
            start = token.end()
    found.append(text[start:].strip(BLANKS))
    return found if found != [""] else []


def line(text: str) -> str:
    """A record as a line; what is no object is set apart."""
    return text if text.startswith("{") and RECORD_END not in text else apart(text)


def apart(text: str) -> str:
    return SET_APART + text.replace(RECORD_END, SET_APART)


def lines(text: str, closing: int, opens: bool, ends: bool) -> list[str]:
    """Lines for a cut text; ``opens`` and ``ends``: it is the first or last of its document."""
    body = (text.removeprefix(BYTE_ORDER_MARK) if opens else text).strip(BLANKS)
    if body == "" or (closing == IN_ARRAY and ends and not opens and body == "]"):
        return []
    if closing == BARE and opens:
        return [line(body)]
    if closing == BARE or not body.startswith("[" if opens else ","):
        return [apart(body)]
    body = body[1:].lstrip(BLANKS)
    if body.startswith("{") and not ends:
        return [line(body)]
    return [line(element) for element in elements(body)]


Key = tuple[int, int, int, bool]
"""File, its size, where a block starts in it, and whether the block is the whole file."""
KEY = ["file", "size", "block", "alone"]
MIXED = "value string, kind string, of long"
LINE, STATE, EDGE, RECUT_EDGE = "line", "state", "edge", "recut"
STATES = (
    "file long, size long, block long, quotes long, net_out long, net_in long, closing int,"
    " guess int, level int, least int, cuts long"
)
CHUNKS = "file long, size long, block long, chunk long, text string"
EDGES = (
    "file long, size long, block long, piece long, text string, closing int,"
    " closes boolean, opens boolean, ends boolean"
)


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(",")]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(_names(schema), zip(*rows))))


def _mixed(rows: Iterable[tuple[str, str, int]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[str, str, int]] = []
    for row in rows:
        held.append(row)
        if len(held) >= 2000:
            yield _batch(MIXED, held)
            held = []
    if held:
        yield _batch(MIXED, held)


def _block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Key, str]]:
    """Runs of fragments of one block, joined again; in row order, some to a block.

    Each text ends with the comma behind its last fragment, the last of a file too.
    """
    for batch in batches:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in KEY]
        changes = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = [0, *(np.flatnonzero(changes) + 1), batch.num_rows]
        for start, stop in zip(starts, starts[1:]):
            values = batch.column("value").slice(start, stop - start)
            joined = pc.binary_join(pa.ListArray.from_arrays([0, stop - start], values), ",")
            yield tuple(k[start].item() for k in keys), joined[0].as_py() + ","


def _unended(texts: Iterable[str]) -> Iterator[str]:
    """All of the texts but for the very last character, the comma that a file did not have.

    Where it did have one there, it is dropped too: no element stands behind it.
    """
    held = None
    for text in texts:
        if held is not None:
            yield held
        held = text
    yield held[:-1]


def _last_marked(cuts: Iterable[Cut]) -> Iterator[tuple[str, bool, bool]]:
    held = None
    for text, closes in cuts:
        if held is not None:
            yield (*held, False)
        held = (text, closes)
    if held is not None:
        yield (*held, True)


def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments (``KEY``, ``value``) to lines; of blocks of larger files also their state and edges."""
    return _mixed(_taken_apart(batches))


def _taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int]]:
    for (file, size, block, alone), run in groupby(_block_texts(batches), key=itemgetter(0)):
        texts = (text for _, text in run)
        if alone:
            first = next(texts)
            cuts = cut(_unended(_chained(first, texts)), closing_depth(first))
            closing = closing_depth(first)
            for piece, (text, _, ends) in enumerate(_last_marked(cuts)):
                yield from ((x, LINE, 0) for x in lines(text, closing, piece == 0, ends))
        else:
            yield from _speculated((file, size, block), Marks(texts))


def take_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (``value``), each in a row, to lines."""
    return _mixed(
        (x, LINE, 0) for batch in batches for text in batch.column("value") for x in document_lines(text.as_py())
    )


def document_lines(text: str) -> Iterator[str]:
    """As a document comes in fragments: without the mark that readers of lines skip, or a comma at its end."""
    text = text.removeprefix(BYTE_ORDER_MARK).removesuffix(",")
    closing = closing_depth(text)
    cuts = cut_short(text, closing) if len(text) <= SHORT else cut([text], closing)
    for piece, (part, _, ends) in enumerate(_last_marked(cuts)):
        yield from lines(part, closing, piece == 0, ends)


def _chained(first: str, rest: Iterator[str]) -> Iterator[str]:
    yield first
    yield from rest


_MARKS = np.isin(np.arange(256), list(b'"{}[]'))
_FOLLOWS = re.compile(r"[ \t\r\n]*(?:\Z|\]|,[ \t\r\n]*(?:\Z|\{))")


class Marks:
    """The text of a block, and the brackets in it: where, which, and how many quotes came before, odd or even."""

    def __init__(self, texts: Iterable[str]):
        parts, at, self.quotes, self.first_quote = [], 0, 0, -1
        found: list[tuple[np.ndarray, ...]] = []
        for text in texts:
            data = np.frombuffer(text.encode("ISO-8859-1"), np.uint8)
            marks = np.flatnonzero(_MARKS[data])
            if "\\" in text:
                marks = np.setdiff1d(marks, _escaped(data), assume_unique=True)
            quote = data[marks] == ord('"')
            before = self.quotes + np.cumsum(quote)
            if self.first_quote < 0 and quote.any():
                self.first_quote = at + int(marks[quote][0])
            found.append((marks[~quote] + at, data[marks[~quote]], (before[~quote] & 1).astype(np.int8)))
            self.quotes += int(quote.sum())
            at += len(text)
            parts.append(text)
        self.text = "".join(parts)
        nothing = (np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.int8))
        self.place, self.mark, self.odd = (np.concatenate(x) for x in zip(nothing, *found, strict=True))
        self.step = np.where((self.mark == ord("{")) | (self.mark == ord("[")), 1, -1)

    def net(self, in_string: int) -> int:
        """The change in depth if the block begins so."""
        return int(self.step[self.odd == in_string].sum())

    def likely_in_string(self) -> int:
        """By what stands before the first quote: one that opens a string comes after a mark."""
        before = self.text[max(0, self.first_quote - 100) : max(0, self.first_quote)].rstrip(BLANKS)
        return int(before != "" and before[-1] not in "{[:,")

    def objects(self, in_string: int) -> tuple[np.ndarray, np.ndarray]:
        """Where objects end, and how deep the text is then, from the block's start."""
        outside = self.odd == in_string
        closed = self.mark[outside] == ord("}")
        return self.place[outside][closed] + 1, np.cumsum(self.step[outside])[closed]


def _escaped(data: np.ndarray) -> np.ndarray:
    """Places of characters that a backslash takes along: those behind every other one of a run."""
    slashes = np.flatnonzero(data == ord("\\"))
    begins = np.diff(slashes, prepend=-2) != 1
    first = np.maximum.accumulate(np.where(begins, np.arange(len(slashes)), 0))
    return slashes[(np.arange(len(slashes)) - first) % 2 == 0] + 1


def _speculated(key: tuple[int, int, int], block: Marks) -> Iterator[tuple[str, str, int]]:
    """A block's state, the lines it holds if it begins as is likely, and its edges.

    Records are taken to end where objects do that no other is around, from the block's start, if what follows
    mostly looks like it.  Whether that was right is known when all states are; see ``stands``.
    """
    file, _, begin = key
    closing = closing_depth(block.text) if begin == 0 else None
    guess = 0 if begin == 0 else block.likely_in_string()
    places, depths = block.objects(guess)
    least = int(depths.min()) if len(depths) else None
    level = least if closing is None else closing
    ends = places[depths <= level].tolist() if least is not None else []
    if closing is None and 2 * sum(1 for end in ends if _FOLLOWS.match(block.text, end)) < len(ends):
        ends = []
    state = (*key, block.quotes, block.net(0), block.net(1), closing, guess, level, least, len(ends))
    yield json.dumps(dict(zip(_names(STATES), state, strict=True))), STATE, file
    for piece, (start, end) in enumerate(zip([0, *ends], ends, strict=False)):
        if piece == 0 and begin != 0:
            yield _edge(key, piece, block.text[start:end], None, True, False, False), EDGE, file
        else:
            of = IN_ARRAY if closing is None else closing
            yield from ((x, LINE, file) for x in lines(block.text[start:end], of, begin == 0 and piece == 0, False))
    rest = block.text[ends[-1] if ends else 0 :]
    yield _edge(key, len(ends), rest, None, False, begin == 0 and not ends, True), EDGE, file


def _edge(*values) -> str:
    key, *rest = values
    return json.dumps(dict(zip(_names(EDGES), (*key, *rest), strict=True)))


STANDS = """
    (cuts > 0 AND guess = in_string AND level = closing - depth AND (block = 0 OR closing = 1))
    OR (cuts = 0 AND guess = in_string AND (least IS NULL OR least > closing - depth))
    OR (cuts = 0 AND quotes = 0 AND in_string = 1)
"""
"""Whether a block was cut as it is now known to begin: ``in_string``, at ``depth``, in a document whose records end at ``closing``."""


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments to fewer, larger rows, numbered within their block."""
    for (*block, _), run in groupby(_block_texts(batches), key=itemgetter(0)):
        for chunk, (_, text) in enumerate(run):
            yield _batch(CHUNKS, [(*block, chunk, text)])


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines for the records that lie within one block, whose chunks come in order.

    The head and tail that a block has of records reaching across come as JSON of ``EDGES``.
    """
    return _mixed(_cut_blocks(batches))


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int]]:
    for key, run in groupby(_chunk_rows(batches), key=itemgetter(0)):
        *block, in_string, depth, closing, first, last = key
        texts = (text for _, text in run)
        cuts = cut(_unended(texts) if last else texts, closing, in_string, depth)
        for piece, (text, closes, at_end) in enumerate(_last_marked(cuts)):
            opens, ends = first and piece == 0, last and at_end
            if (piece > 0 or opens) and (closes or ends):
                yield from ((x, LINE, 0) for x in lines(text, closing, opens, ends))
            else:
                yield _edge(block, piece, text, closing, closes, opens, ends), RECUT_EDGE, 0


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str]]:
    named = ("file", "size", "block", "in_string", "depth", "closing", "first", "last")
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in named]
        yield from zip(zip(*columns), batch.column("text").to_pylist())


def cut_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts put together from edges (``text``, ``closing``, ``opens``, ``ends``) to lines."""
    return _mixed(
        (x, LINE, 0)
        for batch in batches
        for r in batch.to_pylist()
        for x in lines(r["text"], r["closing"], r["opens"], r["ends"])
    )
