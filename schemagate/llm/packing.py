"""Best-fit packing of token sequences by a grouping genetic algorithm.

Texts become token ids, cut from the end into pieces of the sequence length, so that only the
first piece may be shorter.  Pieces are dealt at random into chunks of a bounded number; full
ones are sequences of their own, the others of a chunk are packed by several islands.  An
island holds a few packings.  Crossover injects the best-filled bins of one into another whole,
removes what is now there twice together with its bins, and puts the displaced pieces back by
best fit, longest first.  After each epoch an island's elite migrates to the next one.

A chunk stops as soon as no packing can have fewer bins.  As chunks are dealt by hash, no
source or group of copies makes one larger; a chunk is what a task holds.

Null and empty texts are one piece, the end token alone.  Repeated rows are pieces of their
own.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import random
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemagate.llm.common import stored, text_chunks

LENGTH = 1024
END = 2
"""Tokens of a sequence, and the id that closes each document."""
CHUNK_PIECES = 8192
ISLANDS, EPOCHS, POPULATION, CHILDREN = 3, 2, 4, 6
SEED = 7

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

LATIN = r"a-zA-ZªµºÀ-ÖØ-öø-ɏ"
DIGITS = r"0-9²³¹¼-¾"
BLANKS = r"\t-\r \u0085 "
"""Fixed values: the letters, numbers and white space below U+0250."""


class TokenIds(dict):
    """The ids of pretokens as little-endian 32-bit numbers, remembered up to a number of them."""

    SIMPLE = re.compile(r"[\x00-ɏ‐-‧]*")
    WORDS = re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?[{LATIN}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LATIN}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
    )
    REMEMBERED = 300_000

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merged = _byte_pairs(vocabulary)

    def _encoded(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.REMEMBERED:
            self.clear()
        if self.merged is None:
            ids = self._encoded(word)
        else:
            ids = array("I", self.merged.encode_ordinary(word)).tobytes()
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """The text's ids.  Texts of letters below U+0250 are cut here, as the tokenizer does it, to reuse words."""
        if any(s in text for s in self.special) or not self.SIMPLE.fullmatch(text):
            return self._encoded(text)
        return b"".join(map(self.__getitem__, self.WORDS.findall(text)))


def _byte_pairs(vocabulary: str):
    """The same merges in an encoder that is quicker for single words, if ids are in the order of merges."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        model = json.load(file)["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"].get(a + b) for a, b in pairs]
    if order != list(range(256, 256 + len(order))) or sys.byteorder != "little":
        return None
    # In such files bytes that print stand for themselves and the others, in order, for 256 and on.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
    special = set(model["vocab"]) - {a + b for a, b in pairs} - set(byte)
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """Each document's ids and end token as pieces of at most ``length``, all but the first full."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds(vocabulary or default_vocabulary())
        end = np.array([END], "<u4").tobytes()
        for chunk in text_chunks(batches):
            rows: list[tuple] = []
            texts = chunk.column("text").to_pylist()
            for doc_id, text in zip(chunk.column("doc_id").to_pylist(), texts, strict=True):
                ids = (tokens.of(text) if text else b"") + end
                count = len(ids) // 4
                stops = range((count - 1) % length + 1, count + 1, length)
                for number, stop in enumerate(stops):
                    start = max(0, stop - length)
                    rows.append((doc_id, number, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, PIECES)


def packed(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, chunk_pieces: int = CHUNK_PIECES) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id`` and their ``offset`` in that sequence."""
    cut = stored(pieces(docs, vocabulary, length), "pieces")
    chunks = max(1, -(-cut.count() // chunk_pieces))
    dealt = cut.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))

    def begin(rows: pa.Table) -> pa.Table:
        first = _island_rows(rows.column("chunk")[0].as_py(), _in_order(rows)[1], length)
        return pa.Table.from_batches([_evolved(row, 0, length) for row in first.to_pylist()])

    # A task has one Python function at a time: each in a chain would be a process of its own, which executors keep.
    islands = dealt.groupBy("chunk").applyInArrow(begin, ISLAND)
    for epoch in range(1, EPOCHS):

        def evolve(batches: Iterator[pa.RecordBatch], epoch=epoch) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _evolved(row, epoch, length)

        islands = stored(islands, "islands")
        elite = F.struct("fitness", "packing")
        guests = islands.select("chunk", ((F.col("island") + 1) % ISLANDS).alias("island"), elite.alias("guest"))
        islands = islands.drop("guest").join(guests, ["chunk", "island"]).select(*ISLAND_COLUMNS).mapInArrow(evolve, ISLAND)
    best = islands.groupBy("chunk").agg(F.max_by("packing", F.struct("fitness", "island")).alias("packing"))

    def assign(rows: pa.Table, packings: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({c: pa.array([], t) for c, t in RESULT_TYPES.items()})
        order, lengths = _in_order(rows)
        bins = np.full(len(rows), -1, np.int64)
        short = lengths < length
        bins[short] = np.frombuffer(packings.column("packing")[0].as_py(), np.int32)
        bins[~short] = (bins.max(initial=-1) + 1) + np.arange(int((~short).sum()))
        by_bin = np.argsort(bins, kind="stable")
        ahead = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        new = np.concatenate(([True], np.diff(bins[by_bin]) != 0))
        offsets = np.empty(len(rows), np.int64)
        offsets[by_bin] = ahead - np.maximum.accumulate(np.where(new, ahead, 0))
        table = rows.take(pa.array(order)).drop_columns(["chunk"])
        chunk = rows.column("chunk")[0].as_py()
        return table.append_column("sequence_id", pa.array(bins * chunks + chunk)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("chunk").cogroup(best.groupBy("chunk")).applyInArrow(assign, f"{PIECES}, sequence_id long, offset long")


RESULT_TYPES = {
    "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
    "sequence_id": pa.int64(), "offset": pa.int64(),
}
ISLAND = "chunk long, island int, lengths binary, fitness double, packing binary, guest struct<fitness:double,packing:binary>"
ISLAND_COLUMNS = ["chunk", "island", "lengths", "fitness", "packing", "guest"]
ISLAND_TYPES = [
    pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.binary(),
    pa.struct([("fitness", pa.float64()), ("packing", pa.binary())]),
]


def _in_order(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a chunk's packing speaks of its pieces, and their lengths in it."""
    columns = [rows.column(c).to_numpy() for c in ("ids_crc32", "piece", "doc_id", "length")]
    order = np.lexsort(columns[:3] + [-columns[3]])
    return order, columns[3][order]


def _island_rows(chunk: int, lengths: np.ndarray, full: int) -> pa.Table:
    short = lengths[lengths < full].astype(np.int32).tobytes()
    rows = [[chunk] * ISLANDS, list(range(ISLANDS)), [short] * ISLANDS, [0.0] * ISLANDS, [None] * ISLANDS, [None] * ISLANDS]
    return pa.table([pa.array(c, t) for c, t in zip(rows, ISLAND_TYPES, strict=True)], names=ISLAND_COLUMNS)


def _evolved(row: dict, epoch: int, length: int) -> pa.RecordBatch:
    """The island after an epoch; its packing is the best it has seen."""
    sizes = np.frombuffer(row["lengths"], np.int32).tolist()
    seed = random.Random(f"{SEED}/{row['chunk']}/{row['island']}/{epoch}")
    known = [p for p in (row["packing"], (row["guest"] or {}).get("packing")) if p is not None]
    best = evolution(sizes, length, seed, [_bins(np.frombuffer(p, np.int32)) for p in known])
    place = np.empty(len(sizes), np.int32)
    for number, members in enumerate(best):
        place[members] = number
    values = [row["chunk"], row["island"], row["lengths"], fitness(best, sizes, length), place.tobytes(), None]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(values, ISLAND_TYPES, strict=True)], names=ISLAND_COLUMNS
    )


def _bins(place: np.ndarray) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(int(place.max(initial=-1)) + 1)]
    for piece, number in enumerate(place.tolist()):
        bins[number].append(piece)
    return bins


def fitness(bins: list[list[int]], sizes: list[int], length: int) -> float:
    """Fewer bins first, then fuller ones: the mean of squared fills, less the number of bins."""
    fills = [sum(sizes[p] for p in members) / length for members in bins]
    return sum(f * f for f in fills) / max(1, len(fills)) - len(fills)


def best_fit(bins: list[list[int]], items: list[int], sizes: list[int], length: int) -> list[list[int]]:
    """Put each item into the bin with the least room that still takes it, or a new one."""
    at_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r: some bin has r tokens of room
    for number, members in enumerate(bins):
        room = length - sum(sizes[p] for p in members)
        at_room[room].append(number)
        rooms |= 1 << room
    for item in items:
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = at_room[room].pop()
            if not at_room[room]:
                rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            room, number = length, len(bins)
            bins.append([item])
        at_room[room - size].append(number)
        rooms |= 1 << (room - size)
    return bins


def evolution(sizes: list[int], length: int, seed: random.Random, known: list[list[list[int]]]) -> list[list[int]]:
    """The best packing that a few rounds of crossover from ``known`` and fresh packings give."""
    least = -(-sum(sizes) // length)
    longest_first = sorted(range(len(sizes)), key=lambda p: -sizes[p])
    population = [known_bins for known_bins in known] or [best_fit([], longest_first, sizes, length)]
    best = min(population, key=len)
    if len(best) <= least:
        return best
    while len(population) < POPULATION:
        # Long pieces lead, those of about a length in random order.
        noise = [-sizes[p] * (0.8 + 0.4 * seed.random()) for p in range(len(sizes))]
        population.append(best_fit([], sorted(longest_first, key=noise.__getitem__), sizes, length))
    for _ in range(CHILDREN):
        first, second = seed.sample(range(len(population)), 2)
        child = crossover(population[first], population[second], sizes, length, seed)
        population.append(child)
        population.sort(key=lambda bins: -fitness(bins, sizes, length))
        del population[POPULATION:]
        if len(population[0]) <= least:
            break
    return population[0]


def crossover(receiver: list[list[int]], donor: list[list[int]], sizes: list[int], length: int, seed: random.Random) -> list[list[int]]:
    """The donor's fullest bins enter whole; bins that hold the same pieces go, the rest is best-fitted."""
    fullest = sorted(donor, key=lambda members: -sum(sizes[p] for p in members))
    injected = [list(members) for members in fullest[: seed.randint(1, max(1, len(donor) // 2))]]
    inside = {p for members in injected for p in members}
    displaced = []
    bins = injected
    for members in receiver:
        if inside.isdisjoint(members):
            bins.append(list(members))
        else:
            displaced += [p for p in members if p not in inside]
    displaced.sort(key=lambda p: (-sizes[p], p))
    return best_fit(bins, displaced, sizes, length)
