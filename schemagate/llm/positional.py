"""Benchmark decontamination with a distributed positional inverted index.

``indexed`` stores the postings of all test words in the training texts: word, text, place.
``phrases`` looks for windows of ten consecutive words of an item.  From the lengths of the
postings lists it takes each window's rarest words and intersects their lists, adjusted by the
words' places in the item: what agrees is a diagonal, an item laid at a place of a text.  Only
texts on a diagonal are read again, once each, and compared word by word.  ``nearby`` intersects
the lists of each item's rarest words with some slack and so finds items with words put in or
left out.  Everything is DataFrame operations.

Lists are intersected by hashed groups of (item, text, diagonal), each a bit mask, combined in the
tasks that read the postings; a frequent word, or a passage that many documents share, is never a
group of its own.  Texts are known by two 64-bit hashes with different seeds, so copies have one
set of diagonals.  The tables of test words and of the words chosen are broadcast up to
``BROADCAST_ROWS`` rows, which is counted, and joined by shuffles beyond.

Null texts have no words.  Items without words are found nowhere; rows of an item id, null being
the empty text as an id, are one item.  Repeated documents each get their own row.  Empty tables give
no hits or no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemagate.llm.common import Scratch

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
"""A word before its capitals are lowered; the same places as of the contract's pattern after that."""
WIDTH = 10
"""Words of a window; an item with fewer is one window."""
PROBES = 2
"""Lists intersected for a window, the shortest first."""
BITS = 63
"""Places of an item that a diagonal's mask tells apart; two places so far apart share a bit."""
BROADCAST_ROWS = 200_000
SALTS = 16
"""Parts that the rows of a text are dealt into."""
TEXT = ["k1", "k2"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Index(NamedTuple):
    documents: DataFrame
    """``doc_id``, ``k1``, ``k2`` and ``n_words`` of every row."""
    postings: DataFrame
    """``term``, ``k1``, ``k2`` and ``pos``, from 0, of every test word in the texts."""
    lengths: DataFrame
    """``term`` and ``length`` of its list."""
    items: DataFrame
    """``item``, ``item_id`` and ``words``."""
    places: DataFrame
    """``item``, ``n_words`` of it, ``ipos`` and ``term`` of every word of an item."""


def lowered(word: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does just that where all is ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), "text")


def _with_small(rows: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Joined to a table that is broadcast if it is small."""
    return rows.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on)


def indexed(docs: DataFrame, items: DataFrame, scratch: Scratch) -> Index:
    """Postings of the words of ``items`` (``item_id``, ``text``) in ``docs`` (``doc_id``, ``text``)."""
    named = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    words = F.transform(words_of(F.col("text")), lowered).alias("words")
    known = items.select(named, words).where(F.size("words") > 0).distinct()
    known = scratch.stored(known.withColumn("item", F.monotonically_increasing_id()), "items")
    spread = known.select("item", F.size("words").alias("n_words"), F.posexplode("words").alias("ipos", "word"))
    terms = scratch.stored(spread.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    # One more word, the empty one, stands before each text, so that every document is in the index.
    empty = docs.sparkSession.createDataFrame([("", -1)], "word string, term long")
    read = _keyed(docs).select("doc_id", *TEXT, words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    tokens = read.select("doc_id", *TEXT, "n_words", F.posexplode(F.concat(F.array(F.lit("")), F.col("words"))).alias("pos", "raw"))
    tokens = tokens.select("doc_id", *TEXT, "n_words", (F.col("pos") - 1).alias("pos"), lowered(F.col("raw")).alias("word"))
    found = _with_small(tokens, scratch.stored(terms.union(empty), "terms"), "word").drop("word")
    postings = scratch.stored(found, "postings")
    own = postings.where("term >= 0").select("term", *TEXT, "pos")
    return Index(
        postings.where("term = -1").select("doc_id", *TEXT, F.col("n_words").cast("long").alias("n_words")),
        own,
        scratch.stored(own.groupBy("term").agg(F.count(F.lit(1)).alias("length")), "lengths"),
        known,
        scratch.stored(spread.join(terms, "word").select("item", "n_words", "ipos", "term"), "places"),
    )


def _with_lengths(index: Index) -> DataFrame:
    """The items' words with the lengths of their lists, 0 where there is none."""
    return index.places.join(index.lengths, "term", "left").fillna(0, ["length"])


def anchors(index: Index, width: int = WIDTH, probes: int = PROBES) -> DataFrame:
    """``item``, ``ipos``, ``term``: the words with the shortest lists of each window that can occur.

    ``need`` is how many bits a diagonal has at least where one of the item's windows stands.
    """
    shift = F.least(F.col("n_words"), F.lit(width))
    first, last = F.greatest(F.col("ipos") - shift + 1, F.lit(0)), F.least(F.col("ipos"), F.col("n_words") - shift)
    words = _with_lengths(index).withColumn("window", F.explode(F.sequence(first, last)))
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("length", "ipos", "term"))), 1, probes)
    windows = words.groupBy("item", "window").agg(F.min("length").alias("least"), rarest.alias("rarest")).where("least > 0")
    bits = F.size(F.array_distinct(F.transform("rarest", lambda x: x["ipos"] % BITS)))
    windows = windows.withColumn("need", F.min(bits).over(Window.partitionBy("item")))
    return windows.select("item", "need", F.explode("rarest").alias("x")).select("item", "need", "x.ipos", "x.term").distinct()


def diagonals(index: Index, chosen: DataFrame) -> DataFrame:
    """``item``, ``k1``, ``k2`` and ``shift`` of the text's place where the item's first word would stand."""
    at = _with_small(index.postings, chosen, "term")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("ipos") % BITS)
    met = at.groupBy("item", *TEXT, (F.col("pos") - F.col("ipos")).alias("shift"), "need").agg(F.bit_or(bit).alias("bits"))
    return met.where(F.bit_count("bits") >= F.col("need")).select("item", *TEXT, "shift")


def phrases(docs: DataFrame, index: Index, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """``k1``, ``k2``, ``item_id``, ``start`` and ``width`` of every window of an item in a text."""
    chosen = scratch.stored(anchors(index, width), "anchors")
    lengths = index.items.select("item", F.size("words").alias("n_words"))
    laid = scratch.stored(diagonals(index, chosen).join(lengths, "item"), "diagonals")
    # Of a text's documents one is compared.
    of_text = laid.groupBy(*TEXT).agg(F.collect_list(F.struct("item", "shift", "n_words")).alias("laid"))
    holder = index.documents.join(laid.select(*TEXT).distinct(), TEXT, "left_semi").groupBy(*TEXT).agg(F.min("doc_id").alias("doc_id"))
    wanted = of_text.join(holder, TEXT)
    read = _keyed(docs).alias("d").join(
        wanted.alias("w"), (F.col("d.k1") == F.col("w.k1")) & (F.col("d.k2") == F.col("w.k2")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    ).select("w.k1", "w.k2", "laid", F.transform(words_of(F.col("text")), lowered).alias("words"))

    def part(x: Column) -> Column:
        first = F.greatest(x["shift"], F.lit(0))
        beneath = F.slice("words", first + 1, x["n_words"] + x["shift"] - first)
        return F.struct(x["item"].alias("item"), first.alias("first"), (first - x["shift"]).alias("skipped"), beneath.alias("beneath"))

    parts = read.select(*TEXT, F.explode(F.transform("laid", part)).alias("x")).select(*TEXT, "x.*")
    facing = parts.join(index.items, "item").withColumn("size", F.least(F.size("words"), F.lit(width)))
    facing = facing.withColumn("facing", F.slice("words", F.col("skipped") + 1, F.size("beneath"))).where(F.size("beneath") >= F.col("size"))
    same = lambda i: F.slice("beneath", i, F.col("size")) == F.slice("facing", i, F.col("size"))
    starts = F.filter(F.sequence(F.lit(1), F.size("beneath") - F.col("size") + 1), same)
    found = facing.select(*TEXT, "item_id", "first", "size", F.explode(starts).alias("i"))
    return found.select(*TEXT, "item_id", (F.col("first") + F.col("i") - 1).alias("start"), F.col("size").alias("width")).distinct()


def nearby(index: Index, probes: int = 3, slop: int = 5) -> DataFrame:
    """``k1``, ``k2``, ``item_id``, ``start``: where an item's rarest words stand near their places.

    ``start`` is where the item would begin by its rarest word; each of the next ``probes - 1``
    ones stands at most ``slop`` words from its place by that.  Items of fewer words have fewer.
    """
    rank = F.row_number().over(Window.partitionBy("item").orderBy("length", "ipos")).alias("rank")
    chosen = _with_lengths(index).select("item", "ipos", "term", "n_words", "length", rank).where(F.col("rank") <= probes)
    gone = chosen.where("length = 0").select("item").distinct()
    chosen = chosen.join(gone, "item", "left_anti")
    lists = _with_small(index.postings, chosen, "term").select("item", *TEXT, "rank", (F.col("pos") - F.col("ipos")).alias("start")).distinct()
    # Places up to slop apart are in the same stretch or in neighbouring ones.
    stretch = F.floor(F.col("start") / (slop + 1))
    found = lists.where("rank = 1").select("item", *TEXT, "start", stretch.alias("stretch"))
    for n in range(2, probes + 1):
        other = lists.where(F.col("rank") == n).select("item", *TEXT, F.col("start").alias("other"), F.explode(F.sequence(stretch - 1, stretch + 1)).alias("stretch"))
        with_other = found.join(other, ["item", *TEXT, "stretch"]).where(F.abs(F.col("start") - F.col("other")) <= slop)
        short = chosen.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < n).select("item")
        found = with_other.select("item", *TEXT, "start", "stretch").distinct().unionByName(found.join(short, "item", "left_semi"))
    return found.join(index.items, "item").select(*TEXT, "item_id", F.col("start").alias("start")).distinct()


def covered_words(found: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``n_hit`` words in any window, and ``items``, the ids in order."""
    in_order = Window.partitionBy(*TEXT).orderBy("start", "width").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("width")
    spans = found.select(*TEXT, "start", "width").distinct()
    new = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(in_order), F.lit(0))), F.lit(0))
    hits = spans.withColumn("new", new).groupBy(*TEXT).agg(F.sum("new").alias("n_hit"))
    ids = found.groupBy(*TEXT).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return hits.join(ids, TEXT)


def decontaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document its words, how many of them lie in a window of an item, and which items these are."""
    scratch = Scratch(docs.sparkSession)
    index = indexed(docs, items, scratch)
    hits = scratch.stored(covered_words(phrases(docs, index, scratch, width)), "hits")
    dealt = index.documents.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    salted = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return dealt.join(salted, [*TEXT, "salt"], "left").select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE = rf"""
WITH words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
sized AS (SELECT *, least(len(words), {WIDTH}) AS width FROM words WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item_id, width, words[p + 1:p + width] AS phrase FROM (SELECT *, unnest(range(len(words) - width + 1)) AS p FROM sized)),
texts AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
windows AS (SELECT k, width, p, words[p + 1:p + width] AS phrase FROM (SELECT k, words, width, unnest(range(len(words) - width + 1)) AS p
    FROM texts, (SELECT DISTINCT width FROM sized) WHERE len(words) >= width)),
found AS (SELECT k, item_id, p, w.width FROM windows w JOIN wanted USING (width, phrase)),
hit AS (SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(p, p + width)) AS place FROM found) GROUP BY k),
named AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (k) LEFT JOIN named USING (k)
"""
