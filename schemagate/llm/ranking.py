"""Exact ranked lexical search by bag deduplication.

Documents are restricted to the words of the items.  What is left of a document, its bag, are
those words' numbers with how often each occurs; with its length number m that is all a score
depends on.  Documents with equal bags and equal m form a class: rows are brought together by a
hash and are one class only if bag and m are equal themselves.  A class is scored once, for all
items, and the best classes of an item are expanded into their members by ascending ``doc_id``.

A class that has ``top`` others before it by score and smallest id can't answer, as each of those has
a document before all of its own; so a task sends ``top`` classes an item at most, and of each of the
classes chosen the ``top`` smallest ids are all that can be asked for.  Copies are put together in the
tasks that read them, so a group of any size moves as one row a task.

Items are taken in blocks of about ``BLOCK_TERMS`` of their terms; the words, weights and
places of one block are what a driver and its tasks hold.  Documents are read once for each.

Null texts have no terms and answer nothing, as do items without terms.  A null ``doc_id`` comes last among
equal scores.  Rows of an ``item_id``, null being one, are one item.  Repeated documents count once
each.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schemagate.llm.common import Scratch, byte_texts, small_batches, stored, text_chunks

TOP = 50
BLOCK_TERMS = 500_000
"""Rows of item and term that are handled at a time, about."""
COMBINE_BYTES = 16 << 20
"""Bags and ids that a task holds before it sends them on."""
CELLS = 1 << 21
"""Scores of classes by items that a task holds at a time."""
LAST = (1 << 63) - 1

BAGS = "doc_id long, n long, bag binary"
PARTS = "digest long, m long, bag binary, ids array<long>"
BEST = "item int, score long, least long, class long"

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
"""Capitals to small letters, what can't be in a term to blanks."""


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


def searched(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of the best documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    wanted = scratch.stored(items.select("item_id", "text").mapInArrow(_item_terms, "item_id long, term binary").distinct(), "wanted")
    blocks = max(1, -(-wanted.count() // block_terms))
    in_block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [_block(docs, wanted.where(in_block == b), top, Scratch(spark)) for b in range(blocks)]
    scratch.remove()
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(i, t) for i, text in zip(batch.column("item_id").to_pylist(), byte_texts(batch), strict=True) for t in set(terms_of(text))]
        ids, terms = zip(*pairs, strict=True) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])


def _block(docs: DataFrame, wanted: DataFrame, top: int, scratch: Scratch) -> DataFrame:
    pairs = wanted.toArrow()
    item_ids = pairs.column("item_id").to_pylist()
    terms = pairs.column("term").to_pylist()
    numbers = {t: n for n, t in enumerate(sorted(set(terms)))}
    known = list(dict.fromkeys(item_ids))
    bags = scratch.stored(docs.select("doc_id", "text").mapInArrow(_bags_of(numbers), BAGS), "bags")
    totals = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = weights_of(totals[0], _document_counts(bags, len(numbers)))
    parts = scratch.stored(bags.where("octet_length(bag) > 0").mapInArrow(_parts_of(*totals), PARTS), "parts")
    merged = parts.groupBy("digest", "m", "bag").agg(F.min(F.array_min("ids")).alias("least"))
    classes = scratch.stored(merged.withColumn("class", F.monotonically_increasing_id()), "classes")
    at = {i: n for n, i in enumerate(known)}
    items_of = Incidence([(numbers[t], at[i]) for i, t in zip(item_ids, terms, strict=True)], len(numbers), len(known))
    scored = classes.mapInArrow(_best_of(weights, items_of, top), BEST)
    ahead = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("least"), "class")
    best = scratch.stored(scored.withColumn("place", F.row_number().over(ahead)).where(F.col("place") <= top).drop("place", "least"), "best")
    answers = stored(_expanded(best, classes, parts, top), "answers")
    scratch.remove()
    names = F.array(*(F.lit(i).cast("long") for i in known)) if known else F.array().cast("array<long>")
    return answers.select(F.get(names, F.col("item")).alias("item_id"), "rank", "doc_id", "score")


def _expanded(best: DataFrame, classes: DataFrame, parts: DataFrame, top: int) -> DataFrame:
    """The members of the best classes, smallest ids first, as the answers of each item."""
    chosen = classes.join(best.select("class").distinct(), "class", "left_semi").select("class", "digest", "m", "bag")
    members = parts.join(chosen.select("digest").distinct(), "digest", "left_semi").join(chosen, ["digest", "m", "bag"])
    by_id = F.asc_nulls_last("doc_id")
    members = members.select("class", F.explode("ids").alias("doc_id"))
    members = members.withColumn("place", F.row_number().over(Window.partitionBy("class").orderBy(by_id))).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), by_id))
    return best.join(members.drop("place"), "class").withColumn("rank", rank).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def _bags_of(numbers: dict[bytes, int]):
    def bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            lengths, packed = [], []
            for text in byte_texts(batch):
                found = terms_of(text)
                lengths.append(len(found))
                packed.append(pack({numbers[t]: n for t, n in Counter(found).items() if t in numbers}))
            columns = [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "bag"])

    return bags


def pack(counts: dict[int, int]) -> bytes:
    """Term numbers in order and their counts, as bytes; of equal counts equal ones."""
    order = sorted(counts)
    return np.array(order + [counts[t] for t in order], "<u4").tobytes()


def unpack(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bags in a row: the bag that each entry is of, its term and its count."""
    flat = np.frombuffer(b"".join(bags), "<u4")
    sizes = np.array([len(b) // 8 for b in bags], np.int64)
    bag = np.repeat(np.arange(len(bags)), sizes)
    # An entry lies behind its own bag's earlier ones and both halves of the bags before.
    place = np.arange(len(bag)) + np.repeat(np.cumsum(sizes) - sizes, sizes)
    return bag, flat[place].astype(np.int64), flat[place + np.repeat(sizes, sizes)].astype(np.int64)


def _document_counts(bags: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each of the block's terms occurs."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(unpack(batch.column("bag").to_pylist())[1], minlength=n_terms)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(total[terms], pa.int64())], ["term", "df"])

    counts = np.zeros(n_terms, np.int64)
    found = bags.select("bag").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    counts[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return counts


def weights_of(n_docs: int, counts: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in counts], np.int64)


def _parts_of(n_docs: int, n_terms: int):
    """Rows with equal bag and m of a task as one, with their ids."""

    def sent(held: dict[tuple[int, bytes], list]) -> pa.RecordBatch:
        hashed = [xxhash.xxh3_64_intdigest(bag, seed=m & (1 << 64) - 1) for m, bag in held]
        columns = [
            pa.array(np.array(hashed, np.uint64).view(np.int64)), pa.array((m for m, _ in held), pa.int64()),
            pa.array((bag for _, bag in held), pa.binary()), pa.array(held.values(), pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["digest", "m", "bag", "ids"])

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list] = defaultdict(list)
        size = 0
        for batch in batches:
            for doc_id, n, bag in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "bag")), strict=True):
                ids = held[100 - 50 + 50 * n * n_docs // n_terms, bag]
                size += 8 if ids else len(bag) + 200
                ids.append(doc_id)
                if size >= COMBINE_BYTES:
                    yield sent(held)
                    held.clear()
                    size = 0
        if held:
            yield sent(held)

    return parts


class Incidence:
    """Which items hold each term, as one array with the bounds of each term's part."""

    def __init__(self, pairs: list[tuple[int, int]], n_terms: int, n_items: int):
        term, item = np.array(pairs, np.int64).reshape(-1, 2).T
        self.n_items = n_items
        self.item = item[np.argsort(term, kind="stable")]
        self.size = np.bincount(term, minlength=n_terms)
        self.start = np.cumsum(self.size) - self.size

    def scores(self, bags: list[bytes], m: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A row of scores per bag, a column per item."""
        row, term, tf = unpack(bags)
        gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
        size = self.size[term]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.start[term], size)
        result = np.zeros(len(bags) * self.n_items, np.int64)
        np.add.at(result, np.repeat(row * self.n_items, size) + self.item[place], np.repeat(gain, size))
        return result.reshape(len(bags), self.n_items)


def _best_of(weights: np.ndarray, items_of: Incidence, top: int):
    """The ``top`` classes of each item among a task's."""

    def cut(rows: np.ndarray) -> np.ndarray:
        item, score, least, _ = rows
        rows = rows[:, np.lexsort((least, -score, item))]
        starts = np.searchsorted(rows[0], np.arange(items_of.n_items))
        return rows[:, np.arange(rows.shape[1]) - starts[rows[0]] < top]

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((4, 0), np.int64)
        floor = np.ones(items_of.n_items, np.int64)
        step = max(1, CELLS // max(1, items_of.n_items))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                m, least, number = (part.column(c).fill_null(LAST).to_numpy() for c in ("m", "least", "class"))
                scores = items_of.scores(part.column("bag").to_pylist(), m, weights)
                row, item = np.nonzero(scores >= floor)
                kept = cut(np.hstack([kept, np.stack([item, scores[row, item], least[row], number[row]])]))
                full = np.bincount(kept[0], minlength=items_of.n_items) >= top
                last = np.searchsorted(kept[0], np.arange(items_of.n_items), "right") - 1
                floor[full] = kept[1][last[full]]
        least = pa.array(kept[2], pa.int64(), mask=kept[2] == LAST)
        columns = [pa.array(kept[0], pa.int32()), pa.array(kept[1]), least, pa.array(kept[3])]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "least", "class"])

    return best


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS words FROM documents),
terms AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(words) AS term FROM docs) GROUP BY k, term),
totals AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM terms, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
lengths AS (SELECT k, doc_id, 100 - 50 + ((50 * len(words) * n_docs) // n_terms) AS m FROM docs, totals WHERE len(words) > 0),
scored AS (SELECT item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN terms USING (term) JOIN lengths USING (k) GROUP BY item_id, k, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
