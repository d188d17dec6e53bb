"""Ranked search and the positional index against plain searches, on rows with nulls, ties and copies."""

import hashlib
import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest

from schemagate.llm import positional, ranking
from schemagate.llm.common import Scratch

ITEMS = "item_id long, text string"


def terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


@pytest.fixture(scope="module")
def items(rows):
    """Passages of the rows, words in another order, and what is odd."""
    rng = random.Random(2)
    texts = [t for _, t in rows if t and 60 < len(terms(t)) < 1000]
    found = []
    for n, t in enumerate(rng.sample(texts, 12)):
        words = t.split(" ")
        at = rng.randrange(len(words) - 40)
        found.append((n, " ".join(words[at : at + rng.choice([5, 10, 25])])))
    found += [(12, "THREE two one"), (13, None), (14, ""), (15, "!!"), (16, "nowhere to be found at all"), (None, "one two three")]
    return [*found, found[0], (0, "one two three"), (1, found[1][1])]


# 11: ranked search


def plain_ranks(rows, items, top):
    bags = [(i, Counter(terms(t))) for i, t in rows]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    result = []
    for i, wanted in asked.items():
        scored = []
        for doc_id, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in wanted if t in bag
            )
            if score:
                scored.append((-score, brute.LAST if doc_id is None else doc_id, doc_id))
        result += [(i, n, doc_id, -s) for n, (s, _, doc_id) in enumerate(sorted(scored, key=lambda r: r[:2])[:top], 1)]
    return sorted(result, key=repr)


@pytest.mark.parametrize(("top", "block_terms"), [(3, 10**6), (50, 10**6), (7, 20)])
def test_ranks_are_those_of_a_plain_search(spark, docs, rows, items, top, block_terms):
    found = ranking.searched(docs, spark.createDataFrame(items, ITEMS), top, block_terms)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranks(rows, items, top)


def test_tasks_that_send_early_and_small_steps_change_nothing(spark, docs, rows, items, monkeypatch):
    monkeypatch.setattr(ranking, "COMBINE_BYTES", 300)
    monkeypatch.setattr(ranking, "CELLS", 1)
    found = ranking.searched(docs, spark.createDataFrame(items, ITEMS), 5)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranks(rows, items, 5)


def test_a_large_class_is_expanded_by_ascending_id(spark):
    rows = [(i, "a b c") for i in range(400, 100, -1)] + [(50, "c b a"), (7, "a a a d")]
    found = ranking.searched(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), spark.createDataFrame([(1, "b")], ITEMS))
    assert [r.doc_id for r in sorted(found.collect(), key=lambda r: r.rank)] == [50, *range(101, 150)]


def test_bags_of_equal_hash_stay_apart(spark, docs, rows, items, monkeypatch):
    same = lambda bag, seed: 1
    monkeypatch.setattr(ranking, "xxhash", type("Same", (), {"xxh3_64_intdigest": staticmethod(same)}))
    found = ranking.searched(docs, spark.createDataFrame(items, ITEMS), 5)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranks(rows, items, 5)


def test_bags_are_packed_and_unpacked():
    rng = random.Random(1)
    counts = [{rng.randrange(50): rng.randrange(1, 9) for _ in range(rng.randrange(6))} for _ in range(40)]
    bag, term, n = ranking.unpack([ranking.pack(c) for c in counts])
    assert list(zip(bag.tolist(), term.tolist(), n.tolist(), strict=True)) == [(i, t, c[t]) for i, c in enumerate(counts) for t in sorted(c)]
    assert len(np.concatenate(ranking.unpack([]))) == 0


def test_ranking_of_empty_tables(spark, docs, no_docs, items):
    none = spark.createDataFrame([], ITEMS)
    assert ranking.searched(docs, none).collect() == []
    assert ranking.searched(no_docs, spark.createDataFrame(items, ITEMS)).collect() == []


def test_ranking_with_clashing_columns(spark, wide_docs, rows, items):
    found = ranking.searched(wide_docs, spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS term", "1 AS score"), 4)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranks(rows, items, 4)


# 12: positional index


def plain_hits(rows, items, width=10):
    windows = {}
    for i, text in items:
        w = terms(text)
        size = min(width, len(w))
        for s in range(len(w) - size + 1) if w else ():
            windows.setdefault(size, {}).setdefault(tuple(w[s : s + size]), set()).add("" if i is None else str(i))
    result = []
    for doc_id, text in rows:
        w, hit, ids = terms(text), set(), set()
        for size, known in windows.items():
            for s in range(len(w) - size + 1):
                if found := known.get(tuple(w[s : s + size])):
                    hit |= set(range(s, s + size))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        result.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("width", [1, 3, 10])
def test_hits_are_those_of_a_plain_search(spark, docs, rows, items, width):
    found = positional.decontaminated(docs, spark.createDataFrame(items, ITEMS), width)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_hits(rows, items, width)


def test_without_broadcast_hits_are_the_same(spark, docs, rows, items, monkeypatch):
    monkeypatch.setattr(positional, "BROADCAST_ROWS", 0)
    found = positional.decontaminated(docs, spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, found.collect()), key=repr) == plain_hits(rows, items)


def test_repeated_words_and_overlapping_windows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(120)))) for i in range(40)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(150)))) for i in range(12)]
    found = positional.decontaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), 4)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_hits(rows, items, 4)


def test_decontamination_of_empty_tables(spark, docs, no_docs, rows, items):
    clean = positional.decontaminated(docs, spark.createDataFrame([], ITEMS))
    assert sorted(map(tuple, clean.collect()), key=repr) == plain_hits(rows, [])
    assert positional.decontaminated(no_docs, spark.createDataFrame(items, ITEMS)).collect() == []


def test_decontamination_with_clashing_columns(spark, wide_docs, rows, items):
    wide = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS word", "1 AS term", "2 AS item")
    found = positional.decontaminated(wide_docs.selectExpr("*", "1 AS k1", "2 AS pos"), wide)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_hits(rows, items)


def test_nearby_finds_items_with_words_put_in(spark):
    item = "the quick brown fox jumps over a lazy dog near old barns"
    near = item.replace("fox", "fox who").replace("near", "right near")
    far = item.replace("fox", "fox " + "who " * 9)
    rows = [(1, f"x y {item} z"), (2, near), (3, far), (4, "barns lazy quick"), (5, "the the the over a"), (6, None)]
    rows += [(10 + i, "the over a dog quick old fox near") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = positional.indexed(docs, spark.createDataFrame([(9, item), (8, "barns"), (7, "unseen words")], ITEMS), Scratch(spark))
    named = positional.nearby(index, probes=3, slop=2).join(index.documents, ["k1", "k2"]).select("doc_id", "item_id", "start")
    found = sorted(map(tuple, named.collect()))
    rarest = ["brown", "jumps", "lazy"]  # the first of those with the shortest lists

    def places(text, word):
        return [p for p, w in enumerate(terms(text)) if w == word]

    want = set()
    for i, text in rows:
        for first in (p - 2 for p in places(text, rarest[0])):
            if all(any(abs(p - at - first) <= 2 for p in places(text, w)) for w, at in (("jumps", 4), ("lazy", 7))):
                want.add((i, "9", first))
        want |= {(i, "8", p) for p in places(text, "barns")}
    assert found == sorted(want)
    assert {i for i, n, _ in found if n == "9"} == {1, 2}
