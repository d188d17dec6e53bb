"""The filter audit against every order applied in turn, over many micro-batches and odd rows."""

import random
from collections import Counter, defaultdict
from itertools import permutations
from pathlib import Path

import pytest

from schemagate.llm import interactions
from schemagate.storage import setting

LABELS = "doc_id long, quality int, toxic int"


def failed(doc_id, text, least):
    words = (text or "").encode().split()
    capitals = sum("A" <= c <= "Z" for c in text or "")
    return {
        x
        for x, bad in {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * capitals > 2 * len(text or ""),
            "D": any(c in "#$%&*|" for c in text or ""),
            "E": doc_id is not None and least.get(text or "", doc_id) < doc_id,
        }.items()
        if bad
    }


def plain(rows, labels):
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for doc_id, text, source in rows:
        parts[source or ""].append((doc_id, failed(doc_id, text, least)))
    result, removed_by = [], Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left, gone = docs, []
            for step, own in enumerate(order, 1):
                hit = [d for d in left if own in d[1]]
                redundant = sum(own in d[1] for d in gone)
                left, gone = [d for d in left if own not in d[1]], gone + hit
                removed_by[part, own] += len(hit)
                result.append(
                    [part, order, step, len(left), len(hit), redundant, sum(d[1] == {own} for d in docs),
                     sum(d[0] in good for d in hit), sum(d[0] in toxic for d in hit)]
                )
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in result)


def written(spark, rows, path, files):
    """Files whose ids fall from one to the next, so that later ones take over."""
    rows = sorted(rows, key=lambda r: -(r[0] or 0))
    for n in range(files):
        spark.createDataFrame(rows[n::files] if n % 2 else rows[n::files][::-1], interactions.DOCUMENT).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def odd_rows(rows):
    rng = random.Random(11)
    long = " ".join(f"w{i}" for i in range(230))
    more = [(1000 + i, rng.choice([long, long.upper(), long + " #", "a b " * 150, "", None]), rng.choice([None, "", "x"])) for i in range(60)]
    return [(i, t, [None, "b", "a", "", "é"][n % 5]) for n, (i, t) in enumerate(rows)] + more + more[:5] + [(None, long, "x"), (None, None, "x")]


@pytest.mark.parametrize("batch_bytes", [1, 1 << 40])
def test_every_order_is_counted_as_when_applied(spark, odd_rows, tmp_path, batch_bytes):
    path = written(spark, odd_rows, str(tmp_path / "docs"), 3)
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 1060, 3)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (5, None, None)]
    found = interactions.audited(spark, path, spark.createDataFrame(labels, LABELS), batch_bytes)
    assert sorted(map(tuple, found.collect())) == plain(odd_rows, labels)


def test_no_rows(spark, tmp_path):
    path = written(spark, [], str(tmp_path / "docs"), 1)
    assert interactions.audited(spark, path, spark.createDataFrame([], LABELS)).collect() == []


def test_columns_of_other_names_are_left_out(spark, odd_rows, tmp_path):
    wide = spark.createDataFrame(odd_rows[:40], interactions.DOCUMENT).selectExpr("*", "1 AS part", "2 AS mask", "'x' AS key", "3 AS n")
    wide.write.parquet(str(tmp_path / "docs"))
    found = interactions.audited(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABELS))
    assert sorted(map(tuple, found.collect())) == plain(odd_rows[:40], [])


def test_a_smaller_id_takes_a_text_over():
    row = lambda own, part, n=1: (b"k", 1, part, False, False, own, n, 0, 0)
    least, holders, change = interactions.taken_over(None, {}, [row(9, "a")])
    assert (least, holders, change) == (9, {("a", False, False): 1}, {("a", 1, False, False): 1, ("a", 17, False, False): 0})
    least, holders, change = interactions.taken_over(least, holders, [row(4, "b", 2), row(20, "a")])
    assert (least, holders) == (4, {("b", False, False): 2})
    assert {k: n for k, n in change.items() if n} == {("a", 1, False, False): -1, ("a", 17, False, False): 2, ("b", 1, False, False): 2}


def test_micro_batches_do_not_follow_the_input(spark, odd_rows, tmp_path):
    for files in (4, 12):
        path = written(spark, odd_rows, str(tmp_path / f"docs{files}"), files)
        everything = sum(f.stat().st_size for f in Path(path).glob("*.parquet"))
        with setting(spark, "spark.sql.files.maxPartitionBytes", "1b"):
            got = interactions._batch_bytes(spark, path)
        # Before, it was what all cores read at once, however many times that was in the input.
        assert everything <= got * interactions.MICRO_BATCHES < everything + interactions.MICRO_BATCHES
    found = interactions.audited(spark, path, spark.createDataFrame([], LABELS), got)
    assert sorted(map(tuple, found.collect())) == plain(odd_rows, [])


def test_large_ids_keep_their_order(spark, tmp_path):
    big = (1 << 62) + 1
    path = written(spark, [(big, "same", "a"), (big - 1, "same", "b"), (None, "same", "a")], str(tmp_path / "docs"), 3)
    found = interactions.mask_counts(spark, path, spark.createDataFrame([], LABELS), 1)
    assert sorted((r.part, bool(r["mask"] & interactions.COPY), r.n) for r in found.collect()) == [("a", False, 1), ("a", True, 1), ("b", False, 1)]
