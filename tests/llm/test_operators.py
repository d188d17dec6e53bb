"""Every operator against a plain version, on rows with nulls, ties, copies and odd texts."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import corpus_pipeline
from schemagate.llm import bottomk, common, components, hamming, language, licenses, mixing, packing, repetition, sharding, substrings, warc


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plain(rows):
    return sorted(rows, key=repr)


# 1: substring dedup


def most_held(work):
    """MB that Python and numpy hold at most during ``work``."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_block_and_a_group_take_little_memory():
    """Of what stands as a task's share; four Python workers and the JVM share an executor."""
    size = substrings.BLOCK_BYTES // 6
    text = " ".join(f"{i * 7919 % 100_003:05d}" for i in range(size))
    ids = pa.array([1, 2], pa.int64())
    block = pa.table({"__id": ids, "__block": pa.array([0, 0], pa.int64()), "text": [text[: len(text) // 2], text[len(text) // 2 :]]})
    assert most_held(lambda: substrings._Block(block, 13, substrings._Prefixes([], 64)).labels()) < 80
    rng = np.random.default_rng(3)
    sent = [substrings.packed(np.unique(rng.integers(0, 1 << 32, substrings.GROUP_SUFFIXES // 20, np.uint32))) for _ in range(20)]
    nodes = pa.table({"__group": [0] * 20, "__block": list(range(20)), "labels": sent})
    assert most_held(lambda: substrings._shared(nodes)) < 60


def test_a_label_of_several_blocks_is_seen_elsewhere():
    rng = np.random.default_rng(4)
    sent = [np.unique(rng.integers(0, 400, rng.integers(0, 120)).astype(np.uint32)) for _ in range(12)]
    nodes = pa.table({"__group": [0] * 12, "__block": list(range(12)), "labels": [substrings.packed(x) for x in sent]})
    bits = substrings._shared(nodes).column("bits").to_pylist()
    for i, x in enumerate(sent):
        others = np.concatenate([y for j, y in enumerate(sent) if j != i])
        assert np.unpackbits(np.frombuffer(bits[i], np.uint8))[: len(x)].astype(bool).tolist() == np.isin(x, others).tolist()

CUT = ("row.doc_id", "n_words", "n_removed", "sha2(kept_text, 256) AS kept_sha256")


@pytest.mark.parametrize("settings", [{}, {"group_suffixes": 500, "block_bytes": 20_000}])
def test_substrings_are_cut_as_by_a_plain_search(docs, rows, settings):
    assert plain(map(tuple, substrings.deduplicated(docs, **settings).selectExpr(*CUT).collect())) == plain(brute.substring_dedup(rows))


def test_prefixes_grow_until_groups_are_small(docs):
    plan = substrings._prefixes(docs, 13, 100)
    assert len(plan.frequent) > 1 and plan.groups > 1


def test_removed_spans_name_the_words_cut(docs):
    for r in substrings.deduplicated(docs).collect():
        words = brute.words(r.row.text)
        gone = [k for s in r.removed for k in range(s.start, s.start + s.length)]
        assert len(gone) == r.n_removed
        assert b" ".join(w for k, w in enumerate(words) if k not in set(gone)).decode() == r.kept_text


def test_text_without_repeats_keeps_its_white_space(docs):
    kept = {r.text for r in substrings.shortened(docs).collect()}
    assert "\u00a0  wide \u2003 blank" in kept


# 2: language


def test_code_lengths_equal_a_plain_model():
    rng = random.Random(3)
    for _ in range(25):
        train = [bytes(rng.choice(b"abcdef ") for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 5))]
        runs, counts = np.unique(language.byte_runs(train)[0], return_counts=True)
        model = language.Model(["x"], [language.Tree(runs, counts)])
        texts = [bytes(rng.choice(b"abcdefgz ") for _ in range(rng.randrange(30))) for _ in range(4)]
        assert np.allclose(model.lengths(texts)[:, 0], [_plain_length(train, t) for t in texts], rtol=1e-5)


def _plain_length(train, text):
    seen = [defaultdict(Counter) for _ in range(4)]
    for t in train:
        b = language.START + t
        for i in range(3, len(b)):
            for k in range(4):
                seen[k][b[i - k : i]][b[i]] += 1
    b, bits = language.START + text, 0.0
    for i in range(3, len(b)):
        out = set()
        for k in (3, 2, 1, 0):
            known = {s: n for s, n in seen[k].get(b[i - k : i], {}).items() if s not in out}
            total, kinds = sum(known.values()), len(known)
            if b[i] in known:
                bits += math.log2((total + kinds) / known[b[i]])
                break
            bits += math.log2((total + kinds) / kinds) if kinds else 0
            out |= set(known)
        else:
            bits += math.log2(256 - len(out))
    return bits


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = language.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 30 and sum(r.lang_pred == r.lang for r in found) / len(found) >= 0.95


def test_odd_texts_have_no_language(docs, rows):
    for r in language.predicted(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        known = re.search(r"[^\W\d_]", r.text or "")
        assert (r.lang_pred in ("en", "de") if known else r.lang_pred == "und") and 0 <= r.score <= 1


def test_a_language_of_few_long_documents_is_learned(spark):
    """Its share of the training bytes is less than a document, or than a millionth."""
    texts = [("en", "the cat and the dog are there "), ("de", "der hund und die katze sind da ")]
    rows = [(i * 2 + k, text * 40, lang) for i in range(20) for k, (lang, text) in enumerate(texts)]
    docs = spark.createDataFrame(rows + [(1_000, "", "fr"), (1_001, None, "it")], "doc_id long, text string, lang string")
    for train_bytes in (0, 10):
        got = language.predicted(docs, train_bytes).where("doc_id < 1000").collect()
        assert [r.lang_pred for r in got] == [rows[r.doc_id][2] for r in got]


# 3: mixing


def test_apportionment_gives_highest_quotients(spark):
    rng = random.Random(1)
    for _ in range(6):
        votes = {i: rng.choice([0, 1, 3, 3, 10, 1000]) * rng.random() for i in range(rng.randint(1, 9))}
        for seats in (0, 1, 7, 100):
            entries = spark.createDataFrame([(1, k, float(v), seats) for k, v in votes.items()], "h int, e int, v double, s long")
            won = dict(table(mixing.apportioned(entries, "h", "e", "v", "s"), "e", "won"))
            assert won == (brute.sainte_lague(votes, seats) if any(votes.values()) else dict.fromkeys(votes, 0))


@pytest.mark.parametrize("shard_documents", [20_000, 10])
def test_mix_comes_near_its_targets(docs, rows, shard_documents):
    mix = mixing.mixed(docs, shard_documents=shard_documents)
    got = mix.select("row.source", "size", "source_size", "target", "times", "part").collect()
    sizes = Counter()
    for r in got:
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = brute.water_filled(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    shards = max(1, -(-len(rows) // shard_documents))
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and math.isclose(r.target, targets[s]) for r in own)
        taken = sum(r.times * r.size + r.part for r in own)
        assert abs(taken - targets[s]) <= 8 * (shards + 1)
        assert all(0 <= r.part <= r.size and r.times * r.size + r.part <= 3 * r.size for r in own)
    assert sorted(r.size for r in got) == sorted(len(brute.words(t)) for _, t in rows)


def test_a_small_source_of_short_texts_meets_its_target_in_many_shards(spark):
    rows = [(i, "word", "small") for i in range(300)] + [(i, "w " * 40, "large") for i in range(300, 5_000)]
    mix = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_documents=10)
    small = mix.where("row.source = 'small'").select("target", (F.col("times") * F.col("size") + F.col("part")).alias("taken")).collect()
    assert small[0].target == 900 and abs(sum(r.taken for r in small) - 900) <= 8 and max(r.taken for r in small) <= 3


def test_mix_repeats_and_writes_what_it_takes(docs):
    mix = table(mixing.mixed(docs), "doc_id", "size", "times", "part")
    assert mix == table(mixing.mixed(docs.repartition(3)), "doc_id", "size", "times", "part")
    written = mixing.taken_rows(docs)
    assert written.columns == docs.columns
    assert sum(len(brute.words(r.text)) for r in written.collect()) == sum(m[1] * m[2] + m[3] for m in mix)


# 4: sharding


def test_shards_are_even_and_hold_groups_together(docs, rows):
    got = sharding.sharded(docs, shards=4).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(i) for i, _ in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(4)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))
    sizes = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    assert Counter((r.size, r.text_crc32) for r in got) == sizes
    where = {r.doc_id: r.shard for r in got}
    copies = [where[i] for i in brute.by_text(rows)[rows[0][1]] if i is not None]
    assert len(set(copies)) <= 2


def test_a_group_larger_than_a_shard_is_spread(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"own {i}") for i in range(300)], "doc_id long, text string")
    got = sharding.sharded(docs, shards=10).collect()
    assert set(Counter(r.shard for r in got).values()) == {30}


def test_a_group_larger_than_a_shard_fills_several(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 == 0 else f"own {i}") for i in range(12_000)], "doc_id long, text string")
    got = sharding.sharded(docs, shards=40)
    cut = sharding.cut_share(got.where(F.col("text_crc32") == zlib.crc32(b"same")), F.col("text_crc32")).first()
    assert 1 - cut.cut / cut.pairs >= 0.06  # at random 0.025, at best 0.075
    assert set(Counter(r.shard for r in got.select("shard").collect()).values()) == {300}


def test_groups_move_to_one_shard(spark):
    docs = spark.createDataFrame([(i, f"text {i // 3}" if i < 60 else f"own {i}") for i in range(400)], "doc_id long, text string")
    cut = sharding.cut_share(sharding.sharded(docs, shards=8), F.col("text_crc32")).first()
    assert cut.pairs == 60 and cut.cut <= 6


# 5: licenses


def test_phrases_are_counted_where_they_stand(docs, rows):
    want = []
    for doc, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        at = [
            (k, label) for phrase, label in licenses.PHRASES for p in [phrase.split()]
            for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p
        ]
        places = [k for k, _ in at]
        labels = ",".join(sorted({label for _, label in at}))
        want.append((doc, len(w), len(at), min(places, default=None), max(places, default=None), labels))
    got = table(licenses.scanned(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == plain(want)
    assert any(r[2] >= 3 for r in got)


def test_changed_license_text_is_found_on_merged_diagonals(docs):
    found = {r.labels for r in licenses.scanned(docs).where("labels != ''").collect()}
    assert found == {"mit", "apache,apache-2.0", "gpl,gpl-text"}


def test_words_of_a_text_are_read_once(spark, monkeypatch):
    texts = [
        "The MIT license,mit LICENSE and mit", "license", "apache", "license", None, "", "...", "mit licence", "x" * 70 + " mit license",
        "m\u0130t license \u212ait license Licensed under the Apache License, Version 2.0", "general-public_license general public\u00e9 license",
    ]
    calls = []
    found = licenses.looked_up
    monkeypatch.setattr(licenses, "looked_up", lambda docs: calls.append(found(docs)) or calls[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    scanned = licenses.scanned(docs)
    # Before, the pattern cut all texts twice: for the number of words, and for the pairs.
    assert len(calls) == 1 and "regexp_extract_all" not in scanned._jdf.queryExecution().toString()
    words = [re.findall(licenses.WORD, (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in texts]
    got = {r.doc_id: r for r in scanned.collect()}
    assert [got[i].n_words for i in range(len(texts))] == list(map(len, words))
    grams = {(*row[5:7], row[7]): n for n, row in enumerate(licenses.template_rows())}
    want = {(i, n, p) for i, w in enumerate(words) for gram, n in grams.items() for p in range(len(w))
            if tuple(w[p : p + len([x for x in gram if x])]) == tuple(x for x in gram if x)}
    rows = licenses.looked_up(docs.withColumn("key", F.lit(b"k"))).select("doc_id", F.inline("found")).collect()
    assert {(r.doc_id, licenses.template_rows()[r.row][5:], r.pos) for r in rows} == {(i, licenses.template_rows()[n][5:], p) for i, n, p in want}


def test_versions_and_relatives_are_told_apart(spark):
    under, header = "licensed under the {}", (
        "this program is free software you can redistribute it and or modify it under the terms of the {} public license"
        " as published by the free software foundation"
    )
    want = {
        under.format("GNU General Public License, version 2"): "gpl,gpl-2.0",
        under.format("GNU General Public License, version 3"): "gpl,gpl-3.0",
        under.format("terms of the GNU General Public License, version 2"): "gpl,gpl-2.0",
        under.format("GNU Lesser General Public License, version 2.1"): "gpl",
        under.format("GNU Affero General Public License, version 3"): "gpl",
        under.format("Apache License, Version 1.1"): "apache",
        under.format("Apache License, Version 2.0"): "apache,apache-2.0",
        under.format("GNU General Public License version 2 or the GNU General Public License version 3"): "gpl,gpl-2.0,gpl-3.0",
        under.format("GNU General Public License version 2 license version 3"): "gpl,gpl-2.0",
        header.format("gnu general"): "gpl,gpl-text",
        header.format("gnu lesser general"): "gpl",
        header.format("gnu affero general"): "gpl",
    }
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = dict(table(licenses.scanned(docs), "doc_id", "labels"))
    assert [got[i] for i in range(len(want))] == list(want.values())


# 6: near-duplicates


@pytest.mark.parametrize(("width", "percent"), [(4, 80), (5, 90)])
def test_classes_equal_those_of_all_pairs(docs, rows, width, percent):
    got = table(bottomk.classes(docs, width, percent), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain(brute.near_duplicates(rows, width, percent))


def test_classes_do_not_depend_on_list_sizes_or_frequent_shingles(docs, rows, monkeypatch):
    monkeypatch.setattr(bottomk, "HOT_IN_TASK", 1)
    monkeypatch.setattr(bottomk, "HOT_IN_ALL", 3)
    monkeypatch.setattr(bottomk, "LIST_ENTRIES", 50)
    got = table(bottomk.classes(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain(brute.near_duplicates(rows))


def test_a_family_of_borderline_copies_over_several_blocks(spark, monkeypatch):
    """Some copies are linked with most others, some with few, some with none."""
    monkeypatch.setattr(bottomk, "BLOCK_NODES", 16)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        share = rng.choice([0.005, 0.02, 0.03, 0.06])
        rows.append((i, " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_duplicates(rows)
    assert 2 < len({c for _, _, c, _ in want}) < 80
    assert table(bottomk.classes(docs), "doc_id", "n_shingles", "component_id", "kept") == plain(want)


def test_blocks_are_compared_as_sets(monkeypatch):
    rng = np.random.default_rng(2)
    for dense in (2, 4, 32):
        monkeypatch.setattr(bottomk, "DENSE", dense)
        sets = [np.unique(rng.integers(0, rng.choice([6, 30]), rng.integers(1, 25))).astype(np.uint64) for _ in range(40)]
        got = bottomk._linked(sets, 80)
        both = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
        want = [[100 * n >= 80 * (len(x) + len(y) - n) for n, y in zip(row, sets)] for row, x in zip(both, sets)]
        assert (got | np.eye(40, dtype=bool)).tolist() == want  # a set and itself is no pair
        label = bottomk._connected(got)
        assert all(label[i] == label[j] for i, j in zip(*np.nonzero(got))) and (label <= np.arange(40)).all()


def test_a_link_between_families_around_a_frequent_passage_is_compared(spark):
    """A link that the order of frequent shingles gives few common pairs is a candidate all the same."""
    passage = " ".join(f"p{i}" for i in range(7_200))
    shared = " ".join(f"s{i}" for i in range(3_500))
    rows = [(i, f"{passage} {shared} {' '.join(f'{i}own{k}' for k in range(1_300))}") for i in range(2)]
    rows += [(i, f"{passage} {' '.join(f'{i}own{k}' for k in range(4_800))}") for i in range(2, 26)]
    assert len({c for _, _, c, _ in brute.near_duplicates(rows)}) == 25
    sets = bottomk.shingle_sets(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 4)
    apart = spark.createDataFrame([], "node long, label long")
    pairs = table(bottomk._between_families(bottomk.inverted_lists(sets, 80), apart, 80), "a", "b")
    assert tuple(sorted(n for n, in table(sets.where("doc_id < 2"), "node"))) in pairs


def crowd():
    """Near copies of a text, and texts of their own words around two thirds of it."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(w if rng.random() > 0.01 else f"x{rng.randrange(10**6)}" for w in base)) for i in range(60)]
    for i in range(60, 100):
        at = rng.randrange(50)
        own = [f"{i}own{k}" for k in range(50)]
        rows.append((i, " ".join(own[:at] + base[at : at + 100] + own[at:])))
    return rows


def test_a_text_that_meets_a_family_joins_it(spark):
    """Pairs of a family with each text that shares a passage with it are not given out one by one."""
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = bottomk.shingle_sets(docs, 4).cache()
    lists = bottomk.inverted_lists(sets, 80).cache()
    families = bottomk._families(bottomk._stars(lists), 80)
    found = sets.join(families, "node").select("doc_id", "label").collect()
    large = max((r.label for r in found), key=[r.label for r in found].count)
    inside = {r.doc_id for r in found if r.label == large}
    met = {n for n, in table(lists.join(sets.where("doc_id >= 60"), "node").select("doc_id").distinct(), "doc_id")}
    assert len(inside & set(range(60))) == 60 and len(inside & met) >= 0.8 * len(met) > 20
    assert table(bottomk.classes(docs), "doc_id", "n_shingles", "component_id", "kept") == plain(brute.near_duplicates(rows))


def test_centres_are_counted_over_all_buckets(spark, monkeypatch):
    """A pair of node and centre is one row, into however many buckets the lists are dealt."""
    sets = bottomk.shingle_sets(spark.createDataFrame(crowd(), "doc_id long, text string"), 4).cache()
    one = bottomk.inverted_lists(sets, 80)
    monkeypatch.setattr(bottomk, "LIST_ENTRIES", 100)
    many = bottomk.inverted_lists(sets, 80).cache()
    assert one.select("bucket").distinct().count() == 1 and many.select("bucket").distinct().count() > 20
    columns = ["a", "b", "n", "fits", "o"]
    assert table(bottomk._stars(many), *columns) == table(bottomk._stars(one), *columns)
    assert bottomk._stars(many).groupBy("a", "b").count().where("count > 1").isEmpty()


def test_entries_take_no_more_room_in_more_buckets():
    rng = np.random.default_rng(6)
    values = rng.integers(0, 1 << 48, 200_000, np.uint64)
    values[-9:] = 0, 0, 1, 1, (1 << 48) - 1, (1 << 48) - 1, 1 << 47, 1 << 24, (1 << 24) - 1
    nodes = np.repeat(rng.integers(-(1 << 62), 1 << 62, 2_000), 100)
    sizes = np.repeat(np.append(rng.integers(2, 3_000, 1_999), (1 << 31) - 1), 100)
    room = []
    for buckets in (1, 8, 400):
        dealt = bottomk._dealt(values, nodes, sizes, buckets)
        assert dealt.num_rows == buckets and dealt.column("bucket").to_pylist() == list(range(buckets))
        parts = [bottomk._entries(pa.table(dealt.slice(i, 1))) for i in range(buckets)]
        assert all(a[0].max() < b[0].min() for a, b in zip(parts, parts[1:]))
        back = [np.concatenate(x) for x in zip(*parts)]
        assert sorted(zip(*(x.tolist() for x in back))) == sorted(zip(values.tolist(), nodes.tolist(), sizes.tolist()))
        room.append(sum(len(pa.compress(b"".join(c.to_pylist()), "lz4_raw", asbytes=True)) for c in dealt.columns[1:]))
    # By node, with four bytes of size each, it is 18 in many buckets.
    assert max(room) < 14.5 * len(values)


def test_one_of_each_class_stays(docs, rows):
    kept = bottomk.one_of_each(docs, 4, 80)
    want = {i for i, _, _, k in brute.near_duplicates(rows) if k}
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(want - {None})


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = dict(table(components.components(spark.createDataFrame(links, "a long, b long")), "node", "label"))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


# 7: WARC audit


def test_audit_finds_every_fault_and_nothing_else(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "é" * (i % 50) if i % 7 else None) for i in range(700)], "page_id long, url string, html string")
    laid = warc.manifest(pages, {"a": lambda c: c, "b": warc.damaged}, file_records=100)
    found = warc.audited(warc.leaves(laid, "a"), warc.leaves(laid, "b")).join(laid, ["file", "offset"])
    want = [(i, i % 97 == 7) for i in range(700) if i % 97 in (3, 5, 7)]
    assert table(found, "page_id", F.col("second").isNull()) == plain(want)
    assert warc.audited(warc.leaves(laid, "a"), warc.leaves(laid, "a")).count() == 0


PAGES = "page_id long, url string, html string"


def test_audit_of_odd_pages(spark):
    long = "<p>é</p>" * 300_000
    rows = [(i, f"http://h/{i}", "x" * (i % 9)) for i in range(200)] + [(3, "http://h/3", "xxx"), (3, "other", None)]
    rows += [(None, None, "no id"), (None, "u", None), (5, None, ""), (100 + 97 * 3, None, long), (97 * 4 + 3, "long", long)]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS file", "1 AS offset", "2 AS length", "3 AS node", "'y' AS a")
    laid = common.stored(warc.manifest(pages, {"a": lambda c: c, "b": warc.damaged}, file_records=50), "laid")
    found = warc.audited(warc.leaves(laid, "a"), warc.leaves(laid, "b")).join(laid, ["file", "offset"])
    want = [(i, u, i % 97 == 7) for i, u, _ in rows if i is not None and i % 97 in (3, 5, 7)]
    assert table(found, "page_id", "url", F.col("second").isNull()) == plain(want)


def test_levels_only_add_writes(spark, monkeypatch):
    monkeypatch.setattr(warc, "LEVELS", 9)
    pages = spark.createDataFrame([(i, "u", "x" * 50) for i in range(200)], PAGES)
    laid = common.stored(warc.manifest(pages, {"a": lambda c: c, "b": warc.damaged}, file_records=50), "laid")
    found = warc.audited(warc.leaves(laid, "a"), warc.leaves(laid, "b"))
    assert found.count() == sum(i % 97 in (3, 5, 7) for i in range(200))
    assert "Exchange" not in found._jdf.queryExecution().toString()


def test_records_follow_each_other_in_files(spark):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(50)], "page_id long, url string, html string")
    content = warc.record(F.col("page_id"), F.col("url"), F.col("html"))
    for r in pages.select(content.alias("c"), "html").collect():
        head, body = r.c.split("\r\n\r\n", 1)
        assert body == r.html + "\r\n\r\n" and f"Content-Length: {len(r.html)}" in head
    for _, rows in _by_file(warc.manifest(pages, {}, file_records=10)).items():
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]


def _by_file(laid):
    files = defaultdict(list)
    for r in laid.orderBy("file", "offset").collect():
        files[r.file].append(r)
    return files


# 8: exact search


@pytest.mark.parametrize("spread", [4, 64])
def test_search_equals_comparing_all(spark, spread):
    rng = random.Random(spread)
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(3)]
    vectors = [(i, [x + rng.gauss(0, spread / 16) for x in rng.choice(centres)]) for i in range(400)]
    vectors += [(i, vectors[0][1]) for i in range(400, 500)] + [(7, vectors[7][1]), (None, vectors[0][1]), (600, None), (700, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    coded = [tuple(r) for r in hamming.codes(df).collect()]
    queries = [c for c in coded if c[0] % 20 == 0]
    got = table(hamming.searched(df, top=5, every=20), "query_id", "rank", "vec_id", "distance")
    assert got == plain(brute.nearest(coded, queries, 5))


@pytest.mark.parametrize(("group", "block"), [(4_096, 4_096), (16, 7)])
def test_search_over_small_groups_and_clashing_columns(spark, monkeypatch, group, block):
    monkeypatch.setattr(hamming, "GROUP_CODES", group)
    monkeypatch.setattr(hamming, "QUERY_BLOCK", block)
    rng = random.Random(group)
    # A third shares the low half of its bits, so one segment value is hot.
    low = [rng.gauss(0, 1) for _ in range(32)]
    vectors = [(i, (low if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(32)]) + [rng.gauss(0, 1) for _ in range(32)]) for i in range(600)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 AS code", "2 AS query", "'x' AS segment", "3 AS n")
    coded = [tuple(r) for r in hamming.codes(df).collect()]
    got = table(hamming.searched(df, top=4, every=25), "query_id", "rank", "vec_id", "distance")
    assert got == plain(brute.nearest(coded, [c for c in coded if c[0] % 25 == 0], 4))


def test_fewer_codes_than_asked_for(spark):
    vectors = [(i, [1.0 if i >> b & 1 else -1.0 for b in range(4)] * 16) for i in range(0, 12, 3)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    coded = [tuple(r) for r in hamming.codes(df).collect()]
    got = table(hamming.searched(df, top=10, every=3), "query_id", "rank", "vec_id", "distance")
    assert got == plain(brute.nearest(coded, coded, 10)) and len(got) == 12


def test_segments_cover_all_bits_once():
    for size in (0, 1, 500, 50_000, 10**9):
        segments = hamming.segments_of(size)
        assert [b for start, bits in segments for b in range(start, start + bits)] == list(range(64))


# 9: quality


def test_measures_equal_a_plain_count(docs, rows):
    short = [(i, t) for i, t in rows if len(t or "") < 5_000]
    names = list(brute.quality(""))
    got = table(repetition.judged(docs.where("length(text) < 5000 or text is null")), "doc_id", *names)
    assert got == plain((i, *brute.quality(t).values()) for i, t in short)


def test_kept_is_never_without_the_base_rule(docs):
    got = repetition.judged(docs).collect()
    assert not any(r.kept and r.base_failed for r in got)
    assert any(r.kept for r in got)
    passed = repetition.passed(docs)
    assert passed.schema == docs.schema
    assert passed.count() == sum(r.kept for r in got)


def test_long_repeats_fail_what_the_base_rule_lets_pass(spark):
    once = " ".join(f"u{i}" for i in range(100))
    docs = spark.createDataFrame([(1, f"{once} {' '.join(f'p{i}' for i in range(300))} {once}")], "doc_id long, text string")
    r = repetition.judged(docs).first()
    assert (r.base_failed, r.kept, r.n_covered, r.longest_repeat) == (False, True, 200, 100)
    docs = docs.withColumn("text", F.concat_ws(" ", *[F.lit(" ".join(f"u{i}" for i in range(48)))] * 2, F.lit(" ".join(f"p{i}" for i in range(100)))))
    r = repetition.judged(docs).first()
    assert (r.base_failed, r.kept) == (False, False)


# 10: packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


def test_own_cutting_gives_the_tokenizers_ids(tokenizer):
    ids = packing.TokenIds(packing.default_vocabulary())
    texts = ["", " ", "  a", "a\u0085b", "x\x1c y\x1f", "don't I'LL 12²³ ½", "日本語 text", "a<|endoftext|>b", "\n\n\n a\n  b \n"]
    texts += ["é combining", "“quotes” – … ok", "under_score __x", "\x00\x01 q", "a b c", "× ÷ ª º", "ɏɐ", "​ zero"]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab é'tsß1²\t\n _-—× \u0085\x1c") for _ in range(30)) for _ in range(400)]
    for text in texts:
        assert np.frombuffer(ids.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("settings", [{}, {"chunk_pieces": 16, "length": 64}])
def test_pieces_hold_all_tokens_once(docs, rows, tokenizer, settings):
    length = settings.get("length", 1024)
    got = packing.packed(docs, **settings).collect()
    want = Counter()
    total = 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        start = 0
        first = (len(ids) - 1) % length + 1
        for piece, stop in enumerate(range(first, len(ids) + 1, length)):
            want[doc, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
            start = stop
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for members in sequences.values():
        end = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= length
    assert len(sequences) <= 1.15 * math.ceil(total / length) + 3


def python_functions(node):
    """How many Python functions run at a time in the task of a plan node, and in that of any node below."""
    below = [node.children().apply(i) for i in range(node.children().size())]
    if node.nodeName() == "AdaptiveSparkPlan":
        below = [node.initialPlan()]
    counts = [python_functions(x) for x in below] or [(0, 0)]
    joined = max if node.nodeName() == "Union" else sum  # its sides are tasks of their own
    here = joined([x for x, _ in counts]) + any(x in node.nodeName() for x in ("Arrow", "Pandas", "Python"))
    return 0 if "Exchange" in node.nodeName() else here, max([here, *(x for _, x in counts)])


def test_a_task_of_the_pipeline_has_one_python_process(spark, docs, tmp_path, monkeypatch):
    """Each function of a chain is one of its own, and an executor keeps them for all that follows."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    most, write = [], DataFrameWriter.parquet

    def parquet(self, *args, **settings):
        most.append(python_functions(self._df._jdf.queryExecution().executedPlan())[1])
        return write(self, *args, **settings)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    assert corpus_pipeline.run(spark, str(tmp_path)).count()
    assert max(most) == 1


def test_crossover_keeps_every_piece_once():
    rng = random.Random(4)
    sizes = [rng.randint(1, 90) for _ in range(200)]
    parents = [packing.best_fit([], rng.sample(range(200), 200), sizes, 100) for _ in range(2)]
    for _ in range(20):
        child = packing.crossover(*parents, sizes, 100, rng)
        assert sorted(p for b in child for p in b) == list(range(200))
        assert all(sum(sizes[p] for p in b) <= 100 for b in child)
    best = packing.evolution(sizes, 100, rng, [])
    assert len(best) <= min(len(p) for p in parents)


# all of them

OPERATORS = {
    "substrings": lambda d: substrings.deduplicated(d).selectExpr(*CUT),
    "shortened": lambda d: substrings.shortened(d),
    "language": lambda d: language.predicted(d),
    "mixing": lambda d: mixing.mixed(d).drop("row"),
    "taken": lambda d: mixing.taken_rows(d).drop("__x"),
    "sharding": lambda d: sharding.sharded(d, shards=4).drop("slot"),
    "licenses": lambda d: licenses.scanned(d),
    "bottomk": lambda d: bottomk.classes(d),
    "one of each": lambda d: bottomk.one_of_each(d, 5, 80),
    "repetition": lambda d: repetition.judged(d),
    "passed": lambda d: repetition.passed(d),
    "packing": lambda d: packing.packed(d).drop("sequence_id", "offset"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_give_no_rows(no_docs, name):
    assert OPERATORS[name](no_docs).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_clashing_names_change_nothing(docs, wide_docs, name):
    few = "length(text) < 5000 or text is null"
    narrow, wide = OPERATORS[name](docs.where(few)), OPERATORS[name](wide_docs.where(few))
    assert set(wide.columns) in (set(narrow.columns), {*narrow.columns, *brute.CLASHING})
    columns = ["`" + c.replace("`", "``") + "`" for c in narrow.columns]
    assert table(narrow, *columns) == table(wide, *columns)


def test_search_and_audit_of_nothing(spark):
    assert hamming.searched(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    laid = warc.manifest(spark.createDataFrame([], "page_id long, url string, html string"), {"a": lambda c: c})
    assert warc.audited(warc.leaves(laid, "a"), warc.leaves(laid, "a")).collect() == []
