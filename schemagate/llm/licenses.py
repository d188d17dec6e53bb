"""License scans by diagonal voting.

All pairs of neighbouring words of all texts are looked up by hash among the places where templates
have them, and verified on the words themselves, a third word included where the template has
one.  Texts are read once, in whole arrays of word hashes; a text's number of words comes with it.  A match votes for a diagonal, its place in the text less its place in the template.  A
phrase stands where its diagonal has all votes.  For templates of running text, diagonals next
to each other are merged, as a word more or less moves the rest by one; their label is given
where enough of the template is found in a span of about its length and the words that tell it
from other licenses are among them.  Of overlapping notices of versions the best one stands.

Templates are a fixed table of a few hundred short rows, which each task holds.  Only matches are
shuffled.  Rows are told apart by id and text; rows equal in both have equal results and each
get them.  Null text is empty.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from schemagate.llm.common import byte_texts, hashed_words, small_batches, stored, text_chunks, window_hashes

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases, notices and license texts with their labels, words as the pattern cuts them.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
TEXTS = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "mit-text",
    ),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is"
        " distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "apache-text",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
        "gpl-text",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        "bsd-text",
    ),
]

TELLING = {
    "apache-2.0": ["license version 2"],
    "gpl-3.0": ["gnu general public", "license version 3"],
    "gpl-2.0": ["gnu general public", "license version 2"],
    "gpl-text": ["gnu general public"],
}
"""Word triples without which a text is another license or version, however much else is found."""
VERSIONS = ("apache-2.0", "gpl-3.0", "gpl-2.0")
"""Notices that differ by their telling words alone."""

NEIGHBOURS = 3
"""Diagonals at most so far apart are merged."""
LEAST_SHARE = 0.6
"""Share of a text template's word triples that must be found."""
MOST_STRETCH = 1.5
"""Longest span, in lengths of the template."""
HALF = 60
"""Votes kept in one of the two bit masks; a template has at most twice as many triples, which is checked."""


def template_rows() -> list[tuple[int, str, bool, int, int, str, str, str | None]]:
    """Template number, label, whether a phrase, place, votes to win, and two or three words."""
    rows: list[tuple] = []
    for number, (text, label) in enumerate(PHRASES + TEXTS):
        words, phrase = text.split(), number < len(PHRASES)
        grams = [(*words, None)] if len(words) == 2 else list(zip(words, words[1:], words[2:], strict=False))
        if len(grams) > 2 * HALF:
            raise ValueError(f"the template of {label} has more than {2 * HALF} word triples")
        rows += [(number, label, phrase, place, len(grams), *gram) for place, gram in enumerate(grams)]
    return rows


def telling_places(label: str) -> int:
    """The places of a label's telling triples in its template, as bits of the first mask."""
    words = next(text for text, own in TEXTS if own == label).split()
    return sum(1 << [" ".join(words[i : i + 3]) for i in range(HALF)].index(triple) for triple in TELLING[label])


_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xFF]+")
_BETWEEN = np.array([not _WORD_BYTES.match(bytes([b]).lower()) for b in range(256)])
MATCH = StructType().add("row", IntegerType()).add("pos", LongType())
"""A row of the templates and where a text has its words."""


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, places of base phrases, labels and ``score`` of every row."""
    small_batches(docs.sparkSession)
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    texts = stored(looked_up(docs.select("doc_id", F.unhex(key).alias("key"), "text")), "license-words")
    found = _summary(matches(texts))
    rows = texts.select("doc_id", "key", "n_words")
    labels = lambda c: F.array_join(F.array_sort(F.coalesce(c, F.array().cast("array<string>"))), ",")
    return rows.join(found, "key", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word",
        labels(F.col("base")).alias("base_labels"),
        labels(F.array_union("base", "own")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def looked_up(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``key`` of each row, its ``n_words``, and ``found``, all matches in its text."""
    rows = template_rows()
    grams = [[word and word.encode() for word in row[5:]] for row in rows]
    pairs = np.concatenate([window_hashes(hashed_words([b" ".join(g[:2])])[0], 2) for g in grams])
    thirds = np.concatenate([hashed_words([g[2]])[0] if g[2] else np.zeros(1, np.uint64) for g in grams])
    whole = np.array([g[2] is None for g in grams])
    order = np.argsort(pairs, kind="stable")
    known, first, times = np.unique(pairs[order], return_index=True, return_counts=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            texts = byte_texts(chunk)
            words, ends = hashed_words(texts, lower=True, blank=_BETWEEN)
            begins = np.append(0, ends[:-1])
            windows = window_hashes(words, 2)
            near = np.minimum(np.searchsorted(known, windows), len(known) - 1)
            place = np.flatnonzero(known[near] == windows)
            near = near[place]
            # Each place with all rows of the templates that begin with its two words.
            place, near, of = np.repeat(place, times[near]), np.repeat(near, times[near]), times[near]
            row = order[first[near] + np.arange(len(near)) - np.repeat(np.cumsum(of) - of, of)]
            text = np.searchsorted(ends, place, "right")
            third = words[np.minimum(place + 2, len(words) - 1)] if len(words) else words
            same = (place + 1 < ends[text]) & (whole[row] | ((place + 2 < ends[text]) & (third == thirds[row])))
            text, row, pos = text[same], row[same], (place - begins[text])[same]
            good = _verified(texts, text, row, pos, grams)
            text, row, pos = text[good], row[good], pos[good]
            upto = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays([pa.array(row, pa.int32()), pa.array(pos, pa.int64())], ["row", "pos"])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("key"), pa.array(ends - begins, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(upto), found)],
                names=["doc_id", "key", "n_words", "found"],
            )

    schema = StructType([docs.schema["doc_id"]]).add("key", BinaryType()).add("n_words", LongType()).add("found", ArrayType(MATCH))
    return docs.select("doc_id", "key", "text").mapInArrow(work, schema)


def _verified(texts: list[bytes | None], text: np.ndarray, row: np.ndarray, pos: np.ndarray, grams: list[list]) -> np.ndarray:
    """Which matches hold by the words themselves; those of a text come together."""
    good, read = np.zeros(len(text), bool), None
    for n, (t, r, p) in enumerate(zip(text.tolist(), row.tolist(), pos.tolist())):
        if t != read:
            read, words = t, _WORD_BYTES.findall(texts[t].lower())
        gram = [word for word in grams[r] if word]
        good[n] = words[p : p + len(gram)] == gram
    return good


def matches(texts: DataFrame) -> DataFrame:
    """Where a text (``key``) has the words of a template's place, each once."""
    kinds = "row int, template int, label string, phrase boolean, place int, votes int"
    templates = texts.sparkSession.createDataFrame([(n, *row[:5]) for n, row in enumerate(template_rows())], kinds)
    each = texts.select("key", F.explode("found").alias("m")).select("key", "m.row", "m.pos")
    joined = each.join(F.broadcast(templates), "row")
    return joined.select("key", "template", "label", "phrase", "votes", "place", "pos").distinct()


def _summary(found: DataFrame) -> DataFrame:
    """Per text: base places, first and last start, labels of both kinds, and the best share."""
    bit = F.expr(f"shiftleft(1L, place % {HALF})")
    half = lambda first: F.bit_or(F.when((F.col("place") < HALF) == F.lit(first), bit).otherwise(F.lit(0)))
    named = ["key", "template", "label", "phrase", "votes"]
    diagonals = found.groupBy(*named, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        half(True).alias("low"), half(False).alias("high"), F.min("pos").alias("first"), F.max("pos").alias("last")
    )
    # A diagonal of a phrase stands for itself; those of a text are merged with their neighbours.
    by_text = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal", 1).over(by_text) > NEIGHBOURS)
    merged = (
        diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("group", F.sum("new").over(by_text))
        .groupBy(*named, "group")
        .agg(F.bit_or("low").alias("low"), F.bit_or("high").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("share", (F.bit_count("low") + F.bit_count("high")) / F.col("votes"))
    )
    stands = F.when(F.col("phrase"), F.col("share") == 1).otherwise(
        (F.col("share") >= LEAST_SHARE) & (F.col("last") - F.col("first") + 1 <= F.col("votes") * MOST_STRETCH)
    )
    told = F.lit(True)
    for label in TELLING:
        places = F.lit(telling_places(label)).cast("long")
        told = told & ((F.col("label") != label) | (F.col("low").bitwiseAND(places) == places))
    base = F.col("phrase")
    return _best_versions(merged.where(stands & (base | told))).groupBy("key").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base"),
        F.collect_set(F.when(~base, F.col("label"))).alias("own"),
        F.max("share").alias("score"),
    )


def _best_versions(spans: DataFrame) -> DataFrame:
    """``spans`` with one of each run of overlapping notices of versions: most found, then shortest."""
    version = F.col("label").isin(*VERSIONS) & ~F.col("phrase")
    in_order = Window.partitionBy("key", "version").orderBy("first", "last", "template")
    reached = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("version", version).withColumn("apart", F.coalesce(F.col("first") > reached, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("apart").over(in_order))
    best = Window.partitionBy("key", "version", "run").orderBy(F.desc("share"), F.col("last") - F.col("first"), "template")
    return runs.withColumn("place_in_run", F.row_number().over(best)).where(~F.col("version") | (F.col("place_in_run") == 1))


def _templates_sql() -> str:
    text = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(map(text, row)) + ")" for row in template_rows())


def _telling_sql() -> str:
    """For each label with telling words, whether a span has all their places."""
    places = {label: [k for k in range(HALF) if telling_places(label) >> k & 1] for label in TELLING}
    return " ".join(f"WHEN '{label}' THEN list_has_all(places, {own})" for label, own in places.items())


ORACLE = f"""
WITH templates(template, label, phrase, votes_place, votes, t1, t2, t3) AS (VALUES {_templates_sql()}),
texts AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents),
places AS (SELECT k, unnest(words) AS w1, unnest(range(len(words))) AS pos FROM texts),
grams AS (SELECT k, pos, w1, lead(w1) OVER w AS w2, lead(w1, 2) OVER w AS w3 FROM places WINDOW w AS (PARTITION BY k ORDER BY pos)),
found AS (SELECT k, template, label, phrase, votes, votes_place AS place, pos, pos - votes_place AS diagonal FROM grams
    JOIN templates ON w1 = t1 AND w2 = t2 AND (t3 IS NULL OR w3 = t3)),
marked AS (SELECT *, CASE WHEN phrase OR diagonal - lag(diagonal) OVER (PARTITION BY k, template ORDER BY diagonal, pos) > {NEIGHBOURS}
    THEN 1 ELSE 0 END AS new FROM found),
grouped AS (SELECT *, CASE WHEN phrase THEN diagonal
    ELSE sum(new) OVER (PARTITION BY k, template ORDER BY diagonal, pos ROWS UNBOUNDED PRECEDING) END AS grp FROM marked),
merged AS (SELECT k, template, label, phrase, votes, min(pos) AS first, max(pos) AS last, count(DISTINCT place) / votes AS share, list(DISTINCT place) AS places
    FROM grouped GROUP BY k, template, label, phrase, votes, grp),
stands AS (SELECT * FROM merged WHERE CASE WHEN phrase THEN share = 1
    ELSE share >= {LEAST_SHARE} AND last - first + 1 <= votes * {MOST_STRETCH} END),
told AS (SELECT *, NOT phrase AND label IN ({", ".join(f"'{x}'" for x in VERSIONS)}) AS version FROM stands
    WHERE phrase OR CASE label {_telling_sql()} ELSE true END),
apart AS (SELECT *, coalesce(first > max(last) OVER (PARTITION BY k, version ORDER BY first, last, template
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS apart FROM told),
runs AS (SELECT *, count(*) FILTER (apart) OVER (PARTITION BY k, version ORDER BY first, last, template ROWS UNBOUNDED PRECEDING) AS run FROM apart),
best AS (SELECT *, row_number() OVER (PARTITION BY k, version, run ORDER BY share DESC, last - first, template) AS place_in_run FROM runs),
summed AS (SELECT k, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM best WHERE NOT version OR place_in_run = 1 GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN summed USING (k)
"""
