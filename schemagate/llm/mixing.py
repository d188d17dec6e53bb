"""Mix sources to target weights by Sainte-Laguë apportionment.

Words are dealt out in blocks of equal size.  Highest quotients give each source a whole number
of blocks for its target, then each shard of a source its part of them.  Within a shard,
documents stand in a seeded order, their words make one stream, and the quota takes blocks
from its start, again from the start when the stream is used up.  What a shard can't take of its
blocks goes to the source's other shards that have room.

DataFrame operations only.  A source is split into shards of a bounded number of documents, so
a source with a third of all rows is as many groups as its rows ask for.  What is handled in
one group is one row per source, or one per shard of a source.

Null text has no words and is never taken.  Null is a source of its own, ordered last.  Rows
that repeat an id and size are taken one after the other; among equal rows it doesn't matter
which comes first.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemagate.llm.common import WORD, as_row

WEIGHTS = (5, 2, 1)
"""Weights of the sources by code point, null last, repeating."""
MOST_TIMES = 3
"""A target is at most so many times its source's size."""
BLOCK_WORDS = 16
"""Words of a block; a source's taken words differ from its target by about half a block."""
SHARD_DOCUMENTS = 20_000
"""Documents of a shard, about."""
SEED = 42


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_documents: int = SHARD_DOCUMENTS, seed: int = SEED) -> DataFrame:
    """Each row of ``docs`` as ``row``, with ``size``, ``source_size``, ``target``, ``times`` and ``part``.

    The mix takes the whole text ``times`` times and its first ``part`` words once more.
    """
    shards = max(1, -(-docs.count() // shard_documents))
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string")))
    rows = (
        docs.select(
            as_row(docs).alias("row"),
            F.coalesce("source", F.lit("")).alias("source"),
            F.col("source").isNull().alias("no_source"),
            F.col("doc_id"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .withColumn("place", place)
        .withColumn("shard", F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % shards)
    )
    per_shard = rows.groupBy("no_source", "source", "shard").agg(F.sum("size").alias("shard_size"))
    quotas = shard_quotas(source_quotas(per_shard, block_words), block_words)
    stream = Window.partitionBy("no_source", "source", "shard").orderBy("place", "size", "doc_id")
    start = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    taken = rows.join(quotas, ["no_source", "source", "shard"]).withColumn("start", start)
    rounds = F.when(F.col("shard_size") > 0, F.expr("words div shard_size")).otherwise(0)
    rest = F.col("words") - F.col("times") * F.col("shard_size")
    return taken.withColumn("times", rounds).select(
        "row", "doc_id", "size", "source_size", "target", "times",
        F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start"))).alias("part"),
    )


def source_quotas(per_shard: DataFrame, block_words: int) -> DataFrame:
    """``per_shard`` with its source's ``source_size``, ``target`` and number of ``blocks``."""
    sources = per_shard.groupBy("no_source", "source").agg(F.sum("shard_size").alias("source_size"))
    everything = Window.partitionBy(F.lit(1))
    in_order = everything.orderBy("no_source", "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1)
    sources = sources.select(
        "*",
        weight.cast("double").alias("weight"),
        F.sum("source_size").over(everything).alias("total"),
        (F.col("source_size") * MOST_TIMES).cast("double").alias("most"),
    )
    # Sources reach their most in the order of most / weight.  While all before have, those
    # left share the rest by weight; the first one that this doesn't fill ends the row.
    filling = everything.orderBy(F.col("most") / F.col("weight"), "no_source", "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sources = sources.withColumn("level", left / open_weight)
    place = F.struct((F.col("most") / F.col("weight")).alias("filled_at"), "no_source", "source", "level")
    level = F.min(F.when(F.col("most") > F.col("level") * F.col("weight"), place)).over(everything)["level"]
    target = F.least("most", F.coalesce(level * F.col("weight"), F.col("most")))
    sources = sources.withColumn("target", target).withColumn("seats", F.expr(f"(total + {block_words // 2}) div {block_words}"))
    named = sources.withColumn("entry", F.struct("no_source", "source")).withColumn("house", F.lit(1))
    blocks = apportioned(named, "house", "entry", "target", "seats")
    return per_shard.join(
        blocks.select("no_source", "source", "source_size", "target", F.col("won").alias("blocks")),
        ["no_source", "source"],
    )


def shard_quotas(shards: DataFrame, block_words: int) -> DataFrame:
    """``words`` to take from each shard: its blocks, at most what the limit allows, and what others can't take."""
    named = shards.withColumn("house", F.struct("no_source", "source"))
    won = apportioned(named, "house", "shard", "shard_size", "blocks")
    most = F.col("shard_size") * MOST_TIMES
    won = won.withColumn("own", F.least(F.col("won") * block_words, most)).withColumn("room", most - F.col("own"))
    whole = Window.partitionBy("no_source", "source")
    before = whole.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("won") * block_words - F.col("own")).over(whole) - F.coalesce(F.sum("room").over(before), F.lit(0))
    words = F.col("own") + F.least("room", F.greatest(left, F.lit(0)))
    return won.select("no_source", "source", "shard", "shard_size", "source_size", "target", words.alias("words"))


def apportioned(entries: DataFrame, house: str, entry: str, votes: str, seats: str) -> DataFrame:
    """``entries`` with ``won``: how many of their house's ``seats`` the highest quotients give.

    An entry's quotients are its votes over 1, 3, 5 and so on.  Most seats are certain: with a
    divisor that deals out too few, by half a seat per entry, votes / divisor rounded is won.
    Only the next few quotients of each entry, about twice its share of the number of entries,
    are ranked for the seats that are left.
    """
    all_of = Window.partitionBy(house)
    share = F.col(votes).cast("double") / F.col("_votes")
    # Up to this many quotients of an entry can be among the highest ones left.
    more = F.least(F.ceil(share * F.col("_entries")) + 2, F.col(seats) - F.col("_given"))
    known = (
        entries.withColumn("_votes", F.greatest(F.sum(F.col(votes).cast("double")).over(all_of), F.lit(1e-300)))
        .withColumn("_entries", F.count(F.lit(1)).over(all_of))
        .withColumn("_certain", F.floor(share * F.greatest(F.col(seats) - F.col("_entries") / 2, F.lit(0.0)) + 0.5))
        .withColumn("_certain", F.when(F.col(seats) * 2 > F.col("_entries"), F.col("_certain")).otherwise(F.lit(0)))
        .withColumn("_given", F.sum("_certain").over(all_of))
        .withColumn("_more", F.when(F.col(votes) > 0, F.greatest(more, F.lit(0))).otherwise(F.lit(0)))
    )
    quotient: Column = F.col(votes).cast("double") / (2 * (F.col("_certain") + F.col("_next")) + 1)
    next_ones = known.where("_more > 0").select(
        house, entry, votes, seats, "_given", "_certain", F.explode(F.sequence(F.lit(0), F.col("_more").cast("int") - 1)).alias("_next")
    )
    best = Window.partitionBy(house).orderBy(quotient.desc(), entry)
    won = next_ones.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.col(seats) - F.col("_given"))
    won = won.groupBy(house, entry).agg(F.count(F.lit(1)).alias("_won"))
    joined = known.join(won, [house, entry], "left")
    return joined.withColumn("won", F.col("_certain") + F.coalesce("_won", F.lit(0))).drop(
        "_votes", "_entries", "_certain", "_given", "_more", "_won"
    )


def taken_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself, in the columns of ``docs``: whole texts as often as taken, then the part.

    A part is its words joined by blanks; ``n_chars``, where it is a column, follows.
    """
    texts = mixed(docs, **settings)
    whole = F.array_repeat(F.lit(-1).cast("long"), F.col("times").cast("int"))
    copies = F.concat(whole, F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<bigint>")))
    rows = texts.withColumn("_words", F.explode(copies))
    text, part = F.col("row.text"), _first_words(F.col("row.text"), F.col("_words"))
    rows = rows.withColumn("_text", F.when(F.col("_words") < 0, text).otherwise(part))
    fields = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("_text")
        elif c == "n_chars":
            value = F.when(F.col("_words") < 0, value).otherwise(F.length("_text").cast(docs.schema[c].dataType))
        fields.append(value.alias(c))
    return rows.select(*fields)


def _first_words(text: Column, count: Column) -> Column:
    """The first words, white space between them as one blank each."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), count.cast("int")), " ")


def _apportioned_sql(name: str, source: str, house: str, entry: str, votes: str, seats: str) -> str:
    return f"""
{name}_a AS (SELECT *, CAST({votes} AS DOUBLE) / greatest(sum(CAST({votes} AS DOUBLE)) OVER (PARTITION BY {house}), 1e-300) AS share,
    count(*) OVER (PARTITION BY {house}) AS entries FROM {source}),
{name}_b AS (SELECT *, CASE WHEN {seats} * 2 > entries
    THEN CAST(floor(share * greatest({seats} - entries / 2, 0.0) + 0.5) AS BIGINT) ELSE 0 END AS certain FROM {name}_a),
{name}_c AS (SELECT *, CAST(sum(certain) OVER (PARTITION BY {house}) AS BIGINT) AS given FROM {name}_b),
{name}_d AS (SELECT *, CASE WHEN {votes} > 0 THEN greatest(least(CAST(ceil(share * entries) AS BIGINT) + 2, {seats} - given), 0) ELSE 0 END AS more FROM {name}_c),
{name}_e AS (SELECT *, unnest(range(more)) AS nxt FROM {name}_d WHERE more > 0),
{name}_f AS (SELECT {house}, {entry}, row_number() OVER (PARTITION BY {house}
    ORDER BY CAST({votes} AS DOUBLE) / (2 * (certain + nxt) + 1) DESC, {entry}) AS rnk, {seats} - given AS free FROM {name}_e),
{name}_g AS (SELECT {house}, {entry}, count(*) AS extra FROM {name}_f WHERE rnk <= free GROUP BY {house}, {entry}),
{name} AS (SELECT d.*, d.certain + coalesce(extra, 0) AS won FROM {name}_d d LEFT JOIN {name}_g g USING ({house}, {entry}))"""


ORACLE = f"""
WITH sized AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
placed AS (SELECT *, md5(concat_ws('|', '{SEED}', doc_id::VARCHAR, size::VARCHAR)) AS place FROM sized),
dealt AS (SELECT *, ('0x' || substr(place, 1, 8))::BIGINT
    % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / {SHARD_DOCUMENTS}.0) AS BIGINT)) AS shard FROM placed),
per_shard AS (SELECT src, shard, CAST(sum(size) AS BIGINT) AS shard_size FROM dealt GROUP BY ALL),
weighed AS (SELECT src, CAST(sum(shard_size) AS BIGINT) AS source_size,
    CAST([{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY CASE WHEN src = '1' THEN 1 ELSE 0 END, src) - 1) % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight
    FROM per_shard GROUP BY src),
bounded AS (SELECT *, CAST(source_size * {MOST_TIMES} AS DOUBLE) AS most,
    CAST(sum(source_size) OVER () AS BIGINT) AS total, sum(weight) OVER () AS all_weight FROM weighed),
levels AS (SELECT *, (total - coalesce(sum(most) OVER w, 0.0)) / (all_weight - coalesce(sum(weight) OVER w, 0.0)) AS level FROM bounded
    WINDOW w AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, (SELECT level FROM levels WHERE most > level * weight ORDER BY most / weight, src LIMIT 1) AS final FROM levels),
sources AS (SELECT src, source_size, least(most, coalesce(final * weight, most)) AS target,
    (total + {BLOCK_WORDS // 2}) // {BLOCK_WORDS} AS seats, 1 AS house FROM filled),
{_apportioned_sql("by_source", "sources", "house", "src", "target", "seats")},
shards AS (SELECT p.*, s.source_size, s.target, s.won AS blocks FROM per_shard p JOIN by_source s USING (src)),
{_apportioned_sql("by_shard", "shards", "src", "shard", "shard_size", "blocks")},
quotas AS (SELECT src, shard, shard_size, source_size, target, least(won * {BLOCK_WORDS}, shard_size * {MOST_TIMES}) AS words FROM by_shard),
streams AS (SELECT d.*, q.* EXCLUDE (src, shard), CAST(sum(size) OVER (PARTITION BY d.src, d.shard ORDER BY place, size, doc_id
    ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM dealt d JOIN quotas q USING (src, shard))
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN shard_size > 0 THEN (words // shard_size) * size + greatest(0, least(size, words % shard_size - start)) ELSE 0 END AS BIGINT) AS taken
FROM streams
"""
