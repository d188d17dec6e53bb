"""Sharding by balanced label propagation.

Documents with equal texts are linked; a group of them is a clique, held as one hub rather than
as pairs.  Each round ranks a group's shards by how many of it they hold.  The first ones that
have room for the whole group are its targets; the others' documents wish to move there, the
first target first, as far as quotas allow: wishes are dealt into hash buckets that keep a
group's documents of one shard together, large portions in parts, and the smallest buckets enter
while there is room.  A group larger than what is free in a shard so fills several.

The law is ``rows``: counts are at most one apart.  Linked documents over a shard's share, and
all documents without links, fill the shards to it exactly.  Numbers in a shard are dealt in
two steps, by hash bucket and within it, so that no shard's rows come together in one task.

Null text has size 16, crc 0 and no links.  Rows equal in id and text may be numbered in either
order.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemagate.llm.common import ranked, stored

SHARDS = 40
OVERHEAD = 16
"""Bytes of a document besides its text."""
ROUNDS = 6
"""Most rounds; it ends earlier when nobody moves."""
QUOTA_BUCKETS = 256
"""Buckets that the wishes for a shard are dealt into."""
PART_NODES, MOST_PARTS = 64, 64
"""Documents of a group in one shard that move together, about; most parts of a shard's portion."""
NODE = ["node", "doc_id", "size", "text_crc32"]


def nodes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, and ``link``, the same for equal texts only."""
    text = F.col("text").cast("binary")
    return docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("link"),
    ).withColumn("node", F.xxhash64("doc_id", "size", "text_crc32"))


def propagated(linked: DataFrame, capacity: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``linked`` nodes (``node``, ``link``) with the ``shard`` that propagation leaves them in.

    No shard takes in more than brings it to ``capacity``; one that starts above it only loses.
    """
    state = stored(linked.withColumn("shard", F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")), "labels")
    for number in range(rounds):
        moved = _round(state, capacity, number)
        state = stored(moved.drop("moves"), "labels") if number + 1 == rounds else stored(moved, "labels")
        if number + 1 < rounds:
            if not state.agg(F.count_if("moves")).first()[0]:
                return state.drop("moves")
            state = state.drop("moves")
    return state


def _round(state: DataFrame, capacity: int, number: int) -> DataFrame:
    parts = F.least(F.lit(MOST_PARTS), F.ceil(F.col("n") / PART_NODES)).cast("int")
    tally = state.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
    free = state.groupBy("shard").agg((F.lit(capacity) - F.count(F.lit(1))).alias("free"))
    # A row per link and shard; shards of a link in the order of how many of it they hold.
    ranks = Window.partitionBy("link").orderBy(F.desc("n"), F.xxhash64("link", "shard", F.lit(number)).desc())
    before, upto = ranks.rowsBetween(Window.unboundedPreceding, -1), ranks.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("link")
    ranked_shards = (
        tally.join(F.broadcast(free), "shard")
        .withColumn("room", F.greatest("free", F.lit(0)))
        .withColumn("parts", parts)
        .withColumn("all", F.sum("n").over(whole))
        .withColumn("target", F.coalesce(F.sum(F.col("n") + F.col("room")).over(before), F.lit(0)) < F.col("all"))
        .withColumn("room_upto", F.sum("room").over(upto))
        .withColumn("moving", F.coalesce(F.sum(F.when(~F.col("target"), F.col("n"))).over(before), F.lit(0)))
        .withColumn("targets", F.array_sort(F.collect_list(F.when(F.col("target") & (F.col("room") > 0), F.struct("room_upto", "shard"))).over(whole)))
    )
    # What moves is laid along the targets' rooms: a part goes where its end comes to lie.
    portions = ranked_shards.where(~F.col("target")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    end = F.col("moving") + F.ceil(F.col("n") * (F.col("part") + 1) / F.col("parts"))
    wish = F.element_at(F.filter("targets", lambda t: t["room_upto"] >= end), 1)["shard"]
    wanted = portions.select("link", "shard", "part", wish.alias("wish"))
    sizes = ranked_shards.where(~F.col("target")).select("link", "shard", "parts")
    part = F.pmod(F.xxhash64("node", F.lit("part"), F.lit(number)), F.col("parts")).cast("int")
    wishes = state.join(sizes, ["link", "shard"], "left").withColumn("part", part).join(wanted, ["link", "shard", "part"], "left")
    bucket = F.pmod(F.xxhash64("link", "shard", "part", F.lit(number)), F.lit(QUOTA_BUCKETS)).cast("int")
    wishes = wishes.withColumn("bucket", bucket)
    demand = wishes.where("wish != shard").groupBy("wish", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # A row per shard and bucket at most.
    so_far = F.sum("n").over(Window.partitionBy("wish").orderBy("n", "bucket").rowsBetween(Window.unboundedPreceding, 0))
    room = demand.withColumn("so_far", so_far).join(free.withColumnRenamed("shard", "wish"), "wish", "left")
    granted = room.where(F.col("so_far") <= F.coalesce("free", F.lit(capacity))).select("wish", "bucket", F.lit(True).alias("granted"))
    moves = F.coalesce("granted", F.lit(False)) & (F.col("wish") != F.col("shard"))
    answered = wishes.join(F.broadcast(granted), ["wish", "bucket"], "left").withColumn("moves", F.coalesce(moves, F.lit(False)))
    return answered.select("node", "link", F.when(F.col("moves"), F.col("wish")).otherwise(F.col("shard")).alias("shard"), "moves")


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row."""
    rows = stored(nodes(docs), "nodes")
    total = rows.count()
    least, larger = divmod(total, shards)
    share = F.lit(least) + F.when(F.col("shard") < larger, 1).otherwise(0)
    groups = rows.where("link IS NOT NULL").groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    linked = rows.join(groups.select("link"), "link", "left_semi")
    # Rows of one id and text are one node: they have one shard and are told apart by slot.
    unique = linked.groupBy("node").agg(F.min("link").alias("link"))
    labels = propagated(unique, least, shards, rounds)
    placed = rows.join(labels.select("node", "shard"), "node", "left")
    order = [F.col(c) for c in NODE]
    seated = ranked(placed.where("shard IS NOT NULL"), ["shard"], order, "seat")
    staying = F.col("seat") < share
    seated = stored(seated, "seats")
    kept = seated.where(staying).groupBy("shard").agg(F.count(F.lit(1)).alias("kept"))
    held = {r.shard: r.kept for r in kept.collect()}  # a row per shard at most
    # Documents without a seat stand in one row; each shard takes as many as it lacks.
    starts, seats = [0], [held.get(s, 0) for s in range(shards)]
    for s in range(shards):
        starts.append(starts[-1] + least + (s < larger) - seats[s])
    loose = placed.where("shard IS NULL").select(*NODE).union(seated.where(~staying).select(*NODE))
    number = F.col("number")
    stops = F.array(*(F.lit(x).cast("long") for x in starts[1:]))
    lined = ranked(loose, [], order, "number").withColumn("shard", F.size(F.filter(stops, lambda stop: stop <= number)))
    at = lambda values: F.element_at(F.array(*(F.lit(x).cast("long") for x in values)), F.col("shard") + 1)
    filled = lined.select(*NODE, "shard", (at(seats) + number - at(starts[:-1])).alias("slot"))
    both = filled.union(seated.where(staying).select(*NODE, "shard", F.col("seat").alias("slot")))
    return both.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_share(assigned: DataFrame, link: Column) -> DataFrame:
    """One row: linked pairs, and those whose documents are in different shards, from counts."""
    cells = assigned.where(link.isNotNull()).groupBy(link.alias("link"), "shard").agg(F.count(F.lit(1)).alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    per_link = cells.groupBy("link").agg(F.sum("n").alias("all"), F.sum(pairs(F.col("n"))).alias("together"))
    return per_link.agg(F.sum(pairs(F.col("all"))).alias("pairs"), F.sum(pairs(F.col("all")) - F.col("together")).alias("cut"))
