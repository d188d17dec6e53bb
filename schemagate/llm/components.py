"""Connected components by iterative joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemagate.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that links (``a``, ``b``) lead to, for all nodes with a link.

    Rounds of large-star and small-star hang nodes under the smallest in reach until nothing
    changes; the number of rounds follows the logarithm of the longest chain.  Each round is
    written, so that lineage stays short and lost executors cost no more than their round.
    """
    links = stored(_pointing_down(edges), "links")
    mark = _mark(links)
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        new = _mark(links)
        if new == mark:
            break
        mark = new
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("label"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots).distinct()


def _pointing_down(edges: DataFrame) -> DataFrame:
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return links.where("a != b").distinct()


def _mark(links: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.shiftright(pair, 16)), F.bit_xor(pair)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours under the smallest of all its neighbours and itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours under the smallest of these."""
    down = _pointing_down(links)
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()
