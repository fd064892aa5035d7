"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuemark.llm.common import discard, materialize

MAX_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").select(F.greatest("lo", "m").alias("hi"), F.least("lo", "m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).filter("hi <> lo").distinct()


def stars(links: DataFrame) -> DataFrame:
    """hi, lo: every node of a component but the least, with the least, from links a, b (long).

    Each round is a few joins and minima over the links; a round is written, so a lost executor costs one
    round. It ends when a round changes nothing, after a logarithmic number of rounds.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(), "links", short=True)
    state = lambda e: tuple(e.agg(F.count("*"), F.sum((F.xxhash64("hi", "lo") % (1 << 40)).cast("decimal(38,0)"))).first())
    before = state(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            return edges
        last, edges = edges, materialize(_small(_large(edges)), "links", short=True)
        discard(last)
        now = state(edges)
        if now == before:
            return edges
        before = now
    raise RuntimeError("the components did not settle")
