"""Connected components of a graph of links, by alternating stars.

Each round turns a node's links towards the smallest node it knows: first its
larger neighbours (large star), then its smaller ones (small star). A few rounds
leave one star for each component, around its smallest node. A round is
aggregates and equi-joins of the links, which Spark combines before the shuffle
and splits where one node has very many links; nothing comes to the driver but
a count and a checksum. Links are written after each round, so lineage stays
short and a lost executor repeats one round at most.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path

MAX_ROUNDS = 100


def _stored(links: DataFrame, name: str) -> DataFrame:
    path = scratch_path(links.sparkSession, name)
    links.write.parquet(path)
    return links.sparkSession.read.parquet(path)


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    low = low.select("node", F.least("node", "low").alias("low"))
    out = both.where("b > a").join(low, F.col("a") == F.col("node"))
    return out.select(F.col("low").alias("a"), "b").where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` have a < b: b's smaller neighbours and b itself meet at the smallest."""
    low = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
    out = links.join(low, F.col("b") == F.col("node"))
    moved = out.select(F.col("low").alias("a"), F.col("a").alias("b")).where("a <> b")
    return moved.union(low.select(F.col("low").alias("a"), F.col("node").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with a link; ``links`` are two columns of
    longs, in any direction, repeated or looping. Components are named by their
    smallest node. Links with a null end are ignored."""
    x, y = links.columns
    links = links.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    links = links.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a <> b").distinct()
    links = _stored(links, "links")
    before = _state(links)
    for _ in range(MAX_ROUNDS):
        links = _stored(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    members = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
