"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


#: Over how many tasks the edges of a hub are dealt.
SALTS = 64


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _star(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """The edges with the least neighbour `m` of their `u`.

    A node of at least a thousandth of all edge ends, of which there can't be more than a thousand, has its edges dealt
    over SALTS tasks.
    """
    hot = least.where(F.col("degree") * 1000 >= 2 * n).select("u", F.lit(SALTS).alias("salts"))
    salted = (
        edges
        .join(F.broadcast(hot), "u", "left")
        .withColumn("salt", F.pmod(F.xxhash64("v"), F.coalesce("salts", F.lit(1))).cast("int"))
        .drop("salts")
    )
    copies = F.when(
        F.col("degree") * 1000 >= 2 * n, F.sequence(F.lit(0), F.lit(SALTS - 1))
    ).otherwise(F.array(F.lit(0)))
    return salted.join(least.select("u", "m", F.explode(copies).alias("salt")), ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node of an edge but the roots; the root is the component's least node.

    Nulls and loops link nothing. Each round is a few joins and groupings by node, written to the shared folder; the
    number of rounds is about the logarithm of the longest chain. Neighbours of one node are never gathered: only their
    minimum is, and the edges of a hub are dealt over several tasks.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    e = written(e.where("u <> v").distinct(), "edges")
    state = _state(e)
    while n := state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = (
            both
            .groupBy("u")
            .agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
            .withColumn("m", F.least("u", "m"))
        )
        large = (
            _star(both.where("v > u"), least, n)
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
        small = _star(large, least, n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        discard(large)
        discard(e)
        e, before = new, state
        state = _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
