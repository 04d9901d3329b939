"""Connected components of an edge table by alternating large-star and small-star steps, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidflow.llm.common import forget, settled

#: Parts in which the edges of one node are joined.
SALTS = 8


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (its smallest node) for each node on an edge between two different nodes.

    Each round is two aggregations and two joins on node; the number of rounds grows with the logarithm of the longest
    path. The edges of a round are written to the shared folder, so no round depends on a single executor.
    """
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    now = settled(now, "edges")
    before = _mark(now)
    while before[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        # Where an edge's lower end has a lower neighbour, the upper end moves there. The lower end of many edges, the
        # centre of a star, is joined in as many parts as there are salts; only nodes that moved are repeated for that.
        moved = both.groupBy("u").agg(F.min("v").alias("m")).where("m < u").select(F.col("u").alias("lo"), "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).hint("merge")
        salted = now.withColumn("salt", F.pmod(F.xxhash64("hi"), F.lit(SALTS)).cast("int"))
        large = salted.join(moved, ["lo", "salt"], "left").select("hi", F.coalesce("m", "lo").alias("lo")).distinct()
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        pulled = large.join(small, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        last, now = now, settled(pulled.unionAll(small.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        forget(last)
        after = _mark(now)
        if after == before:
            break
        before = after
    top = now.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(top)
