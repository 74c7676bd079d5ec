"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

#: A node with more edges than this has them dealt over SALTS keys before they meet its smallest neighbour.
SALTS = 16


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges ``a > b``.

    Large: every node links its larger neighbours to its smallest neighbour or itself; small: every node links its smaller
    neighbours and itself to the smallest of them. Both keep what is connected connected. The minimum is pre-aggregated
    in each task, and the edges of a node meet it in SALTS separate groups, so that a node with very many is spread.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    dealt = both.where("b > a") if large else both
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = dealt.withColumn("salt", salt).join(spread, ["a", "salt"])
    linked = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        linked = linked.unionByName(least.where("a != m").select("a", F.col("m").alias("b")))
    return linked.distinct()


def components(edges: DataFrame) -> DataFrame:
    """For every node of an edge its component, the smallest node that can be reached: columns ``node``, ``component``.

    ``edges`` has two columns of one ordered type. Large and small steps alternate until nothing changes; each result is
    written to the shared folder, so no plan grows with the rounds and lost executors cost one round at most. The number
    of rounds follows the logarithm of the size.
    """
    first, second = edges.columns
    now = stored(edges.select(F.greatest(F.col(first), F.col(second)).alias("a"), F.least(F.col(first), F.col(second)).alias("b"))
                 .where("a != b").distinct(), "edges")
    before = None
    while True:
        now = stored(star(star(now, True), False), "edges")
        # stars only: sums of hashes tell that a round has changed nothing
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
