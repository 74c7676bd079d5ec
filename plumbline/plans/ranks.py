"""Distributed ranks: running counts over a whole table with no single-task sort.

Ties collapse first (map-side combine, so a hot value becomes one row), values
are bucketed by literal edges, each bucket is summed by its own window, and
the totals of the earlier buckets are added.  Literal edges make the bucket of
a value the same in every use and after the loss of an executor.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.plans.order import sketched
from plumbline.sources.tables import value as number_of

VALUES_PER_BUCKET = 200_000
FIRST_BUCKETS = 256
BROADCAST_ROWS = 500_000
HOT_SHARES = 10_000
#: Rows of a block of equal values from which on all blocks are cut, and rows of a piece.
LONG_BLOCKS, LONGEST_PIECE = 1_000, 50_000


@dataclass
class Spread:
    """How a column is spread: rows, estimated distinct values, literal bucket edges, and a
    bound on the rows that share one value."""

    rows: int
    distinct: int
    edges: list[float]
    largest: int

    @property
    def mean(self) -> float:
        """Rows of a value."""
        return self.rows / max(1, self.distinct)


def survey(df: DataFrame, value: str) -> Spread:
    """Two passes of bounded sketches.  No bucket holds more than its share of rows, hot values aside."""
    v = number_of(value)

    def shares(parts: int) -> list[float]:
        return [i / parts for i in range(1, parts)]

    row = df.agg(F.count(v).alias("rows"), F.approx_count_distinct(v).alias("distinct")).first()
    edges = sketched(df, {value: (v, shares(FIRST_BUCKETS))})[value] or []
    wanted = math.ceil(row["distinct"] / VALUES_PER_BUCKET)
    # a value seen at k consecutive edges holds at most k + 1 shares (one more for the sketch error)
    repeats = max(Counter(edges).values(), default=0)
    largest = math.ceil(row["rows"] * (repeats + 2) / FIRST_BUCKETS)
    if wanted > FIRST_BUCKETS:
        # only a huge column pays a second pass for finer edges; the sketch grows with their number
        edges = sketched(df, {value: (v, shares(wanted))}, min(65_535, 8 * wanted))[value]
    else:
        spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        step = FIRST_BUCKETS // max(2, wanted, min(spread, FIRST_BUCKETS, math.ceil(row["distinct"] / 1000)))
        edges = edges[step - 1::step]
    return Spread(row["rows"], row["distinct"], sorted({e for e in edges if not math.isnan(e)}), largest)


def add_bucket(df: DataFrame, value: str, edges: Sequence[float], name: str = "bucket") -> DataFrame:
    """Bucket number of each row by binary search in the literal edges."""
    splits = [-math.inf, *(edges or [0.0]), math.inf]
    bucketed = Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)
    # never null, so no null check of it is pushed into the scans
    return bucketed.withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(0)))


def running_counts(df: DataFrame, value: str, by: Sequence[str] = (),
                   sums: Mapping[str, Column] | None = None, spread: Spread | None = None) -> DataFrame:
    """One row per distinct (by..., value): ``n``, each of ``sums``, and the totals
    of all smaller values in the same group as ``n_before``, ``<name>_before``."""
    by = list(by)
    sums = dict(sums or {})
    names = ["n", *sums]
    kept = df.select(*by, number_of(value).alias("value"), *[c.alias(n) for n, c in sums.items()])
    # all join keys are filtered here, so both uses of the counts below have one and the same plan
    for c in [*by, "value"]:
        kept = kept.filter(F.col(c).isNotNull())
    edges = (spread or survey(kept, "value")).edges
    counted = kept.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(s) for s in sums])
    counted = add_bucket(counted, "value", edges)
    # same shuffle as above, which Spark reuses
    totals = counted.groupBy(*by, "bucket").agg(*[F.sum(n).alias(f"{n}_total") for n in names])
    # at most one row per bucket and group reaches this window, whatever the table size
    earlier = Window.partitionBy(*by or [F.lit(0)]).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "bucket", *[F.coalesce(F.sum(f"{n}_total").over(earlier), F.lit(0)).alias(f"{n}_offset")
                                             for n in names])
    if not by:
        # a row for every bucket
        offsets = F.broadcast(offsets)
    inner = Window.partitionBy(*by, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select("*", *[F.coalesce(F.sum(n).over(inner), F.lit(0)).alias(f"{n}_inner") for n in names])
    return counted.join(offsets, [*by, "bucket"]).select(
        *by, "value", *names, *[(F.col(f"{n}_inner") + F.col(f"{n}_offset")).alias(f"{n}_before") for n in names])


def average_rank() -> Column:
    """1-based rank with ties averaged, on the rows of ``running_counts``."""
    return F.col("n_before") + (F.col("n") + 1) / 2


def row_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_rank``, the average rank of each row's value; rows without a value go.

    Few distinct values are broadcast, their number checked.  Otherwise only the hot
    values are, of which there are fewer than HOT_SHARES by arithmetic; their rows pass
    the shuffle in which the others meet their ranks dealt over keys that match nothing.
    Each column adds one use of its own counts, so plans grow with the columns and no faster.
    """
    out = df.withColumns({c: number_of(c) for c in columns})
    spread_key = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(HOT_SHARES)) + 1
    for c in columns:
        spread = survey(df, c)
        ranks = running_counts(df, c, spread=spread).select(F.col("value").alias(c), "n", average_rank().alias(f"{c}_rank"))
        if spread.distinct * 1.25 <= BROADCAST_ROWS:
            out = out.join(F.broadcast(ranks.drop("n")), c)
        else:
            is_hot = F.col("n") * HOT_SHARES > spread.rows
            hot = ranks.filter(is_hot).select(c, F.col(f"{c}_rank").alias("hot rank"))
            cold = ranks.filter(~is_hot).select(c, F.lit(0).cast("bigint").alias("deal"), f"{c}_rank")
            out = out.filter(F.col(c).isNotNull()).join(F.broadcast(hot), c, "left").withColumn(
                "deal", F.when(F.col("hot rank").isNull(), F.lit(0)).otherwise(spread_key).cast("bigint"))
            out = out.join(cold, [c, "deal"], "left").withColumn(
                f"{c}_rank", F.coalesce("hot rank", f"{c}_rank")).drop("hot rank", "deal")
    return out


def expand_ties(ranked: DataFrame, largest: int, keep: Sequence[str] = (), chunk: int = 1_000_000, mean: float = 1.0) -> DataFrame:
    """(keep..., value, i): every row back at its own 1-based rank.

    Where a block of equal values may be longer than ``chunk`` (``largest`` bounds it),
    long blocks are cut and spread over tasks first; where blocks have ``LONG_BLOCKS`` rows
    in the mean, so that a few rows of ``ranked`` stand for the whole table, all are.
    """
    keep = list(keep)
    first, last = F.col("n_before") + 1, F.col("n_before") + F.col("n")
    if largest <= chunk and mean < LONG_BLOCKS:
        return ranked.select(*keep, "value", F.explode(F.sequence(first, last)).alias("i"))
    cut = min(chunk, LONGEST_PIECE)
    whole = ranked if mean >= LONG_BLOCKS else ranked.filter(F.col("n") > cut)
    pieces = whole.select(*keep, "value", last.alias("last"), F.explode(F.sequence(first, last, F.lit(cut))).alias("start"))
    # a number of partitions is given, else so few rows would be left to one task
    tasks = int(ranked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = pieces.repartition(tasks, *keep, "value", "start").select(
        *keep, "value", F.explode(F.sequence("start", F.least(F.col("start") + (cut - 1), F.col("last")))).alias("i"))
    if mean >= LONG_BLOCKS:
        return long
    return ranked.filter(F.col("n") <= cut).select(*keep, "value", F.explode(F.sequence(first, last)).alias("i")).unionByName(long)
