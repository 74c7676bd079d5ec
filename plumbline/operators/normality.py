"""Normality tests over whole columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.normal import normal_cdf, normal_ppf
from plumbline.functions.tails import kolmogorov_tail, normal_sf
from plumbline.operators.association import interpret
from plumbline.operators.describe import literal_rows
from plumbline.plans.ranks import BROADCAST_ROWS, add_bucket, expand_ties, running_counts, survey
from plumbline.sources.tables import unpivot, value

#: Buckets that are scanned together.
BUCKETS_PER_BLOCK = 1_000


def differences(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, diff): first differences in the order of a unique key.

    Rows are bucketed by key range; each bucket takes the last value of the one
    before it from a table of bucket ends, so no task sorts the whole table.  Numbers and
    timestamps are keys; a text key has no place on the number line and is refused.
    """
    if df.schema[key].dataType.simpleString() in ("string", "binary", "boolean"):
        raise ValueError(f"{key} must be a number or a timestamp to order rows by it")
    rows = df.select(F.col(key).cast("double").alias("place"), F.col(key).alias(key), F.col(column).alias("x"))
    rows = rows.filter(F.col("x").isNotNull())
    edges = survey(rows, "place").edges
    rows = add_bucket(rows, "place", edges)
    carried = bucket_ends(rows.groupBy("bucket").agg(F.max_by("x", key).alias("x")))
    # a row for every bucket that has rows
    carried = F.broadcast(carried) if len(edges) < BROADCAST_ROWS else carried
    in_order = Window.partitionBy("bucket").orderBy(key)
    lagged = rows.withColumn("before", F.lag("x").over(in_order)).join(carried, "bucket", "left")
    return lagged.select(key, (F.col("x") - F.coalesce("before", "carried")).alias("diff")).filter(F.col("diff").isNotNull())


def bucket_ends(ends: DataFrame) -> DataFrame:
    """(bucket, carried): the last value before each bucket, from one row (bucket, x) for each that has any.

    Buckets are scanned in blocks, and the blocks' last values in one short scan, so the plan does not grow with them.
    """
    blocks = ends.withColumn("block", F.floor(F.col("bucket") / BUCKETS_PER_BLOCK))
    inside = blocks.withColumn("in block", F.lag("x").over(Window.partitionBy("block").orderBy("bucket")))
    # one row per block
    last = blocks.groupBy("block").agg(F.max_by("x", "bucket").alias("x"))
    before = last.select("block", F.lag("x").over(Window.orderBy("block")).alias("before block"))
    return inside.join(F.broadcast(before), "block").select("bucket", F.coalesce("in block", "before block").alias("carried"))


def jarque_bera_diff(df: DataFrame, key: str, column: str) -> DataFrame:
    """Jarque-Bera test of the first differences."""
    moments = differences(df, key, column).agg(
        F.count(F.lit(1)).alias("n"), F.skewness("diff").alias("s"), F.kurtosis("diff").alias("k"))
    jb = F.col("n") / 6 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4)
    return interpret(moments.select("n", jb.alias("statistic")).withColumn("p_value", F.exp(-F.col("statistic") / 2)))


def ks_normal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-sample Kolmogorov-Smirnov test against a normal with the column's own mean and sample sd."""
    values = unpivot(df.select(*[value(c).alias(c) for c in columns]), columns, "column", "x")
    stats = values.groupBy("column").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.count("x").alias("rows"))
    ranked = running_counts(values, "x", by=["column"]).join(F.broadcast(stats), "column")
    # a column without spread has no standardized values: its statistic and p-value are null
    p = normal_cdf(F.try_divide(F.col("value") - F.col("mean"), "sd"))
    gap = F.greatest((F.col("n_before") + F.col("n")) / F.col("rows") - p, p - F.col("n_before") / F.col("rows"))
    tested = ranked.groupBy("column").agg(F.max("rows").alias("n"), F.max(gap).alias("statistic"))
    return interpret(tested.withColumn("p_value", kolmogorov_tail("statistic", F.col("n").cast("double"))))


def shapiro_wilk(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shapiro-Wilk W and its p-value for every column (Royston's 1995 weights).

    The weights only need normal scores by rank, so W is one sum over the ranked rows.  The
    p-value's approximation was fitted up to 5000 rows; beyond, ``p_is_extrapolated`` is true.
    """
    values = unpivot(df.select(*[value(c).alias(c) for c in columns]), columns, "column", "x")
    sizes = values.groupBy("column").agg(F.count("x").alias("rows"), F.var_pop("x").alias("var"))
    spread = survey(values, "x")
    ranked = running_counts(values, "x", by=["column"], spread=spread)
    scored = expand_ties(ranked, spread.largest, ["column"], mean=spread.mean).join(F.broadcast(sizes), "column")
    score = normal_ppf((F.col("i") - 0.375) / (F.col("rows") + 0.25))
    ends = {"first": F.lit(1), "second": F.lit(2), "last": F.col("rows"), "before_last": F.col("rows") - 1}
    sums = scored.withColumn("m", score).groupBy("column").agg(
        F.max("rows").alias("n"), F.max("var").alias("var"), F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.sum(F.col("m") * F.col("value")).alias("mx"),
        *[F.max(F.when(F.col("i") == place, F.col("value"))).alias(name) for name, place in ends.items()],
        F.max(F.when(F.col("i") == F.col("rows"), F.col("m"))).alias("m_last"),
        F.max(F.when(F.col("i") == F.col("rows") - 1, F.col("m"))).alias("m_before"))
    rows = []
    for r in sums.collect():
        w = _w_statistic(r)
        p = None if w is None else _w_p_value(w, r["n"])
        rows.append((r["column"], r["n"], w, p, None if p is None else p > 0.05, r["n"] > FITTED_ROWS))
    return literal_rows(df.sparkSession, rows, "column string, n bigint, w double, p_value double, is_normal boolean, "
                                               "p_is_extrapolated boolean")


FITTED_ROWS = 5000
# Royston's polynomials for the end weights, lowest power first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)


def _power_sum(coefficients, x: float) -> float:
    return sum(c * x ** i for i, c in enumerate(coefficients))


def _w_statistic(r) -> float | None:
    n, spread = r["n"], r["n"] * (r["var"] or 0.0)
    if n < 3 or spread == 0:
        return None
    outer = r["last"] - r["first"]
    if n == 3:
        return 0.5 * outer ** 2 / spread
    unit = 1 / math.sqrt(n)
    length = math.sqrt(r["mm"])
    a_last = r["m_last"] / length + _power_sum(LAST_WEIGHT, unit)
    middle = r["mx"] - r["m_last"] * outer
    rest, share = r["mm"] - 2 * r["m_last"] ** 2, 1 - 2 * a_last ** 2
    total = a_last * outer
    if n > 5:
        inner = r["before_last"] - r["second"]
        a_next = r["m_before"] / length + _power_sum(NEXT_WEIGHT, unit)
        middle -= r["m_before"] * inner
        rest, share = rest - 2 * r["m_before"] ** 2, share - 2 * a_next ** 2
        total += a_next * inner
    return (total + middle * math.sqrt(share / rest)) ** 2 / spread


def _w_p_value(w: float, n: int) -> float:
    """Fixed constants are Royston's fits of the null distribution."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return 1.0
    y = math.log(1 - w)
    if n <= 11:
        limit = -2.273 + 0.459 * n
        if y >= limit:
            return 0.0
        y = -math.log(limit - y)
        centre = _power_sum((0.5440, -0.39978, 0.025054, -0.0006714), n)
        spread = math.exp(_power_sum((1.3822, -0.77857, 0.062767, -0.0020322), n))
    else:
        u = math.log(n)
        centre = _power_sum((-1.5861, -0.31082, -0.083751, 0.0038915), u)
        spread = math.exp(_power_sum((-0.4803, -0.082676, 0.0030302), u))
    return normal_sf((y - centre) / spread)
