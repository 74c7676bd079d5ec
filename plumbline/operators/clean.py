"""Outliers, cleaning and normalization.

Column statistics are one-row aggregates read once and used as literals, so the
row-level step is a plain projection or a filter that reaches the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.describe import literal_rows
from plumbline.plans.order import exact_quantiles
from plumbline.sources.tables import value as number_of


def _stats(df: DataFrame, **measures: Column) -> dict:
    return df.agg(*[m.alias(n) for n, m in measures.items()]).first().asDict()


def _double(value) -> Column:
    return F.lit(value).cast("double")


def zscores(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Adds ``z`` (absolute, sample sd) and ``is_outlier`` (strictly above the threshold)."""
    x = number_of(column)
    s = _stats(df, mean=F.avg(x), sd=F.stddev_samp(x))
    z = F.abs((x - _double(s["mean"])) / F.nullif(_double(s["sd"]), F.lit(0.0)))
    return df.withColumn("z", z).withColumn("is_outlier", F.coalesce(F.col("z") > threshold, F.lit(False)))


def zscore_outliers(df: DataFrame, key: str, column: str, threshold: float = 3.0) -> DataFrame:
    """Outlying rows with their key, value and z."""
    return zscores(df.select(key, column), column, threshold).filter("is_outlier").select(key, column, "z")


def outlier_summary(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    found = zscores(df.select(column), column, threshold)
    hit = F.col("is_outlier")
    return found.agg(
        F.lit(float(threshold)).alias("threshold"), F.count_if(hit).alias("n_outliers"), F.count(number_of(column)).alias("n_rows"),
        F.min(F.when(hit, F.col(column))).alias("min_outlier"), F.max(F.when(hit, F.col(column))).alias("max_outlier"),
        F.max(F.when(hit, F.col("z"))).alias("max_z"))


def zscore_clean(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows with |z| strictly below the threshold, z by the population sd.

    A constant column has no z, so every row goes; a row whose value is missing or NaN goes too;
    an empty table is an error.
    """
    x = number_of(column)
    s = _stats(df, n=F.count(x), mean=F.avg(x), sd=F.stddev_pop(x))
    if s["n"] == 0:
        raise ValueError("empty dataset")
    if s["sd"] == 0:
        return df.filter(F.lit(False))
    return df.filter(F.abs((F.col(column) - F.lit(s["mean"])) / F.lit(s["sd"])) < threshold)


def normalize(df: DataFrame, column: str, method: str = "l2", name: str = "normalized") -> DataFrame:
    """Divide by the column's l2, l1 or max norm; any other method scales to [0, 1]."""
    x = number_of(column)
    s = _stats(df, n=F.count(x), l2=F.sqrt(F.sum(x * x)), l1=F.sum(F.abs(x)), max=F.max(F.abs(x)),
               low=F.min(x), high=F.max(x))
    if s["n"] == 0:
        raise ValueError("empty dataset")
    if method in ("l2", "l1", "max"):
        scaled = x if s[method] == 0 else x / F.lit(s[method])
    else:
        width = (s["high"] - s["low"]) or 1.0
        scaled = (x - F.lit(s["low"])) / F.lit(width)
    return df.withColumn(name, scaled)


def clean_and_normalize(df: DataFrame, column: str, threshold: float = 3.0, method: str = "l2") -> DataFrame:
    return normalize(zscore_clean(df, column, threshold), column, method)


def clean_counts(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows before, after and removed, from one pass after the column statistics."""
    x = number_of(column)
    s = _stats(df, n=F.count(x), mean=F.avg(x), sd=F.stddev_pop(x))
    if s["n"] == 0:
        raise ValueError("empty dataset")
    z = F.abs((x - F.lit(s["mean"])) / F.nullif(F.lit(s["sd"]), F.lit(0.0)))
    kept = F.count_if(z < threshold)
    return df.agg(F.count(x).alias("n_before"), kept.alias("n_after"), (F.count(x) - kept).alias("n_removed"))


def iqr_fences(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> dict[str, tuple[float, ...]]:
    """column -> (q1, q3, lower fence, upper fence)"""
    found = exact_quantiles(df, columns, [0.25, 0.75])
    return {c: (q1, q3, q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)) for c, (q1, q3) in found.items()
            if q1 is not None}


def outside(fences: Mapping[str, tuple[float, ...]], column: str) -> Column:
    """Outlier predicate; a missing value is never an outlier."""
    _, _, low, high = fences[column]
    return F.coalesce((number_of(column) < F.lit(low)) | (number_of(column) > F.lit(high)), F.lit(False))


def iqr_bounds(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    fences = iqr_fences(df, columns, reach)
    counts = df.agg(*[F.count_if(outside(fences, c)).alias(c) for c in fences]).first()
    rows = [(c, q1, q3, q3 - q1, low, high, counts[c]) for c, (q1, q3, low, high) in fences.items()]
    return literal_rows(df.sparkSession, rows, "column string, q1 double, q3 double, iqr double, lower_fence double, "
                                               "upper_fence double, n_outliers bigint")


def iqr_remove_any(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Rows that are inside the fences of every column."""
    fences = iqr_fences(df, columns, reach)
    inside = F.lit(True)
    for c in fences:
        inside = inside & ~outside(fences, c)
    return df.filter(inside)


def iqr_removal_counts(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    fences = iqr_fences(df, columns, reach)
    hit = F.lit(False)
    for c in fences:
        hit = hit | outside(fences, c)
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(~hit).alias("n_after"),
                  F.count_if(hit).alias("n_removed"),
                  (F.count_if(hit) * 100.0 / F.count(F.lit(1))).alias("percent_removed"))


def scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """column -> (mean, population sd), the sd of a constant column being 1."""
    row = df.agg(*[F.struct(F.avg(number_of(c)).alias("mean"), F.stddev_pop(number_of(c)).alias("sd")).alias(c) for c in columns]).first()
    return {c: (row[c]["mean"], row[c]["sd"] or 1.0) for c in columns}


def apply_scaler(df: DataFrame, fitted: Mapping[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(mean)) / F.lit(sd) for c, (mean, sd) in fitted.items()})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scaler(df, scaler(df, columns))
