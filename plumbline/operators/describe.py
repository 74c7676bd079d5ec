"""Descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.order import exact_quantiles, quantiles_and
from plumbline.plans.ranks import running_counts
from plumbline.sources.tables import unpivot, value


def literal_rows(spark, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small result, already aggregated, as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def settle(aggregated: DataFrame, limit: int = 10_000) -> DataFrame:
    """An aggregated frame as literal rows when they are few, so that later steps do not scan the
    table again; a longer one stays as it is."""
    rows = aggregated.limit(limit + 1).collect()
    return aggregated.sparkSession.createDataFrame(rows, aggregated.schema) if len(rows) <= limit else aggregated


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): the most frequent value, the smallest on ties.

    Counted by a shuffle on (column, value), so no buffer holds all values of a column.
    """
    values = unpivot(df.select(*[value(c).alias(c) for c in columns]), columns, "column", "value")
    counted = values.filter(F.col("value").isNotNull()).groupBy("column", "value").count()
    best = F.max_by("value", F.struct("count", -F.col("value")))
    return counted.groupBy("column").agg(best.alias("mode"))


def _table(df: DataFrame, columns: Sequence[str], probs: dict[str, float], measures: dict) -> DataFrame:
    """(column, measures..., quantiles...): the measures ride on the first pass of the exact quantiles."""
    extra = [build(value(c)).alias(f"{name} of {c}!") for c in columns for name, build in measures.items()]
    found, row = quantiles_and(df, columns, probs.values(), extra)
    rows = [(c, *[row[f"{name} of {c}!"] for name in measures], *found[c]) for c in columns]
    kinds = [f"{name} {'bigint' if name in ('n', 'count') else 'double'}" for name in measures]
    return literal_rows(df.sparkSession, rows, ", ".join(["column string", *kinds, *[f"{p} double" for p in probs]]))


def describe_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, mode, sample sd and variance, range, sum, biased excess kurtosis and skewness."""
    table = _table(df, columns, {"median": 0.5}, {
        "mean": F.avg, "std": F.stddev_samp, "variance": F.var_samp, "min": F.min, "max": F.max, "sum": F.sum,
        "kurtosis": F.kurtosis, "skewness": F.skewness})
    return table.join(modes(df, columns), "column", "left")


def describe_quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample sd, min, quartiles, max."""
    return _table(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})


def describe_psych(df: DataFrame, columns: Sequence[str], trim: float = 0.1) -> DataFrame:
    """n, mean, sd, median, trimmed mean, scaled MAD, range, type-3 skew and kurtosis, standard error."""
    def shrink(x):
        return (F.count(x) - 1) / F.count(x)

    table = _table(df, columns, {"median": 0.5}, {
        "n": F.count, "mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max, "range": lambda x: F.max(x) - F.min(x),
        "skew": lambda x: F.skewness(x) * F.pow(shrink(x), 1.5),
        "kurtosis": lambda x: (F.kurtosis(x) + 3) * F.pow(shrink(x), 2.0) - 3,
        "se": lambda x: F.stddev_samp(x) / F.sqrt(F.count(x))})
    medians = {r["column"]: r["median"] for r in table.collect()}
    away = df.select(*[F.abs(value(c) - F.lit(medians[c]).cast("double")).alias(c) for c in columns])
    mads = [(c, None if q[0] is None else 1.4826 * q[0]) for c, q in exact_quantiles(away, columns, [0.5]).items()]
    return table.join(literal_rows(df.sparkSession, mads, "column string, mad double"), "column").join(
        trimmed_means(df, columns, trim), "column", "left")


def trimmed_means(df: DataFrame, columns: Sequence[str], trim: float = 0.1) -> DataFrame:
    """(column, trimmed): mean after dropping floor(trim * n) values at each end."""
    values = unpivot(df.select(*[value(c).alias(c) for c in columns]), columns, "column", "x")
    ranked = running_counts(values, "x", by=["column"])
    totals = values.groupBy("column").agg(F.count("x").alias("rows"))
    cut = F.floor(F.col("rows") * trim)
    # the part of a value's block of equal rows that lies between the two cuts
    kept = F.greatest(F.lit(0), F.least(F.col("n_before") + F.col("n"), F.col("rows") - cut)
                      - F.greatest(F.col("n_before"), cut))
    return ranked.join(F.broadcast(totals), "column").groupBy("column").agg(
        (F.sum(F.col("value") * kept) / F.sum(kept)).alias("trimmed"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and percentage (two decimals) per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", F.round(F.col("n") * 100.0 / total, 2).alias("percent")).orderBy(F.desc("n"), label)


def group_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Frequencies, nulls being a group of their own."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    found = exact_quantiles(df, columns, probs)
    rows = [(c, float(p), q) for c in columns for p, q in zip(probs, found[c])]
    return literal_rows(df.sparkSession, rows, "column string, prob double, quantile double")
