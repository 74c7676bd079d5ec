"""Centred cross-product sums: one pass over the rows, a k x k matrix on the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.sums import add_up
from plumbline.sources.tables import value as number_of

EXPRESSION_COLUMNS = 14


@dataclass
class Gram:
    """Row count, column means and centred cross-products of some rows."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    def plus(self, other: "Gram", sign: int = 1) -> "Gram":
        n = self.n + sign * other.n
        if n == 0:
            return Gram(0, self.mean * 0, self.cross * 0)
        mean = (self.n * self.mean + sign * other.n * other.mean) / n
        here, there = self.mean - mean, other.mean - mean
        cross = (self.cross + self.n * np.outer(here, here)
                 + sign * (other.cross + other.n * np.outer(there, there)))
        return Gram(n, mean, cross)

    def minus(self, other: "Gram") -> "Gram":
        return self.plus(other, -1)

    def scaled(self, centre: np.ndarray, scale: np.ndarray) -> "Gram":
        """The sums of the same rows after (x - centre) / scale."""
        return Gram(self.n, (self.mean - centre) / scale, self.cross / np.outer(scale, scale))

    def projected(self, matrix: np.ndarray) -> "Gram":
        """The sums of the same rows after multiplication by ``matrix``."""
        return Gram(self.n, self.mean @ matrix, matrix.T @ self.cross @ matrix)

    def std(self) -> np.ndarray:
        """Population standard deviations; 1 for a constant column, as a scaler uses it."""
        s = np.sqrt(np.diag(self.cross) / self.n)
        return np.where(s > 0, s, 1.0)

    def correlation(self) -> np.ndarray:
        s = np.sqrt(np.diag(self.cross))
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.cross / np.outer(s, s)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listwise deletion: rows where every column has a value."""
    return df.na.drop(subset=list(columns))


def gram_by(df: DataFrame, columns: Sequence[str], by: Column | str | None = None) -> dict[object, Gram]:
    """Gram sums of complete rows for each value of ``by`` (a fold or split: few values)."""
    columns = list(columns)
    key = F.lit(0) if by is None else (F.col(by) if isinstance(by, str) else by)
    rows = complete_rows(df, columns).select(
        key.alias("part"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    return _by_expressions(rows, len(columns)) if len(columns) <= EXPRESSION_COLUMNS else _by_blocks(rows, len(columns))


def gram(df: DataFrame, columns: Sequence[str]) -> Gram:
    parts = gram_by(df, columns)
    if not parts:
        raise ValueError("no complete rows")
    return parts[0]


def _by_expressions(rows, k):
    """covar_pop merges stably, so no separate pass for the means is needed."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    table = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for row in table:
        cross = np.zeros((k, k))
        for i, j in pairs:
            cross[i, j] = cross[j, i] = row[f"c{i}_{j}"] * row["n"]
        out[row["part"]] = Gram(row["n"], np.array([row[f"m{i}"] for i in range(k)]), cross)
    return out


def _by_blocks(rows, k):
    """Wide tables: numpy blocks per Arrow batch, summed cell by cell."""
    names = [f"x{i}" for i in range(k)]
    means = rows.agg(*[F.avg(c) for c in names]).first()
    if means[0] is None:
        return {}
    shift = np.array(list(means), dtype=float)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[object, np.ndarray] = {}
        for batch in batches:
            for part, group in batch.groupby("part"):
                x = np.hstack([group[names].to_numpy(dtype=float) - shift, np.ones((len(group), 1))])
                sums[part] = sums.get(part, 0) + x.T @ x
        for part, block in sums.items():
            # the upper triangle, one row of it at a time
            yield pd.DataFrame({"part": part, "i": np.arange(k + 1), "s": [block[i, i:] for i in range(k + 1)]})

    part_type = rows.schema["part"].dataType.simpleString()
    cells = rows.mapInPandas(blocks, f"part {part_type}, i int, s array<double>")
    sums = cells.withColumn("s", array_to_vector("s")).groupBy("part", "i").agg(Summarizer.sum(F.col("s")).alias("s"))
    out: dict[object, Gram] = {}
    totals: dict[object, np.ndarray] = {}
    for row in sums.collect():
        i, block = row["i"], totals.setdefault(row["part"], np.zeros((k + 1, k + 1)))
        block[i, i:] = block[i:, i] = row["s"].toArray()
    for part, block in totals.items():
        n, offset = block[k, k], block[:k, k] / block[k, k]
        out[part] = Gram(n, shift + offset, block[:k, :k] - n * np.outer(offset, offset))
    return out


@dataclass
class PairMoments:
    """For every pair (i, j) of columns, over the rows where both have a value: rows, sums of i, sums of squares of i, and
    sums of products, all after a shift of each column."""

    n: np.ndarray
    total: np.ndarray
    square: np.ndarray
    product: np.ndarray

    def correlation(self) -> np.ndarray:
        """NaN where a pair has no spread."""
        with np.errstate(invalid="ignore", divide="ignore"):
            spread = self.square - self.total ** 2 / self.n
            # what rounding leaves of a constant column is no spread
            spread = np.where(spread > 1e-13 * self.square, spread, np.nan)
            r = (self.product - self.total * self.total.T / self.n) / np.sqrt(spread * spread.T)
        return np.clip(r, -1.0, 1.0)


#: Rows whose means shift the columns, and how many deviations a mean may lie off before the pass is repeated with it.
SHIFT_ROWS, MOST_OFF = 1_000, 1_000.0


def pairwise_moments(df: DataFrame, columns: Sequence[str]) -> PairMoments:
    """One scan: values, squares and presence, as matrices of an Arrow batch, multiplied by one another and added up.

    The shift keeps the sums small; it is the mean of a few rows. Should a column lie far from it, the scan is repeated
    with its true means, which the first one gives. NaN counts as missing.
    """
    columns = list(columns)
    rows = df.select(*[number_of(c).alias(f"x{i}") for i, c in enumerate(columns)])
    few = rows.limit(SHIFT_ROWS).toPandas().to_numpy(dtype=float)
    shift = np.array([x[~np.isnan(x)].mean() if (~np.isnan(x)).any() else 0.0 for x in few.T])
    tasks, k = rows.rdd.getNumPartitions(), len(columns)
    for _ in range(2):
        def measure(batches: Iterator[pd.DataFrame], shift: np.ndarray = shift) -> dict[int, np.ndarray]:
            out = np.zeros((4, k, k))
            for batch in batches:
                x = batch.to_numpy(dtype=float) - shift
                there = ~np.isnan(x)
                x[~there] = 0.0
                there = there.astype(float)
                out += there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x
            return {i: part.ravel() for i, part in enumerate(out)}

        found = add_up(rows, tasks, measure, 4 * k * k)
        n, total, square, product = (found[i].reshape(k, k) if found else np.zeros((k, k)) for i in range(4))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.diag(total) / np.diag(n)
            sd = np.sqrt(np.diag(square) / np.diag(n) - mean ** 2)
            off = np.abs(mean) > MOST_OFF * sd
        if not (off & (mean != 0)).any():
            break
        shift = shift + np.nan_to_num(mean)
    return PairMoments(n, total, square, product)
