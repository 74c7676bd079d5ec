"""Robust local regression: a line fitted around a place to its nearest rows, tricube by distance, with bisquare rounds.

A neighbourhood holds a share of all rows, two thirds by default, so rows cannot be sent to their neighbours' tasks; places
can. Fits are made at anchors: in every cell of width ``delta`` of x the largest x, and the smallest of all; ``delta`` is a
hundredth of the range, so there are about a hundred, and with 0 every different x is one. Between anchors the trend is a
straight line. For all anchors at once, a pass counts the rows within many distances in each task, which narrows the
distance that holds the share; a pass adds up the weighted sums of the lines; and the median of the residuals, exact, scales
the weights of the next round. A row's weights follow from its own x and y, the last round's anchors and that median, so no
row is sorted, moved or joined.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.describe import literal_rows
from plumbline.plans.order import quantiles_and
from plumbline.plans.sums import add_up
from plumbline.sources.tables import value

#: Distances tried for each anchor in a pass, and passes: 256 ** 5 parts of the range.
DISTANCES, SEARCHES = 256, 5
#: Anchors whose weights a task holds at once, per Arrow batch.
ANCHORS_AT_ONCE = 128


def anchors_of(rows: DataFrame, low: float, high: float, delta: float) -> np.ndarray:
    """The places of the fits, in order; the driver holds one number for each."""
    if delta <= 0:
        found = rows.select("x").distinct().collect()
    else:
        found = rows.groupBy(F.ceil((F.col("x") - F.lit(low)) / F.lit(delta))).agg(F.max("x")).select("max(x)").collect()
    return np.array(sorted({low, *[r[0] for r in found]}))


def reaches(rows: DataFrame, tasks: int, anchors: np.ndarray, low: float, high: float, wanted: int) -> np.ndarray:
    """For each anchor the smallest distance within which ``wanted`` rows lie."""
    under, over = np.zeros(len(anchors)), np.maximum(anchors - low, high - anchors)
    for turn in range(SEARCHES):
        # the first turn tries zero itself
        parts = np.linspace(0, 1, DISTANCES + 1)[0 if turn == 0 else 1:]
        tried = under[:, None] + (over - under)[:, None] * parts

        def measure(batches: Iterator[pd.DataFrame], tried: np.ndarray = tried) -> dict[int, np.ndarray]:
            held = np.zeros(tried.shape)
            for batch in batches:
                x = np.sort(batch["x"].to_numpy())
                held += np.searchsorted(x, anchors[:, None] + tried, "right") - np.searchsorted(x, anchors[:, None] - tried, "left")
            return {0: held.ravel()}

        held = add_up(rows.select("x"), tasks, measure, tried.size)[0].reshape(tried.shape)
        first = (held >= wanted).argmax(axis=1)
        each = np.arange(len(anchors))
        over = tried[each, first]
        under = np.where(first > 0, tried[each, np.maximum(first - 1, 0)], np.where(turn == 0, 0.0, under))
    return over


def bisquare(gap: np.ndarray, scale: float) -> np.ndarray:
    """Weights of residuals; ``scale`` is six times their median size."""
    inside = np.where(gap <= 0.001 * scale, 1.0, (1 - (gap / scale) ** 2) ** 2)
    return np.where(gap <= 0.999 * scale, inside, 0.0)


def trusted(places: np.ndarray, heights: np.ndarray, scale: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda x, y: bisquare(np.abs(y - np.interp(x, places, heights)), scale)


def residual_size(places: np.ndarray, heights: np.ndarray) -> Column:
    @F.pandas_udf("double")
    def gap(x: pd.Series, y: pd.Series) -> pd.Series:
        return (y - np.interp(x, places, heights)).abs()

    return gap("x", "y")


def fits_at(rows: DataFrame, tasks: int, anchors: np.ndarray, reach: np.ndarray, spread: float,
            trust: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> np.ndarray:
    """The height of each anchor's line at the anchor; NaN where no row has any weight."""

    def measure(batches: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
        out = np.zeros((5, len(anchors)))
        for batch in batches:
            x, y = batch["x"].to_numpy(), batch["y"].to_numpy()
            own = np.ones(len(x)) if trust is None else trust(x, y)
            for at in range(0, len(anchors), ANCHORS_AT_ONCE):
                some = slice(at, at + ANCHORS_AT_ONCE)
                off = x[:, None] - anchors[some]
                gap, h = np.abs(off), reach[some]
                with np.errstate(invalid="ignore", divide="ignore"):
                    w = np.where(gap <= 0.001 * h, 1.0, (1 - (gap / h) ** 3) ** 3)
                w = np.where(gap <= 0.999 * h, w, 0.0) * own[:, None]
                wx = w * off
                out[:, some] += w.sum(axis=0), wx.sum(axis=0), y @ w, (wx * off).sum(axis=0), y @ wx
        return {0: out.ravel()}

    n, sx, sy, sxx, sxy = add_up(rows, tasks, measure, 5 * len(anchors))[0].reshape(5, -1)
    with np.errstate(invalid="ignore", divide="ignore"):
        mx, my = sx / n, sy / n
        width = np.maximum(sxx / n - mx * mx, 0)
        slope = np.where(np.sqrt(width) > 0.001 * spread, (sxy / n - mx * my) / width, 0.0)
        return np.where(n > 0, my - slope * mx, np.nan)


def lowess(df: DataFrame, x: str, y: str, span: float = 2 / 3, rounds: int = 3, delta: float | None = None) -> DataFrame:
    """(x, trend) at the anchors. Rows without x or y do not count; an empty table has no anchors."""
    rows = df.select(value(x).alias("x"), value(y).alias("y")).na.drop().persist(StorageLevel.MEMORY_AND_DISK)
    n, low, high = rows.agg(F.count("x"), F.min("x"), F.max("x")).first()
    schema = "x double, trend double"
    if not n:
        rows.unpersist()
        return literal_rows(df.sparkSession, [], schema)
    anchors = anchors_of(rows, low, high, 0.01 * (high - low) if delta is None else delta)
    tasks, wanted = rows.rdd.getNumPartitions(), max(min(math.floor(span * n + 1e-7), n), min(2, n))
    reach = reaches(rows, tasks, anchors, low, high, wanted)
    trust = None
    for turn in range(rounds + 1):
        heights = fits_at(rows, tasks, anchors, reach, high - low, trust)
        known = ~np.isnan(heights)
        places, known_heights = anchors[known], heights[known]
        if turn == rounds or not known.any():
            break

        found, row = quantiles_and(rows.select(residual_size(places, known_heights).alias("gap")), ["gap"], [0.5], [F.avg("gap").alias("mean")])
        scale = 6 * found["gap"][0]
        if scale < 1e-7 * row["mean"] or scale == 0:
            break
        trust = trusted(places, known_heights, scale)
    rows.unpersist()
    return literal_rows(df.sparkSession, list(zip(places.tolist(), known_heights.tolist())), schema)


def trend_at(x: Column, curve: DataFrame) -> Column:
    """The trend at any x, from the few rows of ``lowess``; flat beyond the ends."""
    points = sorted((r["x"], r["trend"]) for r in curve.collect())
    places, heights = (np.array(c) for c in zip(*points)) if points else (np.zeros(1), np.full(1, np.nan))

    @F.pandas_udf("double")
    def interpolated(xs: pd.Series) -> pd.Series:
        return pd.Series(np.interp(xs, places, heights), index=xs.index).where(xs.notna())

    return interpolated(x.cast("double"))
