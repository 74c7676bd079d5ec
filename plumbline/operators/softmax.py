"""Multinomial logistic regression by Newton's method: one Spark job a step, for all folds of a cross-validation together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.newton import Problem, Sums, minimise

#: Weights of a model up to which Newton's systems are solved; larger models go to the library's quasi-Newton search.
MOST_WEIGHTS = 600
#: Classes whose probabilities are plain expressions, which Spark compiles; each holds all sums, so more classes use array functions.
PLAIN_CLASSES = 8


@dataclass
class Softmax:
    """Weights per class and feature, and intercepts."""

    weights: np.ndarray
    intercepts: np.ndarray

    def probability(self, columns: Sequence[Column]) -> Column:
        """An array with the probability of each class."""
        sums = [reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(columns, row)], F.lit(float(b)))
                for row, b in zip(self.weights, self.intercepts)]
        if 1 < len(sums) <= PLAIN_CLASSES:
            highest = F.greatest(*sums)
            plain = [F.exp(s - highest) for s in sums]
            total = reduce(lambda a, b: a + b, plain, F.lit(0.0))
            return F.array(*[e / total for e in plain])
        top = F.array_max(F.array(*sums))
        powers = F.transform(F.array(*sums), lambda s: F.exp(s - top))
        return F.transform(powers, lambda e: e / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


class Fit(Problem):
    """Weights of all classes in a row, the last of each class its intercept, which is not penalised. Rows of the fold
    ``without`` are left out."""

    def __init__(self, classes: int, width: int, rows: int, penalty: float, without: int | None, tolerance: float, most_jobs: int):
        super().__init__(0, classes * (width + 1), rows, penalty, np.tile(np.append(np.ones(width), 0.0), classes), tolerance, most_jobs)
        self.classes, self.without = classes, without

    def sums(self) -> Sums:
        k, without = self.classes, self.without
        weights, step, fractions = self.weights.reshape(k, -1), self.step.reshape(k, -1), self.fractions()

        def over(x: np.ndarray, block: pd.DataFrame):
            label = block["label"].to_numpy(dtype=int)
            if without is not None:
                kept = block["fold"].to_numpy() != without
                x, label = x[kept], label[kept]
            z, row = np.column_stack([x, np.ones(len(x))]), np.arange(len(x))
            here, along = z @ weights.T, z @ step.T
            losses = []
            for f in fractions:
                s = here + f * along
                top = s.max(axis=1, initial=-np.inf)
                losses.append((np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[row, label]).sum())
            s = here + along
            p = np.exp(s - s.max(axis=1, keepdims=True, initial=-np.inf))
            p /= p.sum(axis=1, keepdims=True)
            gap = p.copy()
            gap[row, label] -= 1
            size = z.shape[1]
            hessian = np.zeros((k, size, k, size))
            for a in range(k):
                for b in range(a, k):
                    block_sum = z.T @ (z * (p[:, a] * ((a == b) - p[:, b]))[:, None])
                    hessian[a, :, b], hessian[b, :, a] = block_sum, block_sum
            return np.array(losses), (gap.T @ z).ravel(), hessian.reshape(k * size, k * size)

        return over


def fit_softmax(rows: DataFrame, features: Sequence[str], classes: int, penalty: float, tolerance: float = 1e-8,
                max_iter: int = 1000) -> Softmax:
    """Fit of persisted rows with a ``label``: mean loss plus ``penalty`` / 2 times the squared weights."""
    n = rows.count()
    if classes * (len(features) + 1) > MOST_WEIGHTS:
        model = LogisticRegression(regParam=penalty, standardization=False, maxIter=max_iter, tol=1e-6, family="multinomial").fit(
            VectorAssembler(inputCols=list(features), outputCol="features").transform(rows))
        return Softmax(model.coefficientMatrix.toArray(), model.interceptVector.toArray())
    fit = Fit(classes, len(features), n, penalty, None, tolerance, max_iter)
    minimise(rows, features, [_same], [fit])
    return _split(fit)


def fit_without_each_fold(rows: DataFrame, features: Sequence[str], classes: int, penalties: dict[int, float],
                          counts: dict[int, int], tolerance: float = 1e-8, max_iter: int = 1000) -> dict[int, Softmax]:
    """One fit per fold on the rows of the others, all in the same jobs; ``penalties`` and ``counts`` (of rows fitted on)
    by fold."""
    if classes * (len(features) + 1) > MOST_WEIGHTS:
        return {f: fit_softmax(rows.filter(F.col("fold") != f), features, classes, p, tolerance, max_iter) for f, p in penalties.items()}
    fits = {f: Fit(classes, len(features), counts[f], p, f, tolerance, max_iter) for f, p in penalties.items()}
    minimise(rows, features, [_same], list(fits.values()))
    return {f: _split(fit) for f, fit in fits.items()}


def _same(x: np.ndarray) -> np.ndarray:
    return x


def _split(fit: Fit) -> Softmax:
    table = fit.weights.reshape(fit.classes, -1)
    # a shift of all intercepts changes nothing: their mean is zero, as in the library's fits
    return Softmax(table[:, :-1], table[:, -1] - table[:, -1].mean())
