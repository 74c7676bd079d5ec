"""Support vector machines: every machine of every configuration trained together, one Spark job for each step.

A machine separates two classes in the space of a kernel's feature map. Its loss is the hinge, rounded over a band around
the margin that narrows in ``BANDS`` steps, so Newton's method applies (``plans.newton``); with the last band b the hinge
objective at the result is above its minimum by at most b / 4 times the share of rows inside the band.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from plumbline.operators.softmax import Softmax, fit_softmax
from plumbline.plans.newton import Problem, Sums, minimise
from plumbline.plans.sums import shares

#: Half widths of the rounded band, one after another; in the first one all rows are inside at the start.
BANDS = (2.0, 0.4, 0.08)
#: Rows whose angles are held in double precision at a time.
AT_ONCE = 512


@dataclass(frozen=True)
class KernelOptions:
    kernel: str = "rbf"
    c: float = 1.0
    gamma: float | str = "scale"
    degree: int = 3
    random_features: int = 200
    max_iter: int = 200
    tolerance: float = 1e-4
    seed: int = 42


def feature_map(inputs: int, o: KernelOptions, gamma: float, kind: type = np.float64) -> Callable[[np.ndarray], np.ndarray]:
    """A function on row blocks whose inner products give (rbf: approximate) the kernel, in numbers of ``kind``.

    rbf uses random cosine waves; poly all products of exactly ``degree`` inputs, weighted
    so that dot products equal (gamma <x, z>)^degree.  In single precision, angles are brought
    within half a turn of zero in double precision first, so far values lose no digits.
    """
    if o.kernel == "linear":
        return lambda x: x.astype(kind, copy=False)
    if o.kernel == "poly":
        terms = []
        for combo in combinations_with_replacement(range(inputs), o.degree):
            orders = math.factorial(o.degree)
            for i in set(combo):
                orders //= math.factorial(combo.count(i))
            terms.append((list(combo), math.sqrt(orders) * gamma ** (o.degree / 2)))
        return lambda x: np.column_stack([w * x[:, combo].prod(axis=1) for combo, w in terms]).astype(kind, copy=False)
    rng = np.random.default_rng(o.seed)
    directions = rng.normal(0.0, math.sqrt(2 * gamma), (inputs, o.random_features))
    phases = rng.uniform(0, 2 * math.pi, o.random_features)
    height = math.sqrt(2.0 / len(phases))
    if kind == np.float64:
        return lambda x: np.cos(x @ directions + phases) * height
    directions, phases = directions / (2 * math.pi), phases / (2 * math.pi)

    def waves(x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(phases)), kind)
        for at in range(0, len(x), AT_ONCE):
            turns, some = x[at:at + AT_ONCE] @ directions, out[at:at + AT_ONCE]
            turns += phases
            turns -= np.rint(turns)
            np.cos(np.multiply(turns, 2 * math.pi, out=some, casting="same_kind"), out=some)
            some *= kind(height)
        return out

    return waves


def hinge(t: np.ndarray, band: float) -> np.ndarray:
    """The hinge of the margins ``t``, a parabola within ``band`` of the corner."""
    inside = np.clip(1 + band - t, 0, 2 * band)
    return inside * inside / (4 * band) + np.maximum(1 - band - t, 0)


class Machine(Problem):
    """One pair of classes under one configuration; the last weight is the intercept, which is not penalised. Mapped rows end
    with a one; margins, slopes and curvatures of a block are found in the numbers they are mapped to and added up in double."""

    stages = len(BANDS)

    def __init__(self, configuration: int, pair: tuple[int, int], mapping: int, width: int, rows: int, o: KernelOptions):
        super().__init__(mapping, width + 1, rows, 1.0 / (o.c * rows), np.append(np.ones(width), 0.0), o.tolerance, o.max_iter)
        self.configuration, self.pair = configuration, pair

    def sums(self) -> Sums:
        weights, step, (a, b), band, fractions = self.weights, self.step, self.pair, BANDS[self.stage], self.fractions()

        def over(mapped: np.ndarray, block: pd.DataFrame):
            label, kind = block["label"].to_numpy(), mapped.dtype
            mine = (label == a) | (label == b)
            z, label = (mapped, label) if mine.all() else (mapped[mine], label[mine])
            side = np.where(label == a, 1.0, -1.0)
            here, along = side * (z @ weights.astype(kind)), side * (z @ step.astype(kind))
            t = here + along
            losses = np.array([hinge(here + f * along, band).sum() for f in fractions])
            slope = -np.clip((1 + band - t) / (2 * band), 0, 1) * side
            curved = z[np.abs(1 - t) < band]
            return losses, (z.T @ slope.astype(kind)).astype(float), (curved.T @ curved).astype(float) / (2 * band)

        return over


@dataclass
class SupportVector:
    """Pairwise machines of one configuration. ``margins`` has one column per pair, positive for its first class."""

    features: list[str]
    options: KernelOptions
    gamma: float
    pairs: list[tuple[int, int]]
    coefficients: np.ndarray
    intercepts: np.ndarray
    classes: int
    jobs: int
    platt: Softmax | None = None
    kind: type = np.float64

    def sides(self) -> Callable[[np.ndarray], np.ndarray]:
        mapping = feature_map(len(self.features), self.options, self.gamma, self.kind)
        coefficients, intercepts = self.coefficients.astype(self.kind), self.intercepts
        return lambda x: mapping(x) @ coefficients.T + intercepts

    def margins(self, df: DataFrame) -> DataFrame:
        sides = self.sides()

        @F.pandas_udf(ArrayType(DoubleType()))
        def measured(*columns: pd.Series) -> pd.Series:
            return pd.Series(list(sides(np.column_stack([c.to_numpy(dtype=float) for c in columns]))))

        return df.withColumn("margins", measured(*[F.col(c) for c in self.features]))

    def predict(self, df: DataFrame) -> DataFrame:
        """Class with most pairwise votes, the lowest on a tie; probabilities from a logistic
        fit on the margins."""
        votes = []
        for k in range(self.classes):
            won = F.lit(0)
            for i, (a, b) in enumerate(self.pairs):
                side = F.col("margins")[i]
                if k in (a, b):
                    won = won + (side > 0 if k == a else side <= 0).cast("int")
            votes.append(won)
        tally = F.array(*votes)
        best = F.array_position(tally, F.array_max(tally)) - 1
        pairs = [F.col("margins")[i] for i in range(len(self.pairs))]
        return self.margins(df).withColumns({"probability": self.platt.probability(pairs), "prediction": best.cast("int")}).drop("margins")

    def predict_class(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, voted([self])[0])

    def rule(self) -> Callable[[np.ndarray], np.ndarray]:
        sides, pairs, classes = self.sides(), self.pairs, self.classes

        def most_votes(x: np.ndarray) -> np.ndarray:
            votes, margins = np.zeros((len(x), classes), int), sides(x)
            for i, (a, b) in enumerate(pairs):
                votes[:, a] += margins[:, i] > 0
                votes[:, b] += margins[:, i] <= 0
            return votes.argmax(axis=1)

        return most_votes


def voted(models: Sequence[SupportVector]):
    """A Column with the predicted class of each model, all from one pass over the features they share."""
    rules = [m.rule() for m in models]

    @F.pandas_udf(ArrayType(IntegerType()))
    def predicted(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(list(np.stack([rule(x) for rule in rules], axis=1).astype(np.int32)))

    return predicted(*[F.col(c) for c in models[0].features])


def train_machines(rows: DataFrame, features: Sequence[str], classes: int, configurations: Sequence[KernelOptions]) -> list[SupportVector]:
    """Models of all configurations on persisted rows (features, ``label``), without probabilities; gamma 'scale' is
    1 / (d Var(X))."""
    features = list(features)
    sums = rows.agg(*[F.struct(F.avg(c).alias("m"), F.avg(F.col(c) * F.col(c)).alias("s")).alias(c) for c in features]).first()
    counts = dict(rows.groupBy("label").count().collect())
    mean = sum(sums[c]["m"] for c in features) / len(features)
    variance = sum(sums[c]["s"] for c in features) / len(features) - mean ** 2
    gammas = [1.0 / (len(features) * variance) if o.gamma == "scale" else float(o.gamma) for o in configurations]
    pairs = [(a, b) for a in range(classes) for b in range(a + 1, classes) if counts.get(a) and counts.get(b)]
    keys = [(o.kernel,) if o.kernel == "linear" else (o.kernel, g, o.degree, o.random_features, o.seed) for o, g in zip(configurations, gammas)]
    known = list(dict.fromkeys(keys))
    kind = np.float32 if shares(sum(counts.values())) else np.float64
    maps = [feature_map(len(features), configurations[keys.index(k)], gammas[keys.index(k)], kind) for k in known]
    widths = [mapping(np.zeros((1, len(features)))).shape[1] for mapping in maps]
    machines = [Machine(number, pair, known.index(key), widths[known.index(key)], counts[pair[0]] + counts[pair[1]], o)
                for number, (o, key) in enumerate(zip(configurations, keys)) for pair in pairs]
    minimise(rows, features, [_with_one(mapping) for mapping in maps], machines)
    out = []
    for number, (o, gamma) in enumerate(zip(configurations, gammas)):
        mine = [m for m in machines if m.configuration == number]
        weights = np.array([m.weights for m in mine]).reshape(len(mine), -1)
        out.append(SupportVector(features, o, gamma, pairs, weights[:, :-1], weights[:, -1], classes, max((m.jobs for m in mine), default=0),
                                 kind=kind))
    return out


def _with_one(mapping: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    def mapped(x: np.ndarray) -> np.ndarray:
        z = mapping(x)
        return np.column_stack([z, np.ones(len(z), z.dtype)])

    return mapped


def with_probabilities(model: SupportVector, rows: DataFrame) -> SupportVector:
    """The model with a logistic fit on its margins over the training rows, as weakly penalised as one row is heavy."""
    margins = model.margins(rows).select("label", *[F.col("margins")[i].alias(f"m{i}") for i in range(len(model.pairs))])
    model.platt = fit_softmax(margins.persist(), [f"m{i}" for i in range(len(model.pairs))], model.classes, 1.0 / max(1, rows.count()))
    margins.unpersist()
    return model
