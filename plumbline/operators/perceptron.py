"""Multilayer perceptrons trained on all rows at once: one Spark job per step, for all networks of a comparison together.

A step is one update by Adam from the gradient over a whole batch, summed over all tasks from the same weights, so the
result is that of one process that takes the same batches, on any number of machines. An epoch has as many batches as the
table has rows for, ``MOST_STEPS`` at most: beyond, batches grow with the table and the learning rate with the root of
their size. Which rows make a batch follows from the rows and the epoch. The first job of an epoch also scores the held-back
rows; patience counts epochs.

On a large table a network is brought near its end on growing parts of the rows (``sums.shares``), where an epoch is cheap.
It is then trained on all rows until its patience over all held-back rows ends; the weights it keeps come from one of these
epochs, and these are what ``iterations`` and ``losses`` tell. Tasks then calculate in single precision, adding up in double.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from plumbline.operators.split import HASH_DIGITS, key_hash
from plumbline.plans.sums import add_up, shares

#: A task costs about as much as the work on 100,000 rows, so a lane holds several times that.
ROWS_PER_LANE = 400_000
LEAST_LANES = 8
MOST_STEPS = 6
#: The learning rate of large batches stays below this.
MOST_RATE = 0.02
#: Patience on a part of a large table, which need only bring a network near its end.
PART_PATIENCE = 2
#: How many times shorter the steps are over a larger part, and over all rows, than over the part before.
GO_ON = 4
#: Rows that are kept together as bytes, and whose activations are held at a time.
BLOCK = 1_024
FEW_CLASSES, FEW_INPUTS = 7, 4


class Classifier:
    """``predict`` adds ``probability`` (array, one entry per class) and ``prediction`` (class index), ``predict_class`` the
    latter alone; ``rule`` is the function that gives it for a matrix of features, in a task."""

    def predict(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def predict_class(self, df: DataFrame, name: str) -> DataFrame:
        return self.predict(df).withColumnRenamed("prediction", name).drop("probability")

    def rule(self) -> Callable[[np.ndarray], np.ndarray]:
        raise NotImplementedError


def decide(df: DataFrame) -> DataFrame:
    """Adds the class of highest probability."""
    best = F.array_position("probability", F.array_max("probability")) - 1
    return df.withColumn("prediction", best.cast("int"))


def spread_out(rows: DataFrame) -> tuple[DataFrame, int]:
    """Training rows dealt over lanes by their content, and their number.

    A lane for every ROWS_PER_LANE rows, LEAST_LANES at least, each in the order of the hash: what is
    added up over lanes follows from the rows alone, not from cores, files or the order of a shuffle.
    """
    n = rows.count()
    dealt = rows.withColumn("lane", F.xxhash64(*rows.columns))
    return dealt.repartition(max(LEAST_LANES, n // ROWS_PER_LANE), "lane").sortWithinPartitions("lane").drop("lane"), n


@dataclass(frozen=True)
class PerceptronOptions:
    hidden: tuple[int, ...] = (100, 50)
    alpha: float = 0.001
    learning_rate: float = 0.001
    batch: int = 200
    max_iter: int = 1000
    validation: float = 0.1
    patience: int = 10
    tolerance: float = 1e-4
    seed: int = 42


@dataclass
class Perceptron(Classifier):
    features: list[str]
    shapes: list[tuple[int, int]]
    weights: np.ndarray
    iterations: int
    losses: list[float] = field(default_factory=list)
    #: Numbers that classes are found in; probabilities are always of double precision.
    kind: type = np.float64

    @property
    def loss(self) -> float:
        return self.losses[-1] if self.losses else math.nan

    def predict(self, df: DataFrame) -> DataFrame:
        shapes, weights = self.shapes, self.weights

        @F.pandas_udf(ArrayType(DoubleType()))
        def probabilities(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series(list(forward(layers(weights, shapes), x)[-1]))

        return decide(df.withColumn("probability", probabilities(*[F.col(c) for c in self.features])))

    def predict_class(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, guessed([self])[0])

    def rule(self) -> Callable[[np.ndarray], np.ndarray]:
        net, kind = layers(self.weights.astype(self.kind), self.shapes), self.kind
        return lambda x: forward(net, x.astype(kind, copy=False))[-1].argmax(axis=1)

    def input_importance(self) -> list[tuple[str, float]]:
        """Mean absolute first-layer weight of each input, largest first."""
        first, _ = layers(self.weights, self.shapes)[0]
        sizes = np.abs(first).mean(axis=1)
        return sorted(zip(self.features, map(float, sizes)), key=lambda p: -p[1])


def guessed(networks: Sequence[Perceptron]):
    """A Column with the class that each network gives, all from one pass over the features they share."""
    rules = [n.rule() for n in networks]

    @F.pandas_udf(ArrayType(IntegerType()))
    def predicted(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(list(np.stack([rule(x) for rule in rules], axis=1).astype(np.int32)))

    return predicted(*[F.col(c) for c in networks[0].features])


def layers(flat: np.ndarray, shapes: Sequence[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for rows, cols in shapes:
        out.append((flat[at:at + rows * cols].reshape(rows, cols), flat[at + rows * cols:at + (rows + 1) * cols]))
        at += (rows + 1) * cols
    return out


def forward(net, x: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer: rectified hidden units, softmax output."""
    values = [x]
    for i, (w, b) in enumerate(net):
        z = values[-1] @ w
        z += b
        values.append(np.maximum(z, 0, out=z) if i < len(net) - 1 else softmax(z))
    return values


def softmax(z: np.ndarray) -> np.ndarray:
    """Of every row; few classes are gone through by column, which numpy does many rows at a time."""
    if 1 <= z.shape[1] <= FEW_CLASSES:
        columns = range(z.shape[1])
        e = np.exp(z - reduce(np.maximum, [z[:, i] for i in columns])[:, None])
        e /= reduce(np.add, [e[:, i] for i in columns])[:, None]
        return e
    e = np.exp(z - z.max(axis=1, keepdims=True, initial=-np.inf))
    return e / e.sum(axis=1, keepdims=True)


def gradient(flat: np.ndarray, shapes, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Sums over the rows of the gradient and of the loss, without penalty."""
    net = layers(flat, shapes)
    values = forward(net, x)
    row = np.arange(len(y))
    loss = -np.log(np.clip(values[-1][row, y], 1e-12, None)).sum()
    back = values[-1]
    back[row, y] -= 1
    parts: list[np.ndarray] = []
    for i in reversed(range(len(net))):
        parts[:0] = _slopes(values[i], back)
        if i:
            back = back @ net[i][0].T
            back *= values[i] > 0
    return np.concatenate(parts), float(loss)


def _slopes(values: np.ndarray, back: np.ndarray) -> list[np.ndarray]:
    """Sums over the rows for a layer's weights and for its biases. In single precision a few inputs are taken one at a time,
    in half the time of so narrow a product, and biases by a product; in double precision digits stay as numpy sums them."""
    if back.dtype == np.float64:
        return [(values.T @ back).ravel(), back.sum(axis=0)]
    narrow = 1 <= values.shape[1] <= FEW_INPUTS
    weights = np.concatenate([values[:, i] @ back for i in range(values.shape[1])]) if narrow else (values.T @ back).ravel()
    return [weights, np.ones(len(back), back.dtype) @ back]


def batch_numbers(dealt: np.ndarray, seed: int, epoch: int, steps: int) -> np.ndarray:
    """The step of the epoch that takes each row, from the hash it was dealt by."""
    factor = np.random.default_rng([seed, epoch]).integers(1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = dealt.astype(np.uint64) * factor
    mixed = (mixed ^ (mixed >> np.uint64(32))) * factor
    return ((mixed >> np.uint64(33)) % np.uint64(steps)).astype(np.int64)


class Run:
    """One network in training: its weights, Adam's moments, and its patience. Tasks calculate in numbers of ``kind``; weights
    and sums are always of double precision."""

    def __init__(self, inputs: int, classes: int, fitted: int, o: PerceptronOptions, kind: type = np.float64):
        self.o, self.kind = o, kind
        sizes = [inputs, *o.hidden, classes]
        self.shapes = list(zip(sizes, sizes[1:]))
        rng, start = np.random.default_rng(o.seed), []
        for i, (rows, cols) in enumerate(self.shapes):
            bound = math.sqrt((6.0 if i < len(self.shapes) - 1 else 2.0) / (rows + cols))
            start += [rng.uniform(-bound, bound, rows * cols), rng.uniform(-bound, bound, cols)]
        self.weights = np.concatenate(start)
        self.decays = np.concatenate([np.repeat([1.0, 0.0], [rows * cols, cols]) for rows, cols in self.shapes])
        self.first, self.second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        self.updates, self.went_on = 0, False
        self.over(fitted)

    def over(self, fitted: int) -> None:
        """Begin with the epochs over a table of so many rows to fit; weights and moments are kept."""
        o = self.o
        self.patience = o.patience
        self.steps = min(MOST_STEPS, max(1, math.ceil(fitted / o.batch)))
        self.rate = max(o.learning_rate, min(MOST_RATE, o.learning_rate * math.sqrt(max(1.0, fitted / self.steps / o.batch))))
        self.epoch = self.at = self.waited = 0
        self.best, self.best_score, self.done = self.weights, -math.inf, False
        self.lost, self.seen, self.losses = 0.0, 0.0, []

    def go_on(self, fitted: int) -> None:
        """Train further over a larger table, from the best weights; only its own epochs can give the result. Steps are shorter
        than those that led near the end, which would lead away from it."""
        rate, self.weights, self.went_on = self.rate, self.best, True
        self.over(fitted)
        self.rate = max(self.o.learning_rate, rate / GO_ON)

    def task(self) -> tuple:
        """What the tasks need for this step."""
        o = self.o
        return self.weights.astype(self.kind), self.shapes, o.seed, self.epoch, self.steps, self.at, o.validation * 16.0 ** HASH_DIGITS

    def advance(self, sums: np.ndarray) -> None:
        *slopes, lost, seen, held, hits = sums
        o = self.o
        if self.at == 0 and self._ends(hits / held if held else -self.losses[-1] if self.losses else -math.inf):
            self.done = True
            return
        if seen:
            g = np.array(slopes) / seen + o.alpha / seen * self.decays * self.weights
            self.updates += 1
            self.first = 0.9 * self.first + 0.1 * g
            self.second = 0.999 * self.second + 0.001 * g * g
            rate = self.rate * math.sqrt(1 - 0.999 ** self.updates) / (1 - 0.9 ** self.updates)
            self.weights = self.weights - rate * self.first / (np.sqrt(self.second) + 1e-8)
        self.lost, self.seen, self.at = self.lost + lost, self.seen + seen, self.at + 1
        if self.at == self.steps:
            self.losses.append(self.lost / self.seen if self.seen else math.nan)
            self.lost, self.seen, self.at, self.epoch = 0.0, 0.0, 0, self.epoch + 1

    def _ends(self, score: float) -> bool:
        """Whether patience or the limit is over, asked before each epoch with the score of the weights as they are."""
        self.waited = 0 if score > self.best_score + self.o.tolerance else self.waited + 1
        if score > self.best_score or self.epoch == 0 or self.went_on and self.epoch == 1:
            self.best, self.best_score = self.weights, score
        return self.epoch > 0 and (self.waited > self.patience or self.epoch >= self.o.max_iter)


def train_perceptrons(train: DataFrame, features: Sequence[str], keys: Sequence[str], classes: int,
                      options: Sequence[PerceptronOptions]) -> list[Perceptron]:
    """Networks with all the options, each as if trained alone."""
    names = list(features)
    seeds = sorted({o.seed for o in options})
    held = {s: f"held {s}" for s in seeds}
    rows = train.select(*names, F.col("label").cast("int").alias("label"), F.xxhash64(*keys).alias("dealt"),
                        *[key_hash(keys, s + 1).alias(held[s]) for s in seeds])
    spread, n = spread_out(rows)
    limits = sorted({(o.seed, o.validation) for o in options})
    blocks = _blocks(spread, names, limits).persist(StorageLevel.MEMORY_AND_DISK)
    parts, runs = shares(n), {}
    for share in [*parts, 1]:
        part = blocks if share == 1 else _part(blocks, n, share).persist(StorageLevel.MEMORY_AND_DISK)
        fitted = part.agg(*[F.coalesce(F.sum(f"fitted {i}"), F.lit(0)) for i in range(len(limits))]).first()
        for k, o in enumerate(options):
            rows_fitted = fitted[limits.index((o.seed, o.validation))]
            if k in runs:
                runs[k].go_on(rows_fitted)
            else:
                runs[k] = Run(len(names), classes, rows_fitted, o, np.float32 if parts else np.float64)
            if share > 1:
                runs[k].patience = min(o.patience, PART_PATIENCE)
        tasks = part.rdd.getNumPartitions()
        while active := {k: r for k, r in runs.items() if not r.done}:
            for k, sums in _step(part, tasks, len(names), {k: r.task() for k, r in active.items()}).items():
                active[k].advance(sums)
        part.unpersist()
    return [Perceptron(names, r.shapes, r.best, r.epoch, r.losses, r.kind) for r in runs.values()]


def _blocks(rows: DataFrame, names: list[str], limits: list[tuple[int, float]]) -> DataFrame:
    """Up to BLOCK rows in a row, as bytes: what every step reads takes no conversion. Beside them the rows to fit."""
    kinds = {"label": np.int32, "dealt": np.int64, **{f"held {s}": np.float64 for s, _ in limits}}

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [batch.iloc[at:at + BLOCK] for at in range(0, len(batch), BLOCK)]
            out = {"x": [p[names].to_numpy(dtype=float).tobytes() for p in parts]}
            out |= {c: [p[c].to_numpy(dtype=kind).tobytes() for p in parts] for c, kind in kinds.items()}
            out |= {f"fitted {i}": [int((p[f"held {s}"] >= v * 16.0 ** HASH_DIGITS).sum()) for p in parts] for i, (s, v) in enumerate(limits)}
            yield pd.DataFrame(out)

    return rows.mapInPandas(packed, ", ".join(["x binary", *[f"`{c}` binary" for c in kinds], *[f"`fitted {i}` bigint" for i in range(len(limits))]]))


def _part(blocks: DataFrame, n: int, share: int) -> DataFrame:
    """One in ``share`` blocks, dealt over lanes as ``spread_out`` deals so many rows."""
    lanes = max(LEAST_LANES, n // share // ROWS_PER_LANE)
    chosen = blocks.filter(F.pmod(F.xxhash64("dealt"), F.lit(share)) == 0)
    return chosen.repartition(lanes, "dealt").sortWithinPartitions("dealt")


def _step(blocks: DataFrame, tasks: int, width: int, plan: dict[int, tuple]) -> dict[int, np.ndarray]:
    """For each network: the gradient over its batch, loss and rows of the batch, held-back rows and hits among them.
    Networks that take the same batch share its rows."""
    alike: dict[tuple, list] = {}
    for k, (weights, shapes, *batch) in plan.items():
        alike.setdefault((*batch, weights.dtype), []).append((k, weights, shapes))

    def measure(batches: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
        out = {k: np.zeros(len(t[0]) + 4) for k, t in plan.items()}
        for batch in batches:
            x = np.frombuffer(b"".join(batch["x"])).reshape(-1, width)
            y, dealt = np.frombuffer(b"".join(batch["label"]), np.int32), np.frombuffer(b"".join(batch["dealt"]), np.int64)
            for (seed, epoch, steps, at, limit, kind), networks in alike.items():
                away = np.frombuffer(b"".join(batch[f"held {seed}"])) < limit
                pick = np.flatnonzero(~away & (batch_numbers(dealt, seed, epoch, steps) == at))
                some, wanted = x[pick].astype(kind), y[pick]
                for k, weights, shapes in networks:
                    for part in _split(len(pick)):
                        slopes, lost = gradient(weights, shapes, some[part], wanted[part])
                        out[k][:-4] += slopes
                        out[k][-4:-2] += lost, len(wanted[part])
                if at == 0:
                    some, wanted = x[away].astype(kind), y[away]
                    for k, weights, shapes in networks:
                        net = layers(weights, shapes)
                        hits = sum(int((forward(net, some[part])[-1].argmax(axis=1) == wanted[part]).sum()) for part in _split(len(wanted)))
                        out[k][-2:] += len(wanted), hits
        return out

    return add_up(blocks, tasks, measure, sum(len(t[0]) + 4 for t in plan.values()))


def _split(rows: int) -> list[slice]:
    return [slice(at, at + BLOCK) for at in range(0, rows, BLOCK)]


def train_perceptron(train: DataFrame, features: Sequence[str], keys: Sequence[str], classes: int,
                     options: PerceptronOptions = PerceptronOptions()) -> Perceptron:
    return train_perceptrons(train, features, keys, classes, [options])[0]
