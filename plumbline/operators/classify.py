"""Classifiers: logistic regression (``softmax``), support vector machines (``machines``) and perceptrons (``perceptron``),
with their comparison, importances and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.clean import apply_scaler, scaler
from plumbline.operators.describe import literal_rows
from plumbline.operators.machines import KernelOptions, SupportVector, train_machines, voted, with_probabilities
from plumbline.operators.metrics import auc_macro, auc_micro, classification_metrics, confusion_matrix
from plumbline.operators.perceptron import (BLOCK, Classifier, Perceptron, PerceptronOptions, decide, guessed, spread_out, train_perceptron,
                                            train_perceptrons)
from plumbline.operators.softmax import Softmax, fit_softmax, fit_without_each_fold
from plumbline.operators.split import hash_folds, key_hash, label_counts, label_encode, stratified_split


@dataclass
class Task:
    """A scaled, split and label-encoded table for classifiers."""

    rows: DataFrame
    features: list[str]
    keys: list[str]
    classes: list

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "test")


def classification_task(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                        test_size: float = 0.3, seed: int = 42, scale_before_split: bool = False) -> Task:
    """Stratified split, scaler fitted on the training rows (or on all rows if asked), labels 0..k-1."""
    features, keys = list(features), list(keys)
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features], label).na.drop()
    counts = label_counts(rows, label)
    codes = {v: i for i, v in enumerate(counts)}
    rows = stratified_split(label_encode(rows, label, "label", codes), label, keys, test_size, seed, counts)
    fitted = scaler(rows if scale_before_split else rows.filter(F.col("split") == "train"), features)
    return Task(apply_scaler(rows, fitted), features, keys, list(codes))


@dataclass
class Logistic(Classifier):
    model: Softmax
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        return decide(df.withColumn("probability", self.model.probability([F.col(c) for c in self.features])))

    def rule(self) -> Callable[[np.ndarray], np.ndarray]:
        weights, intercepts = self.model.weights, self.model.intercepts
        return lambda x: (x @ weights.T + intercepts).argmax(axis=1)


def train_logistic(train: DataFrame, features: Sequence[str], c: float = 1.0, max_iter: int = 1000) -> Logistic:
    """Multinomial fit with an L2 penalty of strength 1 / (C n), weights on the given scale."""
    rows, n = spread_out(train.select(*features, "label"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    model = fit_softmax(rows, features, _classes(rows), 1.0 / (c * n), max_iter=max_iter)
    rows.unpersist()
    return Logistic(model, list(features))


def _classes(rows: DataFrame) -> int:
    return rows.agg(F.max("label")).first()[0] + 1


def cv_accuracy(train: DataFrame, features: Sequence[str], keys: Sequence[str], folds: int = 5) -> list[float]:
    """Accuracy of logistic regression on each held-out stratified fold; all folds are fitted in the same jobs."""
    folded = hash_folds(train, keys, folds, label="label").select(*features, "label", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    sizes = dict(folded.groupBy("fold").count().collect())
    counts = {f: sum(sizes.values()) - n for f, n in sorted(sizes.items())}
    models = fit_without_each_fold(folded, features, _classes(folded), {f: 1.0 / n for f, n in counts.items()}, counts)
    held = F.col("fold")
    probability = reduce(lambda other, f: F.when(held == f, models[f].probability([F.col(c) for c in features])).otherwise(other),
                         models, F.lit(None).cast("array<double>"))
    hits = decide(folded.withColumn("probability", probability)).groupBy("fold").agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double"))).collect()
    folded.unpersist()
    return [accuracy for _, accuracy in sorted(map(tuple, hits))]


def train_svm(train: DataFrame, features: Sequence[str], classes: int,
              options: KernelOptions = KernelOptions()) -> SupportVector:
    """Pairwise machines on the kernel's feature map, with probabilities."""
    rows = spread_out(train.select(*features, "label"))[0].persist(StorageLevel.MEMORY_AND_DISK)
    model = with_probabilities(train_machines(rows, features, classes, [options])[0], rows)
    rows.unpersist()
    return model


def accuracy_of(model: Classifier, df: DataFrame) -> float:
    return model.predict(df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


#: Rows of a bucket that donors are taken from, and orders of a bucket that its task holds at a time.
PER_BUCKET, ORDERS = 50_000, 64


def permuted_copies(df: DataFrame, features: Sequence[str], keys: Sequence[str], repeats: int, seed: int,
                    per_bucket: int = PER_BUCKET, models: Mapping[str, Classifier] | None = None) -> DataFrame:
    """Every row once per (feature, repeat) with that feature taken from another row.

    Rows are dealt once into hash buckets of about ``per_bucket`` rows; inside a bucket each
    feature is passed, for every repeat, to the next row of a random order of its own, the last
    row's to the first.  A row's donors are therefore the rows of its bucket.  One shuffle serves
    all features and repeats, and no bucket holds more than its share.

    With ``models`` the copies do not leave the task that makes them: for each bucket, feature and repeat there is one row
    with the rows ``n`` and, for each model, the hits ``class i``; the rows as they are have no feature.
    """
    n = df.count()
    buckets = max(1, n // per_bucket)
    names, kinds = list(features), dict(df.dtypes)
    rules = None if models is None else [m.rule() for m in models.values()]
    hits = [f"class {i}" for i in range(len(models or {}))]
    # dealt once; the copies are made inside the buckets, where rows of equal hash stand in the order of their values
    dealt = df.withColumn("bucket", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets)).cast("int")).repartition(buckets, "bucket")
    at_once = max(1, ORDERS // max(1, repeats))

    def made(some: list[str], whole: bool) -> DataFrame:
        def swapped(bucket: pd.DataFrame) -> Iterator[tuple[str, int, np.ndarray]]:
            for f in some:
                values = bucket[f].to_numpy()
                for r in range(repeats):
                    order, moved = np.argsort(bucket[f"order {f} {r}"].to_numpy(), kind="stable"), values.copy()
                    moved[order] = values[np.roll(order, -1)]
                    yield f, r, moved

        def copied(bucket: pd.DataFrame) -> pd.DataFrame:
            bucket = bucket.sort_values(["label", *names], ignore_index=True)
            out = [bucket[["label", *names]].assign(repeat=r, feature=f, **{f: moved}) for f, r, moved in swapped(bucket)]
            return pd.concat(out)[["label", "repeat", "feature", *names]]

        def scored(bucket: pd.DataFrame) -> pd.DataFrame:
            bucket = bucket.sort_values(["label", *names], ignore_index=True)
            x, label = bucket[names].to_numpy(dtype=float), bucket["label"].to_numpy()

            def right(x: np.ndarray) -> list[int]:
                return [sum(int((rule(x[at:at + BLOCK]) == label[at:at + BLOCK]).sum()) for at in range(0, len(x), BLOCK)) for rule in rules]

            out = [(None, None, len(x), *right(x))] if whole else []
            for f, r, moved in swapped(bucket):
                other = x.copy()
                other[:, names.index(f)] = moved
                out.append((f, r, len(x), *right(other)))
            return pd.DataFrame(out, columns=["feature", "repeat", "n", *hits]).astype({"repeat": "Int32"})

        orders = [F.xxhash64(*keys, F.lit(r), F.lit(f"{seed}{f}")).alias(f"order {f} {r}") for f in some for r in range(repeats)]
        grouped = dealt.select("bucket", "label", *names, *orders).groupBy("bucket")
        if models is None:
            return grouped.applyInPandas(copied, f"label {kinds['label']}, repeat int, feature string, " + ", ".join(f"`{f}` {kinds[f]}" for f in names))
        return grouped.applyInPandas(scored, ", ".join(["feature string, repeat int, n bigint", *[f"`{c}` bigint" for c in hits]]))

    return reduce(DataFrame.unionByName, [made(names[at:at + at_once], at == 0) for at in range(0, len(names), at_once)])


def permutation_importance(models: Mapping[str, Classifier], test: DataFrame, features: Sequence[str],
                           keys: Sequence[str], repeats: int = 10, seed: int = 42) -> DataFrame:
    """(model, feature, importance, sd): drop in test accuracy over the shuffles, all models scoring each copy as it is made."""
    copies = permuted_copies(test.select(*keys, *features, "label"), features, keys, repeats, seed, PER_BUCKET, models)
    names = {name: f"class {i}" for i, name in enumerate(models)}
    shares = [(F.sum(c) / F.sum("n")).alias(c) for c in names.values()]
    spread = copies.groupBy("feature", "repeat").agg(*shares).groupBy("feature").agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in names.values()]).collect()
    base = {c: r[c]["mean"] for r in spread if r["feature"] is None for c in names.values()}
    rows = [(name, r["feature"], base[c] - r[c]["mean"], r[c]["sd"]) for name, c in names.items() for r in spread if r["feature"] is not None]
    rows.sort(key=lambda r: (r[0], -r[2], r[1]))
    return literal_rows(test.sparkSession, rows, "model string, feature string, importance double, sd double")


# The settings that the study compares with the base ones.
PERCEPTRON_VARIANTS = {
    "fewer units (50,25)": {"hidden": (50, 25)},
    "more units (200,100)": {"hidden": (200, 100)},
    "more regularization (alpha=0.01)": {"alpha": 0.01},
    "less regularization (alpha=0.0001)": {"alpha": 0.0001},
}
KERNEL_VARIANTS = {
    "C=0.1": {"c": 0.1},
    "C=10.0": {"c": 10.0},
    "gamma=0.1": {"gamma": 0.1},
    "gamma=10.0": {"gamma": 10.0},
    "linear kernel": {"kernel": "linear"},
    "polynomial kernel (degree=3)": {"kernel": "poly", "degree": 3},
}


def sweep_models(task: Task, perceptron: PerceptronOptions = PerceptronOptions(), kernel: KernelOptions = KernelOptions(),
                 probabilities: bool = False) -> dict[str, dict[str, Classifier]]:
    """Models of the base settings (``base``) and of every variant, by family and configuration: all perceptrons trained in
    the same jobs, all machines in the same jobs. Of the machines the base ones alone get ``probabilities``."""
    changes = {"perceptron": {"base": {}, **PERCEPTRON_VARIANTS}, "support vector": {"base": {}, **KERNEL_VARIANTS}}
    networks = train_perceptrons(task.train, task.features, task.keys, len(task.classes),
                                 [replace(perceptron, **c) for c in changes["perceptron"].values()])
    rows = spread_out(task.train.select(*task.features, "label"))[0].persist(StorageLevel.MEMORY_AND_DISK)
    machines = train_machines(rows, task.features, len(task.classes), [replace(kernel, **c) for c in changes["support vector"].values()])
    if probabilities:
        with_probabilities(machines[0], rows)
    rows.unpersist()
    return {family: dict(zip(variants, models)) for (family, variants), models in zip(changes.items(), (networks, machines))}


def parameter_sweep(task: Task, perceptron: PerceptronOptions = PerceptronOptions(), kernel: KernelOptions = KernelOptions(),
                    trained: Mapping[str, Mapping[str, Classifier]] | None = None) -> DataFrame:
    """(family, configuration, accuracy, iterations) for the base settings and every variant.

    One pass over the test rows scores all models. ``trained`` may hold those of ``sweep_models``.
    """
    trained = trained or sweep_models(task, perceptron, kernel)
    networks, machines = list(trained["perceptron"].values()), list(trained["support vector"].values())
    guesses = F.concat(guessed(networks), voted(machines))
    scored = task.test.select("label", guesses.alias("guesses"))
    names = [(family, name) for family, variants in trained.items() for name in variants]
    row = scored.agg(*[F.avg((F.col("label") == F.col("guesses")[i]).cast("double")) for i in range(len(names))]).first()
    iterations = [n.iterations for n in networks] + [None] * len(machines)
    return literal_rows(task.rows.sparkSession, [(*name, accuracy, n) for name, accuracy, n in zip(names, row, iterations)],
                        "family string, configuration string, accuracy double, iterations bigint")


@dataclass
class Retrained:
    """A perceptron on all features and one without ``weakest``, each with the table it was trained on."""

    weakest: str
    full: tuple[Task, Perceptron]
    reduced: tuple[Task, Perceptron]

    def named(self) -> list[tuple[str, str | None, Task, Perceptron]]:
        return [("all", None, *self.full), ("reduced", self.weakest, *self.reduced)]


def retrained_without_weakest(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                              options: PerceptronOptions = PerceptronOptions(), repeats: int = 10, task: Task | None = None,
                              full: Perceptron | None = None) -> Retrained:
    """The weakest feature is that of least permutation importance; ``task`` and ``full`` spare work already done."""
    task = task or classification_task(df, features, label, keys)
    full = full or train_perceptron(task.train, task.features, task.keys, len(task.classes), options)
    ranking = permutation_importance({"perceptron": full}, task.test, task.features, task.keys, repeats)
    weakest = ranking.orderBy("importance", F.desc("feature")).first()["feature"]
    fewer = classification_task(df, [c for c in features if c != weakest], label, keys)
    reduced = train_perceptron(fewer.train, fewer.features, fewer.keys, len(fewer.classes), options)
    return Retrained(weakest, (task, full), (fewer, reduced))


def retrained_metrics(study: Retrained) -> DataFrame:
    """(features, dropped, metrics, areas, accuracy_change) on the test rows, before and after."""
    out, before = [], None
    for name, dropped, task, model in study.named():
        scored = model.predict(task.test).select("label", "prediction", *[
            F.col("probability")[i].alias(f"p{i}") for i in range(len(task.classes))]).persist(StorageLevel.MEMORY_AND_DISK)
        scores = {i: f"p{i}" for i in range(len(task.classes))}
        row = classification_metrics(scored, "label", "prediction").first()
        areas = [area(scored, "label", scores).first()[0] for area in (auc_macro, auc_micro)]
        scored.unpersist()
        before = row["accuracy"] if before is None else before
        out.append((name, dropped, *row, *areas, row["accuracy"] - before))
    columns = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_micro", "recall_micro", "f1_micro", "auc_macro",
               "auc_micro", "accuracy_change"]
    return literal_rows(study.full[0].rows.sparkSession, out, "features string, dropped string, " + ", ".join(f"{c} double" for c in columns))


def retrained_cells(study: Retrained) -> DataFrame:
    """(features, dropped, actual, predicted, n): confusion cells on the test rows, before and after."""
    frames = [confusion_matrix(model.predict(task.test), "label", "prediction", range(len(task.classes))).select(
        F.lit(name).alias("features"), F.lit(dropped).cast("string").alias("dropped"), "*") for name, dropped, task, model in study.named()]
    return frames[0].unionByName(frames[1])


def drop_weakest_retrain(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                         options: PerceptronOptions = PerceptronOptions(), repeats: int = 10) -> DataFrame:
    """Metrics of the perceptron on all features and without the least important one, and the change in accuracy."""
    return retrained_metrics(retrained_without_weakest(df, features, label, keys, options, repeats))
