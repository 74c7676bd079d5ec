"""Linear and ridge regression, principal components, and their comparison.

All fits share one pass: Gram sums per fold and split.  Scaling, component
projection, refits per fold and fold scores are k x k algebra on those sums.
A second pass over the rows gives the error measures of every model at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.tails import f_sf, t_sf2
from plumbline.operators.describe import literal_rows
from plumbline.operators.split import HASHES, HashedKeys, hash_folds, key_hash, split_with_folds
from plumbline.plans.gram import Gram, complete_rows, gram, gram_by
from plumbline.plans.order import exact_quantiles

MAPE_FLOOR = 2.220446049250313e-16


def dot(columns: Sequence[Column], weights) -> Column:
    return reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(columns, weights)])


def error_measures(label: Column, prediction: Column) -> dict[str, Column]:
    """RMSE, R-squared and mean absolute percentage error (denominator floored near zero)."""
    gap = label - prediction
    return {"rmse": F.sqrt(F.avg(gap * gap)), "r2": 1 - F.avg(gap * gap) / F.nullif(F.var_pop(label), F.lit(0.0)),
            "mape": F.avg(F.abs(gap) / F.greatest(F.abs(label), F.lit(MAPE_FLOOR)))}


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    measures = error_measures(F.col(label), F.col(prediction))
    return df.groupBy(*by).agg(*[m.alias(n) for n, m in measures.items()])


@dataclass
class LinearFit:
    """A fitted line over standardized features, optionally through components."""

    features: list[str]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float
    components: np.ndarray | None = None
    cv: list[float] = field(default_factory=list)

    def prediction(self) -> Column:
        weights = self.weights if self.components is None else self.components @ self.weights
        slopes = weights / self.scale
        return F.lit(float(self.intercept - slopes @ self.centre)) + dot([F.col(c) for c in self.features], slopes)


def solve(g: Gram, alpha: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and intercept; the last column is the target, the intercept is not penalised."""
    k = len(g.mean) - 1
    left, right = g.cross[:k, :k] + alpha * np.eye(k), g.cross[:k, k]
    weights = np.linalg.lstsq(left, right, rcond=None)[0] if alpha == 0 else np.linalg.solve(left, right)
    return weights, float(g.mean[k] - weights @ g.mean[:k])


def score(g: Gram, weights: np.ndarray, intercept: float) -> float:
    """R-squared of the line on the rows behind ``g``."""
    k = len(g.mean) - 1
    shift = g.mean[k] - intercept - weights @ g.mean[:k]
    sse = g.cross[k, k] - 2 * weights @ g.cross[:k, k] + weights @ g.cross[:k, :k] @ weights + g.n * shift ** 2
    return float(1 - sse / g.cross[k, k])


def total(parts: Mapping[object, Gram]) -> Gram:
    return reduce(lambda a, b: a.plus(b), parts.values())


@dataclass
class Components:
    """Principal components of the standardized training features."""

    features: list[str]
    loadings: np.ndarray
    ratios: np.ndarray
    count: int

    def kept(self) -> np.ndarray:
        return self.loadings[:, :self.count]


def principal_components(g: Gram, features: Sequence[str], count: int | None = None,
                         min_variance: float = 0.95) -> Components:
    """Eigenvectors of the covariance, each signed so that its largest loading is positive.

    Without ``count``, the smallest number of components that explains ``min_variance``.
    """
    k = len(features)
    values, vectors = np.linalg.eigh(g.cross[:k, :k] / (g.n - 1))
    values, vectors = np.clip(values[::-1], 0, None), vectors[:, ::-1]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    ratios = values / values.sum()
    if count is None:
        enough = np.cumsum(ratios) >= min_variance
        count = int(enough.argmax()) + 1
    return Components(list(features), vectors, ratios, count)


def fit_models(parts: Mapping[object, Gram], features: Sequence[str], alphas: Mapping[str, float],
               components: bool = False, count: int | None = None,
               min_variance: float = 0.95) -> tuple[dict[str, LinearFit], Components | None]:
    """Fits named ridge strengths (0 is least squares) on the training folds' Gram sums."""
    k = len(features)
    whole = total(parts)
    centre, scale = whole.mean.copy(), whole.std()
    centre[k], scale[k] = 0.0, 1.0
    folds = {f: g.scaled(centre, scale) for f, g in parts.items()}
    found = None
    if components:
        found = principal_components(total(folds), features, count, min_variance)
        matrix = np.zeros((k + 1, found.count + 1))
        matrix[:k, :found.count], matrix[k, found.count] = found.kept(), 1.0
        folds = {f: g.projected(matrix) for f, g in folds.items()}
    everything = total(folds)
    fits = {}
    for name, alpha in alphas.items():
        weights, intercept = solve(everything, alpha)
        cv = [score(held, *solve(everything.minus(held), alpha)) for _, held in sorted(folds.items())] if len(folds) > 1 else []
        fits[name] = LinearFit(list(features), centre[:k], scale[:k], weights, intercept,
                               found.kept() if found else None, cv)
    return fits, found


@dataclass
class Prepared:
    """Complete rows with split and fold, persisted until ``release``, and the training Gram sums per fold."""

    rows: DataFrame
    features: list[str]
    target: str
    parts: dict[object, Gram]
    kept: DataFrame

    def release(self) -> None:
        self.kept.unpersist()


def prepare(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], folds: int = 5, test_size: float = 0.2) -> Prepared:
    """Splits ``df`` unless it has a ``split`` column, and draws folds over the training rows. The table is read once; what
    a fit needs of it, narrow and hashed, is persisted for the passes that find the cuts, the sums and the errors."""
    features = list(features)
    columns = list(dict.fromkeys([*features, target]))
    rows = complete_rows(df, columns).select(*columns, *(["split"] if "split" in df.columns else []),
                                             *[key_hash(keys, 42, part).alias(name) for part, name in enumerate(HASHES)])
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    hashed = HashedKeys(HASHES)
    if "split" in df.columns:
        train = hash_folds(kept.filter(F.col("split") == "train"), hashed, folds)
        return Prepared(kept, features, target, gram_by(train, [*features, target], "fold"), kept)
    parted = split_with_folds(kept, hashed, test_size, folds)
    return Prepared(parted, features, target, gram_by(parted.filter("fold is not null"), [*features, target], "fold"), kept)


def model_rows(p: Prepared, fits: Mapping[str, LinearFit]) -> list[tuple[str, str, float]]:
    """(model, measure, value): weights, train and test errors, cross-validation mean and sd."""
    label = F.col(p.target).cast("double")
    measures = [m.alias(f"{name}|{m_name}") for name, fit in fits.items()
                for m_name, m in error_measures(label, fit.prediction()).items()]
    table = {r["split"]: r for r in p.rows.groupBy("split").agg(*measures).collect()}
    out = []
    for name, fit in fits.items():
        out.append((name, "intercept", fit.intercept))
        names = p.features if fit.components is None else [f"PC{i + 1}" for i in range(len(fit.weights))]
        out += [(name, f"coefficient {c}", float(w)) for c, w in zip(names, fit.weights)]
        out += [(name, f"{split} {m}", table[split][f"{name}|{m}"]) for split in ("train", "test") if split in table
                for m in ("rmse", "r2", "mape")]
        out += [(name, "cv mean", float(np.mean(fit.cv))), (name, "cv sd", float(np.std(fit.cv)))]
    return out


def regression_models(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str],
                      alphas: Mapping[str, float], components: bool = False, count: int | None = None,
                      min_variance: float = 0.95, test_size: float = 0.2) -> DataFrame:
    """(model, measure, value) for each named ridge strength, on features or on components; see ``prepare`` for the split."""
    p = prepare(df, features, target, keys, test_size=test_size)
    rows = _model_table(p, alphas, components, count, min_variance)
    p.release()
    return literal_rows(df.sparkSession, rows, MODEL_ROWS)


MODEL_ROWS = "model string, measure string, value double"


def _model_table(p: Prepared, alphas: Mapping[str, float], components: bool, count: int | None, min_variance: float) -> list[tuple]:
    fits, found = fit_models(p.parts, p.features, alphas, components, count, min_variance)
    rows = model_rows(p, fits)
    if found:
        rows += [(name, "explained variance", float(found.ratios[:found.count].sum())) for name in alphas]
    return rows


def regression_on_components(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], alphas: Mapping[str, float],
                             count: int | None = None, min_variance: float = 0.95, test_size: float = 0.2) -> DataFrame:
    """``compare_components`` of the models on features and on components, from one preparation."""
    p = prepare(df, features, target, keys, test_size=test_size)
    both = [literal_rows(df.sparkSession, _model_table(p, alphas, c, count, min_variance), MODEL_ROWS) for c in (False, True)]
    p.release()
    return compare_components(*both)


def compare_models(models: DataFrame, measures: Sequence[str] = ("test r2", "test rmse", "cv mean")) -> DataFrame:
    """One row per model."""
    wide = models.filter(F.col("measure").isin(*measures)).groupBy("model").pivot("measure", list(measures)).agg(F.max("value"))
    return wide.select("model", *[F.col(f"`{m}`").alias(m.replace(" ", "_")) for m in measures])


def compare_components(plain: DataFrame, on_components: DataFrame) -> DataFrame:
    """Each model on the features beside the same model on components, with the differences."""
    a, b = compare_models(plain), compare_models(on_components)
    measures = [c for c in a.columns if c != "model"]
    joined = a.join(b.select("model", *[F.col(m).alias(f"pca_{m}") for m in measures]), "model")
    return joined.select("*", *[(F.col(f"pca_{m}") - F.col(m)).alias(f"diff_{m}") for m in measures])


def cv_scores(df: DataFrame, features: Sequence[str], target: str, fold: str, alpha: float = 0.0) -> DataFrame:
    """(fold, r2) for every held-out fold, from one pass of Gram sums."""
    parts = gram_by(df, [*features, target], fold)
    fits, _ = fit_models(parts, features, {"model": alpha})
    rows = [(int(f), r2) for f, r2 in zip(sorted(parts), fits["model"].cv)]
    return literal_rows(df.sparkSession, rows, "fold bigint, r2 double")


@dataclass
class OrdinaryFit:
    """Least squares on the raw features with the classical inference."""

    features: list[str]
    target: str
    g: Gram
    coefficients: np.ndarray
    inverse: np.ndarray
    sse: float

    @property
    def dof(self) -> int:
        return int(self.g.n) - len(self.features) - 1

    @property
    def sigma(self) -> float:
        return float(np.sqrt(self.sse / self.dof))


def ordinary_fit(df: DataFrame, features: Sequence[str], target: str) -> OrdinaryFit:
    features = list(features)
    g = gram(df, [*features, target])
    k = len(features)
    inverse = np.linalg.pinv(g.cross[:k, :k])
    slopes = inverse @ g.cross[:k, k]
    sse = float(g.cross[k, k] - slopes @ g.cross[:k, k])
    return OrdinaryFit(features, target, g, np.array([g.mean[k] - slopes @ g.mean[:k], *slopes]), inverse, max(sse, 0.0))


def quotient(top: float, bottom: float) -> float | None:
    """Infinite over zero, and none for zero over zero: an exact fit has no error to compare with."""
    if bottom:
        return top / bottom
    return None if top == 0 else float(np.copysign(np.inf, top))


def lm_coefficients(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(term, estimate, std_error, t, p_value)"""
    fit = ordinary_fit(df, features, target)
    k = len(fit.features)
    mean = fit.g.mean[:k]
    variances = [1 / fit.g.n + mean @ fit.inverse @ mean, *np.diag(fit.inverse)]
    rows = []
    for term, value, v in zip(["intercept", *fit.features], fit.coefficients, variances):
        error = fit.sigma * float(np.sqrt(v))
        t = quotient(float(value), error)
        rows.append((term, float(value), error, t, None if t is None else t_sf2(t, fit.dof)))
    return literal_rows(df.sparkSession, rows, "term string, estimate double, std_error double, t double, p_value double")


def lm_summary(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One row: residual quartiles, residual error and degrees of freedom, R-squared, F and its p-value, equation."""
    fit = ordinary_fit(df, features, target)
    k = len(fit.features)
    residual = with_residuals(complete_rows(df, [*fit.features, target]), fit).select("residual")
    spread = exact_quantiles(residual, ["residual"], [0, 0.25, 0.5, 0.75, 1])["residual"]
    syy = float(fit.g.cross[k, k])
    r2 = 1 - fit.sse / syy if syy else None
    f = quotient((syy - fit.sse) / k, fit.sse / fit.dof if fit.dof else 0.0)
    adjusted = 1 - (1 - r2) * (fit.g.n - 1) / fit.dof if syy and fit.dof else None
    equation = f"{target} = {fit.coefficients[0]:.2f}" + "".join(
        f" + {b:.2f} * {c}" for b, c in zip(fit.coefficients[1:], fit.features))
    row = (*spread, fit.sigma, fit.dof, r2, adjusted, f, None if f is None else f_sf(f, k, fit.dof), equation)
    return literal_rows(df.sparkSession, [tuple(v.item() if hasattr(v, "item") else v for v in row)],
                        "min_residual double, q1_residual double, median_residual double, q3_residual double, "
                        "max_residual double, sigma double, df bigint, r2 double, adj_r2 double, f double, "
                        "p_value double, equation string")


def with_residuals(df: DataFrame, fit: OrdinaryFit, standardized: bool = False) -> DataFrame:
    """Adds ``fitted``, ``residual`` and, if wanted, ``std_residual`` = e / (s sqrt(1 - leverage))."""
    xs = [F.col(c) for c in fit.features]
    fitted = F.lit(float(fit.coefficients[0])) + dot(xs, fit.coefficients[1:])
    out = df.withColumn("fitted", fitted).withColumn("residual", F.col(fit.target) - F.col("fitted"))
    if standardized:
        away = [x - F.lit(float(m)) for x, m in zip(xs, fit.g.mean)]
        leverage = F.lit(1 / fit.g.n)
        for i, a in enumerate(away):
            leverage = leverage + a * dot(away, fit.inverse[i])
        out = out.withColumn("std_residual", F.col("residual") / (F.lit(fit.sigma) * F.sqrt(1 - leverage)))
    return out


def fit_components(df: DataFrame, features: Sequence[str], count: int | None = None,
                   min_variance: float = 0.95) -> tuple[Components, Gram]:
    g = gram(df, features)
    return principal_components(g.scaled(g.mean, g.std()), features, count, min_variance), g


def pca_variance(df: DataFrame, features: Sequence[str], min_variance: float = 0.95) -> DataFrame:
    """(component, ratio, cumulative, kept) for every component: the scree data."""
    found, _ = fit_components(df, features, None, min_variance)
    rows = [(i + 1, float(r), float(c), i < found.count) for i, (r, c) in
            enumerate(zip(found.ratios, np.cumsum(found.ratios)))]
    return literal_rows(df.sparkSession, rows, "component bigint, ratio double, cumulative double, kept boolean")


def pca_loadings(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(component, feature, loading, size, is_top)"""
    found, _ = fit_components(df, features, len(features))
    rows = []
    for j in range(len(features)):
        column = found.loadings[:, j]
        rows += [(j + 1, c, float(w), float(abs(w)), i == int(np.abs(column).argmax()))
                 for i, (c, w) in enumerate(zip(features, column))]
    return literal_rows(df.sparkSession, rows, "component bigint, feature string, loading double, size double, is_top boolean")


def pca_scores(df: DataFrame, features: Sequence[str], count: int | None = None) -> DataFrame:
    """Adds PC1..PCk for every row, centred and scaled before projecting."""
    found, g = fit_components(df, features, count)
    scale = g.std()
    away = [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(features, g.mean, scale)]
    return df.withColumns({f"PC{j + 1}": dot(away, found.loadings[:, j]) for j in range(found.count)})
