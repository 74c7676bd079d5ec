"""Whole analyses, composed of the operators, as long result frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators import association, bins, classify, clean, describe, linear, metrics, normality, split
from plumbline.operators.anova import anova_f_scores


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def melt(df: DataFrame, keys: Sequence[str], section: str, measures: Sequence[str] | None = None) -> DataFrame:
    """(section, item, statistic, value), the item being the keys joined by a blank."""
    measures = list(measures or [c for c, t in df.dtypes if c not in keys and t in ("double", "bigint", "int", "boolean")])
    cells = F.array(*[F.struct(F.lit(m).alias("statistic"), F.col(m).cast("double").alias("value")) for m in measures])
    item: Column = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    return df.select(F.lit(section).alias("section"), item.alias("item"), F.explode(cells).alias("c")).select(
        "section", "item", "c.*")


def univariate_report(df: DataFrame, columns: Sequence[str], key: str, outliers: bool = True, histogram: bool = True,
                      qq: bool = True, normality_tests: bool = True, threshold: float = 3.0) -> DataFrame:
    """(section, item, statistic, value) for every column: parameters, box, histogram, Q-Q line, tests, outliers."""
    columns = list(columns)
    parts = [melt(describe.describe_params(df, columns), ["column"], "parameters"),
             melt(bins.boxplot_stats(df, columns), ["column"], "box")]
    if histogram:
        parts.append(melt(bins.histogram_sturges(df, columns), ["column", "bin"], "histogram", ["lower", "upper", "n"]))
    if qq:
        parts += [melt(bins.qq_fit(bins.qq_points(df, c)).withColumn("column", F.lit(c)), ["column"], "qq line")
                  for c in columns]
    if normality_tests:
        parts.append(melt(normality.ks_normal(df, columns), ["column"], "ks", ["statistic", "p_value"]))
        parts += [melt(normality.jarque_bera_diff(df, key, c).withColumn("column", F.lit(c)), ["column"],
                       "jarque-bera of differences", ["statistic", "p_value"]) for c in columns]
    if outliers:
        parts += [melt(clean.outlier_summary(df, c, threshold).withColumn("column", F.lit(c)), ["column"], "outliers")
                  for c in columns]
    return stack(parts)


def correlation_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation matrix, pair strengths and variance inflation."""
    matrix = association.corr_matrix(df, columns)
    return stack([
        melt(matrix, ["row", "col"], "correlation", ["r"]),
        melt(association.corr_insights(df, columns), ["row", "col", "strength"], "insight", ["r"]),
        melt(association.vif(df, columns), ["column", "level"], "vif", ["vif"]),
        melt(association.lower_triangle(matrix, columns), ["row", "col"], "heat map", ["r"])])


def contingency_report(df: DataFrame, a: str, b: str, k: int = 5) -> DataFrame:
    """Two numeric columns cut into k equal widths: observed, expected, chi-square, Cramer's V."""
    edges = bins.equal_width_edges(df, [a, b], k)
    binned = bins.with_bins(df.select(a, b), edges)
    x, y = f"{a}_bin", f"{b}_bin"
    return stack([
        melt(association.crosstab(binned, x, y), ["a", "b"], "observed", ["n"]),
        melt(association.expected_counts(binned, x, y), ["a", "b"], "expected", ["expected"]),
        melt(association.chi2_independence(binned, x, y), [], "test", ["chi2", "p_value", "dof", "reject_h0"]),
        melt(association.cramers_v(binned, x, y), [], "strength", ["cramers_v"])])


def _split_for(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], test_size: float) -> DataFrame:
    rows = df.select(*keys, *features, target).na.drop(subset=[*features, target])
    return split.train_test_split(rows, keys, test_size)


def logistic_models(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str],
                    test_size: float = 0.2, components: int | float | None = None) -> DataFrame:
    """(model, measure, value) of a logistic regression on standardized features: accuracies, the test rows' report
    per class and their confusion cells.  With ``components`` (a number, or the share of variance to keep) the
    features are principal components of the training rows, and their ratios and loadings are given too.
    """
    rows = split.label_encode(_split_for(df, features, target, keys, test_size), target, "label")
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    fitted, extra, used = clean.scaler(train, features), [], list(features)
    train, test = clean.apply_scaler(train, fitted), clean.apply_scaler(test, fitted)
    if components is not None:
        given = {"min_variance": components} if isinstance(components, float) else {"count": components}
        found, _ = linear.fit_components(train, features, **given)
        used = [f"PC{j + 1}" for j in range(found.count)]
        scores = {c: linear.dot([F.col(f) for f in features], found.loadings[:, j]) for j, c in enumerate(used)}
        train, test = train.withColumns(scores), test.withColumns(scores)
        extra = _component_rows(found, features)
    model = classify.train_logistic(train, used)
    cv = classify.cv_accuracy(train, used, keys)
    mean = sum(cv) / len(cv)
    sd = (sum((c - mean) ** 2 for c in cv) / len(cv)) ** 0.5
    scored = model.predict(test)
    cells = describe.settle(metrics.confusion_matrix(scored.withColumn("guess", F.col("prediction")), "label", "guess"))
    hits = cells.agg(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n"))) / F.sum("n")).first()[0]
    rows = [("train accuracy", classify.accuracy_of(model, train)), ("test accuracy", hits), ("cv mean", mean), ("cv sd", sd)]
    rows += [(f"confusion {r.actual} {r.predicted}", float(r.n)) for r in cells.collect()]
    rows += [(f"class {r['class']} {m}", float(r[m])) for r in metrics.per_class(cells).collect()
             for m in ("precision", "recall", "f1", "support")]
    return describe.literal_rows(df.sparkSession, [("logistic", m, v) for m, v in [*rows, *extra]],
                                 "model string, measure string, value double")


def _component_rows(found, features: Sequence[str]) -> list[tuple[str, float]]:
    ratios = [(f"ratio PC{i + 1}", float(r)) for i, r in enumerate(found.ratios)]
    return ratios + [(f"loading PC{j + 1} {c}", float(found.loadings[i, j])) for j in range(found.count) for i, c in enumerate(features)]


def regression_report(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str],
                      test_size: float = 0.2, alpha: float = 1.0) -> DataFrame:
    """(model, measure, value): logistic for a categorical target, else least squares and ridge."""
    if split.target_kind(df, target).first()["kind"] == "categorical":
        return logistic_models(df, features, target, keys, test_size)
    return linear.regression_models(df, features, target, keys, {"linear": 0.0, "ridge": alpha}, test_size=test_size)


def regression_pca_report(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str],
                          test_size: float = 0.2, alpha: float = 1.0, count: int | None = None) -> DataFrame:
    """(features, model, measure, value): models on features, on components, what the components change, scree and
    loadings; logistic models for a categorical target, else least squares and ridge."""
    if split.target_kind(df, target).first()["kind"] == "categorical":
        both = [logistic_models(df, features, target, keys, test_size),
                logistic_models(df, features, target, keys, test_size, count or 0.95)]
        shown = ("test accuracy", "cv mean")
        got = [{r.measure: r.value for r in t.filter(F.col("measure").isin(*shown)).collect()} for t in both]
        change = describe.literal_rows(df.sparkSession, [("change", "logistic", m, got[1][m] - got[0][m]) for m in shown],
                                       "features string, model string, measure string, value double")
        named = [t.select(F.lit(n).alias("features"), "model", "measure", "value") for n, t in zip(("original", "components"), both)]
        return stack([*named, change])
    alphas = {"linear": 0.0, "ridge": alpha}
    p = linear.prepare(df, features, target, keys, test_size=test_size)
    plain, _ = linear.fit_models(p.parts, p.features, alphas)
    reduced, found = linear.fit_models(p.parts, p.features, alphas, True, count)
    named = {**{("original", n): f for n, f in plain.items()}, **{("components", n): f for n, f in reduced.items()}}
    measured = linear.model_rows(p, {f"{kind} {n}": f for (kind, n), f in named.items()})
    p.release()
    out = [(name.split(" ")[0], name.split(" ")[1], m, v) for name, m, v in measured]
    out += [("components", "pca", m, v) for m, v in _component_rows(found, p.features)]
    values = {row[:3]: row[3] for row in out}
    out += [("change", n, m, values["components", n, m] - values["original", n, m]) for n in alphas
            for m in ("test r2", "test rmse", "cv mean") if ("original", n, m) in values]
    return describe.literal_rows(df.sparkSession, out, "features string, model string, measure string, value double")


def classification_report_full(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                               perceptron: classify.PerceptronOptions = classify.PerceptronOptions(),
                               kernel: classify.KernelOptions = classify.KernelOptions(), repeats: int = 10) -> DataFrame:
    """The classification study: description, normality, feature scores, two models with their metrics, areas, ROC points
    and confusion cells on train and test rows, importances, the sweep of settings, and the retraining without the weakest
    feature."""
    features = list(features)
    task = classify.classification_task(df, features, label, keys)
    kept = task.rows.persist(StorageLevel.MEMORY_AND_DISK)
    # the base models and those of the sweep share their jobs
    trained = classify.sweep_models(task, perceptron, kernel, probabilities=True)
    models = {family: variants["base"] for family, variants in trained.items()}
    parts = [melt(describe.class_distribution(df, label), [label], "classes"),
             melt(describe.describe_quartiles(df, features), ["column"], "description"),
             melt(normality.shapiro_wilk(df, features), ["column"], "normality", ["w", "p_value"]),
             melt(anova_f_scores(df, features, label), ["column"], "feature score"),
             melt(association.corr_matrix(df, features), ["row", "col"], "correlation", ["r"]),
             melt(df.sparkSession.createDataFrame(models["perceptron"].input_importance(), "feature string, importance double"),
                  ["feature"], "weight importance")]
    scores = {i: f"p{i}" for i in range(len(task.classes))}
    for name, model in models.items():
        scored = model.predict(task.rows).select(
            "split", "label", "prediction", *[F.col("probability")[i].alias(c) for i, c in scores.items()]).persist(
            StorageLevel.MEMORY_AND_DISK)
        named = F.lit(name).alias("model")
        by_split = metrics.classification_metrics(scored, "label", "prediction", ["split"])
        small = [melt(by_split.select(named, "*"), ["model", "split"], "metrics")]
        for part in ("train", "test"):
            rows = scored.filter(F.col("split") == part)
            for area in (metrics.auc_macro, metrics.auc_micro):
                small.append(melt(area(rows, "label", scores).select(named, F.lit(part).alias("split"), "*"), ["model", "split"], "auc"))
        test = scored.filter(F.col("split") == "test")
        small.append(melt(metrics.confusion_matrix(test, "label", "prediction", range(len(task.classes))).select(named, "*"),
                          ["model", "actual", "predicted"], "confusion", ["n"]))
        small.append(melt(metrics.roc_curve(test, "label", scores).select(named, "*"), ["model", "class", "threshold"], "roc",
                          ["fpr", "tpr"]))
        # few rows become literal, so nothing scores again after this; a long curve stays as it is
        parts += [describe.settle(s) for s in small]
        scored.unpersist()
    parts.append(melt(classify.permutation_importance(models, task.test, features, keys, repeats), ["model", "feature"], "importance"))
    parts.append(melt(classify.parameter_sweep(task, perceptron, kernel, trained), ["family", "configuration"], "sweep"))
    study = classify.retrained_without_weakest(df, features, label, keys, perceptron, repeats, task, models["perceptron"])
    parts.append(melt(classify.retrained_metrics(study), ["features", "dropped"], "retrained"))
    parts.append(melt(describe.settle(classify.retrained_cells(study)), ["features", "actual", "predicted"], "retrained confusion", ["n"]))
    result = stack(parts)
    kept.unpersist()
    return result
