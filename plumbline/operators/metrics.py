"""Classification quality from confusion cells and score ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.association import complete_grid
from plumbline.operators.describe import literal_rows, settle
from plumbline.plans.ranks import running_counts


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """(actual, predicted, n) for every pair of classes; those that occur on either side, or the given ones."""
    kind = df.schema[label].dataType.simpleString()
    cells = settle(df.groupBy(F.col(label).alias("actual"), F.col(prediction).cast(kind).alias("predicted")).agg(F.count(F.lit(1)).alias("n")))
    if classes is None:
        either = cells.select(F.explode(F.array("actual", "predicted")).alias("class")).filter(F.col("class").isNotNull())
    else:
        either = literal_rows(df.sparkSession, [(c,) for c in classes], f"class {kind}")
    grid = complete_grid(either, either).select(F.col("a").alias("actual"), F.col("b").alias("predicted"))
    return grid.join(cells, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def per_class(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(class, support, predicted, hits, precision, recall, f1); 0 where a ratio has no denominator."""
    nothing = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), nothing.alias("predicted"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(nothing).alias("hits")),
        F.struct(F.col("predicted").alias("class"), nothing.alias("support"), F.col("n").alias("predicted"),
                 nothing.alias("hits")))
    sums = cells.filter(F.col("n") > 0).select(*by, F.explode(sides).alias("s")).select(*by, "s.*").groupBy(
        *by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    p, r = ratio(F.col("hits"), F.col("predicted")), ratio(F.col("hits"), F.col("support"))
    return sums.withColumns({"precision": p, "recall": r}).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def classification_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy; macro and micro precision, recall and F1, per value of ``by``."""
    cells = df.groupBy(*by, F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    classes = per_class(cells, by)
    accuracy = F.sum("hits") / F.sum("support")
    # every row has one label and one prediction, so the micro averages all equal the accuracy
    return classes.groupBy(*by).agg(
        accuracy.alias("accuracy"), F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"), accuracy.alias("precision_micro"), accuracy.alias("recall_micro"),
        accuracy.alias("f1_micro"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(name, precision, recall, f1, support): one row per class, accuracy, macro and weighted averages."""
    cells = df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    classes = per_class(cells)
    weight = F.sum("support")
    accuracy = F.sum("hits") / weight
    summary = classes.agg(F.array(
        F.struct(F.lit("accuracy").alias("name"), accuracy.alias("precision"), accuracy.alias("recall"),
                 accuracy.alias("f1"), weight.alias("support")),
        F.struct(F.lit("macro avg").alias("name"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                 F.avg("f1").alias("f1"), weight.alias("support")),
        F.struct(F.lit("weighted avg").alias("name"),
                 *[(F.sum(F.col(m) * F.col("support")) / weight).alias(m) for m in ("precision", "recall", "f1")],
                 weight.alias("support"))).alias("rows"))
    return classes.select(F.col("class").cast("string").alias("name"), "precision", "recall", "f1", "support").unionByName(
        summary.select(F.explode("rows").alias("r")).select("r.*"))


def class_scores(df: DataFrame, label: str, scores: dict[object, str]) -> DataFrame:
    """(class, score, positive): one row per row and class, for one-vs-rest curves."""
    kind = df.schema[label].dataType.simpleString()
    parts = F.array(*[F.struct(F.lit(k).cast(kind).alias("class"), F.col(s).cast("double").alias("score"),
                               (F.col(label) == F.lit(k)).cast("bigint").alias("positive")) for k, s in scores.items()])
    return df.select(F.explode(parts).alias("s")).select("s.*")


def _auc(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mann-Whitney area from tie-averaged ranks."""
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    sums = ranked.groupBy(*by).agg(F.sum(rank * F.col("positive")).alias("rank_sum"),
                                   F.sum("positive").cast("double").alias("p"), F.sum("n").cast("double").alias("rows"))
    area = (F.col("rank_sum") - F.col("p") * (F.col("p") + 1) / 2) / F.nullif(
        F.col("p") * (F.col("rows") - F.col("p")), F.lit(0.0))
    return sums.select(*by, area.alias("auc"))


def auc_by_class(df: DataFrame, label: str, scores: dict[object, str]) -> DataFrame:
    long = class_scores(df, label, scores)
    return _auc(running_counts(long, "score", by=["class"], sums={"positive": F.col("positive")}), ["class"])


def auc_macro(df: DataFrame, label: str, scores: dict[object, str]) -> DataFrame:
    return auc_by_class(df, label, scores).agg(F.avg("auc").alias("auc_macro"))


def auc_micro(df: DataFrame, label: str, scores: dict[object, str]) -> DataFrame:
    long = class_scores(df, label, scores)
    return _auc(running_counts(long, "score", sums={"positive": F.col("positive")}), []).withColumnRenamed("auc", "auc_micro")


def roc_curve(df: DataFrame, label: str, scores: dict[object, str]) -> DataFrame:
    """(class, threshold, fpr, tpr) for every distinct score, and the origin at an infinite threshold.

    A rate without a row to count (a class that never or always occurs) is null.
    """
    long = class_scores(df, label, scores)
    ranked = running_counts(long, "score", by=["class"], sums={"positive": F.col("positive")})
    totals = long.filter(F.col("score").isNotNull()).groupBy("class").agg(
        F.sum("positive").alias("p"), F.count(F.lit(1)).alias("rows"))
    # one row per class on the small side
    joined = ranked.join(F.broadcast(totals), "class")
    above, positive_above = F.col("rows") - F.col("n_before"), F.col("p") - F.col("positive_before")
    points = joined.select("class", F.col("value").alias("threshold"),
                           F.try_divide(above - positive_above, F.col("rows") - F.col("p")).alias("fpr"),
                           F.try_divide(positive_above, F.col("p")).alias("tpr"))
    origin = totals.select("class", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def metrics_table(long: DataFrame, model: str, models: Sequence[str]) -> DataFrame:
    """Metric by model, six decimals, from a frame with one row of metrics per model."""
    measures = [c for c in long.columns if c != model]
    return long.unpivot([model], measures, "metric", "value").groupBy("metric").pivot(model, list(models)).agg(
        F.round(F.max("value"), 6))
