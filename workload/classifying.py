"""Metrics on a fixed-rule scorer (checkable in SQL) and trained classifiers."""

from dataclasses import replace

from pyspark.sql import functions as F

from plumbline.operators import classify, metrics, reports
from workload.registry import LINE_KEYS, LINES, lines, query

# the scorer looks at quantity only, the true grade also at the discount
SCORER = f"""{LINES}, sc AS (SELECT grade, flag, CASE WHEN quantity < 12 THEN 'low' WHEN quantity < 40 THEN 'mid' ELSE 'top' END AS guess,
  1 - quantity / 50 AS s_low, 1 - abs(quantity - 25) / 25 AS s_mid, quantity / 50 AS s_top FROM li)"""
SCORES = {"low": "s_low", "mid": "s_mid", "top": "s_top"}


def scored(spark, sf_dir):
    q = F.col("quantity")
    return lines(spark, sf_dir).select(
        "grade", "flag", F.when(q < 12, "low").when(q < 40, "mid").otherwise("top").alias("guess"),
        (1 - q / 50).alias("s_low"), (1 - F.abs(q - 25) / 25).alias("s_mid"), (q / 50).alias("s_top"))


CLASSES = """cl AS (SELECT unnest(['low', 'mid', 'top']) AS class)"""


@query("confusion_matrix", "actual s, predicted s, n i", f"""WITH {SCORER}, {CLASSES}
SELECT a.class AS actual, p.class AS predicted, (SELECT count(*) FROM sc WHERE grade = a.class AND guess = p.class) AS n FROM cl AS a, cl AS p""")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir), "grade", "guess")


def per_class_sql(by: str = "") -> str:
    key = f"{by}, " if by else ""
    return f"""pc AS (SELECT {key}class, count(*) FILTER (grade = class) AS support, count(*) FILTER (guess = class) AS predicted,
  count(*) FILTER (grade = class AND guess = class) AS hits FROM sc, cl GROUP BY ALL),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM pc),
f1 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr)"""


@query("classification_metrics", "flag s, accuracy 8, precision_macro 8, recall_macro 8, f1_macro 8, precision_micro 8, recall_micro 8, f1_micro 8",
       f"""WITH {SCORER}, {CLASSES}, {per_class_sql('flag')}
SELECT flag, sum(hits) / sum(support) AS accuracy, avg(p) AS precision_macro, avg(r) AS recall_macro, avg(f) AS f1_macro,
  sum(hits) / sum(predicted) AS precision_micro, sum(hits) / sum(support) AS recall_micro, 2 * sum(hits) / (sum(predicted) + sum(support)) AS f1_micro
FROM f1 GROUP BY flag""")
def classification_metrics(spark, sf_dir):
    return metrics.classification_metrics(scored(spark, sf_dir), "grade", "guess", ["flag"])


@query("classification_report", "name s, precision 8, recall 8, f1 8, support i", f"""WITH {SCORER}, {CLASSES}, {per_class_sql()}
SELECT class AS name, p AS precision, r AS recall, f AS f1, support FROM f1
UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM f1
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM f1
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM f1""")
def classification_report(spark, sf_dir):
    return metrics.classification_report(scored(spark, sf_dir), "grade", "guess")


LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS class, {s} AS score, CAST(grade = '{c}' AS INT) AS pos FROM sc" for c, s in SCORES.items()) + ")"
AREA = "(sum(rk * pos) - sum(pos) * (sum(pos) + 1) / 2.0) / (sum(pos) * (count(*) - sum(pos)))"


@query("auc_ovr_macro", "auc_macro 8", f"""WITH {SCORER}, {LONG},
r AS (SELECT class, pos, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS rk FROM long),
a AS (SELECT class, {AREA} AS auc FROM r GROUP BY class) SELECT avg(auc) AS auc_macro FROM a""")
def auc_ovr_macro(spark, sf_dir):
    return metrics.auc_macro(scored(spark, sf_dir), "grade", SCORES)


@query("auc_micro", "auc_micro 8", f"""WITH {SCORER}, {LONG},
r AS (SELECT pos, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM long)
SELECT {AREA} AS auc_micro FROM r""")
def auc_micro(spark, sf_dir):
    return metrics.auc_micro(scored(spark, sf_dir), "grade", SCORES)


@query("roc_curve", "class s, threshold s, fpr 8, tpr 8", f"""WITH {SCORER}, {LONG},
v AS (SELECT class, score, count(*) AS n, sum(pos) AS pos FROM long GROUP BY 1, 2),
c AS (SELECT class, score, sum(n) OVER w AS n, sum(pos) OVER w AS pos, sum(n) OVER (PARTITION BY class) AS rows, sum(pos) OVER (PARTITION BY class) AS p
  FROM v WINDOW w AS (PARTITION BY class ORDER BY score DESC))
SELECT class, printf('%.6f', score) AS threshold, (n - pos) / (rows - p) AS fpr, pos / p AS tpr FROM c
UNION ALL SELECT class, 'inf', 0, 0 FROM (SELECT unnest(['low', 'mid', 'top']) AS class)""")
def roc_curve(spark, sf_dir):
    points = metrics.roc_curve(scored(spark, sf_dir), "grade", SCORES)
    text = F.when(F.col("threshold") == float("inf"), "inf").otherwise(F.format_string("%.6f", "threshold"))
    return points.withColumn("threshold", text)


@query("metrics_compare", "metric s, quantity_rule 6, majority_rule 6", f"""WITH {LINES}, {CLASSES}, base AS (SELECT grade, quantity FROM li),
sc AS (SELECT 'quantity_rule' AS flag, grade, CASE WHEN quantity < 12 THEN 'low' WHEN quantity < 40 THEN 'mid' ELSE 'top' END AS guess FROM base
  UNION ALL SELECT 'majority_rule', grade, 'mid' FROM base), {per_class_sql('flag')},
m AS (SELECT flag, sum(hits) / sum(support) AS accuracy, avg(p) AS precision_macro, avg(r) AS recall_macro, avg(f) AS f1_macro FROM f1 GROUP BY flag)
""" + " UNION ALL ".join(f"""SELECT '{m}' AS metric, max({m if not m.endswith('micro') else 'accuracy'}) FILTER (flag = 'quantity_rule') AS quantity_rule,
  max({m if not m.endswith('micro') else 'accuracy'}) FILTER (flag = 'majority_rule') AS majority_rule FROM m""" for m in (
    "accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_micro", "recall_micro", "f1_micro")))
def metrics_compare(spark, sf_dir):
    rows = scored(spark, sf_dir).select("grade", "guess")
    both = rows.select("grade", F.explode(F.array(
        F.struct(F.lit("quantity_rule").alias("model"), F.col("guess").alias("guess")),
        F.struct(F.lit("majority_rule").alias("model"), F.lit("mid").alias("guess")))).alias("m")).select("grade", "m.*")
    return metrics.metrics_table(metrics.classification_metrics(both, "grade", "guess", ["model"]), "model",
                                 ["quantity_rule", "majority_rule"])


# Trained models: three grades by a linear rule; a ring around the centre for the kernels.

FEATURES = ["quantity", "discount", "tax"]
# trained until patience or tolerance ends it, as the options say by default
PERCEPTRON = classify.PerceptronOptions()
KERNEL = classify.KernelOptions()


def graded(spark, sf_dir):
    return classify.classification_task(lines(spark, sf_dir), FEATURES, "grade", LINE_KEYS)


def ring_rows(spark, sf_dir):
    """Inside or outside a ring around the middle of (quantity, discount)."""
    far = F.pow((F.col("quantity") - 25.5) / 14.4, 2) + F.pow((F.col("discount") - 0.05) / 0.032, 2)
    return lines(spark, sf_dir).withColumn("place", F.when(far < 1.6, "inside").otherwise("outside"))


def ringed(spark, sf_dir):
    return classify.classification_task(ring_rows(spark, sf_dir), ["quantity", "discount"], "place", LINE_KEYS)


QUALITY = "split s, accuracy 6, precision_macro 6, recall_macro 6, f1_macro 6, precision_micro 6, recall_micro 6, f1_micro 6"


def quality(model, task):
    return metrics.classification_metrics(model.predict(task.rows), "label", "prediction", ["split"])


@query("logistic_regression", QUALITY)
def logistic_regression(spark, sf_dir):
    task = graded(spark, sf_dir)
    return quality(classify.train_logistic(task.train, task.features), task)


@query("logistic_cv", "model s, measure s, value 6")
def logistic_cv(spark, sf_dir):
    return reports.logistic_models(lines(spark, sf_dir), FEATURES, "grade", LINE_KEYS)


@query("predict_proba", "l_orderkey i, cents i, split s, p_low 6, p_mid 6, p_top 6")
def predict_proba(spark, sf_dir):
    task = graded(spark, sf_dir)
    scored_rows = classify.train_logistic(task.train, task.features).predict(task.rows)
    return scored_rows.select("l_orderkey", "cents", "split", *[
        F.col("probability")[i].alias(f"p_{c}") for i, c in enumerate(task.classes)])


@query("mlp_classifier", QUALITY)
def mlp_classifier(spark, sf_dir):
    task = graded(spark, sf_dir)
    return quality(classify.train_perceptron(task.train, task.features, task.keys, 3, PERCEPTRON), task)


@query("mlp_weight_importance", "feature s, importance 6")
def mlp_weight_importance(spark, sf_dir):
    task = graded(spark, sf_dir)
    model = classify.train_perceptron(task.train, task.features, task.keys, 3, PERCEPTRON)
    return spark.createDataFrame(model.input_importance(), "feature string, importance double")


@query("svm_rbf", QUALITY)
def svm_rbf(spark, sf_dir):
    task = ringed(spark, sf_dir)
    return quality(classify.train_svm(task.train, task.features, len(task.classes), KERNEL), task)


@query("svm_linear", QUALITY)
def svm_linear(spark, sf_dir):
    task = graded(spark, sf_dir)
    return quality(classify.train_svm(task.train, task.features, len(task.classes), replace(KERNEL, kernel="linear")), task)


@query("svm_poly", QUALITY)
def svm_poly(spark, sf_dir):
    task = graded(spark, sf_dir)
    return quality(classify.train_svm(task.train, task.features, len(task.classes), replace(KERNEL, kernel="poly")), task)


@query("permutation_importance", "model s, feature s, importance 6, sd 6")
def permutation_importance(spark, sf_dir):
    task = graded(spark, sf_dir)
    models = {"perceptron": classify.train_perceptron(task.train, task.features, task.keys, 3, PERCEPTRON),
              "support vector": classify.train_svm(task.train, task.features, len(task.classes), KERNEL)}
    return classify.permutation_importance(models, task.test, task.features, task.keys)


@query("parameter_sweep", "family s, configuration s, accuracy 6, iterations i")
def parameter_sweep(spark, sf_dir):
    return classify.parameter_sweep(ringed(spark, sf_dir), PERCEPTRON, KERNEL)


@query("drop_weakest_retrain", """features s, dropped s, accuracy 6, precision_macro 6, recall_macro 6, f1_macro 6, auc_macro 6, auc_micro 6,
  accuracy_change 6""")
def drop_weakest_retrain(spark, sf_dir):
    return classify.drop_weakest_retrain(lines(spark, sf_dir), FEATURES, "grade", LINE_KEYS, PERCEPTRON)


@query("drop_weakest_confusion", "features s, dropped s, actual s, predicted s, n i")
def drop_weakest_confusion(spark, sf_dir):
    return classify.retrained_cells(classify.retrained_without_weakest(lines(spark, sf_dir), FEATURES, "grade", LINE_KEYS, PERCEPTRON))
