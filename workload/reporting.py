"""Whole analyses."""

from plumbline.operators import reports
from workload.binning import bounds_sql, cut_sql
from workload.classifying import FEATURES, KERNEL, PERCEPTRON
from workload.modelling import FEATURES as PREDICTORS
from workload.modelling import PORTABLE, TARGET, models_sql
from workload.registry import LINE_KEYS, LINES, chi2_even_sql, lines, query, table

ROW = "section s, item s, statistic s, value 6"


@query("univariate_report", ROW)
def univariate_report(spark, sf_dir):
    return reports.univariate_report(table(spark, sf_dir, "events"), ["value", "user_id"], "event_id")


def pairs_sql(columns, lower: bool):
    return [(a, b) for i, a in enumerate(columns) for b in (columns[:i] if lower else columns[i + 1:])]


TRIO = ["price", "discount", "disc_price"]


@query("correlation_report", ROW, f"""WITH {LINES},
c AS ({' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM li" for a in TRIO for b in TRIO)}),
o AS (SELECT *, list_position({TRIO!r}, a) AS i, list_position({TRIO!r}, b) AS j,
  CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.3 THEN 'moderate' ELSE 'weak' END AS strength FROM c),
r AS (SELECT max(r) FILTER (i = 1 AND j = 2) AS p, max(r) FILTER (i = 1 AND j = 3) AS q, max(r) FILTER (i = 2 AND j = 3) AS s FROM o),
d AS (SELECT *, 1 + 2 * p * q * s - p * p - q * q - s * s AS det FROM r),
v AS (SELECT 'price' AS c, (1 - s * s) / det AS vif FROM d UNION ALL SELECT 'discount', (1 - q * q) / det FROM d UNION ALL SELECT 'disc_price', (1 - p * p) / det FROM d)
SELECT 'correlation' AS section, a || ' ' || b AS item, 'r' AS statistic, r AS value FROM o
UNION ALL SELECT 'insight', a || ' ' || b || ' ' || strength, 'r', r FROM o WHERE i < j
UNION ALL SELECT 'vif', c || ' ' || CASE WHEN vif < 5 THEN 'low' WHEN vif < 10 THEN 'moderate' ELSE 'high' END, 'vif', vif FROM v
UNION ALL SELECT 'heat map', a || ' ' || b, 'r', r FROM o WHERE i > j""")
def correlation_report(spark, sf_dir):
    return reports.correlation_report(lines(spark, sf_dir), TRIO)


@query("contingency_report", ROW, f"""WITH {LINES}, {bounds_sql('disc_price', 'quantity')},
cells AS (SELECT {cut_sql('disc_price')} AS a, {cut_sql('quantity')} AS b, count(*) AS n FROM li, b GROUP BY 1, 2),
e AS (SELECT *, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM cells),
x AS (SELECT sum(power(n - e, 2) / e) AS chi2, sum(n) AS n FROM e),
m AS (SELECT CASE WHEN grouping(a) = 1 THEN 'All' ELSE CAST(a AS VARCHAR) END AS a, CASE WHEN grouping(b) = 1 THEN 'All' ELSE CAST(b AS VARCHAR) END AS b, sum(n) AS n
  FROM cells GROUP BY CUBE (a, b))
SELECT 'observed' AS section, a || ' ' || b AS item, 'n' AS statistic, CAST(n AS DOUBLE) AS value FROM m
UNION ALL SELECT 'expected', a || ' ' || b, 'expected', e FROM e
UNION ALL SELECT 'test', '', 'chi2', chi2 FROM x UNION ALL SELECT 'test', '', 'p_value', {chi2_even_sql('chi2', 16)} FROM x
UNION ALL SELECT 'test', '', 'dof', 16 FROM x UNION ALL SELECT 'test', '', 'reject_h0', CAST(chi2 > 26.296 AS INT) FROM x
UNION ALL SELECT 'strength', '', 'cramers_v', sqrt(chi2 / (n * 4)) FROM x""")
def contingency_report(spark, sf_dir):
    return reports.contingency_report(lines(spark, sf_dir), "disc_price", "quantity")


@query("regression_report", "model s, measure s, value 6", f"""
SELECT 'linear' AS model, measure, value FROM (WITH {LINES}, {models_sql(0.0, 'res')} SELECT * FROM res) AS plain
UNION ALL SELECT 'ridge', measure, value FROM (WITH {LINES}, {models_sql(1.0, 'res')} SELECT * FROM res) AS penalised""")
def regression_report(spark, sf_dir):
    return reports.regression_report(lines(spark, sf_dir), PREDICTORS, TARGET, PORTABLE)


@query("regression_pca_report", "features s, model s, measure s, value 6")
def regression_pca_report(spark, sf_dir):
    return reports.regression_pca_report(lines(spark, sf_dir), [*PREDICTORS, "discount"], TARGET, LINE_KEYS)


@query("regression_report_categorical", "model s, measure s, value 6")
def regression_report_categorical(spark, sf_dir):
    return reports.regression_report(lines(spark, sf_dir), PREDICTORS, "grade", LINE_KEYS)


@query("regression_pca_report_categorical", "features s, model s, measure s, value 6")
def regression_pca_report_categorical(spark, sf_dir):
    return reports.regression_pca_report(lines(spark, sf_dir), [*PREDICTORS, "discount"], "grade", LINE_KEYS)


@query("classification_report_full", ROW)
def classification_report_full(spark, sf_dir):
    return reports.classification_report_full(lines(spark, sf_dir), FEATURES, "grade", LINE_KEYS, PERCEPTRON, KERNEL)
