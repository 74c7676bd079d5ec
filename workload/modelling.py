"""Splits, linear models, principal components."""

from pyspark.sql import functions as F

from plumbline.operators import association, linear, split
from plumbline.plans.wide import wide_components
from workload.registry import LINE_KEYS, LINES, hash_sql, lines, query, t_tail_sql, table

# hashed so that SQL can repeat the splits
PORTABLE = split.PortableKeys(LINE_KEYS)


@query("target_kind", "target s, rows i, kind s", f"""WITH {LINES}
SELECT 'quantity' AS target, count(*) AS rows, CASE WHEN count(DISTINCT quantity) < 0.1 * count(*) THEN 'categorical' ELSE 'continuous' END AS kind FROM li
UNION ALL SELECT 'price', count(*), CASE WHEN count(DISTINCT price) < 0.1 * count(*) THEN 'categorical' ELSE 'continuous' END FROM li""")
def target_kind(spark, sf_dir):
    rows = lines(spark, sf_dir)
    frames = [split.target_kind(rows, c).withColumn("target", F.lit(c)) for c in ("quantity", "price")]
    return frames[0].unionByName(frames[1])


@query("label_encode", "o_orderkey i, o_orderpriority s, code i", """
SELECT o_orderkey, o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM orders""")
def label_encode(spark, sf_dir):
    return split.label_encode(table(spark, sf_dir, "orders"), "o_orderpriority", "code")


def split_sql(source: str, keys, share: float, seed: int = 42) -> str:
    return f"""CASE WHEN row_number() OVER (ORDER BY {hash_sql(keys, seed)}, {hash_sql(keys, seed, 1)})
  <= ceil({share} * (SELECT count(*) FROM {source})) THEN 'test' ELSE 'train' END"""


@query("train_test_split", "o_orderkey i, split s", f"SELECT o_orderkey, {split_sql('orders', ['o_orderkey'], 0.2)} AS split FROM orders")
def train_test_split(spark, sf_dir):
    return split.train_test_split(table(spark, sf_dir, "orders"), split.PortableKeys(["o_orderkey"]), 0.2)


@query("stratified_split", "doc_id i, quality i, split s", f"""
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1),
k AS (SELECT *, n * ceil(0.3 * sum(n) OVER ()) / sum(n) OVER () AS exact, ceil(0.3 * sum(n) OVER ()) AS total FROM c),
f AS (SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, quality)
  <= total - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS size FROM k),
r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {hash_sql(['doc_id'], 42)}, {hash_sql(['doc_id'], 42, 1)}) AS i FROM labels)
SELECT doc_id, quality, CASE WHEN i <= size THEN 'test' ELSE 'train' END AS split FROM r JOIN f USING (quality)""")
def stratified_split(spark, sf_dir):
    return split.stratified_split(table(spark, sf_dir, "labels"), "quality", split.PortableKeys(["doc_id"]), 0.3)


FEATURES = ["quantity", "disc_price"]
TARGET = "price"


def model_lines(spark, sf_dir, features=FEATURES):
    return lines(spark, sf_dir).select(*LINE_KEYS, *features, TARGET)


def eigen_sql(source: str) -> str:
    """``eig``: eigenvalues and signed unit vectors of the correlation matrix whose entries a, b, c (of the first and second,
    first and third, second and third feature) are in a source of one row.

    Eigenvalues by the cosines of a third of an angle; a vector is at right angles to two rows of the matrix less the value,
    those whose cross product is longest; its largest entry is positive.
    """
    return f"""ang AS (SELECT a, b, c, sqrt((a * a + b * b + c * c) / 3) AS p FROM {source}),
phi AS (SELECT *, acos(greatest(-1.0, least(1.0, a * b * c / power(p, 3)))) / 3 AS t FROM ang),
val AS (SELECT a, b, c, unnest([1, 2, 3]) AS component,
  unnest([1 + 2 * p * cos(t), 1 - 2 * p * cos(t) - 2 * p * cos(t + 2 * pi() / 3), 1 + 2 * p * cos(t + 2 * pi() / 3)]) AS l FROM phi),
dif AS (SELECT component, l, a, b, c, 1 - l AS d FROM val),
crs AS (SELECT component, l, a * c - b * d AS x, b * a - d * c AS y, d * d - a * a AS z FROM dif
  UNION ALL SELECT component, l, a * d - b * c, b * b - d * d, d * c - a * b FROM dif
  UNION ALL SELECT component, l, d * d - c * c, c * b - a * d, a * c - d * b FROM dif),
lng AS (SELECT *, sqrt(x * x + y * y + z * z) AS n FROM crs QUALIFY row_number() OVER (PARTITION BY component ORDER BY n DESC) = 1),
eig AS (SELECT component, l, x / n * s AS x, y / n * s AS y, z / n * s AS z FROM (SELECT *, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN sign(x)
  WHEN abs(y) >= abs(z) THEN sign(y) ELSE sign(z) END AS s FROM lng) AS signed)"""


#: Two predictors; the first component of two; or two components of three, as the 95 % rule finds them.
PLAIN, FIRST, TWO_OF_THREE = "plain", "first", "two of three"
MORE = ["quantity", "disc_price", "charge"]
PAIR = ["disc_price", "charge"]


def models_sql(alpha: float, name: str, kind: str = PLAIN, features=FEATURES) -> str:
    """Models on two variables u and v (or u alone) by Cramer's rule on centred sums, with five folds."""
    if kind == FIRST:
        b1, b2, terms = f"s1y / (s11 + {alpha})", "0.0", [("PC1", "b1")]
        first, second, vectors, explained = "(z1 + sign(a) * z2) / sqrt(2.0)", "0.0", "one AS (SELECT 1 AS one)", "SELECT (1 + abs(a)) / 2 FROM sc"
    else:
        det = f"(s11 + {alpha}) * (s22 + {alpha}) - s12 * s12"
        b1, b2 = f"((s22 + {alpha}) * s1y - s12 * s2y) / ({det})", f"((s11 + {alpha}) * s2y - s12 * s1y) / ({det})"
        terms = list(zip(features if kind == PLAIN else ("PC1", "PC2"), ("b1", "b2")))
        first, second, vectors, explained = "z1", "z2", "one AS (SELECT 1 AS one)", None
    if kind == TWO_OF_THREE:
        first, second = "x1v * z1 + y1v * z2 + z1v * z3", "x2v * z1 + y2v * z2 + z2v * z3"
        vectors = f"""{eigen_sql('sc')}, one AS (SELECT f.x AS x1v, f.y AS y1v, f.z AS z1v, s.x AS x2v, s.y AS y2v, s.z AS z2v
  FROM eig AS f, eig AS s WHERE f.component = 1 AND s.component = 2)"""
        explained = "SELECT sum(l) / 3 FROM eig WHERE component <= 2"
    x1, x2, x3 = features if len(features) == 3 else (*features, "0.0")
    z3 = "(x3 - m3) / d3" if len(features) == 3 else "0.0"
    weights = " ".join(f"UNION ALL SELECT 'coefficient {t}', {b} FROM c WHERE f = 5" for t, b in terms)
    return f"""sp AS (SELECT {x1} AS x1, {x2} AS x2, {x3} AS x3, {TARGET} AS y, {hash_sql(LINE_KEYS, 42, 1)} AS h, {split_sql('li', LINE_KEYS, 0.2)} AS split FROM li),
tr AS (SELECT *, row_number() OVER (ORDER BY h) - 1 AS i, count(*) OVER () AS n FROM sp WHERE split = 'train'),
sc AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS d1, avg(x2) AS m2, stddev_pop(x2) AS d2, avg(x3) AS m3, stddev_pop(x3) AS d3,
  corr(x1, x2) AS a{", corr(x1, x3) AS b, corr(x2, x3) AS c" if len(features) == 3 else ""} FROM tr), {vectors},
z0 AS (SELECT split, y, (x1 - m1) / d1 AS z1, (x2 - m2) / d2 AS z2, {z3} AS z3, a FROM sp, sc),
t0 AS (SELECT y, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) ELSE (i - n % 5) // (n // 5) END AS fold,
  (x1 - m1) / d1 AS z1, (x2 - m2) / d2 AS z2, {z3} AS z3, a FROM tr, sc),
z AS (SELECT split, y, {first} AS u, {second} AS v FROM z0, one), t AS (SELECT fold, y, {first} AS u, {second} AS v FROM t0, one),
f AS (SELECT unnest(range(6)) AS f),
s AS (SELECT f, avg(u) AS mu, avg(v) AS mv, avg(y) AS my, covar_pop(u, u) * count(*) AS s11, covar_pop(v, v) * count(*) AS s22, covar_pop(u, v) * count(*) AS s12,
  covar_pop(u, y) * count(*) AS s1y, covar_pop(v, y) * count(*) AS s2y FROM f JOIN t ON fold <> f GROUP BY f),
b AS (SELECT f, {b1} AS b1, {b2} AS b2, my, mu, mv FROM s), c AS (SELECT *, my - b1 * mu - b2 * mv AS b0 FROM b),
cv AS (SELECT f, 1 - sum(power(y - b0 - b1 * u - b2 * v, 2)) / (var_pop(y) * count(*)) AS r2 FROM t JOIN c ON fold = f GROUP BY f),
m AS (SELECT split, sqrt(avg(power(y - b0 - b1 * u - b2 * v, 2))) AS rmse, 1 - avg(power(y - b0 - b1 * u - b2 * v, 2)) / var_pop(y) AS r2,
  avg(abs(y - b0 - b1 * u - b2 * v) / greatest(abs(y), 2.220446049250313e-16)) AS mape FROM z JOIN c ON f = 5 GROUP BY split),
{name} AS (SELECT 'intercept' AS measure, b0 AS value FROM c WHERE f = 5 {weights}
  UNION ALL SELECT split || ' rmse' AS measure, rmse AS value FROM m UNION ALL SELECT split || ' r2', r2 FROM m UNION ALL SELECT split || ' mape', mape FROM m
  UNION ALL SELECT 'cv mean', avg(r2) FROM cv UNION ALL SELECT 'cv sd', stddev_pop(r2) FROM cv
  {f"UNION ALL SELECT 'explained variance', ({explained})" if explained else ''})"""


def _models(key: str, name: str, alpha: float):
    @query(key, "model s, measure s, value 6", f"WITH {LINES}, {models_sql(alpha, 'res')} SELECT '{name}' AS model, measure, value FROM res")
    def build(spark, sf_dir):
        return linear.regression_models(model_lines(spark, sf_dir), FEATURES, TARGET, PORTABLE, {name: alpha})


_models("linear_regression", "linear", 0.0)
# a strong penalty, so that it shows on this many rows
_models("ridge_regression", "ridge", 1000.0)


def _component_models(key: str, name: str, alpha: float):
    @query(key, "model s, measure s, value 6", f"WITH {LINES}, {models_sql(alpha, 'res', TWO_OF_THREE, MORE)} SELECT '{name}' AS model, measure, value FROM res")
    def build(spark, sf_dir):
        return linear.regression_models(model_lines(spark, sf_dir, MORE), MORE, TARGET, PORTABLE, {name: alpha}, True)


_component_models("pca_linear_regression", "linear", 0.0)
_component_models("pca_ridge_regression", "ridge", 1000.0)

SHOWN = "max(value) FILTER (measure = 'test r2') AS test_r2, max(value) FILTER (measure = 'test rmse') AS test_rmse, max(value) FILTER (measure = 'cv mean') AS cv_mean"


@query("compare_models", "model s, test_r2 8, test_rmse 6, cv_mean 8", f"""
SELECT 'linear' AS model, {SHOWN} FROM (WITH {LINES}, {models_sql(0.0, 'res')} SELECT * FROM res) AS plain
UNION ALL SELECT 'ridge', {SHOWN} FROM (WITH {LINES}, {models_sql(1000.0, 'res')} SELECT * FROM res) AS penalised""")
def compare_models(spark, sf_dir):
    models = linear.regression_models(model_lines(spark, sf_dir), FEATURES, TARGET, PORTABLE, {"linear": 0.0, "ridge": 1000.0})
    return linear.compare_models(models)


def compared_sql(name: str, alpha: float) -> str:
    return f"""SELECT '{name}' AS model, a.test_r2, p.test_r2 AS pca_test_r2, p.test_r2 - a.test_r2 AS diff_test_r2, a.test_rmse, p.test_rmse AS pca_test_rmse,
  p.test_rmse - a.test_rmse AS diff_test_rmse, a.cv_mean, p.cv_mean AS pca_cv_mean, p.cv_mean - a.cv_mean AS diff_cv_mean
FROM (SELECT {SHOWN} FROM (WITH {LINES}, {models_sql(alpha, 'res', PLAIN, PAIR)} SELECT * FROM res) AS plain) AS a,
  (SELECT {SHOWN} FROM (WITH {LINES}, {models_sql(alpha, 'res', FIRST, PAIR)} SELECT * FROM res) AS reduced) AS p"""


@query("compare_pca", """model s, test_r2 8, pca_test_r2 8, diff_test_r2 8, test_rmse 6, pca_test_rmse 6, diff_test_rmse 6, cv_mean 8,
  pca_cv_mean 8, diff_cv_mean 8""", f"{compared_sql('linear', 0.0)} UNION ALL {compared_sql('ridge', 1000.0)}")
def compare_pca(spark, sf_dir):
    # two nearly equal predictors, of which the rule keeps one component
    return linear.regression_on_components(model_lines(spark, sf_dir, PAIR), PAIR, TARGET, PORTABLE, {"linear": 0.0, "ridge": 1000.0})


@query("kfold_cv", "fold i, r2 8", """
WITH o AS (SELECT event_id, value AS y, CAST(user_id AS DOUBLE) AS x, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events),
t AS (SELECT x, y, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) ELSE (i - n % 5) // (n // 5) END AS fold FROM o),
f AS (SELECT unnest(range(5)) AS f),
s AS (SELECT f, regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM f JOIN t ON fold <> f GROUP BY f)
SELECT f AS fold, 1 - sum(power(y - b0 - b1 * x, 2)) / (var_pop(y) * count(*)) AS r2 FROM t JOIN s ON fold = f GROUP BY f""")
def kfold_cv(spark, sf_dir):
    folded = split.contiguous_folds(table(spark, sf_dir, "events"), "event_id", 5)
    return linear.cv_scores(folded, ["user_id"], "value", "fold")


# price on discounted price, one predictor: every classical quantity from regr_* aggregates
SIMPLE = f"""{LINES}, s AS (SELECT count(*) AS n, regr_slope(price, disc_price) AS b1, regr_intercept(price, disc_price) AS b0, regr_sxx(price, disc_price) AS sxx,
  regr_syy(price, disc_price) AS syy, regr_sxy(price, disc_price) AS sxy, avg(disc_price) AS mx FROM li),
q AS (SELECT *, syy - sxy * sxy / sxx AS sse, n - 2 AS dof FROM s), e AS (SELECT *, sqrt(sse / dof) AS sigma FROM q)"""


@query("lm_coefficients", "term s, estimate 6, std_error 8, t 4, p_value 6", f"""WITH {SIMPLE},
c AS (SELECT 'intercept' AS term, b0 AS estimate, sigma * sqrt(1.0 / n + mx * mx / sxx) AS std_error, dof FROM e
  UNION ALL SELECT 'disc_price', b1, sigma / sqrt(sxx), dof FROM e)
SELECT term, estimate, std_error, estimate / std_error AS t, {t_tail_sql('(estimate / std_error)', 'dof')} AS p_value FROM c""")
def lm_coefficients(spark, sf_dir):
    return linear.lm_coefficients(lines(spark, sf_dir), ["disc_price"], "price")


@query("lm_summary", "min_residual 6, q1_residual 6, median_residual 6, q3_residual 6, max_residual 6, sigma 6, df i, r2 8, adj_r2 8, f 0, p_value 8, equation s",
       f"""WITH {SIMPLE}, r AS (SELECT price - (b0 + b1 * disc_price) AS r FROM li, e)
SELECT min(r) AS min_residual, quantile_cont(r, 0.25) AS q1_residual, quantile_cont(r, 0.5) AS median_residual, quantile_cont(r, 0.75) AS q3_residual,
  max(r) AS max_residual, any_value(sigma) AS sigma, any_value(dof) AS df, any_value(1 - sse / syy) AS r2, any_value(1 - sse / syy * (n - 1) / dof) AS adj_r2,
  any_value((syy - sse) / (sse / dof)) AS f, 0.0 AS p_value, any_value(printf('price = %.2f + %.2f * disc_price', b0, b1)) AS equation FROM r, e""")
def lm_summary(spark, sf_dir):
    return linear.lm_summary(lines(spark, sf_dir), ["disc_price"], "price")


RESIDUAL_KEYS = "l_orderkey i, cents i"


@query("residuals", f"{RESIDUAL_KEYS}, fitted 2, residual 2",
       f"WITH {SIMPLE} SELECT l_orderkey, cents, b0 + b1 * disc_price AS fitted, price - (b0 + b1 * disc_price) AS residual FROM li, e")
def residuals(spark, sf_dir):
    rows = lines(spark, sf_dir)
    return linear.with_residuals(rows, linear.ordinary_fit(rows, ["disc_price"], "price"))


@query("std_residuals", f"{RESIDUAL_KEYS}, std_residual 4", f"""WITH {SIMPLE}
SELECT l_orderkey, cents, (price - (b0 + b1 * disc_price)) / (sigma * sqrt(1 - 1.0 / n - power(disc_price - mx, 2) / sxx)) AS std_residual FROM li, e""")
def std_residuals(spark, sf_dir):
    rows = lines(spark, sf_dir)
    return linear.with_residuals(rows, linear.ordinary_fit(rows, ["disc_price"], "price"), standardized=True)


@query("regression_metrics", "flag s, rmse 6, r2 8, mape 8", f"""WITH {LINES}
SELECT flag, sqrt(avg(power(charge - price * 0.95, 2))) AS rmse, 1 - avg(power(charge - price * 0.95, 2)) / var_pop(charge) AS r2,
  avg(abs(charge - price * 0.95) / greatest(abs(charge), 2.220446049250313e-16)) AS mape FROM li GROUP BY flag""")
def regression_metrics(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("guess", F.col("price") * 0.95)
    return linear.regression_metrics(rows, "charge", "guess", ["flag"])


@query("pred_vs_actual", "l_orderkey i, cents i, actual 4, predicted 4",
       f"WITH {SIMPLE} SELECT l_orderkey, cents, price AS actual, b0 + b1 * disc_price AS predicted FROM li, e")
def pred_vs_actual(spark, sf_dir):
    rows = lines(spark, sf_dir)
    fitted = linear.with_residuals(rows, linear.ordinary_fit(rows, ["disc_price"], "price"))
    return fitted.select("l_orderkey", "cents", F.col("price").alias("actual"), F.col("fitted").alias("predicted"))


@query("pca_analysis", "component i, ratio 8, cumulative 8, kept b", f"""WITH {LINES},
r AS (SELECT (1 + abs(corr(quantity, disc_price))) / 2 AS top FROM li)
SELECT 1 AS component, top AS ratio, top AS cumulative, true AS kept FROM r UNION ALL SELECT 2, 1 - top, 1.0, top < 0.95 FROM r""")
def pca_analysis(spark, sf_dir):
    return linear.pca_variance(lines(spark, sf_dir), FEATURES)


THREE = ["price", "discount", "disc_price"]
THREE_SQL = f"""{LINES}, sc AS (SELECT corr(price, discount) AS a, corr(price, disc_price) AS b, corr(discount, disc_price) AS c FROM li), {eigen_sql('sc')}"""


@query("pca_variance_three", "component i, ratio 8, cumulative 8, kept b", f"""WITH {THREE_SQL}
SELECT component, l / 3 AS ratio, sum(l) OVER (ORDER BY component) / 3 AS cumulative, coalesce(sum(l) OVER (ORDER BY component ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) / 3 < 0.95, true) AS kept FROM eig""")
def pca_variance_three(spark, sf_dir):
    return linear.pca_variance(lines(spark, sf_dir), THREE)


@query("pca_loadings", "component i, feature s, loading 6, size 6, is_top b", f"""WITH {THREE_SQL},
w AS (SELECT component, unnest(['price', 'discount', 'disc_price']) AS feature, unnest([x, y, z]) AS loading FROM eig)
SELECT *, abs(loading) AS size, abs(loading) = max(abs(loading)) OVER (PARTITION BY component) AS is_top FROM w""")
def pca_loadings(spark, sf_dir):
    return linear.pca_loadings(lines(spark, sf_dir), THREE)


def _score_sql(component: int) -> str:
    return f"""(SELECT x FROM eig WHERE component = {component}) * (price - m1) / d1 + (SELECT y FROM eig WHERE component = {component}) * (discount - m2) / d2
  + (SELECT z FROM eig WHERE component = {component}) * (disc_price - m3) / d3 AS "PC{component}" """


@query("pca_scores", "l_orderkey i, cents i, PC1 4, PC2 4, PC3 4", f"""WITH {THREE_SQL},
m AS (SELECT avg(price) AS m1, stddev_pop(price) AS d1, avg(discount) AS m2, stddev_pop(discount) AS d2, avg(disc_price) AS m3, stddev_pop(disc_price) AS d3 FROM li)
SELECT l_orderkey, cents, {', '.join(map(_score_sql, (1, 2, 3)))} FROM li, m""")
def pca_scores(spark, sf_dir):
    return linear.pca_scores(lines(spark, sf_dir), THREE, 3)


@query("pca_embeddings", "component i, ratio 6, cumulative 6, kept b")
def pca_embeddings(spark, sf_dir):
    """Wide features: 64 columns through the block path of the Gram sums."""
    rows = table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(64)]
    return linear.pca_variance(rows.select(*[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names)


@query("pca_embeddings_leading", "component i, element i, loading 6, ratio 6")
def pca_embeddings_leading(spark, sf_dir):
    """Four leading components of the embeddings, whose covariance is never made."""
    found = wide_components(table(spark, sf_dir, "embeddings"), "embedding", 4)
    rows = [(j + 1, i, float(found.loadings[i, j]), float(found.ratios[j])) for j in range(4) for i in range(len(found.centre))]
    return spark.createDataFrame(rows, "component int, element int, loading double, ratio double")


@query("corr_matrix_wide", "row s, col s, r 6", """WITH x AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding) AS x FROM embeddings)
SELECT 'e' || a.i AS "row", 'e' || b.i AS col, CASE WHEN a.i = b.i THEN 1.0 ELSE corr(a.x::DOUBLE, b.x::DOUBLE) END AS r
FROM x AS a JOIN x AS b USING (vec_id) GROUP BY a.i, b.i""")
def corr_matrix_wide(spark, sf_dir):
    """All pairs of 64 columns from one scan."""
    names = [f"e{i}" for i in range(64)]
    rows = table(spark, sf_dir, "embeddings").select(*[F.col("embedding")[i].alias(n) for i, n in enumerate(names)])
    return association.corr_matrix(rows, names)
