"""Correlation, contingency, normality, analysis of variance."""

from pyspark.sql import functions as F

from plumbline.operators import anova, association, bins, normality
from workload.binning import CORRELATED, bounds_sql, cut_sql, tertile_sql
from workload.registry import (LINES, chi2_even_sql, f2_tail_sql, lines, long_sql, normal_cdf_sql, normal_ppf_sql, polish_sql,
                               query, t_tail_sql, table)
from workload.sources import HOLES, with_holes


@query("corr_matrix", "row s, col s, r 8", f"WITH {LINES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS r FROM li"
    for a in CORRELATED for b in CORRELATED))
def corr_matrix(spark, sf_dir):
    return association.corr_matrix(lines(spark, sf_dir), CORRELATED)


@query("corr_matrix_pairwise", "row s, col s, r 8", f"""WITH {HOLES},
h AS (SELECT value, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS user_number, CAST(event_id AS DOUBLE) AS event_number FROM holes)
""" + " UNION ALL ".join(f"SELECT '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS r FROM h"
                         for a in ("value", "user_number", "event_number") for b in ("value", "user_number", "event_number")))
def corr_matrix_pairwise(spark, sf_dir):
    holes = with_holes(spark, sf_dir).select(
        "value", F.when(F.col("event_id") % 5 != 0, F.col("user_id").cast("double")).alias("user_number"),
        F.col("event_id").cast("double").alias("event_number"))
    return association.corr_matrix(holes, ["value", "user_number", "event_number"])


@query("corr_insights", "row s, col s, r 8, strength s", f"WITH {LINES}, p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS r FROM li"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:])
    + ") SELECT *, CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.3 THEN 'moderate' ELSE 'weak' END AS strength FROM p")
def corr_insights(spark, sf_dir):
    return association.corr_insights(lines(spark, sf_dir), CORRELATED)


@query("vif", "column s, vif 6, level s", f"""WITH {LINES}, r AS (SELECT 1 / (1 - power(corr(price, disc_price), 2)) AS vif FROM li)
SELECT unnest(['price', 'disc_price']) AS "column", vif, CASE WHEN vif < 5 THEN 'low' WHEN vif < 10 THEN 'moderate' ELSE 'high' END AS level FROM r""")
def vif(spark, sf_dir):
    return association.vif(lines(spark, sf_dir), ["price", "disc_price"])


# three predictors: the diagonal of the inverse of a 3 x 3 correlation matrix by cofactors
@query("vif_three", "column s, vif 6, level s", f"""WITH {LINES},
r AS (SELECT corr(price, discount) AS a, corr(price, disc_price) AS b, corr(discount, disc_price) AS c FROM li),
d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM r),
v AS (SELECT 'price' AS "column", (1 - c * c) / det AS vif FROM d UNION ALL SELECT 'discount', (1 - b * b) / det FROM d
  UNION ALL SELECT 'disc_price', (1 - a * a) / det FROM d)
SELECT *, CASE WHEN vif < 5 THEN 'low' WHEN vif < 10 THEN 'moderate' ELSE 'high' END AS level FROM v""")
def vif_three(spark, sf_dir):
    return association.vif(lines(spark, sf_dir), ["price", "discount", "disc_price"])


ORDER_CELLS = """cells AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY 1, 2)"""


@query("crosstab", "a s, b s, n i", f"""WITH {ORDER_CELLS}
SELECT CASE WHEN grouping(a) = 1 THEN 'All' ELSE a END AS a, CASE WHEN grouping(b) = 1 THEN 'All' ELSE b END AS b,
  CAST(sum(n) AS BIGINT) AS n FROM cells GROUP BY CUBE (a, b)""")
def crosstab(spark, sf_dir):
    return association.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("expected_freq", "a s, b s, n i, expected 6", f"""WITH {ORDER_CELLS}
SELECT a, b, n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS expected FROM cells""")
def expected_freq(spark, sf_dir):
    return association.expected_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


CHI = """e AS (SELECT n, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM cells),
x AS (SELECT sum(power(n - e, 2) / e) AS chi2, sum(n) AS n FROM e)"""


@query("chi2_independence", "chi2 6, p_value 6, dof i, n i, reject_h0 b", f"""WITH {ORDER_CELLS}, {CHI}
SELECT chi2, {chi2_even_sql('chi2', 8)} AS p_value, 8 AS dof, n, chi2 > 15.507 AS reject_h0 FROM x""")
def chi2_independence(spark, sf_dir):
    return association.chi2_independence(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


YATES = """cells AS (SELECT l_linestatus AS a, l_quantity > 25 AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
e AS (SELECT n, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM cells),
x AS (SELECT sum(power(abs(n - e) - least(0.5, abs(n - e)), 2) / e) AS chi2, sum(n) AS n FROM e)"""


# a 2 x 2 table, with the continuity correction
@query("chi2_yates", "chi2 6, p_value 6, dof i, n i, reject_h0 b", f"""WITH {YATES}
SELECT chi2, 2 * (1 - {normal_cdf_sql('sqrt(chi2)')}) AS p_value, 1 AS dof, n, chi2 > 3.8415 AS reject_h0 FROM x""")
def chi2_yates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_linestatus", (F.col("l_quantity") > 25).alias("bulk"))
    return association.chi2_independence(rows, "l_linestatus", "bulk")


DEPENDENT = f"""{LINES}, {bounds_sql('disc_price')},
cells AS (SELECT {cut_sql('disc_price')} AS a, {tertile_sql('discount')} AS b, count(*) AS n FROM li, b GROUP BY 1, 2)"""


def dependent(spark, sf_dir):
    rows = lines(spark, sf_dir).select("disc_price", "discount")
    return bins.with_bins(bins.with_bins(rows, bins.equal_width_edges(rows, ["disc_price"])),
                          bins.quantile_edges(rows, ["discount"], 3))


@query("cramers_v", "chi2 6, dof i, n i, cramers_v 8, strength s", f"""WITH {DEPENDENT}, {CHI}
SELECT chi2, 8 AS dof, n, sqrt(chi2 / (n * 2)) AS cramers_v, CASE WHEN sqrt(chi2 / (n * 2)) < 0.1 THEN 'very weak'
  WHEN sqrt(chi2 / (n * 2)) < 0.3 THEN 'weak' WHEN sqrt(chi2 / (n * 2)) < 0.5 THEN 'moderate' ELSE 'strong' END AS strength FROM x""")
def cramers_v(spark, sf_dir):
    return association.cramers_v(dependent(spark, sf_dir), "disc_price_bin", "discount_bin")


PAIRS = (("l_returnflag", "l_linestatus", 2), ("l_returnflag", "l_linenumber", 12), ("l_linestatus", "l_linenumber", 6))


@query("chi2_all_pairs", "var_a s, var_b s, chi2 6, p_value 6, dof i, n i, reject_h0 b", "WITH " + ", ".join(
    f"""c{i} AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
e{i} AS (SELECT n, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM c{i}),
x{i} AS (SELECT sum(power(n - e, 2) / e) AS chi2, sum(n) AS n FROM e{i}),
p{i} AS (SELECT '{a}' AS var_a, '{b}' AS var_b, chi2, {chi2_even_sql('chi2', dof)} AS p_value, {dof} AS dof, n FROM x{i})"""
    for i, (a, b, dof) in enumerate(PAIRS)) + " SELECT *, p_value < 0.05 AS reject_h0 FROM (SELECT * FROM p0 UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM p2)")
def chi2_all_pairs(spark, sf_dir):
    return association.chi2_all_pairs(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


def rank_sql(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


@query("spearman_test", "n i, rho 8, s 0, p_value 6, reject_h0 b, strength s, direction s", f"""WITH {LINES},
r AS (SELECT {rank_sql('discount')} AS rx, {rank_sql('disc_price')} AS ry FROM li),
c AS (SELECT count(*) AS n, corr(rx, ry) AS rho FROM r), t AS (SELECT *, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM c),
p AS (SELECT *, {t_tail_sql('t', 'n - 2')} AS p_value FROM t)
SELECT n, rho, (power(n, 3) - n) * (1 - rho) / 6 / 1e6 AS s, p_value, p_value < 0.05 AS reject_h0,
  CASE WHEN abs(rho) < 0.1 THEN 'very weak' WHEN abs(rho) < 0.3 THEN 'weak' WHEN abs(rho) < 0.5 THEN 'moderate'
  WHEN abs(rho) < 0.7 THEN 'strong' ELSE 'very strong' END AS strength,
  CASE WHEN rho > 0 THEN 'positive' WHEN rho < 0 THEN 'negative' ELSE 'none' END AS direction FROM p""")
def spearman_test(spark, sf_dir):
    # S is about n^3 / 6, compared in millions
    return association.spearman_test(lines(spark, sf_dir), "discount", "disc_price").withColumn("s", F.col("s") / 1e6)


SPEARMAN = ["quantity", "discount", "disc_price"]


@query("spearman_matrix", "row s, col s, rho 8", f"""WITH {LINES},
r AS (SELECT {', '.join(f'{rank_sql(c)} AS {c}' for c in SPEARMAN)} FROM li)
""" + " UNION ALL ".join(f"SELECT '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS rho FROM r"
                         for a in SPEARMAN for b in SPEARMAN))
def spearman_matrix(spark, sf_dir):
    return association.spearman_matrix(lines(spark, sf_dir), SPEARMAN)


@query("jarque_bera_diff", "n i, statistic 4, p_value 6, reject_h0 b", """
WITH d AS (SELECT value - lag(value) OVER (ORDER BY event_id) AS d FROM events),
m AS (SELECT count(d) AS n, avg(d) AS mean FROM d),
c AS (SELECT any_value(n) AS n, avg(power(d - mean, 2)) AS m2, avg(power(d - mean, 3)) AS m3, avg(power(d - mean, 4)) AS m4 FROM d, m WHERE d IS NOT NULL),
j AS (SELECT n, n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS statistic FROM c)
SELECT n, statistic, exp(-statistic / 2) AS p_value, exp(-statistic / 2) < 0.05 AS reject_h0 FROM j""")
def jarque_bera_diff(spark, sf_dir):
    return normality.jarque_bera_diff(table(spark, sf_dir, "events"), "event_id", "value")


def ks_sql(long: str) -> str:
    return f"""long AS ({long}), s AS (SELECT "column", avg(x) AS mean, stddev_samp(x) AS sd FROM long GROUP BY 1),
o AS (SELECT long."column", (x - mean) / sd AS z, row_number() OVER (PARTITION BY long."column" ORDER BY x) AS i, count(*) OVER (PARTITION BY long."column") AS n
  FROM long JOIN s ON long."column" = s."column"),
k AS (SELECT "column", any_value(n) AS n, max(greatest(i * 1.0 / n - {normal_cdf_sql('z')}, {normal_cdf_sql('z')} - (i - 1.0) / n)) AS statistic FROM o GROUP BY 1),
a AS (SELECT *, statistic * sqrt(n) + 1 / (6 * sqrt(n)) + (statistic * sqrt(n) - 1) / (4 * n) AS z FROM k),
p AS (SELECT "column", n, statistic, (SELECT least(1, greatest(0, 2 * sum(power(-1, j - 1) * exp(-2 * j * j * z * z)))) FROM range(1, 60) AS r(j)) AS p_value FROM a)
SELECT *, p_value < 0.05 AS reject_h0 FROM p"""


@query("ks_normal", "column s, n i, statistic 8, p_value 6, reject_h0 b",
       f"WITH {LINES}, {ks_sql(long_sql(['quantity', 'price', 'disc_price'], 'li'))}")
def ks_normal(spark, sf_dir):
    return normality.ks_normal(lines(spark, sf_dir), ["quantity", "price", "disc_price"])


@query("ks_normal_small", "column s, n i, statistic 8, p_value 4, reject_h0 b",
       f"WITH {ks_sql(long_sql(['c_acctbal'], 'customer'))}")
def ks_normal_small(spark, sf_dir):
    return normality.ks_normal(table(spark, sf_dir, "customer"), ["c_acctbal"])


def horner_sql(coefficients, x: str) -> str:
    """Lowest power first."""
    return "(" + " + ".join(f"({c!r}) * power({x}, {i})" for i, c in enumerate(coefficients)) + ")"


def shapiro_sql(long: str) -> str:
    return f"""long AS ({long}),
o AS (SELECT "column", x, row_number() OVER (PARTITION BY "column" ORDER BY x) AS i, count(*) OVER (PARTITION BY "column") AS n FROM long),
p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM o), z AS (SELECT *, {normal_ppf_sql('p')} AS z FROM p),
m AS (SELECT "column", x, i, n, {polish_sql('z', 'p')} AS m FROM z),
s AS (SELECT "column", any_value(n) AS n, sum(m * m) AS mm, max(m) FILTER (i = n) AS m1, max(m) FILTER (i = n - 1) AS m2, var_pop(x) * any_value(n) AS ss,
  1 / sqrt(any_value(n)) AS u FROM m GROUP BY 1),
a AS (SELECT *, m1 / sqrt(mm) + {horner_sql(normality.LAST_WEIGHT, 'u')} AS a1, m2 / sqrt(mm) + {horner_sql(normality.NEXT_WEIGHT, 'u')} AS a2 FROM s),
f AS (SELECT *, sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS scale FROM a),
w AS (SELECT f."column", any_value(f.n) AS n, power(sum(x * CASE WHEN i = f.n THEN a1 WHEN i = 1 THEN -a1 WHEN i = f.n - 1 THEN a2 WHEN i = 2 THEN -a2
  ELSE m / scale END), 2) / any_value(ss) AS w FROM m JOIN f ON m."column" = f."column" GROUP BY 1),
l AS (SELECT *, ln(1 - w) AS y, ln(n) AS u FROM w),
t AS (SELECT *, 1 - {normal_cdf_sql('''((y - (-1.5861 - 0.31082 * u - 0.083751 * u * u + 0.0038915 * u * u * u)) / exp(-0.4803 - 0.082676 * u + 0.0030302 * u * u))''')} AS tail FROM l)
SELECT "column", n, w, tail AS p_value, tail > 0.05 AS is_normal, n > 5000 AS p_is_extrapolated FROM t"""


@query("shapiro_wilk", "column s, n i, w 8, p_value 6, is_normal b, p_is_extrapolated b",
       f"WITH {shapiro_sql(long_sql(['p_retailprice', 'p_size'], 'part'))}")
def shapiro_wilk(spark, sf_dir):
    return normality.shapiro_wilk(table(spark, sf_dir, "part"), ["p_retailprice", "p_size"])


@query("shapiro_wilk_large", "column s, n i, w 8, p_value 6, is_normal b, p_is_extrapolated b", f"WITH {shapiro_sql(long_sql(['value'], 'events'))}")
def shapiro_wilk_large(spark, sf_dir):
    return normality.shapiro_wilk(table(spark, sf_dir, "events"), ["value"])


def oneway_sql(long: str, by: str) -> str:
    return f"""long AS ({long}),
g AS (SELECT "column", {by}, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY 1, 2),
t AS (SELECT "column", avg(x) AS mean, count(*) AS rows FROM long GROUP BY 1),
s AS (SELECT g."column", count(*) AS k, any_value(rows) AS rows, sum(n * power(m - mean, 2)) AS between_ss, sum(n * v) AS within_ss
  FROM g JOIN t ON g."column" = t."column" GROUP BY 1),
f AS (SELECT *, (between_ss / (k - 1)) / (within_ss / (rows - k)) AS f FROM s)"""


F_COLUMNS = ["quantity", "price", "discount", "disc_price"]


@query("anova_f_scores", "column s, f 6, p_value 6", f"""WITH {LINES}, {oneway_sql(long_sql(F_COLUMNS, 'li', ', flag'), 'flag')}
SELECT "column", f, {f2_tail_sql('f', '(rows - k)')} AS p_value FROM f""")
def anova_f_scores(spark, sf_dir):
    return anova.anova_f_scores(lines(spark, sf_dir), F_COLUMNS, "flag")


@query("anova_oneway", "term s, df i, ss 0, ms 0, f 6, p_value 8", f"""WITH {LINES},
third AS (SELECT disc_price, {tertile_sql('discount')} AS discount_bin FROM li),
{oneway_sql(long_sql(['disc_price'], 'third', ', discount_bin'), 'discount_bin')}
SELECT 'discount_bin' AS term, k - 1 AS df, between_ss AS ss, between_ss / (k - 1) AS ms, f, {f2_tail_sql('f', '(rows - k)')} AS p_value FROM f
UNION ALL SELECT 'residuals', rows - k, within_ss / 1e6, within_ss / (rows - k), NULL, NULL FROM f""")
def anova_oneway(spark, sf_dir):
    rows = lines(spark, sf_dir).select("disc_price", "discount")
    grouped = bins.with_bins(rows, bins.quantile_edges(rows, ["discount"], 3))
    result = anova.anova_oneway(grouped, "disc_price", "discount_bin")
    # the residual sum has more digits than a rounded double keeps, so it is compared in millions
    return result.withColumn("ss", F.when(F.col("term") == "residuals", F.col("ss") / 1e6).otherwise(F.col("ss")))


@query("anova_twoway", "term s, df i, ss 6, f 6, p_value 6", f"""WITH {LINES},
d AS (SELECT disc_price / 1000 AS y, {tertile_sql('discount')} AS a, CAST(status = 'O' AS INT) AS b FROM li),
am AS (SELECT a, avg(y) AS ma, avg(b) AS mb FROM d GROUP BY 1), cm AS (SELECT a, b, avg(y) AS mc FROM d GROUP BY 1, 2),
w AS (SELECT d.*, ma, mb, mc, avg(y) OVER () AS m FROM d JOIN am USING (a) JOIN cm USING (a, b)),
s AS (SELECT count(*) AS n, sum(power(ma - m, 2)) AS ss_a, power(sum((b - mb) * (y - ma)), 2) / sum(power(b - mb, 2)) AS ss_b,
  sum(power(mc - ma, 2)) AS ss_cells, sum(power(y - mc, 2)) AS sse FROM w),
f AS (SELECT *, ss_cells - ss_b AS ss_ab, n - 6 AS dof FROM s),
r AS (SELECT *, ss_a / 2 / (sse / dof) AS fa, ss_b / (sse / dof) AS fb, ss_ab / 2 / (sse / dof) AS fab FROM f)
SELECT 'discount_bin' AS term, 2 AS df, ss_a AS ss, fa AS f, {f2_tail_sql('fa', 'dof')} AS p_value FROM r
UNION ALL SELECT 'status', 1, ss_b, fb, {t_tail_sql('sqrt(fb)', 'dof')} FROM r
UNION ALL SELECT 'discount_bin:status', 2, ss_ab, fab, {f2_tail_sql('fab', 'dof')} FROM r
UNION ALL SELECT 'residuals', dof, sse, NULL, NULL FROM r""")
def anova_twoway(spark, sf_dir):
    rows = lines(spark, sf_dir).select((F.col("disc_price") / 1000).alias("thousands"), "discount", "status")
    return anova.anova_twoway(bins.with_bins(rows, bins.quantile_edges(rows, ["discount"], 3)), "thousands", "discount_bin", "status")


@query("interpret_p", "column s, p_value 6, reject_h0 b", f"""WITH {LINES}, {oneway_sql(long_sql(F_COLUMNS, 'li', ', flag'), 'flag')}
SELECT "column", {f2_tail_sql('f', '(rows - k)')} AS p_value, {f2_tail_sql('f', '(rows - k)')} < 0.05 AS reject_h0 FROM f""")
def interpret_p(spark, sf_dir):
    return association.interpret(anova.anova_f_scores(lines(spark, sf_dir), F_COLUMNS, "flag"))
