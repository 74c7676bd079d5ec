"""Bins, histograms and plot data."""

from pyspark.sql import functions as F

from plumbline.operators import association, bins, describe, lowess
from workload.registry import LINES, MEASURES, lines, long_sql, normal_ppf_sql, polish_sql, query, table

LONG = f"long AS ({long_sql(MEASURES, 'li')})"
HIST = ["quantity", "price", "disc_price"]


@query("histogram_sturges", "column s, bin i, lower 6, upper 6, n i", f"""WITH {LINES}, long AS ({long_sql(HIST, 'li')}),
b AS (SELECT "column", min(x) AS lo, max(x) AS hi, CAST(floor(1 + log2(count(x))) AS INT) AS k FROM long GROUP BY 1),
g AS (SELECT "column", lo, hi, k, (hi - lo) / k AS w, unnest(range(k)) AS bin FROM b),
c AS (SELECT long."column", least(CAST(floor((x - lo) / ((hi - lo) / k)) AS INT), k - 1) AS bin, count(*) AS n
  FROM long JOIN b ON long."column" = b."column" GROUP BY 1, 2)
SELECT g."column", g.bin, lo + g.bin * w AS lower, CASE WHEN g.bin = k - 1 THEN hi ELSE lo + (g.bin + 1) * w END AS upper,
  coalesce(n, 0) AS n FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def histogram_sturges(spark, sf_dir):
    return bins.histogram_sturges(lines(spark, sf_dir), HIST)


@query("histogram_r", "column s, bin i, lower 6, upper 6, n i", f"""WITH {LINES}, long AS ({long_sql(HIST, 'li')}),
b AS (SELECT "column", min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / ceil(1 + 3.322 * log10(count(x))) AS cell FROM long GROUP BY 1),
u AS (SELECT *, power(10, floor(log10(cell))) AS base FROM b),
s AS (SELECT *, CASE WHEN 2 * base - cell >= 1.5 * (cell - base) THEN base WHEN 5 * base - cell >= 2.75 * (cell - 2 * base) THEN 2 * base
  WHEN 10 * base - cell >= 1.5 * (cell - 5 * base) THEN 5 * base ELSE 10 * base END AS step FROM u),
e AS (SELECT *, CAST(floor(lo / step + 1e-10) AS INT) AS first, CAST(ceil(hi / step - 1e-10) AS INT) AS last FROM s),
g AS (SELECT "column", step, first, unnest(range(last - first)) AS bin FROM e),
c AS (SELECT long."column", least(greatest(CAST(ceil((x - first * step) / step - 1e-7) AS INT) - 1, 0), last - first - 1) AS bin, count(*) AS n
  FROM long JOIN e ON long."column" = e."column" GROUP BY 1, 2)
SELECT g."column", g.bin, (first + g.bin) * step AS lower, (first + g.bin + 1) * step AS upper, coalesce(n, 0) AS n
FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def histogram_r(spark, sf_dir):
    return bins.histogram_pretty(lines(spark, sf_dir), HIST)


@query("histogram_by_class", "column s, flag s, bin i, lower 6, upper 6, n i", f"""WITH {LINES},
long AS ({long_sql(['quantity', 'disc_price'], 'li', ', flag')}),
b AS (SELECT "column", flag, min(x) AS lo, max(x) AS hi FROM long GROUP BY 1, 2),
g AS (SELECT *, (hi - lo) / 15 AS w, unnest(range(15)) AS bin FROM b),
c AS (SELECT "column", flag, least(CAST(floor((x - lo) / ((hi - lo) / 15)) AS INT), 14) AS bin, count(*) AS n
  FROM long JOIN b USING ("column", flag) GROUP BY 1, 2, 3)
SELECT "column", flag, bin, lo + bin * w AS lower, lo + (bin + 1) * w AS upper, coalesce(n, 0) AS n
FROM g LEFT JOIN c USING ("column", flag, bin)""")
def histogram_by_class(spark, sf_dir):
    return bins.histogram_by_class(lines(spark, sf_dir), ["quantity", "disc_price"], "flag")


def cut_sql(c: str, k: int = 5) -> str:
    """1-based equal-width bin of a column, bounds from b."""
    return "1 + " + " + ".join(f"({c} > lo_{c} + {i} * (hi_{c} - lo_{c}) / {k})::INT" for i in range(1, k))


def bounds_sql(*columns: str) -> str:
    return "b AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in columns) + " FROM li)"


@query("cut_equal_width", "disc_price_bin i, disc_price_label s, n i, min_value 6, max_value 6", f"""WITH {LINES}, {bounds_sql('disc_price')},
c AS (SELECT disc_price, lo_disc_price AS lo, hi_disc_price AS hi, {cut_sql('disc_price')} AS bin FROM li, b)
SELECT bin AS disc_price_bin, printf('%.1f-%.1f', CASE WHEN bin = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (bin - 1) * (hi - lo) / 5 END,
  lo + bin * (hi - lo) / 5) AS disc_price_label, count(*) AS n, min(disc_price) AS min_value, max(disc_price) AS max_value
FROM c GROUP BY bin, lo, hi""")
def cut_equal_width(spark, sf_dir):
    cut = bins.cut_equal_width(lines(spark, sf_dir), ["disc_price"])
    return cut.groupBy("disc_price_bin", "disc_price_label").agg(
        F.count(F.lit(1)).alias("n"), F.min("disc_price").alias("min_value"), F.max("disc_price").alias("max_value"))


def tertile_sql(c: str, source: str = "li") -> str:
    """1-based quantile-third of a column, ties together; lower edges from a scalar subquery."""
    third, two = f"{1 / 3!r}", f"{2 / 3!r}"
    return (f"(1 + ({c} > (SELECT quantile_cont({c}, {third}) FROM {source}))::INT"
            f" + ({c} > (SELECT quantile_cont({c}, {two}) FROM {source}))::INT)")


@query("cut_quantile", "discount_bin i, discount_label s, n i, min_value 6, max_value 6", f"""WITH {LINES},
c AS (SELECT discount, {tertile_sql('discount')} AS bin FROM li)
SELECT bin AS discount_bin, CASE bin WHEN 1 THEN 'low' WHEN 2 THEN 'middle' ELSE 'high' END AS discount_label, count(*) AS n,
  min(discount) AS min_value, max(discount) AS max_value FROM c GROUP BY bin""")
def cut_quantile(spark, sf_dir):
    cut = bins.cut_quantile(lines(spark, sf_dir), ["discount"], 3, ["low", "middle", "high"])
    return cut.groupBy("discount_bin", "discount_label").agg(
        F.count(F.lit(1)).alias("n"), F.min("discount").alias("min_value"), F.max("discount").alias("max_value"))


SIX = ", ".join(f"quantile_cont(tax, {i / 6!r})" for i in range(1, 6))


@query("merge_small_bins", "tax_category s, n i", f"""WITH {LINES},
e AS (SELECT [{SIX}] AS edges FROM li),
c AS (SELECT tax, 1 + len(list_filter(list_distinct(edges), lambda v: v < tax)) AS bin FROM li, e),
g AS (SELECT bin, count(*) AS n, min(tax) AS lo, max(tax) AS hi FROM c GROUP BY 1),
r AS (SELECT *, lag(bin) OVER w AS l, lead(bin) OVER w AS r, lag(n) OVER w AS ln, lead(n) OVER w AS rn,
  round_even((SELECT count(*) FROM li) * 0.15, 0) AS least_n FROM g WINDOW w AS (ORDER BY bin)),
t AS (SELECT *, CASE WHEN n >= least_n THEN bin WHEN r IS NULL OR (l IS NOT NULL AND ln >= rn) THEN l ELSE r END AS home FROM r)
SELECT printf('Tax_%.2f_%.2f', min(lo), max(hi)) AS tax_category, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY home""")
def merge_small_bins(spark, sf_dir):
    merged = bins.merge_small_bins(lines(spark, sf_dir), "tax", "Tax", 0.15, 6)
    return describe.group_counts(merged, ["tax_category"])


@query("boxplot_stats", "column s, q1 6, median 6, q3 6, whisker_low 6, whisker_high 6, n_fliers i", """
WITH long AS (SELECT 'value' AS "column", value AS x FROM events UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE) FROM events),
q AS (SELECT "column", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM long GROUP BY 1)
SELECT "column", q1, median, q3, least(min(x) FILTER (x >= q1 - 3 * (q3 - q1)), q1) AS whisker_low,
  greatest(max(x) FILTER (x <= q3 + 3 * (q3 - q1)), q3) AS whisker_high,
  count(*) FILTER (x < q1 - 3 * (q3 - q1) OR x > q3 + 3 * (q3 - q1)) AS n_fliers
FROM long JOIN q USING ("column") GROUP BY "column", q1, median, q3""")
def boxplot_stats(spark, sf_dir):
    return bins.boxplot_stats(table(spark, sf_dir, "events"), ["value", "user_id"])


@query("boxplot_fliers", "event_id i, value 6", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def boxplot_fliers(spark, sf_dir):
    return bins.boxplot_fliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", 1.5)


@query("boxplot_by_group", "event_type s, n i, q1 6, median 6, q3 6, whisker_low 6, whisker_high 6, n_fliers i", """
WITH o AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i,
  count(*) OVER (PARTITION BY event_type) AS n FROM events),
d AS (SELECT *, floor((n + 3) / 2.0) / 2.0 AS depth FROM o),
h AS (SELECT event_type, n, (max(value) FILTER (i = floor(depth)) + max(value) FILTER (i = ceil(depth))) / 2 AS q1,
  (max(value) FILTER (i = floor((n + 1) / 2.0)) + max(value) FILTER (i = ceil((n + 1) / 2.0))) / 2 AS median,
  (max(value) FILTER (i = floor(n + 1 - depth)) + max(value) FILTER (i = ceil(n + 1 - depth))) / 2 AS q3 FROM d GROUP BY 1, 2)
SELECT event_type, h.n, q1, median, q3, min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_fliers
FROM o JOIN h USING (event_type) GROUP BY event_type, h.n, q1, median, q3""")
def boxplot_by_group(spark, sf_dir):
    return bins.boxplot_by_group(table(spark, sf_dir, "events").select("event_type", "value"), "value", "event_type")


FILLIBEN = """o AS (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events),
p AS (SELECT i, value, CASE WHEN i = n THEN power(0.5, 1.0 / n) WHEN i = 1 THEN 1 - power(0.5, 1.0 / n)
  ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o)"""
PPOINTS = """o AS (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events),
p AS (SELECT i, value, (i - CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END) / (n + 1 - 2 * CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END) AS p FROM o)"""
SCORES = f"a AS (SELECT i, value, p, {normal_ppf_sql('p')} AS z FROM p), s AS (SELECT i, value, {polish_sql('z', 'p')} AS z FROM a)"


@query("qq_points", "i i, theoretical 6, sample 6",
       f"WITH {FILLIBEN}, {SCORES} SELECT i, z AS theoretical, value AS sample FROM s")
def qq_points(spark, sf_dir):
    return bins.qq_points(table(spark, sf_dir, "events"), "value")


@query("qq_fit", "slope 6, intercept 6, r 6", f"""WITH {FILLIBEN}, {SCORES}
SELECT regr_slope(value, z) AS slope, regr_intercept(value, z) AS intercept, corr(value, z) AS r FROM s""")
def qq_fit(spark, sf_dir):
    return bins.qq_fit(bins.qq_points(table(spark, sf_dir, "events"), "value"))


@query("qq_points_r", "i i, theoretical 6, sample 6",
       f"WITH {PPOINTS}, {SCORES} SELECT i, z AS theoretical, value AS sample FROM s")
def qq_points_r(spark, sf_dir):
    return bins.qq_points(table(spark, sf_dir, "events"), "value", "ppoints")


@query("qq_line_r", "slope 6, intercept 6", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT (q3 - q1) / (2 * 0.6744897501960817) AS slope, (q1 + q3) / 2 AS intercept FROM q""")
def qq_line_r(spark, sf_dir):
    return bins.qq_quartile_line(table(spark, sf_dir, "events"), "value")


@query("kde_curve", "column s, event_type s, point i, x 6, density 8", """
WITH s AS (SELECT event_type, count(*) AS n, stddev_samp(value) * power(count(*), -0.2) AS h, min(value) AS lo, max(value) AS hi
  FROM events GROUP BY 1),
g AS (SELECT *, unnest(range(200)) AS point FROM s),
p AS (SELECT event_type, n, h, point, lo - 3 * h + point * ((hi - lo + 6 * h) / 199) AS x FROM g),
v AS (SELECT event_type, value, count(*) AS c FROM events GROUP BY 1, 2)
SELECT 'value' AS "column", event_type, point, x, sum(c * exp(-power((x - value) / h, 2) / 2)) / (n * h * sqrt(2 * pi())) AS density
FROM p JOIN v USING (event_type) GROUP BY event_type, point, x, n, h""")
def kde_curve(spark, sf_dir):
    return bins.kde_curve(table(spark, sf_dir, "events"), ["value"], "event_type")


TWENTY = ", ".join(f"quantile_cont(price, {i / 20!r})" for i in range(1, 20))


@query("trend_binned", "bin i, x 6, trend 4, n i", f"""WITH {LINES},
e AS (SELECT [{TWENTY}] AS edges FROM li),
c AS (SELECT price AS x, disc_price AS y, 1 + len(list_filter(edges, lambda v: v < price)) AS bin FROM li, e),
b AS (SELECT bin, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS cxy FROM c GROUP BY 1),
d AS (SELECT a.bin, a.mx AS centre, a.n AS own, b.n, b.mx, b.my, b.vx, b.cxy, abs(b.mx - a.mx) AS gap,
  sum(b.n) OVER (PARTITION BY a.bin ORDER BY abs(b.mx - a.mx), b.bin ROWS UNBOUNDED PRECEDING) AS upto, sum(b.n) OVER (PARTITION BY a.bin) AS total
  FROM b AS a, b),
r AS (SELECT bin AS rb, min(gap) FILTER (upto >= total * (2.0 / 3)) AS reach FROM d GROUP BY 1),
w AS (SELECT d.*, n * power(greatest(1 - power(gap / reach, 3), 0), 3) AS w FROM d JOIN r ON bin = rb),
m AS (SELECT bin AS mb, sum(w * mx) / sum(w) AS wx, sum(w * my) / sum(w) AS wy FROM w GROUP BY 1)
SELECT bin, centre AS x, wy + sum(w * ((mx - wx) * (my - wy) + cxy)) / sum(w * ((mx - wx) * (mx - wx) + vx)) * (centre - wx) AS trend, own AS n
FROM w JOIN m ON bin = mb GROUP BY bin, centre, wx, wy, own""")
def trend_binned(spark, sf_dir):
    return bins.trend_binned(lines(spark, sf_dir), "price", "disc_price")


def lowess_sql(source: str, rounds: int = 3) -> str:
    """(x, trend) at the anchors of rows (x, y), every neighbourhood from sorted distances."""
    parts = [f"""ev AS (SELECT x, y, 1.0::DOUBLE AS trust FROM ({source}) AS given),
st AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n FROM ev),
an AS (SELECT lo AS a FROM st UNION SELECT max(x) FROM ev, st GROUP BY ceil((x - lo) / (0.01::DOUBLE * (hi - lo)))),
hs AS (SELECT a, gap AS h FROM (SELECT a, abs(x - a) AS gap, row_number() OVER (PARTITION BY a ORDER BY abs(x - a)) AS i FROM an, ev) AS g, st
  WHERE i = greatest(least(floor(2.0::DOUBLE / 3 * n + 1e-7), n), 2)),
e0 AS (SELECT * FROM ev)"""]
    for r in range(rounds + 1):
        parts.append(f"""w{r} AS (SELECT a, x - a AS o, y, trust * CASE WHEN abs(x - a) > 0.999 * h THEN 0 WHEN abs(x - a) <= 0.001 * h THEN 1
  ELSE power(1 - power(abs(x - a) / h, 3), 3) END AS w FROM hs, e{r}),
m{r} AS (SELECT a, sum(w * o) / sum(w) AS mx, sum(w * y) / sum(w) AS my, sum(w * o * o) / sum(w) AS mxx, sum(w * o * y) / sum(w) AS mxy FROM w{r} GROUP BY a),
f{r} AS (SELECT a, my - CASE WHEN sqrt(greatest(mxx - mx * mx, 0)) > 0.001 * (hi - lo) THEN (mxy - mx * my) / (mxx - mx * mx) ELSE 0 END * mx AS t FROM m{r}, st)""")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT a, t, lead(a) OVER (ORDER BY a) AS b, lead(t) OVER (ORDER BY a) AS u FROM f{r}),
g{r} AS (SELECT x, y, abs(y - (t + CASE WHEN b IS NULL THEN 0 ELSE (u - t) * (x - a) / (b - a) END)) AS g FROM ev ASOF JOIN s{r} ON ev.x >= s{r}.a),
c{r} AS (SELECT 6 * median(g) AS c FROM g{r}),
e{r + 1} AS (SELECT x, y, CASE WHEN g > 0.999 * c THEN 0 WHEN g <= 0.001 * c THEN 1 ELSE power(1 - power(g / c, 2), 2) END AS trust FROM g{r}, c{r})""")
    return f"WITH {', '.join(parts)} SELECT a AS x, t AS trend FROM f{rounds}"


@query("lowess_trend", "x 6, trend 6", lowess_sql("SELECT CAST(user_id AS DOUBLE) AS x, value AS y FROM events"))
def lowess_trend(spark, sf_dir):
    return lowess.lowess(table(spark, sf_dir, "events"), "user_id", "value")


CORRELATED = ["quantity", "price", "discount", "disc_price", "charge"]


@query("heatmap_cells", "row s, col s, r 8", f"WITH {LINES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS r FROM li"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[:i]))
def heatmap_cells(spark, sf_dir):
    return association.lower_triangle(association.corr_matrix(lines(spark, sf_dir), CORRELATED), CORRELATED)
