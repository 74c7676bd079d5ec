"""Descriptive statistics."""

from pyspark.sql import functions as F

from plumbline.operators import bins, describe
from workload.registry import LINES, MEASURES, lines, long_sql, query, table

LONG = f"long AS ({long_sql(MEASURES, 'li')})"
MOMENTS = """mom AS (SELECT "column", count(x) AS n, avg(x) AS mean, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi,
  quantile_cont(x, 0.5) AS median FROM long GROUP BY 1),
cen AS (SELECT long."column", avg(power(x - mean, 2)) AS m2, avg(power(x - mean, 3)) AS m3, avg(power(x - mean, 4)) AS m4
  FROM long JOIN mom ON long."column" = mom."column" GROUP BY 1)"""


@query("describe_params", "column s, mean 8, median 6, mode 6, std 6, variance 3, min 6, max 6, sum 2, kurtosis 6, skewness 6",
       f"""WITH {LINES}, {LONG}, {MOMENTS},
freq AS (SELECT "column", x, row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, x) AS r FROM long GROUP BY "column", x)
SELECT mom."column", mean, median, freq.x AS mode, sd AS std, sd * sd AS variance, lo AS min, hi AS max, n * mean AS sum,
  m4 / (m2 * m2) - 3 AS kurtosis, m3 / power(m2, 1.5) AS skewness
FROM mom JOIN cen ON mom."column" = cen."column" JOIN freq ON mom."column" = freq."column" AND r = 1""")
def describe_params(spark, sf_dir):
    return describe.describe_params(lines(spark, sf_dir), MEASURES)


@query("describe_quartiles", "column s, count i, mean 8, std 6, min 6, q25 6, q50 6, q75 6, max 6", f"""WITH {LINES}, {LONG}
SELECT "column", count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, quantile_cont(x, 0.25) AS q25,
  quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75, max(x) AS max FROM long GROUP BY 1""")
def describe_quartiles(spark, sf_dir):
    return describe.describe_quartiles(lines(spark, sf_dir), MEASURES)


# a column in which every third event has NaN, which counts as missing
@query("describe_quartiles_nan", "column s, count i, mean 8, std 6, min 6, q25 6, q50 6, q75 6, max 6", """
SELECT 'value' AS "column", count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, quantile_cont(x, 0.25) AS q25,
  quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75, max(x) AS max
FROM (SELECT CASE WHEN event_id % 3 <> 0 THEN value END AS x FROM events)""")
def describe_quartiles_nan(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    gaps = F.when(F.col("event_id") % 3 == 0, float("nan")).otherwise(F.col("value"))
    return describe.describe_quartiles(rows.select(gaps.alias("value")), ["value"])


# a class whose values are all equal beside an ordinary one
@query("histogram_by_class_flat", "column s, status s, bin i, lower 6, upper 6, n i", f"""WITH {LINES},
v AS (SELECT status, CASE WHEN status = 'F' THEN 7.0 ELSE quantity END AS x FROM li),
b AS (SELECT status, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v GROUP BY 1),
g AS (SELECT *, unnest(range(15)) AS bin FROM b),
c AS (SELECT v.status, least(CAST(floor((x - lo) / ((hi - lo) / 15)) AS INT), 14) AS bin, count(*) AS n FROM v JOIN b USING (status) GROUP BY 1, 2)
SELECT 'x' AS "column", g.status, g.bin, lo + g.bin * (hi - lo) / 15 AS lower, lo + (g.bin + 1) * (hi - lo) / 15 AS upper, coalesce(n, 0) AS n
FROM g LEFT JOIN c ON g.status = c.status AND g.bin = c.bin""")
def histogram_by_class_flat(spark, sf_dir):
    rows = lines(spark, sf_dir).select("status", F.when(F.col("status") == "F", 7.0).otherwise(F.col("quantity")).alias("x"))
    return bins.histogram_by_class(rows, ["x"], "status", 15)


PSYCH = ["value", "user_id"]


@query("describe_psych", "column s, n i, mean 6, sd 6, median 6, trimmed 6, mad 6, min 6, max 6, range 6, skew 6, kurtosis 6, se 6",
       f"""WITH long AS ({long_sql(PSYCH, 'events')}), {MOMENTS},
dev AS (SELECT long."column", 1.4826 * quantile_cont(abs(x - median), 0.5) AS mad
  FROM long JOIN mom ON long."column" = mom."column" GROUP BY 1),
ord AS (SELECT "column", x, row_number() OVER (PARTITION BY "column" ORDER BY x) AS i, count(*) OVER (PARTITION BY "column") AS rows FROM long),
tri AS (SELECT "column", avg(x) AS trimmed FROM ord WHERE i > floor(rows * 0.1) AND i <= rows - floor(rows * 0.1) GROUP BY 1)
SELECT mom."column", n, mean, sd, median, trimmed, mad, lo AS min, hi AS max, hi - lo AS range,
  m3 / power(m2, 1.5) * power((n - 1) / n, 1.5) AS skew, m4 / (m2 * m2) * power((n - 1) / n, 2) - 3 AS kurtosis, sd / sqrt(n) AS se
FROM mom JOIN cen ON mom."column" = cen."column" JOIN dev ON mom."column" = dev."column" JOIN tri ON mom."column" = tri."column" """)
def describe_psych(spark, sf_dir):
    return describe.describe_psych(table(spark, sf_dir, "events"), PSYCH)


@query("class_distribution", "l_returnflag s, n i, percent 2", """
SELECT l_returnflag, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM lineitem) AS percent FROM lineitem GROUP BY 1""")
def class_distribution(spark, sf_dir):
    return describe.class_distribution(table(spark, sf_dir, "lineitem"), "l_returnflag")


PROBS = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query("quantile_exact", "column s, prob 2, quantile 6", f"""WITH {LINES}, {LONG}
""" + " UNION ALL ".join(f"""SELECT "column", {p} AS prob, quantile_cont(x, {p}) AS quantile FROM long GROUP BY 1""" for p in PROBS))
def quantile_exact(spark, sf_dir):
    return describe.quantiles(lines(spark, sf_dir), MEASURES, PROBS)
