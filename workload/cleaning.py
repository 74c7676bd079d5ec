"""Outliers and normalization, on the skewed ``events.value``."""

from plumbline.operators import clean
from workload.registry import LINES, lines, query, table

Z = """s AS (SELECT avg(value) AS mean, stddev_samp(value) AS sd, stddev_pop(value) AS sp FROM events),
z AS (SELECT event_id, value, abs((value - mean) / sd) AS z, abs((value - mean) / sp) AS zp FROM events, s)"""


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value")


@query("zscore_outliers", "event_id i, value 6, z 6", f"WITH {Z} SELECT event_id, value, z FROM z WHERE z > 3")
def zscore_outliers(spark, sf_dir):
    return clean.zscore_outliers(events(spark, sf_dir), "event_id", "value")


@query("outlier_summary", "threshold 2, n_outliers i, n_rows i, min_outlier 6, max_outlier 6, max_z 6", f"""WITH {Z}
SELECT 3.0 AS threshold, count(*) FILTER (z > 3) AS n_outliers, count(*) AS n_rows, min(value) FILTER (z > 3) AS min_outlier,
  max(value) FILTER (z > 3) AS max_outlier, max(z) FILTER (z > 3) AS max_z FROM z""")
def outlier_summary(spark, sf_dir):
    return clean.outlier_summary(events(spark, sf_dir), "value")


@query("zscore_clean", "event_id i, value 6", f"WITH {Z} SELECT event_id, value FROM z WHERE zp < 3")
def zscore_clean(spark, sf_dir):
    return clean.zscore_clean(events(spark, sf_dir), "value")


def _norm(method: str, scale: str):
    @query(f"normalize_{method}", "event_id i, normalized 10", f"SELECT event_id, {scale} AS normalized FROM events")
    def build(spark, sf_dir):
        return clean.normalize(events(spark, sf_dir), "value", method)


_norm("l2", "value / (SELECT sqrt(sum(value * value)) FROM events)")
_norm("l1", "value / (SELECT sum(abs(value)) FROM events)")
_norm("max", "value / (SELECT max(abs(value)) FROM events)")
_norm("minmax", "(value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events)")


@query("clean_normalize", "event_id i, value 6, normalized 10", f"""WITH {Z}, kept AS (SELECT event_id, value FROM z WHERE zp < 3)
SELECT event_id, value, value / (SELECT sqrt(sum(value * value)) FROM kept) AS normalized FROM kept""")
def clean_normalize(spark, sf_dir):
    return clean.clean_and_normalize(events(spark, sf_dir), "value")


@query("clean_counts", "n_before i, n_after i, n_removed i", f"""WITH {Z}
SELECT count(*) AS n_before, count(*) FILTER (zp < 3) AS n_after, count(*) - count(*) FILTER (zp < 3) AS n_removed FROM z""")
def clean_counts(spark, sf_dir):
    return clean.clean_counts(events(spark, sf_dir), "value")


FENCES = """q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
  quantile_cont(CAST(user_id AS DOUBLE), 0.25) AS u1, quantile_cont(CAST(user_id AS DOUBLE), 0.75) AS u3 FROM events),
f AS (SELECT *, coalesce(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1), false) AS out_v,
  coalesce(user_id < u1 - 1.5 * (u3 - u1) OR user_id > u3 + 1.5 * (u3 - u1), false) AS out_u FROM events, q)"""


@query("iqr_bounds", "column s, q1 6, q3 6, iqr 6, lower_fence 6, upper_fence 6, n_outliers i", f"""WITH {FENCES}
SELECT 'value' AS "column", any_value(q1) AS q1, any_value(q3) AS q3, any_value(q3 - q1) AS iqr,
  any_value(q1 - 1.5 * (q3 - q1)) AS lower_fence, any_value(q3 + 1.5 * (q3 - q1)) AS upper_fence, count(*) FILTER (out_v) AS n_outliers FROM f
UNION ALL SELECT 'user_id', any_value(u1), any_value(u3), any_value(u3 - u1), any_value(u1 - 1.5 * (u3 - u1)),
  any_value(u3 + 1.5 * (u3 - u1)), count(*) FILTER (out_u) FROM f""")
def iqr_bounds(spark, sf_dir):
    return clean.iqr_bounds(table(spark, sf_dir, "events"), ["value", "user_id"])


@query("iqr_remove_any", "event_id i, user_id i, value 6",
       f"WITH {FENCES} SELECT event_id, user_id, value FROM f WHERE NOT out_v AND NOT out_u")
def iqr_remove_any(spark, sf_dir):
    return clean.iqr_remove_any(table(spark, sf_dir, "events"), ["value", "user_id"])


@query("iqr_removal_counts", "n_before i, n_after i, n_removed i, percent_removed 6", f"""WITH {FENCES}
SELECT count(*) AS n_before, count(*) FILTER (NOT out_v AND NOT out_u) AS n_after, count(*) FILTER (out_v OR out_u) AS n_removed,
  count(*) FILTER (out_v OR out_u) * 100.0 / count(*) AS percent_removed FROM f""")
def iqr_removal_counts(spark, sf_dir):
    return clean.iqr_removal_counts(table(spark, sf_dir, "events"), ["value", "user_id"])


@query("standardize", "l_orderkey i, cents i, quantity 6, disc_price 6", f"""WITH {LINES}
SELECT l_orderkey, cents, (quantity - avg(quantity) OVER ()) / stddev_pop(quantity) OVER () AS quantity,
  (disc_price - avg(disc_price) OVER ()) / stddev_pop(disc_price) OVER () AS disc_price FROM li""")
def standardize(spark, sf_dir):
    return clean.standardize(lines(spark, sf_dir), ["quantity", "disc_price"])
