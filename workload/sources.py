"""Reading, projecting, filtering."""

from pyspark.sql import functions as F

from plumbline.operators.describe import group_counts
from plumbline.sources import tables
from workload.registry import LINES, lines, query, table


@query("scan_table", "l_orderkey i, l_linenumber i, l_quantity 6, l_extendedprice 6, l_shipdate s", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem""")
def scan_table(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/lineitem.parquet", [
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]).withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("select_columns", "order_key i, quantity 6, list_price 6", """
SELECT l_orderkey AS order_key, l_quantity AS quantity, l_extendedprice AS list_price FROM lineitem""")
def select_columns(spark, sf_dir):
    # the first and last are found by id, the middle one by its position
    return tables.select_columns(table(spark, sf_dir, "lineitem"), {
        "l_orderkey": ("order_key", 0), "E": ("quantity", 4), "l_extendedprice": ("list_price", 5)})


@query("numeric_coerce", "p_partkey i, label_number 6, size_number 6", """
SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 25 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS label_number,
       CAST(p_size AS DOUBLE) AS size_number FROM part""")
def numeric_coerce(spark, sf_dir):
    mixed = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.col("p_size").cast("string"))
    return tables.to_numeric(table(spark, sf_dir, "part").select(
        "p_partkey", mixed.alias("label_number"), F.col("p_size").alias("size_number")), ["label_number", "size_number"])


HOLES = """holes AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS kind FROM events)"""


def with_holes(spark, sf_dir):
    """Events with missing values made by rule."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"))


@query("drop_nulls", "event_id i, value 6, kind s",
       f"WITH {HOLES} SELECT event_id, value, kind FROM holes WHERE value IS NOT NULL AND kind IS NOT NULL")
def drop_nulls(spark, sf_dir):
    return tables.drop_missing(with_holes(spark, sf_dir), ["value", "kind"]).select("event_id", "value", "kind")


@query("null_counts", "column s, type s, missing i", f"""WITH {HOLES}
SELECT 'event_id' AS "column", 'bigint' AS type, count(*) - count(event_id) AS missing FROM holes
UNION ALL SELECT 'user_id', 'bigint', count(*) - count(user_id) FROM holes
UNION ALL SELECT 'event_type', 'string', count(*) - count(event_type) FROM holes
UNION ALL SELECT 'value', 'double', count(*) - count(value) FROM holes
UNION ALL SELECT 'kind', 'string', count(*) - count(kind) FROM holes""")
def null_counts(spark, sf_dir):
    return tables.missing_counts(with_holes(spark, sf_dir))


@query("dataset_profile", "rows i, features i, classes i, class_list s", """
SELECT count(*) AS rows, 10 AS features, count(DISTINCT l_returnflag) AS classes,
       string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS class_list FROM lineitem""")
def dataset_profile(spark, sf_dir):
    return tables.profile(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("head_sample", "event_id i, event_type s, value 6",
       "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def head_sample(spark, sf_dir):
    return tables.head(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_id", 5)


@query("filter_by_class", "l_orderkey i, l_quantity 6, l_discount 6",
       "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_returnflag = 'R'")
def filter_by_class(spark, sf_dir):
    return tables.of_class(table(spark, sf_dir, "lineitem"), "l_returnflag", "R", ["l_orderkey", "l_quantity", "l_discount"])


@query("drop_feature", "event_id i, ts s, user_id i, value 6, props s", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, value, props FROM events""")
def drop_feature(spark, sf_dir):
    return tables.without(table(spark, sf_dir, "events"), "event_type").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("scatter_points", "x_name s, y_name s, x 8, y 8, flag s", f"""WITH {LINES}
SELECT 'quantity' AS x_name, 'price' AS y_name, quantity AS x, price AS y, flag FROM li
UNION ALL SELECT 'price', 'disc_price', price, disc_price, flag FROM li
UNION ALL SELECT 'discount', 'disc_price', discount, disc_price, flag FROM li""")
def scatter_points(spark, sf_dir):
    return tables.scatter_points(lines(spark, sf_dir), [
        ("quantity", "price"), ("price", "disc_price"), ("discount", "disc_price")], "flag")


@query("group_counts", "kind s, n i", f"WITH {HOLES} SELECT kind, count(*) AS n FROM holes GROUP BY kind")
def group_counts_query(spark, sf_dir):
    return group_counts(with_holes(spark, sf_dir), ["kind"])
