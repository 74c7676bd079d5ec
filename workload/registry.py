"""Registration, output rounding and the shared input frames with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, columns: str, sql: str | None = None):
    """Register a query.

    ``columns`` fixes names and types on both sides: ``name s`` text, ``name i`` bigint,
    ``name b`` boolean, ``name 6`` double rounded to six decimals.
    """
    shape = [part.split() for part in columns.split(",")]

    def spark_column(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind in ("s", "i", "b"):
            return c.cast({"s": "string", "i": "bigint", "b": "boolean"}[kind]).alias(name)
        # adding zero turns a negative zero into a plain one
        return (F.round(c.cast("double"), int(kind)) + F.lit(0.0)).alias(name)

    def sql_column(name: str, kind: str) -> str:
        if kind in ("s", "i", "b"):
            return f'CAST("{name}" AS {dict(s="VARCHAR", i="BIGINT", b="BOOLEAN")[kind]}) AS "{name}"'
        return f'round(CAST("{name}" AS DOUBLE), {kind}) + 0.0 AS "{name}"'

    def register(build):
        QUERIES[key] = lambda spark, sf_dir: build(spark, sf_dir).select(*[spark_column(n, k) for n, k in shape])
        if sql:
            ORACLES[key] = f"SELECT {', '.join(sql_column(n, k) for n, k in shape)} FROM (\n{sql}\n) AS result"
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cents"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a numeric table: unique key, four measures, two derived prices, two labels."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    rule = F.col("l_quantity").cast("int") * 2 + F.round(discount * 100).cast("int") * 10
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(price * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").alias("quantity"), price.alias("price"), discount.alias("discount"), F.col("l_tax").alias("tax"),
        (price * (1 - discount)).alias("disc_price"), (price * (1 - discount) * (1 + F.col("l_tax"))).alias("charge"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        F.when(rule < 70, "low").when(rule < 130, "mid").otherwise("top").alias("grade"))


LINES = """li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
  l_extendedprice * (1 - l_discount) AS disc_price, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
  l_returnflag AS flag, l_linestatus AS status,
  CASE WHEN CAST(l_quantity AS INT) * 2 + CAST(round(l_discount * 100) AS INT) * 10 < 70 THEN 'low'
       WHEN CAST(l_quantity AS INT) * 2 + CAST(round(l_discount * 100) AS INT) * 10 < 130 THEN 'mid' ELSE 'top' END AS grade
  FROM lineitem)"""

MEASURES = ["quantity", "price", "discount", "tax"]


def long_sql(columns, source: str, extra: str = "") -> str:
    """Columns of a source unpivoted to ("column", x)."""
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS x{extra} FROM {source}""" for c in columns)


def hash_sql(keys, seed: int, part: int = 0) -> str:
    joined = ", ".join([*keys, f"'{seed}'"])
    return f"CAST(CAST('0x' || substr(md5(concat_ws('|', {joined})), {1 + 13 * part}, 13) AS BIGINT) AS DOUBLE)"


def normal_cdf_sql(x: str) -> str:
    """Hart's approximation as one SQL expression."""
    from plumbline.functions.normal import HART_BOTTOM, HART_TOP

    def horner(coefficients):
        text = repr(coefficients[0])
        for c in coefficients[1:]:
            text = f"({text} * abs({x}) + CAST('{c!r}' AS DOUBLE))"
        return text

    tail = (f"(CASE WHEN abs({x}) > 7.07 THEN 0.0 ELSE exp(-({x}) * ({x}) / 2) * {horner(HART_TOP)} / {horner(HART_BOTTOM)} END)")
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


def normal_ppf_sql(p: str) -> str:
    """Acklam's approximation, polished by one Halley step."""
    # Acklam's coefficients.
    a = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00)
    b = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01, 1.0)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)

    def horner(coefficients, q):
        text = f"CAST('{coefficients[0]!r}' AS DOUBLE)"
        for k in coefficients[1:]:
            text = f"({text} * {q} + CAST('{k!r}' AS DOUBLE))"
        return text

    low, mid = f"sqrt(-2 * ln(least({p}, 1 - {p})))", f"({p} - 0.5)"
    tail = f"({horner(c, low)} / {horner(d, low)})"
    core = f"({mid} * {horner(a, f'({mid} * {mid})')} / {horner(b, f'({mid} * {mid})')})"
    return f"(CASE WHEN {p} < 0.02425 THEN {tail} WHEN {p} > 0.97575 THEN -{tail} ELSE {core} END)"


def polish_sql(z: str, p: str) -> str:
    """One Halley step towards the exact inverse."""
    error = f"(({normal_cdf_sql(z)} - {p}) * 2.5066282746310002 * exp({z} * {z} / 2))"
    return f"({z} - {error} / (1 + {z} * {error} / 2))"


def t_tail_sql(t: str, dof: str) -> str:
    """Two-sided Student tail for large degrees of freedom (first-order expansion)."""
    return (f"(2 * (1 - {normal_cdf_sql(f'abs({t})')}) + 2 * exp(-({t}) * ({t}) / 2) / 2.5066282746310002"
            f" * (power(abs({t}), 3) + abs({t})) / (4.0 * ({dof})))")


def f2_tail_sql(f: str, dof: str) -> str:
    """F tail with two numerator degrees of freedom, in closed form."""
    return f"exp(-({dof}) / 2.0 * ln(1 + 2 * ({f}) / ({dof})))"


def chi2_even_sql(x: str, dof: int) -> str:
    """Chi-square tail for even degrees of freedom, in closed form."""
    terms, text = 1, "1.0"
    for k in range(1, dof // 2):
        terms *= k
        text += f" + power(({x}) / 2.0, {k}) / {float(terms)}"
    return f"(exp(-({x}) / 2.0) * ({text}))"
