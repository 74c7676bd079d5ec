"""Reading tables and shaping columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table; naming the columns narrows the scan to them."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_delimited(spark: SparkSession, path: str, names: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """A headerless delimited file with assigned names: doubles, except the ``text`` columns.

    A row with the wrong number of fields fails the read; blank lines are skipped.
    """
    schema = StructType([StructField(n, StringType() if n in text else DoubleType()) for n in names])
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path)


def write_result(result: DataFrame, path: str) -> None:
    result.write.mode("overwrite").parquet(path)


def select_columns(df: DataFrame, spec: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Configured columns, found by id, else by 0-based position, and renamed.

    ``spec`` maps a column id to (display name, position).
    """
    picked = []
    for column_id, (name, position) in spec.items():
        source = column_id if column_id in df.columns else df.columns[position]
        picked.append(F.col(source).alias(name))
    return df.select(*picked)


def value(column: str | Column) -> Column:
    """A column as a double in which NaN counts as missing."""
    x = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(x), x)


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Doubles; whatever is not a number becomes null."""
    return df.withColumns({c: value(F.col(c).try_cast("double")) for c in columns})


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type, missing) from one pass; NaN is missing too."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    counted = df.agg(*[F.count_if((value(c) if types[c] in ("double", "float") else F.col(c)).isNull()).alias(c) for c in columns])
    return unpivot(counted, columns, "column", "missing").select(
        "column", F.create_map(*[F.lit(t) for c in columns for t in (c, types[c])])[F.col("column")].alias("type"),
        "missing")


def profile(df: DataFrame, label: str) -> DataFrame:
    """Rows, features, number of classes and the sorted class list."""
    labels = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return labels.agg(
        F.sum("n").alias("rows"), F.lit(len(df.columns) - 1).cast("bigint").alias("features"),
        F.count(label).alias("classes"),
        F.array_join(F.array_sort(F.collect_list(F.col(label).cast("string"))), ",").alias("class_list"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first rows in key order (a distributed top-n)."""
    return df.orderBy(key).limit(n)


def of_class(df: DataFrame, label: str, wanted, columns: Sequence[str]) -> DataFrame:
    return df.filter(F.col(label) == wanted).select(*columns)


def without(df: DataFrame, column: str) -> DataFrame:
    return df.drop(column)


def scatter_points(df: DataFrame, pairs: Sequence[tuple[str, str]], label: str | None = None) -> DataFrame:
    """Points of every listed pair as (x_name, y_name, x, y[, label]) from one scan."""
    points = F.array(*[F.struct(F.lit(x).alias("x_name"), F.lit(y).alias("y_name"),
                                F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
                       for x, y in pairs])
    keep = [label] if label else []
    return df.select(*keep, F.explode(points).alias("p")).select("p.*", *keep)


def unpivot(df: DataFrame, columns: Sequence[str], name: str, measure: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.unpivot(list(keep), list(columns), name, measure)
