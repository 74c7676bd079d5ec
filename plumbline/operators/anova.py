"""Analysis of variance from per-group counts, means and variances."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.tails import f_sf, f_tail
from plumbline.operators.describe import literal_rows, settle
from plumbline.plans.sums import add_up
from plumbline.sources.tables import unpivot


def _group_sums(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """(column, n, k, ss_between, ss_within), over any number of groups."""
    values = unpivot(df.filter(F.col(group).isNotNull()).select(group, *[F.col(c).cast("double").alias(c) for c in columns]),
                     columns, "column", "x", [group]).filter(F.col("x").isNotNull())
    groups = settle(values.groupBy("column", group).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v")))
    totals = groups.groupBy("column").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    gap = F.col("m") - F.col("grand")
    # one row per column name on the small side
    return groups.join(F.broadcast(totals), "column").groupBy("column").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * gap * gap).alias("ss_between"), F.sum(F.col("n") * F.col("v")).alias("ss_within"))


def _ratio(between: Column, between_df: Column, within: Column, within_df: Column) -> Column:
    """The F statistic: infinite when groups differ and do not vary, null without degrees of freedom."""
    top, bottom = F.try_divide(between, between_df), F.try_divide(within, within_df)
    return F.when((bottom == 0) & (top > 0), F.lit(float("inf"))).otherwise(F.try_divide(top, bottom))


def anova_f_scores(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """(column, f, p_value) ordered by F, all columns in one job."""
    s = _group_sums(df, columns, group)
    between, within = F.col("k") - 1, F.col("n") - F.col("k")
    f = _ratio(F.col("ss_between"), between, F.col("ss_within"), within)
    scored = s.withColumn("f", f).withColumn(
        "p_value", f_tail("f", between.cast("double"), within.cast("double")))
    return scored.select("column", "f", "p_value").orderBy(F.desc("f"))


def anova_oneway(df: DataFrame, value: str, group: str) -> DataFrame:
    """(term, df, ss, ms, f, p_value) for the factor and the residuals."""
    s = _group_sums(df, [value], group)
    between, within = F.col("k") - 1, F.col("n") - F.col("k")
    f = _ratio(F.col("ss_between"), between, F.col("ss_within"), within)
    s = s.withColumn("f", f).withColumn("p_value", f_tail("f", between.cast("double"), within.cast("double")))
    nothing = F.lit(None).cast("double")
    terms = F.array(
        F.struct(F.lit(group).alias("term"), between.alias("df"), F.col("ss_between").alias("ss"),
                 F.try_divide("ss_between", between).alias("ms"), F.col("f").alias("f"), F.col("p_value").alias("p_value")),
        F.struct(F.lit("residuals").alias("term"), within.alias("df"), F.col("ss_within").alias("ss"),
                 F.try_divide("ss_within", within).alias("ms"), nothing.alias("f"), nothing.alias("p_value")))
    return s.select(F.explode(terms).alias("t")).select("t.*")


#: Cells of a task in the two-way analysis, and how far the additive model's normal equations are solved.
CELLS_PER_TASK, MOST_STEPS, SOLVED = 1_000_000, 500, 1e-13


def numbered(frame: DataFrame, column: str, name: str, buckets: int = 64) -> tuple[DataFrame, int]:
    """(column, name): the different values numbered from 0 without a sort of all, and how many there are. Numbers follow
    from the values alone."""
    found = frame.select(column).distinct().withColumn("bucket", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(column)))
    sizes = dict(found.groupBy("bucket").agg(F.max("place")).collect())
    starts, total = [], 0
    for b in range(buckets):
        starts.append(F.lit(total))
        total += sizes.get(b, 0)
    return found.select(column, (F.get(F.array(*starts), F.col("bucket")) + F.col("place") - 1).cast("int").alias(name)), total


def joined_sets(u: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """The smallest number that each of ``size`` numbers is linked to, itself included, by the links u - v."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _whole(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    frames = list(batches)
    return pd.concat(frames, ignore_index=True) if frames else None


def _links(cells: DataFrame, width: int) -> int:
    """Connected parts of the graph that joins levels standing in one cell, counted over the kept factor's levels."""
    def linked(pairs: pd.DataFrame) -> pd.DataFrame:
        label = joined_sets(pairs["u"].to_numpy(), pairs["v"].to_numpy(), width)
        own = np.flatnonzero(label != np.arange(width))
        return pd.DataFrame({"u": own.astype(np.int32), "v": label[own].astype(np.int32)})

    def in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _whole(batches)
        if table is not None:
            first = table.groupby("gone")["kept"].transform("first")
            yield linked(pd.DataFrame({"u": first, "v": table["kept"]}))

    # a task hands on a forest at most, lanes join the tasks' forests, the driver the lanes'
    forests = cells.select("gone", "kept").mapInPandas(in_task, "u int, v int").withColumn("lane", F.spark_partition_id() % 64)
    joined = forests.groupBy("lane").applyInPandas(lambda f: linked(f), "u int, v int").toPandas()
    label = joined_sets(joined["u"].to_numpy(dtype=int), joined["v"].to_numpy(dtype=int), width)
    return int((label == np.arange(width)).sum())


def _explained_beyond(cells: DataFrame, tasks: int, width: int) -> float:
    """What the kept factor explains of y beyond the other one, which is eliminated: conjugate gradients on its levels'
    normal equations, one pass over the cells a step. All cells of an eliminated level are in one task."""
    def over(vector: np.ndarray | None):
        def measure(batches: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
            table = _whole(batches)
            if table is None:
                return {}
            _, gone = np.unique(table["gone"].to_numpy(), return_inverse=True)
            kept, n = table["kept"].to_numpy(), table["n"].to_numpy(dtype=float)
            value = table["y"].to_numpy() if vector is None else vector[kept]
            mean = np.bincount(gone, n * value) / np.bincount(gone, n)
            out = {0: np.bincount(kept, n * (value - mean[gone]), width)}
            return out | ({1: np.bincount(kept, n, width)} if vector is None else {})

        return add_up(cells, tasks, measure, 2 * width)

    first = over(None)
    right, weight = first[0], first[1]
    solution, left = np.zeros(width), right.copy()
    scaled = left / weight
    direction, size = scaled.copy(), float(left @ scaled)
    start = size
    for _ in range(MOST_STEPS):
        if size <= SOLVED * start or size == 0:
            break
        image = over(direction)[0]
        bend = float(direction @ image)
        if bend <= 0:
            break
        solution += size / bend * direction
        left -= size / bend * image
        scaled = left / weight
        size, before = float(left @ scaled), size
        direction = scaled + size / before * direction
    return float(right @ solution)


def anova_twoway(df: DataFrame, value: str, a: str, b: str) -> DataFrame:
    """Sequential sums of squares for a, b given a, their interaction, and the residuals; exact for unbalanced designs.

    The rows reduce to one (n, mean, variance) per cell. Cells stay distributed: of the two factors the one with more levels
    is eliminated inside the tasks, and the driver holds a few numbers for each level of the other. The additive model's
    rank is the number of levels less that of connected parts of the graph of levels.
    """
    rows = df.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(value).cast("double").alias("y")).na.drop()
    table = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("m"), F.var_pop("y").alias("v"))
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    count, grand, all_rows, within = table.agg(F.count(F.lit(1)), F.sum(F.col("n") * F.col("m")) / F.sum("n"), F.sum("n"),
                                               F.sum(F.col("n") * F.col("v"))).first()
    all_rows, within = all_rows or 0, float(within or 0.0)
    (code_a, levels_a), (code_b, levels_b) = (numbered(table, side, f"code of {side}") for side in ("a", "b"))
    y = F.col("m") - F.lit(grand)
    total = float(table.agg(F.sum(F.col("n") * y * y)).first()[0] or 0.0)
    by = {side: float(table.groupBy(side).agg((F.sum(F.col("n") * y) ** 2 / F.sum("n")).alias("s")).agg(F.sum("s")).first()[0] or 0.0)
          for side in ("a", "b")}
    gone, kept, width = ("a", "b", levels_b) if levels_b <= levels_a else ("b", "a", levels_a)
    explained, rank = 0.0, 0
    if count:
        tasks = max(1, min(count // CELLS_PER_TASK + 8, count))
        cells = table.join(code_a, "a").join(code_b, "b").select(
            F.col(f"code of {gone}").alias("gone"), F.col(f"code of {kept}").alias("kept"), "n", y.alias("y"))
        cells = cells.repartition(tasks, "gone").persist(StorageLevel.MEMORY_AND_DISK)
        explained = by[gone] + _explained_beyond(cells, tasks, width)
        rank = levels_a + levels_b - _links(cells, width)
        cells.unpersist()
    table.unpersist()
    # what is left of a sum beside a much larger one is rounding
    fits = [(total, 1), (total - by["a"], levels_a), (max(total - explained, 0.0), rank), (0.0, count)]
    residual_df = all_rows - count
    out = []
    for term, (sse0, rank0), (sse1, rank1) in zip((a, b, f"{a}:{b}"), fits, fits[1:]):
        ss, dof = max(sse0 - sse1, 0.0), rank1 - rank0
        f = None
        if dof and residual_df:
            f = (ss / dof) / (within / residual_df) if within else float("inf") if ss > 0 else None
        out.append((term, dof, ss, ss / dof if dof else None, f, None if f is None else f_sf(f, dof, residual_df)))
    out.append(("residuals", residual_df, within, within / residual_df if residual_df else None, None, None))
    return literal_rows(df.sparkSession, out, "term string, df bigint, ss double, ms double, f double, p_value double")
