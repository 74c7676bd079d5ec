"""Correlation, contingency tables and tests of independence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.tails import chi2_tail, t_tail
from plumbline.operators.describe import literal_rows, settle
from plumbline.plans.gram import gram, pairwise_moments
from plumbline.plans.ranks import row_ranks
from plumbline.sources.tables import value

#: Pairs of columns up to which JVM aggregates are one pass; more go through numpy blocks, also in one pass.
EXPRESSION_PAIRS = 120
#: Buckets over which levels are numbered, and cells of a task's counts before they are handed on.
LEVEL_BUCKETS = 64
CELLS_IN_TASK = 1 << 20


def _pair_correlations(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Pearson r of every pair over the rows where both have a value, from one pass."""
    pairs = list(combinations(columns, 2))
    if len(pairs) > EXPRESSION_PAIRS:
        r = pairwise_moments(df, columns).correlation()
        place = {c: i for i, c in enumerate(columns)}
        found = [(pair, float(r[place[pair[0]], place[pair[1]]])) for pair in pairs]
    else:
        row = df.agg(*[F.corr(value(a), value(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]).first() if pairs else []
        found = list(zip(pairs, row))
    return {pair: None if r is None or np.isnan(r) else r for pair, r in found}


def _matrix(df: DataFrame, columns: Sequence[str], found, name: str) -> DataFrame:
    rows = [(a, b, 1.0 if a == b else found.get((a, b), found.get((b, a)))) for a in columns for b in columns]
    return literal_rows(df.sparkSession, rows, f"row string, col string, {name} double")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(row, col, r), pairwise complete."""
    return _matrix(df, columns, _pair_correlations(df, columns), "r")


def corr_insights(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every pair once with the strength of its correlation."""
    found = _pair_correlations(df, columns)
    pairs = literal_rows(df.sparkSession, [(a, b, r) for (a, b), r in found.items()], "row string, col string, r double")
    size = F.abs("r")
    return pairs.withColumn("strength", F.when(size >= 0.7, "strong").when(size >= 0.3, "moderate").otherwise("weak"))


def lower_triangle(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells below the diagonal, in the given column order."""
    order = F.create_map(*[v for i, c in enumerate(columns) for v in (F.lit(c), F.lit(i))])
    return matrix.filter(order[F.col("row")] > order[F.col("col")])


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation: the diagonal of the inverse correlation matrix, infinite when singular."""
    r = gram(df, columns).correlation()
    # one decomposition: the diagonal of the inverse, infinite for columns that a dependency involves
    sizes, axes = np.linalg.eigh(np.nan_to_num(r))
    alive = sizes > 1e-12 * max(1.0, float(sizes.max(initial=0.0)))
    inverse = (axes[:, alive] ** 2 / sizes[alive]).sum(axis=1)
    tied = (axes[:, ~alive] ** 2).sum(axis=1) > 1e-9
    rows = []
    for c, value, dependent in zip(columns, inverse, tied):
        value = float("inf") if dependent else float(value)
        rows.append((c, value, "low" if value < 5 else "moderate" if value < 10 else "high"))
    return literal_rows(df.sparkSession, rows, "column string, vif double, level string")


def cell_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) over the rows where both categories exist."""
    # plain null filters, the same that joins on a and b add: every use of the cells then
    # has one and the same plan and its shuffle is reused
    return settle(df.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(
        F.col("a").isNotNull() & F.col("b").isNotNull()).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))


def levels(df: DataFrame, column: str) -> list:
    """The sorted categories of a column; the driver holds one value of each."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def complete_grid(rows: DataFrame, cols: DataFrame) -> DataFrame:
    """(a, b) for every value of the first frame's column with every value of the second's; neither is collected.

    The second's values are numbered inside hash buckets. Every value of the first meets all numbers, a range made in its
    task, and these meet their values in an ordinary join.
    """
    a, b = rows.columns[0], cols.columns[0]
    numbered = cols.select(F.col(b).alias("b")).distinct().withColumn("bucket", F.pmod(F.xxhash64("b"), F.lit(LEVEL_BUCKETS)).cast("int"))
    numbered = numbered.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("b")))
    # one row per bucket
    sizes = F.broadcast(numbered.groupBy("bucket").agg(F.max("place").alias("size")))
    spread = rows.select(F.col(a).alias("a")).distinct().select("a", F.explode(F.sequence(F.lit(0), F.lit(LEVEL_BUCKETS - 1))).alias("bucket"))
    places = spread.join(sizes, "bucket").select("a", "bucket", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("place"))
    return places.join(numbered, ["bucket", "place"]).select("a", "b")


def crosstab(df: DataFrame, a: str, b: str, margins: bool = True) -> DataFrame:
    """(a, b, n) with every combination of categories, and ``All`` rows for the margins.

    The table is cut to its cells first; the cube runs over the cells, and zero cells are made where they are missing.
    """
    cells = cell_counts(df, a, b)
    sides = [cells.select(F.col(side).cast("string").alias(side)) for side in ("a", "b")]
    if margins:
        margin = df.sparkSession.createDataFrame([("All",)], "level string")
        sides = [side.union(margin) for side in sides]
        cells = cells.cube("a", "b").agg(F.sum("n").alias("n"), F.grouping("a").alias("ga"), F.grouping("b").alias("gb"))
        cells = cells.select(F.when(F.col("ga") == 1, "All").otherwise(F.col("a").cast("string")).alias("a"),
                             F.when(F.col("gb") == 1, "All").otherwise(F.col("b").cast("string")).alias("b"), "n")
    else:
        cells = cells.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "n")
    grid = complete_grid(*sides)
    return grid.join(cells, ["a", "b"], "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"))


def _with_totals(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds row, column and grand totals to the cells."""
    keys = list(keys)
    rows = cells.groupBy(*keys, "a").agg(F.sum("n").alias("row_total"), F.count(F.lit(1)).alias("row_cells"))
    cols = cells.groupBy(*keys, "b").agg(F.sum("n").alias("col_total"), F.count(F.lit(1)).alias("col_cells"))
    joined = cells.join(rows, [*keys, "a"]).join(cols, [*keys, "b"])
    if not keys:
        return joined.withColumn("total", cells.agg(F.sum("n")).scalar())
    return joined.join(cells.groupBy(*keys).agg(F.sum("n").alias("total")), keys)


def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n, expected) for every combination of non-empty rows and columns."""
    cells = crosstab(df, a, b, margins=False)
    return _with_totals(cells).select("a", "b", "n", (F.col("row_total") * F.col("col_total") / F.col("total")).alias("expected"))


def _test_cells(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Chi-square from the non-empty cells, with the continuity correction when dof is 1.

    Empty cells need not exist: sum((o-e)^2/e) = N (sum(o^2 / (row col)) - 1), and in a
    2 x 2 table |o-e| is the same in all four cells.
    """
    keys = list(keys)
    full = _with_totals(cells, keys)
    sums = full.groupBy(*keys).agg(
        F.max("total").alias("n"),
        # every cell of a row adds its part of that row, so rows and columns count without a distinct
        F.round(F.sum(1 / F.col("row_cells"))).cast("bigint").alias("rows"),
        F.round(F.sum(1 / F.col("col_cells"))).cast("bigint").alias("cols"),
        F.sum(F.col("n") * F.col("n") / (F.col("row_total") * F.col("col_total"))).alias("share"),
        F.max(F.abs(F.col("n") - F.col("row_total") * F.col("col_total") / F.col("total"))).alias("gap"),
        F.max("row_total").alias("r1"), F.max("col_total").alias("c1"))
    plain = F.col("n") * (F.col("share") - 1)
    gap = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    r2, c2 = F.col("n") - F.col("r1"), F.col("n") - F.col("c1")
    inverse = F.col("n") * (1 / F.col("r1") + 1 / r2) * (1 / F.col("c1") + 1 / c2)
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    tested = sums.select(*keys, "n", "rows", "cols", dof.alias("dof"),
                         F.when(dof == 1, gap * gap * inverse).when(dof > 0, F.greatest(plain, F.lit(0.0)))
                         .otherwise(0.0).alias("chi2"))
    p = F.when(F.col("dof") > 0, chi2_tail(F.col("chi2"), F.col("dof").cast("double"))).otherwise(1.0)
    return interpret(tested.withColumn("p_value", p))


def interpret(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds ``reject_h0``."""
    return tests.withColumn("reject_h0", F.col("p_value") < alpha)


def chi2_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    return _test_cells(cell_counts(df, a, b)).select("chi2", "p_value", "dof", "n", "reject_h0")


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """sqrt(chi2 / (n (min(rows, cols) - 1))), null for a single row or column."""
    short = F.least("rows", "cols") - 1
    v = F.when(short > 0, F.sqrt(F.col("chi2") / (F.col("n") * short)))
    tested = _test_cells(cell_counts(df, a, b)).withColumn("cramers_v", v)
    return tested.select("chi2", "dof", "n", "cramers_v", _strength(F.col("cramers_v"), (
        (0.1, "very weak"), (0.3, "weak"), (0.5, "moderate")), "strong").alias("strength"))


def _strength(value: Column, cuts, last: str) -> Column:
    text = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, name in cuts:
        text = text.when(value < limit, name)
    return text.otherwise(last)


def pair_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(var_a, var_b, a, b, n): the cells of every pair of categorical columns, over the rows where all have a value.

    One scan, whatever the number of columns: a task codes each column's values once, counts the cells of a pair from the
    codes, and hands on what it has counted; Spark adds up by cell.
    """
    names, pairs = list(columns), list(combinations(range(len(columns)), 2))
    texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(names)]).na.drop()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: list[dict[str, int]] = [{} for _ in names]
        counted: dict[int, dict[int, int]] = {k: {} for k in range(len(pairs))}
        held = 0

        def handed_on() -> Iterator[pd.DataFrame]:
            words = [np.array(list(k), dtype=object) for k in known]
            for k, (i, j) in enumerate(pairs):
                if counted[k]:
                    cell = np.fromiter(counted[k], np.int64, len(counted[k]))
                    yield pd.DataFrame({"var_a": names[i], "var_b": names[j], "a": words[i][cell >> 32], "b": words[j][cell & 0xFFFFFFFF],
                                        "n": np.fromiter(counted[k].values(), np.int64, len(cell))})
                    counted[k].clear()
            for k in known:
                k.clear()

        for batch in batches:
            codes = []
            for i, c in enumerate(batch.columns):
                local, found = pd.factorize(batch[c])
                codes.append(np.array([known[i].setdefault(v, len(known[i])) for v in found], np.int64)[local])
            for k, (i, j) in enumerate(pairs):
                width = len(known[j])
                if len(known[i]) * width <= 4 * len(batch):
                    block = np.bincount(codes[i] * width + codes[j], minlength=1)
                    cell = np.flatnonzero(block)
                    n, cell = block[cell], (cell // width) << 32 | cell % width
                else:
                    cell, n = np.unique(codes[i] << 32 | codes[j], return_counts=True)
                mine = counted[k]
                held -= len(mine)
                for at, more in zip(cell.tolist(), n.tolist()):
                    mine[at] = mine.get(at, 0) + more
                held += len(mine)
            if held > CELLS_IN_TASK:
                yield from handed_on()
                held = 0
        yield from handed_on()

    parts = texts.mapInPandas(count, "var_a string, var_b string, a string, b string, n bigint")
    return parts.groupBy("var_a", "var_b", "a", "b").agg(F.sum("n").alias("n"))


def chi2_all_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The test for every pair of categorical columns, in one job."""
    cells = settle(pair_cells(df, columns))
    return _test_cells(cells, ["var_a", "var_b"]).select("var_a", "var_b", "chi2", "p_value", "dof", "n", "reject_h0")


def spearman_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with ties averaged, t-based two-sided p-value, S statistic and verdicts."""
    both = df.select(F.col(x).alias("x"), F.col(y).alias("y")).na.drop()
    ranked = row_ranks(both, ["x", "y"])
    stats = ranked.agg(F.count(F.lit(1)).alias("n"), F.corr("x_rank", "y_rank").alias("rho"))
    n, rho = F.col("n").cast("double"), F.col("rho")
    t = rho * F.sqrt((n - 2) / F.nullif((1 - rho) * (1 + rho), F.lit(0.0)))
    tested = stats.withColumn("p_value", F.when(F.abs(rho) >= 1, 0.0).otherwise(t_tail(t, n - 2)))
    strength = _strength(F.abs("rho"), ((0.1, "very weak"), (0.3, "weak"), (0.5, "moderate"), (0.7, "strong")), "very strong")
    return interpret(tested).select(
        "n", "rho", (((n * n * n) - n) * (1 - rho) / 6).alias("s"), "p_value", "reject_h0", strength.alias("strength"),
        F.when(rho > 0, "positive").when(rho < 0, "negative").otherwise("none").alias("direction"))


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(row, col, rho) after listwise deletion."""
    complete = df.select(*columns).na.drop()
    ranked = row_ranks(complete, columns)
    found = _pair_correlations(ranked.select(*[F.col(f"{c}_rank").alias(c) for c in columns]), columns)
    return _matrix(df, columns, found, "rho")
