"""Binning, histograms and the data behind plots.

Bounds come from a one-row aggregate and become literal edges, so assigning a
bin is a projection; counts are one map-side combined groupBy for all columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.normal import normal_ppf
from plumbline.operators.describe import literal_rows, settle
from plumbline.plans.order import exact_quantiles
from plumbline.plans.ranks import expand_ties, running_counts, survey
from plumbline.sources.tables import unpivot, value

#: Classes that are broadcast to their values.
BROADCAST_CLASSES = 10_000


def bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """column -> (count, min, max)"""
    row = df.agg(*[F.struct(F.count(value(c)).alias("n"), F.min(value(c)).alias("low"),
                            F.max(value(c)).alias("high")).alias(c) for c in columns]).first()
    return {c: tuple(row[c]) for c in columns if row[c]["n"]}


def edges_below(x: Column, edges: Sequence[float]) -> Column:
    """How many edges lie strictly below x (null for a null)."""
    total = F.lit(0)
    for e in edges:
        total = total + (x > F.lit(float(e))).cast("int")
    return total


def _counted(df: DataFrame, assigned: dict[str, Column], edges: dict[str, list[float]]) -> DataFrame:
    """Counts per (column, bin), empty bins included, beside the bin edges."""
    columns = list(assigned)
    binned = df.select(*[assigned[c].cast("int").alias(c) for c in columns])
    counts = unpivot(binned, columns, "column", "bin").filter(F.col("bin").isNotNull()).groupBy("column", "bin").count()
    frame = literal_rows(df.sparkSession, [(c, i, edges[c][i], edges[c][i + 1]) for c in columns
                                           for i in range(len(edges[c]) - 1)],
                         "column string, bin int, lower double, upper double")
    return frame.join(counts, ["column", "bin"], "left").select(
        "column", F.col("bin").cast("bigint").alias("bin"), "lower", "upper", F.coalesce("count", F.lit(0)).alias("n"))


def _equal_width(x: Column, low: float, high: float, k: int) -> tuple[Column, list[float]]:
    """Left-closed equal-width bins, the last one closed on both sides."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / k
    place = F.floor((x - F.lit(low)) / F.lit(width))
    return F.least(F.greatest(place, F.lit(0)), F.lit(k - 1)), [low + i * width for i in range(k)] + [high]


def histogram_sturges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """int(1 + log2 n) equal-width bins per column."""
    assigned, edges = {}, {}
    for c, (n, low, high) in bounds(df, columns).items():
        assigned[c], edges[c] = _equal_width(value(c), low, high, int(1 + math.log2(n)))
        assigned[c] = F.when(value(c).isNotNull(), assigned[c])
    return _counted(df, assigned, edges)


def pretty_breaks(low: float, high: float, hint: int) -> list[float]:
    """Round break points covering [low, high] in steps of 1, 2, 5 or 10 times a power of ten."""
    span = high - low
    cell = span / hint if span > 0 else max(abs(high), 1.0) / hint
    base = 10.0 ** math.floor(math.log10(cell))
    step = base
    for multiple, bias in ((2, 1.5), (5, 2.75), (10, 1.5)):
        if multiple * base - cell < bias * (cell - step):
            step = multiple * base
        else:
            break
    first, last = math.floor(low / step + 1e-10), math.ceil(high / step - 1e-10)
    return [i * step for i in range(first, max(last, first + 1) + 1)]


def histogram_pretty(df: DataFrame, columns: Sequence[str], hint: int | None = None) -> DataFrame:
    """Right-closed bins at round break points; the default hint is ceil(1 + 3.322 log10 n)."""
    assigned, edges = {}, {}
    for c, (n, low, high) in bounds(df, columns).items():
        breaks = pretty_breaks(low, high, hint or math.ceil(1 + 3.322 * math.log10(n)))
        width = breaks[1] - breaks[0]
        # values a hair above a break still count as on it
        place = F.ceil((value(c) - F.lit(breaks[0])) / F.lit(width) - 1e-7) - 1
        assigned[c] = F.when(value(c).isNotNull(), F.least(F.greatest(place, F.lit(0)), F.lit(len(breaks) - 2)))
        edges[c] = breaks
    return _counted(df, assigned, edges)


def histogram_by_class(df: DataFrame, columns: Sequence[str], label: str, k: int = 15) -> DataFrame:
    """k bins for every (column, class), each over its own range."""
    values = unpivot(df.select(label, *[value(c).alias(c) for c in columns]),
                     columns, "column", "value", [label]).filter(F.col("value").isNotNull() & F.col(label).isNotNull())
    grid = settle(values.groupBy("column", label).agg(F.min("value").alias("low"), F.max("value").alias("high"),
                                                      F.count(F.lit(1)).alias("rows")))
    flat = F.col("low") == F.col("high")
    grid = grid.select("column", label, "rows", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
                       F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"))
    width = (F.col("high") - F.col("low")) / k
    placed = _beside_their_class(values, grid, label).withColumn(
        "bin", F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(k - 1)).cast("int"))
    counts = placed.groupBy("column", label, "bin").count()
    frame = grid.withColumn("bin", F.explode(F.array(*[F.lit(i) for i in range(k)])))
    return frame.join(counts, ["column", label, "bin"], "left").select(
        "column", label, F.col("bin").cast("bigint").alias("bin"), (F.col("low") + F.col("bin") * width).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("count", F.lit(0)).alias("n"))


def _beside_their_class(values: DataFrame, grid: DataFrame, label: str) -> DataFrame:
    """Values joined with the row of their column and class. The classes with most rows, fewer than ``BROADCAST_CLASSES`` by
    arithmetic, are broadcast, so no task receives a whole large class; the others meet their values in a shuffle."""
    by = ["column", label]
    if grid.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES:
        return values.join(F.broadcast(grid), by)
    everything = grid.agg(F.sum("rows")).first()[0]
    large = settle(grid.filter(F.col("rows") * BROADCAST_CLASSES > everything), BROADCAST_CLASSES)
    known = F.broadcast(large.select(*by))
    rest = values.join(known, by, "left_anti").join(grid.join(known, by, "left_anti"), by)
    return values.join(F.broadcast(large), by).unionByName(rest)


def equal_width_edges(df: DataFrame, columns: Sequence[str], k: int = 5) -> dict[str, list[float]]:
    """k + 1 edges, the lowest one moved down by 0.1 % of the range."""
    out = {}
    for c, (_, low, high) in bounds(df, columns).items():
        if low == high:
            spread = 0.001 * abs(low) or 0.001
            low, high = low - spread, high + spread
            out[c] = [low + i * (high - low) / k for i in range(k + 1)]
        else:
            out[c] = [low - (high - low) * 0.001] + [low + i * (high - low) / k for i in range(1, k)] + [high]
    return out


def with_bins(df: DataFrame, edges: dict[str, list[float]], labels: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Adds ``<column>_bin`` (1-based, right-closed, lowest edge included) and, given
    labels, ``<column>_label``."""
    added = {}
    for c, e in edges.items():
        number = F.when(F.col(c).isNotNull(), edges_below(F.col(c), e[1:-1]) + 1)
        added[f"{c}_bin"] = number
        if labels:
            added[f"{c}_label"] = F.get(F.array(*[F.lit(t) for t in labels[c]]), number - 1)
    return df.withColumns(added)


def interval_labels(edges: dict[str, list[float]]) -> dict[str, list[str]]:
    return {c: [f"{a:.1f}-{b:.1f}" for a, b in zip(e, e[1:])] for c, e in edges.items()}


def cut_equal_width(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    edges = equal_width_edges(df, columns, k)
    return with_bins(df, edges, interval_labels(edges))


def quantile_edges(df: DataFrame, columns: Sequence[str], groups: int) -> dict[str, list[float]]:
    """Edges at equal shares of the rows, duplicates removed."""
    found = exact_quantiles(df, columns, [i / groups for i in range(groups + 1)])
    return {c: sorted(set(e)) for c, e in found.items() if e[0] is not None}


def cut_quantile(df: DataFrame, columns: Sequence[str], groups: int,
                 labels: Sequence[str] | None = None) -> DataFrame:
    edges = quantile_edges(df, columns, groups)
    named = None if labels is None else {c: labels[:len(e) - 1] for c, e in edges.items()}
    return with_bins(df, edges, named)


def merge_map(sizes: dict[int, int], min_count: int, rounds: int = 50) -> dict[int, int]:
    """bin -> bin it ends up in.

    Every round visits the bins below ``min_count`` in order and moves each into its
    larger neighbour (left on a tie), judged by the sizes from the start of the round.
    """
    home = {b: b for b in sizes}
    for _ in range(rounds):
        current: dict[int, int] = {}
        for b, n in sizes.items():
            current[home[b]] = current.get(home[b], 0) + n
        order = sorted(current)
        small = [b for b in order if current[b] < min_count]
        if not small or len(order) == 1:
            break
        for b in small:
            at = order.index(b)
            sides = order[max(at - 1, 0):at] + order[at + 1:at + 2]
            target = max(sides, key=lambda s: (current[s], -s))
            home = {k: target if v == b else v for k, v in home.items()}
    return home


def merge_small_bins(df: DataFrame, column: str, name: str, min_share: float = 0.05, groups: int = 12) -> DataFrame:
    """Adds ``<column>_category``: quantile bins with the rare ones merged, labelled name_min_max."""
    edges = quantile_edges(df, [column], groups)
    binned = with_bins(df, edges)
    bin_column = f"{column}_bin"
    # at most ``groups`` rows
    table = binned.filter(F.col(bin_column).isNotNull()).groupBy(bin_column).agg(
        F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
    rows = {r[bin_column]: r for r in table}
    total = sum(r["n"] for r in table)
    home = merge_map({b: r["n"] for b, r in rows.items()}, max(1, round(total * min_share)))
    texts = {}
    for b, target in home.items():
        members = [rows[m] for m in home if home[m] == target]
        texts[b] = f"{name}_{min(m['low'] for m in members):.2f}_{max(m['high'] for m in members):.2f}"
    pairs = [v for b, t in texts.items() for v in (F.lit(b), F.lit(t))]
    return binned.withColumn(f"{column}_category", F.create_map(*pairs)[F.col(bin_column)]).drop(bin_column)


def boxplot_stats(df: DataFrame, columns: Sequence[str], reach: float = 3.0) -> DataFrame:
    """Quartiles, whiskers at the furthest values inside ``reach`` IQRs, number of fliers."""
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    cells, rows = [], []
    for c, (q1, _, q3) in found.items():
        low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        x = F.col(c)
        # a whisker never ends inside the box
        cells.append(F.struct(
            F.least(F.min(F.when(x >= low, x)), F.lit(q1)).cast("double").alias("low"),
            F.greatest(F.max(F.when(x <= high, x)), F.lit(q3)).cast("double").alias("high"),
            F.count_if((x < low) | (x > high)).alias("fliers")).alias(c))
    row = df.agg(*cells).first()
    for c, (q1, q2, q3) in found.items():
        rows.append((c, q1, q2, q3, row[c]["low"], row[c]["high"], row[c]["fliers"]))
    return literal_rows(df.sparkSession, rows, "column string, q1 double, median double, q3 double, "
                                               "whisker_low double, whisker_high double, n_fliers bigint")


def boxplot_fliers(df: DataFrame, column: str, reach: float = 3.0) -> DataFrame:
    (q1, q3), = exact_quantiles(df, [column], [0.25, 0.75]).values()
    return df.filter((F.col(column) < q1 - reach * (q3 - q1)) | (F.col(column) > q3 + reach * (q3 - q1)))


def boxplot_by_group(df: DataFrame, column: str, group: str, reach: float = 1.5) -> DataFrame:
    """Tukey hinges and whiskers per group."""
    ranked = running_counts(df.filter(F.col(group).isNotNull()), column, by=[group])
    # few groups become literal rows, which Spark broadcasts, so no value is moved to its group's task
    sizes = settle(ranked.groupBy(group).agg(F.sum("n").alias("rows")))
    depth = F.floor((F.col("rows") + 3) / 2) / 2
    places = {"q1": depth, "median": (F.col("rows") + 1) / 2, "q3": F.col("rows") + 1 - depth}

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("n_before") < rank) & (rank <= F.col("n_before") + F.col("n")), F.col("value")))

    hinges = settle(ranked.join(sizes, group).groupBy(group).agg(
        F.max("rows").alias("n"),
        *[((at(F.floor(d)) + at(F.ceil(d))) / 2).alias(name) for name, d in places.items()]))
    margin = reach * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - margin) & (F.col("value") <= F.col("q3") + margin)
    ends = ranked.withColumnRenamed("n", "tied").join(hinges, group).groupBy(group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("tied"))).alias("n_fliers"))
    return ends.select(group, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers")


def qq_points(df: DataFrame, column: str, positions: str = "filliben") -> DataFrame:
    """(i, theoretical, sample) for every row; positions ``filliben`` or ``ppoints``."""
    spread = survey(df, column)
    n = spread.rows
    points = expand_ties(running_counts(df, column, spread=spread), spread.largest, mean=spread.mean)
    i = F.col("i").cast("double")
    if positions == "filliben":
        end = 0.5 ** (1.0 / n)
        p = F.when(F.col("i") == n, end).when(F.col("i") == 1, 1 - end).otherwise((i - 0.3175) / (n + 0.365))
    else:
        a = 0.375 if n <= 10 else 0.5
        p = (i - a) / (n + 1 - 2 * a)
    return points.select("i", normal_ppf(p).alias("theoretical"), F.col("value").alias("sample"))


def qq_fit(points: DataFrame) -> DataFrame:
    """Least-squares line through the points and its correlation."""
    return points.agg(F.regr_slope("sample", "theoretical").alias("slope"),
                      F.regr_intercept("sample", "theoretical").alias("intercept"),
                      F.corr("sample", "theoretical").alias("r"))


def qq_quartile_line(df: DataFrame, column: str) -> DataFrame:
    """Line through the first and third quartiles."""
    (q1, q3), = exact_quantiles(df, [column], [0.25, 0.75]).values()
    quartile = 0.6744897501960817
    slope = (q3 - q1) / (2 * quartile)
    return literal_rows(df.sparkSession, [(slope, q1 + slope * quartile)], "slope double, intercept double")


def quartile_gaps(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, gap): interquartile range of ``value`` in each group, all groups in one pass."""
    ranked = running_counts(values, "value", by=keys)
    sizes = settle(ranked.groupBy(*keys).agg(F.sum("n").alias("rows")))
    found = ranked.join(sizes, list(keys))

    def quartile(share: float) -> Column:
        place = (F.col("rows") - 1) * F.lit(share)
        whole = F.floor(place)

        def at(rank: Column) -> Column:
            return F.max(F.when((F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n")), F.col("value")))

        low, high, part = at(whole), at(F.least(whole + 1, F.col("rows") - 1)), F.max(place - whole)
        return low * (1 - part) + high * part

    return found.groupBy(*keys).agg((quartile(0.75) - quartile(0.25)).alias("gap"))


#: Cells of a bandwidth, moments of a cell, and bandwidths beyond which a kernel (below 1e-17) is left out.
CELLS_PER_WIDTH, MOMENTS, REACH = 2, 18, 9.0


def kde_curve(df: DataFrame, columns: Sequence[str], label: str | None = None, points: int = 200,
              bandwidth: str = "scott") -> DataFrame:
    """Gaussian density of each column (and class) on an even grid, over all rows, within 1e-12 of the direct sum.

    Values are counted into cells of half a bandwidth, by their moments around the cell's middle; a cell's kernels at a grid
    point are a series in these moments, and only cells within ``REACH`` bandwidths of a point add to it. One scan finds
    the spread, one the moments, and what is evaluated depends on the cells, not on the rows.  A column or class without
    spread (one value, or one row) takes the size of its value as spread, or 1 if that is 0.
    """
    keys = ["column"] + ([label] if label else [])
    values = unpivot(df.select(*keys[1:], *[value(c).alias(c) for c in columns]),
                     columns, "column", "value", keys[1:])
    for c in [*keys, "value"]:
        values = values.filter(F.col(c).isNotNull())
    stats = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.stddev_samp("value").alias("sd"),
                                      F.min("value").alias("low"), F.max("value").alias("high"))
    if bandwidth == "nrd0":
        stats = stats.join(quartile_gaps(values, keys), keys).withColumn(
            "sd", F.least("sd", F.nullif(F.col("gap") / 1.34, F.lit(0.0))))
    spread = F.coalesce(F.nullif("sd", F.lit(0.0)), F.nullif(F.abs("low"), F.lit(0.0)), F.lit(1.0))
    h = F.lit({"scott": 1.0, "nrd0": 0.9}[bandwidth]) * spread * F.pow("rows", F.lit(-0.2))
    grid = settle(stats.withColumn("h", h).select(
        *keys, "rows", "h", (F.col("low") - 3 * F.col("h")).alias("start"),
        ((F.col("high") - F.col("low") + 6 * F.col("h")) / (points - 1)).alias("step")))
    # one row per column (and class) on the small side
    placed = values.join(F.broadcast(grid) if label is None else grid, keys)
    cell = F.floor((F.col("value") - F.col("start")) / F.col("h") * CELLS_PER_WIDTH)
    off = (F.col("value") - F.col("start")) / F.col("h") - (F.col("cell") + 0.5) / CELLS_PER_WIDTH
    cells = placed.withColumn("cell", cell).withColumn("off", off).groupBy(*keys, "cell").agg(
        *[F.sum(F.pow("off", F.lit(n)) / math.factorial(n)).alias(f"m{n}") for n in range(MOMENTS)])
    middle = (F.col("cell") + 0.5) / CELLS_PER_WIDTH
    step = F.col("step") / F.col("h")
    near = F.sequence(F.greatest(F.ceil((middle - REACH) / step), F.lit(0)).cast("int"),
                      F.least(F.floor((middle + REACH) / step), F.lit(points - 1)).cast("int"))
    has_any = F.ceil((middle - REACH) / step) <= F.least(F.floor((middle + REACH) / step), F.lit(points - 1))
    pairs = cells.join(grid, keys).filter(has_any).select("*", F.explode(near).alias("g"))
    kernel = _series(F.col("g") * step - middle, F.array(*[F.col(f"m{n}") for n in range(MOMENTS)]))
    summed = pairs.groupBy(*keys, "g").agg(F.sum(kernel / (F.col("rows") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))
    every = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("g"))
    return every.join(summed, [*keys, "g"], "left").select(
        *keys, F.col("g").cast("bigint").alias("point"),
        (F.col("start") + F.col("g") * F.col("step")).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def _series(t: Column, moments: Column) -> Column:
    """Sum of exp(-(t - s)^2 / 2) over the s behind ``moments`` (sums of s^n / n!): exp(-t^2 / 2) times the moments'
    products with the polynomials p(n + 1) = t p(n) - n p(n - 1)."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("previous"), F.lit(1.0).alias("now"), F.lit(0.0).alias("n"))

    def add(state: Column, moment: Column) -> Column:
        return F.struct((state["total"] + state["now"] * moment).alias("total"), state["now"].alias("previous"),
                        (t * state["now"] - state["n"] * state["previous"]).alias("now"), (state["n"] + 1.0).alias("n"))

    return F.exp(-t * t / 2) * F.aggregate(moments, start, add, lambda state: state["total"])


def trend_binned(df: DataFrame, x: str, y: str, groups: int = 20, span: float = 2 / 3) -> DataFrame:
    """Smooth trend: a tricube-weighted line around the mean of each quantile bin of x.

    Works on the bin sums, so it approximates a row-wise local regression.
    """
    import numpy as np

    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    edges = quantile_edges(rows, ["x"], groups)
    sums = with_bins(rows, edges).groupBy("x_bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
        F.var_pop("x").alias("vx"), F.covar_pop("x", "y").alias("cxy")).orderBy("x_bin").collect()
    n, mx, my, vx, cxy = (np.array([float(r[k]) for r in sums]) for k in ("n", "mx", "my", "vx", "cxy"))
    out = []
    for i, centre in enumerate(mx):
        gap = np.abs(mx - centre)
        order = np.argsort(gap, kind="stable")
        reach = gap[order][np.searchsorted(np.cumsum(n[order]), span * n.sum())]
        weight = n * np.clip(1 - (gap / reach) ** 3, 0, None) ** 3 if reach > 0 else n * (gap == 0)
        wx, wy = np.average(mx, weights=weight), np.average(my, weights=weight)
        sxx = float(np.sum(weight * ((mx - wx) ** 2 + vx)))
        sxy = float(np.sum(weight * ((mx - wx) * (my - wy) + cxy)))
        out.append((i + 1, float(centre), float(wy + (sxy / sxx if sxx > 0 else 0.0) * (centre - wx)), int(n[i])))
    return literal_rows(df.sparkSession, out, "bin bigint, x double, trend double, n bigint")
