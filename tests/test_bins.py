import numpy as np
import pandas as pd
import pytest

from plumbline.operators import bins

RNG = np.random.default_rng(3)


def test_sturges_matches_numpy(column):
    x = RNG.normal(size=300)
    got = bins.histogram_sturges(column(x), ["x"]).orderBy("bin").toPandas()
    counts, edges = np.histogram(x, bins=int(1 + np.log2(300)))
    assert list(got.n) == list(counts)
    np.testing.assert_allclose(got.lower, edges[:-1])


def test_histogram_of_a_constant_and_empty_bins(column):
    assert bins.histogram_sturges(column([5, 5, 5]), ["x"]).toPandas().n.sum() == 3
    got = bins.histogram_sturges(column([0, 0, 0, 100]), ["x"]).orderBy("bin").toPandas()
    assert list(got.n) == [3, 0, 1]


@pytest.mark.parametrize("low,high,hint,want", [
    (0, 10, 5, [0, 2, 4, 6, 8, 10]), (1, 50, 17, list(range(0, 55, 5))[:11]), (0.02, 0.93, 5, [0, 0.2, 0.4, 0.6, 0.8, 1.0]),
    (-3, 3, 6, [-3, -2, -1, 0, 1, 2, 3])])
def test_pretty_breaks(low, high, hint, want):
    got = bins.pretty_breaks(low, high, hint)
    if len(got) != len(want):
        assert got[0] <= low and got[-1] >= high
        assert len(set(np.round(np.diff(got), 12))) == 1
    else:
        np.testing.assert_allclose(got, want)


def test_right_closed_histogram_puts_edges_left(column):
    got = bins.histogram_pretty(column([0, 2, 2, 4, 10]), ["x"], 5).orderBy("bin").toPandas()
    assert list(got.n) == [3, 1, 0, 0, 1]


def test_class_histograms_have_their_own_range(spark):
    df = spark.createDataFrame([(float(i), "a" if i < 15 else "b") for i in range(30)], "x double, k string")
    got = bins.histogram_by_class(df, ["x"], "k").toPandas()
    assert list(got.groupby("k").size()) == [15, 15] and set(got.n) == {1}


def test_equal_width_cut_matches_pandas(column):
    x = RNG.gamma(2, 3, 400)
    got = bins.cut_equal_width(column(x), ["x"]).orderBy("id").toPandas()
    want = pd.cut(pd.Series(x), 5)
    assert list(got.x_bin) == list(want.cat.codes + 1)
    edges = [x.min() - (np.ptp(x)) * 0.001, *np.linspace(x.min(), x.max(), 6)[1:]]
    assert set(got.x_label) <= {f"{a:.1f}-{b:.1f}" for a, b in zip(edges, edges[1:])}


def test_quantile_cut_keeps_ties_together_and_nulls_null(column):
    df = bins.cut_quantile(column([1, 1, 1, 1, 1, 1, 2, 3, None]), ["x"], 3, ["a", "b", "c"])
    got = {r.id: (r.x_bin, r.x_label) for r in df.collect()}
    assert got[8] == (None, None)
    assert {got[i] for i in range(6)} == {(1, "a")}


def test_merge_rule():
    assert bins.merge_map({1: 10, 2: 10}, 5) == {1: 1, 2: 2}
    # ends have one neighbour; the larger side wins; a tie goes left
    assert bins.merge_map({1: 1, 2: 10, 3: 2, 4: 30, 5: 1}, 5) == {1: 2, 2: 2, 3: 4, 4: 4, 5: 4}
    assert bins.merge_map({1: 9, 2: 1, 3: 9}, 5) == {1: 1, 2: 1, 3: 3}
    # sizes from the start of the round: 3 goes to 2, not to the growing 4
    assert bins.merge_map({1: 11359, 2: 14968, 3: 7422, 4: 7569, 5: 14945, 6: 3737}, 9000) == {1: 1, 2: 2, 3: 2, 4: 5, 5: 5, 6: 5}
    assert bins.merge_map({1: 1}, 5) == {1: 1}


def test_merged_bins_are_large_enough_and_labelled_by_range(column):
    x = np.concatenate([np.zeros(50), RNG.integers(1, 6, 50)])
    got = bins.merge_small_bins(column(x), "x", "X", 0.2, 12).toPandas()
    sizes = got.groupby("x_category").x.agg(["size", "min", "max"])
    assert sizes["size"].min() >= 20
    assert set(sizes.index) == {f"X_{a:.2f}_{b:.2f}" for a, b in zip(sizes["min"], sizes["max"])}


def test_box_whiskers(column):
    x = [*range(1, 12), 1000]
    row = bins.boxplot_stats(column(x), ["x"]).first()
    assert (row.q1, row.median, row.q3) == tuple(np.quantile(x, [0.25, 0.5, 0.75]))
    assert (row.whisker_low, row.whisker_high, row.n_fliers) == (1, 11, 1)
    assert [r.x for r in bins.boxplot_fliers(column(x), "x").collect()] == [1000.0]


def test_hinges_by_group(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 5, 6, 7, 30)] + [("b", 4.0)], "g string, x double")
    got = {r.g: r for r in bins.boxplot_by_group(df, "x", "g").collect()}
    # Tukey hinges of 1..7, 30
    assert (got["a"].q1, got["a"].median, got["a"].q3, got["a"].n_fliers) == (2.5, 4.5, 6.5, 1)
    assert got["a"].whisker_high == 7 and got["b"].q1 == 4.0


def test_qq_points_are_the_sorted_sample(column):
    x = RNG.normal(10, 2, 200)
    points = bins.qq_points(column(x), "x")
    got = points.orderBy("i").toPandas()
    np.testing.assert_allclose(got["sample"], np.sort(x))
    assert got.theoretical.is_monotonic_increasing and abs(got.theoretical.mean()) < 1e-9
    fit = bins.qq_fit(points).first()
    slope, intercept = np.polyfit(got.theoretical, got["sample"], 1)
    assert fit.slope == pytest.approx(slope) and fit.intercept == pytest.approx(intercept) and fit.r > 0.98


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(v), "a" if v < 0 else "b") for v in RNG.normal(size=400)], "x double, k string")
    got = bins.kde_curve(df, ["x"], "k").toPandas()
    for _, part in got.groupby("k"):
        part = part.sort_values("x")
        assert np.trapezoid(part.density, part.x) == pytest.approx(1, abs=0.01)
    assert bins.kde_curve(df, ["x"], points=50, bandwidth="nrd0").count() == 50


def test_trend_follows_a_line(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(500)], "x double, y double")
    for r in bins.trend_binned(df, "x", "y").collect():
        assert r.trend == pytest.approx(2 * r.x + 1)


def test_histogram_by_class_broadcasts_large_classes(spark, monkeypatch):
    rows = [("big", float(i % 40)) for i in range(400)] + [(f"k{i}", float(i + j)) for i in range(12) for j in range(3)]
    df = spark.createDataFrame(rows, "k string, x double")
    plain = bins.histogram_by_class(df, ["x"], "k", 4)
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan or "leftHint=(strategy=broadcast)" in plan
    want = sorted(map(tuple, plain.collect()))
    monkeypatch.setattr(bins, "BROADCAST_CLASSES", 5)
    assert sorted(map(tuple, bins.histogram_by_class(df, ["x"], "k", 4).collect())) == want and len(want) == 13 * 4
