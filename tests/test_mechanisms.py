"""Mechanisms that replace driver grids, literal arrays and repeated scans, against plain numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import anova, association, bins, lowess, metrics, normality
from plumbline.plans import gram, wide

RNG = np.random.default_rng(17)


def holes(x, share=0.15):
    return np.where(RNG.random(x.shape) < share, np.nan, x)


def test_pairwise_correlations_of_many_columns_from_one_scan(spark):
    x = RNG.normal(size=(700, 40)) @ RNG.normal(size=(40, 40))
    x[:, 3] = 1e9 + x[:, 3]  # far from zero
    x[:, 4] = 7.0  # constant
    x = holes(x)
    x[:, 5] = np.nan  # empty
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(40)])
    read = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.createDataFrame(pdf).repartition(3).cache()
    got = association.corr_matrix(df.mapInPandas(watched, df.schema), pdf.columns).toPandas().pivot(index="row", columns="col", values="r")
    assert read.value <= 2 * len(pdf)  # the rows that shift the columns, and one scan
    want = pdf.drop(columns=["c4", "c5"]).corr().to_numpy()
    kept = [c for c in pdf.columns if c not in ("c4", "c5")]
    np.testing.assert_allclose(got.loc[kept, kept].to_numpy(), want, atol=1e-6)
    assert got.loc["c4", "c1"] is None or np.isnan(got.loc["c4", "c1"])
    assert np.isnan(got.loc["c5", "c1"])


def test_pairwise_moments_repeat_where_the_first_rows_mislead(spark, monkeypatch):
    monkeypatch.setattr(gram, "SHIFT_ROWS", 1)
    y = RNG.normal(size=400)
    pdf = pd.DataFrame({"a": np.concatenate([[0.0], 1e8 + y[1:]]), "b": y, "id": np.arange(400)})
    df = spark.createDataFrame(pdf.iloc[1:]).unionByName(spark.createDataFrame(pdf.iloc[:1])).drop("id")
    whole = spark.createDataFrame(pd.DataFrame({"a": 1e8 + y, "b": y}))
    r = gram.pairwise_moments(whole.withColumn("a", F.col("a")), ["a", "b"]).correlation()
    assert r[0, 1] == pytest.approx(1, abs=1e-6)
    assert np.isfinite(gram.pairwise_moments(df, ["a", "b"]).correlation()).all()


def test_grid_of_many_levels_is_complete(spark):
    pdf = pd.DataFrame({"a": RNG.integers(0, 300, 2000), "b": [f"level {i}" for i in RNG.integers(0, 70, 2000)]})
    df = spark.createDataFrame(pdf).repartition(3)
    cells = association.crosstab(df, "a", "b").toPandas()
    want = pd.crosstab(pdf.a, pdf.b, margins=True)
    assert len(cells) == want.size and not cells.duplicated(["a", "b"]).any()
    got = cells.pivot(index="a", columns="b", values="n")
    want.index = want.index.astype(str)
    pd.testing.assert_frame_equal(got.sort_index(), want.sort_index()[sorted(want)], check_names=False, check_dtype=False)
    expected = association.expected_counts(df, "a", "b").toPandas()
    assert len(expected) == pdf.a.nunique() * pdf.b.nunique() and expected.expected.sum() == pytest.approx(2000)


def test_confusion_of_classes_on_either_side(spark):
    df = spark.createDataFrame([(0, 5), (0, 0), (3, 0), (None, 3)], "y int, p int")
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert set(cells) == {(a, b) for a in (0, 3, 5) for b in (0, 3, 5)} and cells[0, 5] == 1 and cells[5, 5] == 0
    given = metrics.confusion_matrix(df, "y", "p", [0, 5]).collect()
    assert {(r.actual, r.predicted): r.n for r in given} == {(0, 0): 1, (0, 5): 1, (5, 0): 0, (5, 5): 0}
    empty = metrics.confusion_matrix(df.limit(0), "y", "p")
    assert empty.count() == 0


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_cells_of_all_pairs(spark, monkeypatch, held):
    monkeypatch.setattr(association, "CELLS_IN_TASK", held)
    pdf = pd.DataFrame({f"c{i}": RNG.integers(0, k, 3000).astype(str) for i, k in enumerate((2, 3, 20, 5, 900))})
    pdf.loc[RNG.random(3000) < 0.1, "c1"] = None
    df = spark.createDataFrame(pdf).repartition(4)
    complete = pdf.dropna()
    got = association.pair_cells(df, pdf.columns).toPandas().set_index(["var_a", "var_b", "a", "b"]).n.to_dict()
    want = {}
    for i, a in enumerate(pdf.columns):
        for b in pdf.columns[i + 1:]:
            want |= {(a, b, *k): n for k, n in complete.groupby([a, b]).size().items()}
    assert got == want
    tests = association.chi2_all_pairs(df, list(pdf.columns)).toPandas().set_index(["var_a", "var_b"])
    alone = association.chi2_independence(df.na.drop(), "c2", "c3").first()
    assert tests.loc[("c2", "c3")].chi2 == pytest.approx(alone.chi2) and tests.loc[("c2", "c3")].dof == alone.dof


def test_bucket_ends_carry_over_blocks_and_gaps(spark, monkeypatch):
    monkeypatch.setattr(normality, "BUCKETS_PER_BLOCK", 7)
    there = np.sort(RNG.choice(400, 150, replace=False))
    x = RNG.normal(size=150)
    ends = spark.createDataFrame([(int(b), float(v)) for b, v in zip(there, x)], "bucket int, x double").repartition(3)
    got = {r.bucket: r.carried for r in normality.bucket_ends(ends).collect()}
    assert got == dict(zip(there.tolist(), [None, *x[:-1].tolist()]))


def test_differences_have_a_plan_that_does_not_grow_with_buckets(spark, monkeypatch):
    pdf = pd.DataFrame({"k": RNG.permutation(3000), "x": RNG.normal(size=3000)})
    df = spark.createDataFrame(pdf).repartition(4)
    want = np.diff(pdf.sort_values("k").x)
    sizes = []
    for n in (8, 64):
        monkeypatch.setattr(normality, "survey", lambda rows, name, n=n: type("S", (), {"edges": [3000 * i / n for i in range(1, n)]})())
        got = normality.differences(df, "k", "x")
        sizes.append(len(got._jdf.queryExecution().optimizedPlan().toString()))
        np.testing.assert_allclose(got.orderBy("k").toPandas()["diff"], want)
    assert sizes[1] <= sizes[0] + 64 * 20  # the Bucketizer's edges alone


@pytest.mark.parametrize("label", [None, "k"])
def test_density_equals_the_direct_sum(spark, label):
    x = np.concatenate([RNG.normal(size=900), RNG.standard_cauchy(60) * 5, np.full(40, 2.5)])
    pdf = pd.DataFrame({"x": x, "k": np.where(np.arange(1000) % 3 == 0, "u", "v")})
    got = bins.kde_curve(spark.createDataFrame(pdf).repartition(4), ["x"], label).toPandas()
    for name, part in pdf.groupby("k") if label else [(None, pdf)]:
        mine = (got if name is None else got[got.k == name]).sort_values("point")
        v = part.x.to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 200)
        want = np.exp(-((grid[:, None] - v) / h) ** 2 / 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        np.testing.assert_allclose(mine.x, grid, rtol=1e-9)
        np.testing.assert_allclose(mine.density, want, rtol=0, atol=1e-10 * want.max())
    assert len(got) == 200 * (2 if label else 1)


def plain_lowess(x, y, span, rounds, anchors):
    """Row by row: every neighbourhood from sorted distances, every line by weighted least squares."""
    n = len(x)
    q = max(min(int(span * n + 1e-7), n), 2)
    trust = np.ones(n)
    for turn in range(rounds + 1):
        heights = []
        for a in anchors:
            gap = np.abs(x - a)
            h = np.sort(gap)[q - 1]
            w = np.where(gap <= 0.999 * h, np.where(gap <= 0.001 * h, 1, (1 - (gap / max(h, 1e-300)) ** 3) ** 3), 0) * trust
            w = w / w.sum()
            mean = (w * x).sum()
            c = (w * (x - mean) ** 2).sum()
            if np.sqrt(c) > 0.001 * (x.max() - x.min()):
                w = w * (1 + (a - mean) * (x - mean) / c)
            heights.append((w * y).sum())
        gap = np.abs(y - np.interp(x, anchors, heights))
        scale = 6 * np.median(gap)
        trust = np.where(gap <= 0.999 * scale, np.where(gap <= 0.001 * scale, 1, (1 - (gap / scale) ** 2) ** 2), 0)
    return np.array(heights)


@pytest.mark.parametrize("n,span,rounds,delta", [(2000, 2 / 3, 3, 0.0), (1500, 0.2, 2, None), (900, 0.5, 0, 0.3)])
def test_lowess_equals_row_by_row(spark, n, span, rounds, delta):
    x = RNG.gamma(2, 2, n) if delta != 0 else np.round(RNG.normal(size=n), 2)
    y = np.sin(x) + RNG.normal(size=n) * 0.3
    y[::50] += 8  # outliers
    pdf = pd.DataFrame({"x": x, "y": y})
    pdf.loc[n] = [1.0, np.nan]
    got = lowess.lowess(spark.createDataFrame(pdf).repartition(4), "x", "y", span, rounds, delta).toPandas()
    want = plain_lowess(x, y, span, rounds, got.x.to_numpy())
    np.testing.assert_allclose(got.trend, want, atol=1e-7)
    if delta == 0:
        assert len(got) == len(np.unique(x))
    assert np.diff(got.x).min() > 0 and got.x.iloc[0] == x.min() and got.x.iloc[-1] == x.max()


def test_lowess_of_degenerate_tables(spark):
    def curve(rows):
        return [tuple(r) for r in lowess.lowess(spark.createDataFrame(rows, "x double, y double"), "x", "y").collect()]

    assert curve([]) == [] and curve([(None, 1.0)]) == []
    assert curve([(2.0, 5.0)]) == [(2.0, 5.0)]
    assert curve([(2.0, 5.0), (2.0, 7.0)]) == [(2.0, 6.0)]
    line = curve([(float(i), 2.0 * i + 1) for i in range(30)])
    np.testing.assert_allclose([h for _, h in line], [2 * a + 1 for a, _ in line])
    rows = spark.createDataFrame([(0.5,), (None,), (-9.0,)], "x double")
    back = rows.withColumn("t", lowess.trend_at(F.col("x"), spark.createDataFrame([(0.0, 1.0), (1.0, 3.0)], "x double, trend double"))).collect()
    assert [r.t for r in back] == [2.0, None, 1.0]


def plain_twoway(pdf):
    """Sums of squares and ranks of the nested models by dense least squares."""
    y = pdf.y.to_numpy()
    a, b = (pd.get_dummies(pdf[c]).to_numpy(float) for c in ("a", "b"))
    cells = pd.get_dummies(pdf.a.astype(str) + "|" + pdf.b.astype(str)).to_numpy(float)
    fits = []
    for design in (np.ones((len(y), 1)), a, np.hstack([a, b]), cells):
        fits.append((((y - design @ np.linalg.lstsq(design, y, rcond=None)[0]) ** 2).sum(), np.linalg.matrix_rank(design)))
    return [(s0 - s1, r1 - r0) for (s0, r0), (s1, r1) in zip(fits, fits[1:])] + [(fits[-1][0], len(y) - fits[-1][1])]


@pytest.mark.parametrize("n,p,q,parts", [(800, 6, 9, 1), (300, 40, 25, 1), (500, 12, 12, 3), (60, 30, 30, 1), (400, 1, 5, 1)])
def test_twoway_equals_dense_least_squares(spark, n, p, q, parts):
    part = RNG.integers(0, parts, n)  # parts of the design that share no level
    a, b = RNG.integers(0, p, n) * parts + part, RNG.integers(0, q, n) * parts + part
    pdf = pd.DataFrame({"a": a, "b": [f"b{i}" for i in b], "y": 1e4 + a + 0.3 * b + RNG.normal(size=n)})
    got = anova.anova_twoway(spark.createDataFrame(pdf).repartition(3), "y", "a", "b").collect()
    for r, (ss, dof) in zip(got, plain_twoway(pdf)):
        assert r.df == dof and r.ss == pytest.approx(ss, rel=1e-6, abs=1e-5)


def test_twoway_of_very_many_levels(spark):
    n, p, q = 40_000, 9_000, 6_000
    a, b = RNG.integers(0, p, n), RNG.integers(0, q, n)
    effect_a, effect_b = RNG.normal(size=p), RNG.normal(size=q)
    pdf = pd.DataFrame({"a": a, "b": b, "y": effect_a[a] + effect_b[b]})  # no noise: nothing is left to the interaction
    got = {r.term: r for r in anova.anova_twoway(spark.createDataFrame(pdf).repartition(4), "y", "a", "b").collect()}
    total = ((pdf.y - pdf.y.mean()) ** 2).sum()
    means = pdf.groupby("a").y.transform("mean")
    assert got["a"].ss == pytest.approx(((means - pdf.y.mean()) ** 2).sum())
    assert got["b"].ss == pytest.approx(total - got["a"].ss, rel=1e-6) and got["a:b"].ss < 1e-4 * total


def test_linked_sets():
    label = anova.joined_sets(np.array([5, 1, 7, 2, 2]), np.array([4, 7, 3, 2, 9]), 10)
    assert label.tolist() == [0, 1, 2, 1, 4, 4, 6, 1, 8, 2]
    chain = RNG.permutation(3000)
    assert (anova.joined_sets(chain[:-1], chain[1:], 3000) == 0).all()


def test_leading_components_of_wide_vectors(spark):
    n, k = 600, 800
    x = RNG.normal(size=(n, 12)) * np.linspace(6, 1, 12) @ RNG.normal(size=(12, k)) + RNG.normal(size=(n, k)) * 0.5 + 100
    x[:, 7] = 3.0  # constant
    rows = [(x[i].tolist(),) for i in range(n)] + [(None,), ([1.0],), ([float("nan")] * k,)]
    df = spark.createDataFrame(rows, "e array<double>").repartition(4)
    got = wide.wide_components(df, "e", 6)
    kept = np.delete(np.arange(k), 7)
    z = (x[:, kept] - x[:, kept].mean(0)) / x[:, kept].std(0)
    _, sizes, axes = np.linalg.svd(z, full_matrices=False)
    np.testing.assert_allclose(got.ratios, sizes[:6] ** 2 / n / (k - 1), rtol=1e-8)
    for j in range(6):
        want = axes[j] * np.sign(axes[j][np.abs(axes[j]).argmax()])
        np.testing.assert_allclose(got.loadings[kept, j], want, atol=1e-6)
    assert got.loadings[7] == pytest.approx(0) and got.passes <= 5
    scored = wide.wide_scores(df, "e", got).toPandas().scores
    assert scored.isna().sum() == 3 and np.stack(scored.dropna()).var(axis=0) == pytest.approx(sizes[:6] ** 2 / n, rel=1e-6)


def test_all_components_of_flat_vectors(spark):
    x = RNG.normal(size=(300, 30))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "e array<float>")
    got = wide.wide_components(df, "e", 4)
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    np.testing.assert_allclose(got.ratios, values[:4] / 30, rtol=1e-5)
    with pytest.raises(ValueError):
        wide.wide_components(df.limit(0), "e", 2)
