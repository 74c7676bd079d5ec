"""Correlation, contingency, normality, analysis of variance."""

import math

import numpy as np
import pandas as pd
import pytest

from plumbline.operators import anova, association, normality
from plumbline.plans import ranks

RNG = np.random.default_rng(11)


def cells_frame(spark, table):
    rows = [(f"r{i}", f"c{j}") for i, line in enumerate(table) for j, n in enumerate(line) for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b string")


def chi2_by_hand(table, correct=False):
    o = np.array(table, float)
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    gap = np.abs(o - e)
    if correct:
        gap = gap - np.minimum(0.5, gap)
    return (gap ** 2 / e).sum()


@pytest.mark.parametrize("table,correct", [
    ([[10, 20, 30], [6, 9, 17]], False), ([[12, 5], [7, 9]], True), ([[3, 0], [0, 4]], True), ([[5, 0, 2], [0, 7, 1]], False)])
def test_chi_square(spark, table, correct):
    row = association.chi2_independence(cells_frame(spark, table), "a", "b").first()
    assert row.chi2 == pytest.approx(chi2_by_hand(table, correct))
    assert row.dof == (len(table) - 1) * (len(table[0]) - 1) and row.reject_h0 == (row.p_value < 0.05)


def test_single_row_table_has_no_strength(spark):
    df = cells_frame(spark, [[4, 5]])
    row = association.cramers_v(df, "a", "b").first()
    assert row.cramers_v is None and row.strength is None
    assert association.chi2_independence(df, "a", "b").first().p_value == 1.0


def test_crosstab_fills_empty_cells_and_margins(spark):
    df = cells_frame(spark, [[2, 0], [1, 3]]).union(spark.createDataFrame([("r0", None)], "a string, b string"))
    got = {(r.a, r.b): r.n for r in association.crosstab(df, "a", "b").collect()}
    assert got == {("r0", "c0"): 2, ("r0", "c1"): 0, ("r1", "c0"): 1, ("r1", "c1"): 3, ("r0", "All"): 2, ("r1", "All"): 4,
                   ("All", "c0"): 3, ("All", "c1"): 3, ("All", "All"): 6}
    expected = {(r.a, r.b): r.expected for r in association.expected_counts(df, "a", "b").collect()}
    assert expected[("r0", "c1")] == 1.0 and len(expected) == 4


def test_all_pairs_equal_single_tests(spark):
    pdf = pd.DataFrame({c: RNG.integers(0, k, 500) for c, k in (("a", 2), ("b", 2), ("c", 4))})
    df = spark.createDataFrame(pdf)
    for r in association.chi2_all_pairs(df, ["a", "b", "c"]).collect():
        assert r.chi2 == pytest.approx(association.chi2_independence(df, r.var_a, r.var_b).first().chi2)


def test_pairwise_correlation_and_listwise_vif(spark):
    pdf = pd.DataFrame(RNG.normal(size=(60, 3)), columns=list("abc"))
    pdf["c"] += pdf["a"]
    pdf.loc[:9, "a"] = None
    pdf.loc[50:, "b"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    got = {(r.row, r.col): r.r for r in association.corr_matrix(df, list("abc")).collect()}
    for (a, b), r in got.items():
        assert r == pytest.approx(pdf.corr().loc[a, b])
    full = pdf.dropna()
    want = np.diag(np.linalg.inv(full.corr()))
    np.testing.assert_allclose([r.vif for r in association.vif(df, list("abc")).collect()], want)
    strengths = {r.strength for r in association.corr_insights(df, list("abc")).collect()}
    assert strengths <= {"strong", "moderate", "weak"}
    assert association.lower_triangle(association.corr_matrix(df, list("abc")), list("abc")).count() == 3


def test_collinear_columns_have_infinite_vif(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(30)], "a double, b double, c double")
    levels = {r["column"]: (r.vif, r.level) for r in association.vif(df, ["a", "b", "c"]).collect()}
    assert levels["a"] == (math.inf, "high") and levels["c"][1] == "low"


@pytest.mark.parametrize("limit", [500_000, 0])
def test_spearman_with_ties_and_a_hot_value(spark, monkeypatch, limit):
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", limit)
    x = np.where(RNG.random(900) < 0.4, 3.0, RNG.integers(0, 50, 900))
    y = x + RNG.normal(0, 20, 900)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(1.0, None)], "x double, y double")
    row = association.spearman_test(df, "x", "y").first()
    rho = np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]
    assert row.n == 900 and row.rho == pytest.approx(rho)
    assert row.s == pytest.approx((900 ** 3 - 900) * (1 - rho) / 6)
    assert row.reject_h0 and row.direction == "positive"


def test_perfect_rank_correlation(spark):
    df = spark.createDataFrame([(float(i), float(-i ** 3)) for i in range(10)], "x double, y double")
    row = association.spearman_test(df, "x", "y").first()
    assert row.rho == pytest.approx(-1) and row.p_value == pytest.approx(0, abs=1e-12) and row.strength == "very strong"


def test_differences_follow_the_key_across_buckets(column):
    x = RNG.normal(size=5000)
    df = column(x)
    got = normality.differences(df, "id", "x").orderBy("id").toPandas()
    np.testing.assert_allclose(got["diff"], np.diff(x))
    d = np.diff(x)
    d = d - d.mean()
    skew, kurt = (d ** 3).mean() / d.std() ** 3, (d ** 4).mean() / d.std() ** 4 - 3
    row = normality.jarque_bera_diff(df, "id", "x").first()
    assert row.statistic == pytest.approx(len(d) / 6 * (skew ** 2 + kurt ** 2 / 4))
    assert row.p_value == pytest.approx(math.exp(-row.statistic / 2))


def test_kolmogorov_smirnov_statistic(column):
    from statistics import NormalDist
    x = np.sort(np.round(RNG.normal(size=300), 1))
    p = np.array([NormalDist(x.mean(), x.std(ddof=1)).cdf(v) for v in x])
    want = max((np.arange(1, 301) / 300 - p).max(), (p - np.arange(300) / 300).max())
    assert normality.ks_normal(column(x), ["x"]).first().statistic == pytest.approx(want)


def test_shapiro_wilk_published_example(column):
    row = normality.shapiro_wilk(column([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]), ["x"]).first()
    assert row.w == pytest.approx(0.78881, abs=1e-5) and row.p_value == pytest.approx(0.006704, abs=2e-6)
    assert row.is_normal is False


def test_shapiro_wilk_edges(column):
    assert normality.shapiro_wilk(column([1, 2, 4]), ["x"]).first().w == pytest.approx(0.9643, abs=1e-4)
    assert normality.shapiro_wilk(column([5, 5, 5, 5]), ["x"]).first().w is None
    large = normality.shapiro_wilk(column(RNG.normal(size=6000)), ["x"]).first()
    assert large.w > 0.99 and 0 < large.p_value <= 1 and large.p_is_extrapolated


def anova_frame(spark):
    pdf = pd.DataFrame({"y": RNG.normal(size=200), "a": RNG.choice(list("pqr"), 200), "b": RNG.choice(list("uv"), 200, p=[0.7, 0.3])})
    pdf["y"] += (pdf.a == "p") * 1.0 + (pdf.b == "u") * 0.5
    return pdf, spark.createDataFrame(pdf)


def test_oneway(spark):
    pdf, df = anova_frame(spark)
    terms = {r.term: r for r in anova.anova_oneway(df, "y", "a").collect()}
    means = pdf.groupby("a").y.transform("mean")
    assert terms["a"].ss == pytest.approx(((means - pdf.y.mean()) ** 2).sum())
    assert terms["residuals"].ss == pytest.approx(((pdf.y - means) ** 2).sum())
    assert (terms["a"].df, terms["residuals"].df) == (2, 197)
    assert anova.anova_f_scores(df, ["y"], "a").first().f == pytest.approx(terms["a"].f)


def test_twoway_is_sequential_on_unbalanced_data(spark):
    pdf, df = anova_frame(spark)
    designs = [np.ones((200, 1)), pd.get_dummies(pdf.a).to_numpy(float)]
    designs.append(np.hstack([designs[1], pd.get_dummies(pdf.b).to_numpy(float)]))
    designs.append(pd.get_dummies(pdf.a + pdf.b).to_numpy(float))
    sse = [((pdf.y - d @ np.linalg.lstsq(d, pdf.y, rcond=None)[0]) ** 2).sum() for d in designs]
    got = [r.ss for r in anova.anova_twoway(df, "y", "a", "b").collect()]
    np.testing.assert_allclose(got, [sse[0] - sse[1], sse[1] - sse[2], sse[2] - sse[3], sse[3]])
