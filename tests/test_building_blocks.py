"""Order statistics, ranks, Gram sums and distribution functions."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import tails
from plumbline.functions.normal import normal_cdf, normal_ppf
from plumbline.plans import gram, order, ranks

RNG = np.random.default_rng(7)
HOT = np.concatenate([np.full(3000, 5.0), RNG.normal(5, 3, 6000), [5.0000001, -1e9, 1e9]])


@pytest.mark.parametrize("values", [RNG.normal(size=4000), HOT, np.full(50, 2.0), np.arange(7.0), np.array([1.0])],
                         ids=["normal", "hot", "constant", "few", "one"])
@pytest.mark.parametrize("buffer_values", [100_000, 40, 3])
def test_quantiles_are_exact_whatever_the_buffer(column, values, buffer_values):
    probs = [0, 0.01, 1 / 3, 0.5, 0.75, 0.999, 1]
    found = order.exact_quantiles(column(values), ["x"], probs, buffer_values)["x"]
    np.testing.assert_allclose(found, np.quantile(values, probs), rtol=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-4, 4), min_size=1, max_size=60))
def test_order_statistics_with_ties(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = order.order_statistics(df, {"x": range(len(values))}, buffer_values=2, accuracy=10)["x"]
    assert [found[i] for i in range(len(values))] == sorted(map(float, values))


def test_quantiles_skip_nulls_and_report_missing_columns(column):
    assert order.exact_quantiles(column([None, 1, 3]), ["x"], [0.5])["x"] == [2.0]
    assert order.exact_quantiles(column([None]), ["x"], [0.5])["x"] == [None]


@pytest.mark.parametrize("values", [RNG.normal(size=3000), HOT, np.full(20, 1.0)], ids=["normal", "hot", "constant"])
def test_average_ranks_equal_a_single_window(column, values):
    got = ranks.running_counts(column(values), "x").withColumn("r", ranks.average_rank()).toPandas()
    want = pd.Series(values).rank().groupby(values).first()
    np.testing.assert_allclose(got.sort_values("value").r, want.sort_index())


def test_ranks_by_group_with_extra_sums(spark):
    pdf = pd.DataFrame({"g": RNG.choice(["a", "b"], 2000), "x": RNG.integers(0, 40, 2000) * 1.0, "w": RNG.integers(0, 5, 2000)})
    got = ranks.running_counts(spark.createDataFrame(pdf), "x", ["g"], {"w": F.col("w")}).toPandas()
    for g, part in pdf.groupby("g"):
        sums = part.groupby("x").agg(n=("w", "size"), w=("w", "sum")).sort_index()
        mine = got[got.g == g].sort_values("value")
        assert list(mine.n) == list(sums.n) and list(mine.w) == list(sums.w)
        assert list(mine.n_before) == list(sums.n.cumsum() - sums.n)
        assert list(mine.w_before) == list(sums.w.cumsum() - sums.w)


def test_row_ranks_without_broadcast(column, monkeypatch):
    df = column(HOT)
    small = ranks.row_ranks(df, ["x"]).toPandas().sort_values("id")
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ranks, "HOT_SHARES", 100)
    split = ranks.row_ranks(df, ["x"])
    np.testing.assert_allclose(split.toPandas().sort_values("id").x_rank, small.x_rank)
    np.testing.assert_allclose(small.x_rank, pd.Series(HOT).rank())


@pytest.mark.parametrize("chunk", [1_000_000, 7])
def test_expanded_ties_restore_every_rank(column, chunk):
    df = column(HOT)
    spread = ranks.survey(df, "x")
    rows = ranks.expand_ties(ranks.running_counts(df, "x", spread=spread), spread.largest, chunk=chunk).toPandas()
    rows = rows.sort_values("i")
    assert list(rows.i) == list(range(1, len(HOT) + 1))
    np.testing.assert_array_equal(rows.value, np.sort(HOT))
    assert spread.largest >= 3000


def test_gram_paths_agree_with_numpy(spark, monkeypatch):
    x = RNG.normal(1e6, 1, (500, 4))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(part=np.arange(500) % 3)).repartition(4)
    away = x - x.mean(0)
    one = gram.gram(df, list("abcd"))
    parts = gram.gram_by(df, list("abcd"), "part")
    merged = parts[0].plus(parts[1]).plus(parts[2])
    monkeypatch.setattr(gram, "EXPRESSION_COLUMNS", 2)
    blocks = gram.gram(df, list("abcd"))
    for g in (one, merged, blocks):
        assert g.n == 500
        np.testing.assert_allclose(g.cross, away.T @ away, rtol=1e-6, atol=1e-6)
    np.testing.assert_allclose(merged.minus(parts[1]).cross, parts[0].plus(parts[2]).cross, atol=1e-6)


def test_gram_leaves_out_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, None), (5.0, 4.0)], "a double, b double")
    assert gram.gram(df, ["a", "b"]).n == 2
    with pytest.raises(ValueError):
        gram.gram(df.filter("a is null"), ["a", "b"])


def test_normal_columns(spark):
    df = spark.range(1, 2000).select((F.col("id") / 2000).alias("p"), (F.col("id") / 100 - 10).alias("x"))
    got = df.select("p", "x", normal_ppf(F.col("p")).alias("z"), normal_cdf(F.col("x")).alias("c")).toPandas()
    np.testing.assert_allclose(got.z, [NormalDist().inv_cdf(p) for p in got.p], atol=1e-13)
    np.testing.assert_allclose(got.c, [0.5 * math.erfc(-x / math.sqrt(2)) for x in got.x], rtol=1e-7)
    edge = spark.createDataFrame([(0.0,), (1.0,), (1e-300,)], "p double").select(normal_ppf(F.col("p")).alias("z")).collect()
    assert edge[0].z is None and edge[1].z is None and abs(edge[2].z + 37.0471) < 1e-3


def test_tails():
    # closed forms
    assert tails.chi2_sf(3.93, 8) == pytest.approx(math.exp(-1.965) * sum(1.965 ** k / math.factorial(k) for k in range(4)))
    assert tails.f_sf(3, 2, 50) == pytest.approx((50 / 56) ** 25)
    assert tails.t_sf2(1.0, 1) == pytest.approx(0.5)
    assert tails.t_sf2(1.96, 1e12) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), abs=1e-10)
    # both branches meet
    assert tails.f_sf(3, 5, 99_999) == pytest.approx(tails.f_sf(3, 5, 100_001), rel=1e-6)
    assert tails.f_sf(0, 3, 10) == 1.0
    # tabulated value of the exact Kolmogorov distribution
    assert tails.kolmogorov_sf(0.274, 10) == pytest.approx(1 - 0.6285, abs=1e-3)
    assert tails.kolmogorov_sf(0.05, 399) == pytest.approx(tails.kolmogorov_sf(0.05, 401), abs=5e-3)


def test_a_few_long_blocks_are_ranked_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LONGEST_PIECE", 100)
    df = spark.range(9_000).select((F.col("id") % 3).cast("double").alias("x"))
    spread = ranks.survey(df, "x")
    assert spread.mean >= ranks.LONG_BLOCKS
    rows = ranks.expand_ties(ranks.running_counts(df, "x", spread=spread), spread.largest, mean=spread.mean)
    got = rows.withColumn("task", F.spark_partition_id()).toPandas().sort_values("i")
    assert got.i.tolist() == list(range(1, 9_001)) and got.value.tolist() == [v for v in (0.0, 1.0, 2.0) for _ in range(3_000)]
    assert got.task.nunique() > 1
