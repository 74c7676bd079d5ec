import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import clean, describe
from plumbline.sources import tables


def test_params_of_a_small_sample(column):
    row = describe.describe_params(column([1, 2, 2, 3, 3, 10]), ["x"]).first()
    assert row["mode"] == 2.0 and row["median"] == 2.5 and row["sum"] == 21.0
    assert row["kurtosis"] == pytest.approx(0.8453, abs=1e-4)
    assert row["skewness"] == pytest.approx(1.5774, abs=1e-4)
    assert row["std"] == pytest.approx(3.2711, abs=1e-4)


def test_each_column_drops_its_own_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 5.0), (None, 7.0)], "a double, b double")
    rows = {r["column"]: r for r in describe.describe_quartiles(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 2 and rows["a"]["mean"] == 2.0 and rows["b"]["q50"] == 6.0


def test_psych_description(column):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]
    row = describe.describe_psych(column(values), ["x"]).first()
    assert row["trimmed"] == np.mean(values[1:9]) and row["mad"] == pytest.approx(1.4826 * 2.5)
    x = np.array(values, float)
    assert row["skew"] == pytest.approx(((x - x.mean()) ** 3).mean() / x.std(ddof=1) ** 3)
    assert row["se"] == pytest.approx(x.std(ddof=1) / np.sqrt(10))


def test_trimmed_mean_cuts_inside_ties(column):
    values = [1.0] * 7 + [2.0] * 6 + [9.0] * 7
    row = describe.trimmed_means(column(values), ["x"], 0.25).first()
    assert row["trimmed"] == pytest.approx(np.mean(sorted(values)[5:-5]))


def test_distribution_and_null_group(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in describe.class_distribution(df, "k").collect()] == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert {r.k: r.n for r in describe.group_counts(df, ["k"]).collect()} == {"a": 2, "b": 1, None: 1}


def test_outlier_rules_differ_in_sd_and_strictness(column):
    values = [0.0] * 10 + [10.0]
    x = np.array(values)
    z1, z0 = (abs(x - x.mean()) / x.std(ddof=d) for d in (1, 0))
    df = column(values)
    # a margin on either side: the last digit depends on the order in which partial variances meet
    assert [clean.zscore_outliers(df, "id", "x", z1.max() + e).count() for e in (1e-9, -1e-9)] == [0, 1]
    assert [clean.zscore_clean(df, "x", z0.max() + e).count() for e in (1e-9, -1e-9)] == [11, 10]
    # whole numbers on the line itself: sample deviation 1 of three values, population deviation 1 of two
    assert clean.zscore_outliers(column([-1, 0, 1]), "id", "x", 1.0).count() == 0
    assert clean.zscore_clean(column([-1, 1]), "x", 1.0).count() == 0
    assert clean.zscore_outliers(df, "id", "x", 2.9).first()["id"] == 10
    counts = clean.clean_counts(df, "x", 3.0).first()
    assert (counts.n_before, counts.n_after, counts.n_removed) == (11, 10, 1)


def test_constant_and_empty_columns(column, spark):
    assert clean.zscore_clean(column([5, 5, 5]), "x").count() == 0
    assert clean.zscore_outliers(column([5, 5, 5]), "id", "x").count() == 0
    for method in ("l2", "l1", "max"):
        assert {r.normalized for r in clean.normalize(column([0, 0]), "x", method).collect()} == {0.0}
    assert {r.normalized for r in clean.normalize(column([5, 5]), "x", "minmax").collect()} == {0.0}
    assert {r.x for r in clean.standardize(column([5, 5]), ["x"]).collect()} == {0.0}
    empty = spark.createDataFrame([], "x double")
    for action in (clean.zscore_clean, clean.normalize, clean.clean_counts):
        with pytest.raises(ValueError):
            action(empty, "x")


@pytest.mark.parametrize("method,scale", [("l2", 5.0), ("l1", 7.0), ("max", 4.0)])
def test_norms(column, method, scale):
    got = sorted(r.normalized for r in clean.normalize(column([3, -4]), "x", method).collect())
    assert got == [-4 / scale, 3 / scale]


def test_iqr_removal_spares_nulls(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(20)] + [(1000.0, None), (None, 99.0)], "a double, b double")
    kept = clean.iqr_remove_any(df, ["a", "b"])
    assert kept.count() == 20
    assert clean.iqr_removal_counts(df, ["a", "b"]).first().n_removed == 2
    bounds = {r["column"]: r for r in clean.iqr_bounds(df, ["a", "b"]).collect()}
    assert bounds["a"].n_outliers == 1 and bounds["a"].q1 == np.quantile([*range(20), 1000.0], 0.25)


def test_standardize_uses_population_sd_and_train_only(column):
    values = np.array([1.0, 2.0, 4.0, 9.0])
    df = column(values)
    got = sorted(r.x for r in clean.standardize(df, ["x"]).collect())
    np.testing.assert_allclose(got, (values - values.mean()) / values.std())
    fitted = clean.scaler(df.filter("id < 2"), ["x"])
    assert fitted["x"] == (1.5, 0.5)


def test_column_shaping(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1.5,a\n\n2,b\n")
    df = tables.read_delimited(spark, str(tmp_path / "t.csv"), ["v", "k"], text=["k"])
    assert [tuple(r) for r in df.orderBy("v").collect()] == [(1.5, "a"), (2.0, "b")]
    picked = tables.select_columns(df, {"k": ("kind", 0), "A": ("value", 0)})
    assert picked.columns == ["kind", "value"]
    dirty = spark.createDataFrame([("1",), ("x",), (None,)], "t string")
    assert [r.t for r in tables.to_numeric(dirty, ["t"]).collect()] == [1.0, None, None]
    assert tables.missing_counts(dirty).first().missing == 1
    tables.write_result(picked, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_results_do_not_depend_on_partitioning(spark):
    pdf = pd.DataFrame({"x": np.random.default_rng(1).exponential(3, 500)})
    a = describe.describe_params(spark.createDataFrame(pdf).coalesce(1), ["x"]).first().asDict()
    b = describe.describe_params(spark.createDataFrame(pdf.sample(frac=1, random_state=2)).repartition(7), ["x"]).first().asDict()
    for name in a:
        assert a[name] == b[name] or a[name] == pytest.approx(b[name], rel=1e-9)
    assert spark.createDataFrame(pdf).agg(F.count("x")).first()[0] == 500
