"""Many classes, missing and degenerate data, plans that grow with the columns only, and workers without the package."""

import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import tails
from plumbline.operators import anova, association, bins, clean, describe, linear, metrics, normality, split
from plumbline.plans import ranks
from plumbline.sources import tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def crowded(spark):
    """20,000 rows of 5,000 classes; the first class holds 5,001 more."""
    return spark.range(25_001).select(F.col("id"), F.when(F.col("id") >= 20_000, 0).otherwise(F.col("id") % 5000).alias("k"),
                                      (F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 2).alias("b"))


def test_five_thousand_classes(crowded):
    codes = {r.k: r.c for r in split.label_encode(crowded, "k", "c").select("k", "c").distinct().collect()}
    assert codes == {k: k for k in range(5000)}
    table = association.crosstab(crowded, "k", "b")
    assert table.count() == 5001 * 3 and table.filter("a = 'All' and b = 'All'").first().n == 25_001
    cells = bins.histogram_by_class(crowded, ["x"], "k", 4)
    assert cells.count() == 5000 * 4 and cells.agg(F.sum("n")).first()[0] == 25_001


def test_stratified_split_and_folds_of_many_classes(crowded):
    got = split.stratified_split(crowded, "k", ["id"], 0.25)
    assert got.columns == ["id", "k", "x", "b", "split"]
    sizes = {(r.k, r.split): r["count"] for r in got.groupBy("k", "split").count().collect()}
    assert sum(n for (_, s), n in sizes.items() if s == "test") == math.ceil(0.25 * 25_001)
    assert abs(sizes[0, "test"] - 0.25 * 5005) <= 1 and all(abs(sizes.get((k, "test"), 0) - 1) <= 1 for k in range(1, 5000))
    folds = split.hash_folds(crowded, ["id"], 5, label="k").groupBy("k", "fold").count().collect()
    per_class = {}
    for r in folds:
        per_class.setdefault(r.k, []).append(r["count"])
    assert per_class[0] == [1001] * 5 and all(sum(v) == 4 and max(v) == 1 for k, v in per_class.items() if k)


def test_many_classes_split_like_few(spark, monkeypatch):
    df = spark.range(900).select("id", (F.col("id") % 7).alias("k"))
    few = {r.id: (r.split, r.fold) for r in split.hash_folds(split.stratified_split(df, "k", ["id"]), ["id"], label="k").collect()}
    monkeypatch.setattr(split, "LITERAL_CLASSES", 2)
    many = {r.id: (r.split, r.fold) for r in split.hash_folds(split.stratified_split(df, "k", ["id"]), ["id"], label="k").collect()}
    assert few == many


def test_two_way_analysis_of_many_cells(spark):
    rows = spark.range(60_000).select((F.col("id") % 150).alias("a"), (F.floor(F.col("id") / 150) % 100).alias("b"),
                                      (F.col("id") % 150 + F.xxhash64("id") % 3).cast("double").alias("y"))
    got = {r.term: r for r in anova.anova_twoway(rows, "y", "a", "b").collect()}
    assert got["a"].df == 149 and got["b"].df == 99 and got["a:b"].df == 149 * 99 and got["residuals"].df == 60_000 - 15_000
    total = rows.agg(F.var_pop("y") * F.count("y")).first()[0]
    assert sum(r.ss for r in got.values()) == pytest.approx(total)


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(float(i), float(i) if i % 4 else math.nan) for i in range(1, 41)], "id double, x double")


def test_nan_is_missing(spark, gaps):
    clear = gaps.filter(~F.isnan("x"))
    for report in (describe.describe_params, describe.describe_quartiles, describe.describe_psych, bins.histogram_sturges):
        assert sorted(map(str, report(gaps, ["x"]).collect())) == sorted(map(str, report(clear, ["x"]).collect()))
    assert tables.missing_counts(gaps, ["x"]).first().missing == 10
    assert tables.to_numeric(spark.createDataFrame([("NaN",), ("1",)], "x string"), ["x"]).filter("x is null").count() == 1
    assert clean.zscore_clean(gaps, "x").count() == 30 and clean.iqr_bounds(gaps, ["x"]).first().n_outliers == 0


def test_degenerate_columns_and_classes(spark):
    rows = spark.createDataFrame([("a", 5.0, 1.0), ("b", 2.0, 1.0), ("b", 2.0, 1.0), ("c", 0.0, 1.0), ("c", 4.0, 1.0)], "k string, x double, flat double")
    for width in ("scott", "nrd0"):
        curve = bins.kde_curve(rows, ["x"], "k", 20, width).toPandas()
        assert len(curve) == 60 and np.isfinite(curve["density"]).all()
    apart = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 2.0)], "k string, x double")
    assert anova.anova_f_scores(apart, ["x"], "k").first()[1:] == (math.inf, 0.0)
    single = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    assert {r.term: r.f for r in anova.anova_oneway(single, "x", "k").collect()} == {"k": None, "residuals": None}
    assert normality.ks_normal(rows, ["flat"]).first().p_value is None
    never = rows.select(F.lit("n").alias("y"), "x")
    assert {r.tpr for r in metrics.roc_curve(never, "y", {"p": "x"}).filter("threshold < 100").collect()} == {None}
    line = spark.createDataFrame([(float(i), 2.0 * i, 7.0) for i in range(6)], "x double, y double, flat double")
    assert linear.lm_summary(line, ["x"], "flat").first().r2 is None
    assert {r.term: r.p_value for r in linear.lm_coefficients(line, ["x"], "y").collect()}["x"] < 1e-12
    assert association.vif(line, ["x", "y"]).first().vif == math.inf
    with pytest.raises(ValueError):
        normality.differences(rows, "k", "x")


def test_tails_keep_their_digits_at_any_size():
    for dof in (1e3, 9.99e4, 1.01e5, 1e9):
        exact = math.exp(-dof / 2 * math.log1p(60 / dof))
        assert tails.f_sf(30, 2, dof) == pytest.approx(exact, rel=1e-12)
    assert tails.f_sf(math.inf, 2, 10) == 0.0


def test_ranks_of_large_columns_use_each_column_once(spark, monkeypatch):
    rows = spark.range(3000).select(*[(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") * p % 3001)).cast("double").alias(f"c{p}")
                                      for p in (7, 11, 13)])
    small = sorted(map(str, ranks.row_ranks(rows, rows.columns).collect()))
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", 0)
    big = ranks.row_ranks(rows, rows.columns)
    assert sorted(map(str, big.select("c7", "c11", "c13", "c7_rank", "c11_rank", "c13_rank").collect())) == sorted(
        map(str, ranks.row_ranks(rows, rows.columns).select("c7", "c11", "c13", "c7_rank", "c11_rank", "c13_rank").collect()))
    assert len(small) == big.count() == 3000
    leaves = [ranks.row_ranks(rows, rows.columns[:k])._jdf.queryExecution().optimizedPlan().collectLeaves().size() for k in (1, 2, 3)]
    assert leaves[2] - leaves[1] == leaves[1] - leaves[0]


WORKER_SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
for key in {keys!r}:
    print(key, entry.queries()[key](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_workers_need_no_copy_of_the_package(tmp_path):
    keys = ["chi2_all_pairs", "spearman_test", "ks_normal", "anova_f_scores", "contingency_report", "svm_linear"]
    script = tmp_path / "run.py"
    script.write_text(WORKER_SCRIPT.format(root=ROOT, keys=keys))
    clean_env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean_env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.split()[:1] and line.split()[0] in keys] == keys
