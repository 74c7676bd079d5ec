"""Splits, linear models, metrics, classifiers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import classify, linear, machines, metrics, perceptron, reports, softmax, split
from plumbline.plans import hashes, newton, sums

RNG = np.random.default_rng(5)


def frame(spark, n=600):
    x = RNG.normal(size=(n, 3)) * [1, 5, 0.2] + [3, 0, 1]
    y = 2 + x @ [1.5, -0.3, 4] + RNG.normal(size=n)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, id=np.arange(n))
    return pdf, spark.createDataFrame(pdf).repartition(4)


@pytest.mark.parametrize("keys", [["id"], split.PortableKeys(["id"])])
def test_split_has_exact_size_and_ignores_partitioning(spark, keys):
    _, df = frame(spark)
    one = split.train_test_split(df, keys, 0.2)
    two = split.train_test_split(df.coalesce(1), keys, 0.2)
    assert one.filter("split = 'test'").count() == 120
    assert one.select("id", "split").exceptAll(two.select("id", "split")).count() == 0
    other = split.train_test_split(df, keys, 0.2, seed=7)
    assert one.select("id", "split").exceptAll(other.select("id", "split")).count() > 0


def test_split_stays_exact_when_hashes_collide(spark, monkeypatch):
    _, df = frame(spark)
    first = split.key_hash

    def coarse(keys, seed, part=0):
        return F.floor(first(keys, seed, part) / 2.0 ** 49).cast("double") if part == 0 else first(keys, seed, part)

    monkeypatch.setattr(split, "key_hash", coarse)
    assert split.train_test_split(df, ["id"], 0.3).filter("split = 'test'").count() == 180


def test_stratified_split_keeps_shares(spark):
    df = spark.createDataFrame([(i, "rare" if i % 10 == 0 else "common") for i in range(503)], "id long, k string")
    got = {(r.k, r.split): r["count"] for r in split.stratified_split(df, "k", ["id"], 0.3).groupBy("k", "split").count().collect()}
    assert got[("rare", "test")] + got[("common", "test")] == 151
    assert got[("rare", "test")] == 15


def test_folds(spark):
    df = spark.range(23).withColumn("k", F.col("id") % 2)
    got = split.contiguous_folds(df, "id", 5).orderBy("id").toPandas().fold
    assert list(got) == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 4 + [4] * 4
    sizes = split.hash_folds(df, ["id"], 5).groupBy("fold").count().toPandas()["count"]
    assert sorted(sizes) == [4, 4, 5, 5, 5]
    per_class = split.hash_folds(df, ["id"], 5, label="k").groupBy("k", "fold").count().toPandas()["count"]
    assert set(per_class) <= {2, 3} and per_class.sum() == 23


@pytest.mark.parametrize("n,share,folds", [(503, 0.2, 5), (40, 0.5, 7), (7, 0.3, 5), (3, 0.9, 2)])
def test_split_and_folds_found_together(spark, n, share, folds):
    df = spark.range(n).repartition(3)
    for keys in (["id"], split.PortableKeys(["id"])):
        got = split.split_with_folds(df, keys, share, folds).toPandas()
        apart = split.train_test_split(df, keys, share)
        want = split.hash_folds(apart.filter("split = 'train'"), keys, folds).select("id", "fold").toPandas()
        assert dict(zip(want.id, want.fold)) == dict(zip(got[got.split == "train"].id, got[got.split == "train"].fold))
        assert set(got[got.split == "test"].id) == {r.id for r in apart.filter("split = 'test'").collect()}


@pytest.mark.parametrize("bins,buffer", [(4096, 20_000), (64, 3), (64, 1)])
def test_cuts_equal_sorted_hashes_at_any_size_of_bins(spark, monkeypatch, bins, buffer):
    monkeypatch.setattr(hashes, "BINS", bins)
    monkeypatch.setattr(hashes, "BUFFER", buffer)
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 52, 800)
    h[:200] = h[200]  # many equal ones
    h[300:330] = h[400:430]
    g = rng.integers(0, 3, 800)
    df = spark.createDataFrame([(int(a) if a < 2 else None, float(b)) for a, b in zip(g, h)], "g int, h double").repartition(3)
    ranks = {0: [0, 5, 100], 1: [3, 150]}
    cuts, sizes = hashes.ranked(df, 2, F.col("g"), F.col("h"), lambda n: ranks)
    assert sizes == {0: (g == 0).sum(), 1: (g == 1).sum()}
    for group, places in ranks.items():
        mine = np.sort(h[g == group])
        for r in places:
            cut = cuts[group, r]
            assert (cut.value, cut.below, cut.at) == (mine[r], (mine < mine[r]).sum(), (mine == mine[r]).sum())
    assert (hashes.split_and_folds(df.withColumn("x", F.col("h")), F.col("h"), F.col("x"), 0.25, 4) is None) == (buffer < 200 and bins == 64)


def test_the_source_is_read_once_for_a_regression(spark):
    pdf, df = frame(spark)
    read = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    seen = df.mapInPandas(watched, df.schema)
    linear.regression_models(seen, ["a", "b"], "y", ["id"], {"m": 0.0}).collect()
    assert read.value == len(pdf)


def test_target_kind_and_codes(spark):
    df = spark.range(100).select(F.col("id").alias("many"), (F.col("id") % 3).alias("few"), (F.col("id") % 10).alias("tenth"))
    assert [split.target_kind(df, c).first().kind for c in ("many", "few", "tenth")] == ["continuous", "categorical", "continuous"]
    coded = split.label_encode(spark.createDataFrame([("b",), ("a",), (None,)], "k string"), "k", "i").collect()
    assert {r.k: r.i for r in coded} == {"a": 0, "b": 1, None: None}


@pytest.mark.parametrize("alpha", [0.0, 50.0])
def test_regression_matches_closed_form(spark, alpha):
    _, df = frame(spark)
    rows = split.train_test_split(df, ["id"], 0.2)
    got = {(r.model, r.measure): r.value for r in linear.regression_models(rows, ["a", "b", "c"], "y", ["id"], {"m": alpha}).collect()}
    table = split.hash_folds(rows.filter("split = 'train'"), ["id"]).toPandas()
    x, y = table[["a", "b", "c"]].to_numpy(), table.y.to_numpy()
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / sd

    def fit(z, y):
        w = np.linalg.solve((z - z.mean(0)).T @ (z - z.mean(0)) + alpha * np.eye(3), (z - z.mean(0)).T @ (y - y.mean()))
        return w, y.mean() - z.mean(0) @ w

    w, b = fit(z, y)
    np.testing.assert_allclose([got[("m", f"coefficient {c}")] for c in "abc"], w)
    cv = []
    for f in range(5):
        held = (table.fold == f).to_numpy()
        wf, bf = fit(z[~held], y[~held])
        cv.append(1 - ((y[held] - z[held] @ wf - bf) ** 2).sum() / ((y[held] - y[held].mean()) ** 2).sum())
    assert got[("m", "cv mean")] == pytest.approx(np.mean(cv)) and got[("m", "cv sd")] == pytest.approx(np.std(cv))
    test = rows.filter("split = 'test'").toPandas()
    gap = test.y - ((test[["a", "b", "c"]].to_numpy() - mean) / sd @ w + b)
    assert got[("m", "test rmse")] == pytest.approx(np.sqrt((gap ** 2).mean()))
    assert got[("m", "test mape")] == pytest.approx((gap.abs() / test.y.abs()).mean())


def test_components_keep_all_variance_when_all_are_kept(spark):
    _, df = frame(spark)
    rows = split.train_test_split(df, ["id"], 0.2)
    plain = linear.regression_models(rows, ["a", "b", "c"], "y", ["id"], {"m": 0.0})
    full = linear.regression_models(rows, ["a", "b", "c"], "y", ["id"], {"m": 0.0}, True, 3)
    row = linear.compare_components(plain, full).first()
    assert row.diff_test_r2 == pytest.approx(0, abs=1e-9) and row.diff_cv_mean == pytest.approx(0, abs=1e-9)


def test_components_match_eigenvectors_and_scores_are_centred(spark):
    pdf, df = frame(spark)
    x = pdf[["a", "b", "c"]].to_numpy()
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    got = linear.pca_variance(df, ["a", "b", "c"]).toPandas()
    np.testing.assert_allclose(got.ratio, values / values.sum())
    scores = linear.pca_scores(df, ["a", "b", "c"], 2).toPandas()
    assert abs(scores.PC1.mean()) < 1e-9 and scores.PC1.var(ddof=0) == pytest.approx(values[0])
    loadings = linear.pca_loadings(df, ["a", "b", "c"]).toPandas()
    assert (loadings[loadings.is_top].loading > 0).all() and loadings.is_top.sum() == 3


def test_summary_of_least_squares(spark):
    pdf, df = frame(spark)
    x = np.column_stack([np.ones(len(pdf)), pdf.a, pdf.b])
    b, sse, *_ = np.linalg.lstsq(x, pdf.y, rcond=None)
    s2 = sse[0] / (len(pdf) - 3)
    got = linear.lm_coefficients(df, ["a", "b"], "y").toPandas()
    np.testing.assert_allclose(got.estimate, b)
    np.testing.assert_allclose(got.std_error, np.sqrt(s2 * np.diag(np.linalg.inv(x.T @ x))))
    row = linear.lm_summary(df, ["a", "b"], "y").first()
    assert row.sigma == pytest.approx(np.sqrt(s2)) and row.df == len(pdf) - 3
    fit = linear.ordinary_fit(df, ["a", "b"], "y")
    rows = linear.with_residuals(df, fit, standardized=True).toPandas()
    hat = np.diag(x @ np.linalg.inv(x.T @ x) @ x.T)
    want = (pdf.y - x @ b) / np.sqrt(s2 * (1 - hat))
    np.testing.assert_allclose(rows.sort_values("id").std_residual, want, rtol=1e-8)
    assert abs((rows.residual * rows.a).sum()) < 1e-6


def test_mape_floor(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0)], "y double, p double")
    assert linear.regression_metrics(df, "y", "p").first().mape == 0.25


def test_metrics_from_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    row = metrics.classification_metrics(df, "y", "p").first()
    assert row.accuracy == 0.6 and row.f1_micro == 0.6
    assert row.precision_macro == pytest.approx((1 + 1 / 3 + 0) / 3) and row.recall_macro == pytest.approx((2 / 3 + 1 + 0) / 3)
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert len(cells) == 9 and sum(cells.values()) == 5 and cells[(2, 2)] == 0
    report = {r.name: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert report["2"].precision == 0.0 and report["weighted avg"].support == 5


def test_auc_equals_pair_counting_with_ties(spark):
    score, label = RNG.integers(0, 6, 120) / 5, RNG.integers(0, 2, 120)
    df = spark.createDataFrame([(int(y), float(s), float(1 - s)) for y, s in zip(label, score)], "y int, s1 double, s0 double")
    pos, neg = score[label == 1], score[label == 0]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    areas = {r["class"]: r.auc for r in metrics.auc_by_class(df, "y", {0: "s0", 1: "s1"}).collect()}
    assert areas[1] == pytest.approx(want) and areas[0] == pytest.approx(want)
    curve = metrics.roc_curve(df, "y", {1: "s1"}).toPandas().sort_values(["fpr", "tpr"])
    assert np.trapezoid(curve.tpr, curve.fpr) == pytest.approx(want)
    assert (curve.fpr.iloc[0], curve.tpr.iloc[-1]) == (0, 1)


@pytest.fixture(scope="module")
def blobs(spark):
    n = 1500
    k = RNG.integers(0, 3, n)
    x = RNG.normal(size=(n, 3)) * 0.7
    x[:, 0] += k * 2.5
    x[:, 1] -= k
    pdf = pd.DataFrame(x, columns=["a", "b", "noise"]).assign(k=[f"class {i}" for i in k], id=np.arange(n))
    return spark.createDataFrame(pdf).repartition(4)


def test_logistic_gradient_vanishes(blobs):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    model = classify.train_logistic(task.train, task.features)
    rows = model.predict(task.train).toPandas()
    p, y = np.stack(rows.probability), np.eye(3)[rows.label]
    gradient = (p - y).T @ rows[task.features].to_numpy() + model.model.weights
    assert np.abs(gradient).max() < 0.005 and abs((p - y).sum(axis=0)).max() < 0.005
    assert classify.accuracy_of(model, task.test) > 0.9


def test_perceptron_learns_and_ranks_inputs(blobs):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    options = classify.PerceptronOptions(hidden=(20, 10), learning_rate=0.01, batch=50, max_iter=15)
    model = classify.train_perceptron(task.train, task.features, task.keys, 3, options)
    assert classify.accuracy_of(model, task.test) > 0.9 and 1 <= model.iterations <= 15
    assert len(model.input_importance()) == 3
    ranking = classify.permutation_importance({"m": model}, task.test, task.features, task.keys, 3).collect()
    assert ranking[0].feature == "a" and abs(ranking[-1].importance) < 0.05
    again = classify.train_perceptron(task.train, task.features, task.keys, 3, options)
    np.testing.assert_allclose(again.weights, model.weights, rtol=1e-6, atol=1e-8)


def test_perceptron_gradient_is_the_slope():
    shapes = [(3, 4), (4, 2)]
    flat = RNG.normal(size=sum((r + 1) * c for r, c in shapes))
    x, y = RNG.normal(size=(10, 3)), RNG.integers(0, 2, 10)
    g, _ = perceptron.gradient(flat, shapes, x, y)
    for i in range(0, len(flat), 5):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        slope = (perceptron.gradient(flat + step, shapes, x, y)[1] - perceptron.gradient(flat - step, shapes, x, y)[1]) / 2e-6
        assert g[i] == pytest.approx(slope, abs=1e-5)


def plain_adam(x, y, dealt, held, classes, o, epochs):
    """Adam in one process over the batches of ``batch_numbers``: loss of each epoch and the last weights."""
    run = perceptron.Run(x.shape[1], classes, int((~held).sum()), o)
    w, shapes, losses = run.weights.copy(), run.shapes, []
    m, v, done = np.zeros_like(w), np.zeros_like(w), 0
    for epoch in range(epochs):
        number, lost = perceptron.batch_numbers(dealt, o.seed, epoch, run.steps), 0.0
        for step in range(run.steps):
            pick = ~held & (number == step)
            g, loss = perceptron.gradient(w, shapes, x[pick], y[pick])
            g = (g + o.alpha * run.decays * w) / pick.sum()
            done, lost = done + 1, lost + loss
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - run.rate * (m / (1 - 0.9 ** done)) / (np.sqrt(v / (1 - 0.999 ** done)) + 1e-8 / np.sqrt(1 - 0.999 ** done))
        losses.append(lost / (~held).sum())
    return losses, w


def test_perceptrons_equal_one_process_and_do_not_depend_on_files(blobs):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    options = [classify.PerceptronOptions(hidden=(8,), learning_rate=0.01, batch=100, max_iter=4, patience=99),
               classify.PerceptronOptions(hidden=(6, 5), alpha=0.1, batch=300, max_iter=3, patience=99)]
    got = classify.train_perceptrons(task.train, task.features, task.keys, 3, options)
    rows = task.train.select(*task.features, "label", F.xxhash64("id").alias("dealt"),
                             (split.key_hash(["id"], 43) < 0.1 * 16.0 ** 13).alias("held")).toPandas()
    x, y = rows[task.features].to_numpy(), rows.label.to_numpy()
    for model, o in zip(got, options):
        losses, _ = plain_adam(x, y, rows.dealt.to_numpy(), rows.held.to_numpy(), 3, o, o.max_iter)
        np.testing.assert_allclose(model.losses, losses, rtol=1e-6)
        assert model.iterations == o.max_iter
    other = classify.train_perceptrons(task.train.repartition(2, "noise"), task.features, task.keys, 3, options)
    assert all((a.weights == b.weights).all() for a, b in zip(got, other))


def test_perceptron_asks_patience_every_epoch():
    o = classify.PerceptronOptions(patience=2, batch=10)
    run = perceptron.Run(1, 2, 10, o)
    size, asked = len(run.weights), 0
    while not run.done:
        run.advance(np.concatenate([np.zeros(size), [1.0, 10.0, 4.0, 3.0]]))  # the same score every epoch
        asked += 1
    assert run.epoch == 3 and asked == 4
    empty = perceptron.Run(1, 2, 0, classify.PerceptronOptions(max_iter=3))
    while not empty.done:
        empty.advance(np.zeros(size + 4))
    assert empty.epoch <= 3 and np.isfinite(empty.weights).all()


def test_large_tables_have_few_large_batches():
    run = perceptron.Run(3, 2, 10 ** 9, classify.PerceptronOptions())
    assert run.steps == perceptron.MOST_STEPS and 0.001 < run.rate <= perceptron.MOST_RATE
    small = perceptron.Run(3, 2, 700, classify.PerceptronOptions())
    assert small.steps == 4 and small.rate == 0.001
    numbers = perceptron.batch_numbers(np.arange(10_000) * 977, 1, 5, 6)
    assert np.bincount(numbers, minlength=6).min() > 1500 and (numbers != perceptron.batch_numbers(np.arange(10_000) * 977, 1, 6, 6)).any()


def test_kernel_maps():
    x = RNG.normal(size=(20, 2))
    poly = machines.feature_map(2, machines.KernelOptions("poly"), 0.4)(x)
    np.testing.assert_allclose(poly @ poly.T, (0.4 * x @ x.T) ** 3, atol=1e-9)
    waves = machines.feature_map(2, classify.KernelOptions(random_features=20_000), 0.5)(x)
    gap = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.testing.assert_allclose(waves @ waves.T, np.exp(-0.5 * gap), atol=0.05)


def test_rbf_solves_a_ring(spark):
    x = RNG.uniform(-1, 1, (800, 2))
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(k=np.where((x ** 2).sum(1) < 0.5, "in", "out"), id=np.arange(800))
    task = classify.classification_task(spark.createDataFrame(pdf), ["a", "b"], "k", ["id"])
    rbf = classify.train_svm(task.train, task.features, 2)
    flat = classify.train_svm(task.train, task.features, 2, classify.KernelOptions("linear"))
    assert classify.accuracy_of(rbf, task.test) > 0.93 > classify.accuracy_of(flat, task.test)


def duality_gap(z, side, weights, intercept, c):
    """Hinge objective of a machine (penalty 1 / (c n)) less a lower bound of its minimum: the dual objective at the
    nearest feasible multipliers that the machine's own margins suggest."""
    n = len(side)
    penalty, t = 1 / (c * n), side * (z @ weights + intercept)
    primal = np.maximum(1 - t, 0).mean() + penalty / 2 * weights @ weights
    band = machines.BANDS[-1]
    a = np.clip((1 + band - t) / (2 * band), 0, 1)
    plus, minus = a[side > 0].sum(), a[side < 0].sum()
    a[side > 0] *= min(plus, minus) / plus
    a[side < 0] *= min(plus, minus) / minus
    moved = z.T @ (a * side) / n
    return primal, primal - (a.mean() - moved @ moved / (2 * penalty))


@pytest.mark.parametrize("o", [machines.KernelOptions("linear"), machines.KernelOptions("linear", c=0.01), machines.KernelOptions("poly", c=10.0),
                               machines.KernelOptions(random_features=60), machines.KernelOptions(c=0.1, gamma=2.0, random_features=60)])
def test_machines_are_optimal(blobs, o):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    model = machines.train_machines(task.train.persist(), task.features, 3, [o])[0]
    rows = task.train.toPandas()
    z = machines.feature_map(3, o, model.gamma)(rows[task.features].to_numpy())
    assert model.pairs == [(0, 1), (0, 2), (1, 2)]
    for (a, b), weights, intercept in zip(model.pairs, model.coefficients, model.intercepts):
        mine = rows.label.isin([a, b]).to_numpy()
        primal, gap = duality_gap(z[mine], np.where(rows.label[mine] == a, 1.0, -1.0), weights, intercept, o.c)
        assert -1e-9 <= gap < 3e-3
        # steps down the hinge itself do not gain a thousandth either
        x, side, best = np.column_stack([z[mine], np.ones(mine.sum())]), np.where(rows.label[mine] == a, 1.0, -1.0), primal
        w, penalty = np.append(weights, intercept), np.append(np.full(len(weights), 1 / (o.c * mine.sum())), 0.0)
        for step in range(1, 3000):
            w = w + 0.3 / step ** 0.7 * ((x * (side * (side * (x @ w) < 1))[:, None]).mean(axis=0) - penalty * w)
            best = min(best, np.maximum(1 - side * (x @ w), 0).mean() + (penalty * w * w).sum() / 2)
        assert primal - best < 1e-3


def test_machines_together_equal_machines_alone(blobs, monkeypatch):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    rows = task.train.repartition(5).persist()
    wanted = [machines.KernelOptions(random_features=20), machines.KernelOptions("linear"), machines.KernelOptions(random_features=20, c=10.0)]
    together = machines.train_machines(rows, task.features, 3, wanted)
    monkeypatch.setattr(newton, "SYSTEM_CELLS", 10)  # one after another
    monkeypatch.setattr(sums, "DIRECT_VALUES", 0)  # through lanes
    for o, other in zip(wanted, together):
        alone = machines.train_machines(rows, task.features, 3, [o])[0]
        np.testing.assert_allclose(alone.coefficients, other.coefficients, rtol=1e-6, atol=1e-9)
    row = task.test.select(machines.voted(together).alias("v"), *task.features, "label")
    assert [r.v[1] for r in row.collect()] == [r.prediction for r in machines.with_probabilities(together[1], rows).predict(row).collect()]


def test_softmax_equals_the_library_and_folds_equal_single_fits(blobs):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    rows = split.hash_folds(task.train, ["id"], 3, label="label").persist()
    got = softmax.fit_softmax(rows, task.features, 3, 0.01)
    want = LogisticRegression(regParam=0.01, standardization=False, maxIter=500, tol=1e-12, family="multinomial").fit(
        VectorAssembler(inputCols=task.features, outputCol="features").transform(rows))
    np.testing.assert_allclose(got.weights, want.coefficientMatrix.toArray(), atol=1e-4)
    np.testing.assert_allclose(got.intercepts, want.interceptVector.toArray(), atol=1e-4)
    counts = {f: rows.filter(F.col("fold") != f).count() for f in range(3)}
    folds = softmax.fit_without_each_fold(rows, task.features, 3, dict.fromkeys(counts, 0.01), counts)
    for f in counts:
        alone = softmax.fit_softmax(rows.filter(F.col("fold") != f), task.features, 3, 0.01)
        np.testing.assert_allclose(folds[f].weights, alone.weights, atol=1e-6)


def test_retraining_without_the_weakest_feature(blobs):
    o = classify.PerceptronOptions(hidden=(8,), learning_rate=0.02, batch=100, max_iter=12)
    study = classify.retrained_without_weakest(blobs, ["a", "b", "noise"], "k", ["id"], o, 3)
    assert study.weakest == "noise"
    rows = {r.features: r for r in classify.retrained_metrics(study).collect()}
    cells = classify.retrained_cells(study).toPandas()
    for name, _, task, model in study.named():
        table = model.predict(task.test).toPandas()
        assert rows[name].accuracy == pytest.approx((table.label == table.prediction).mean())
        mine = cells[cells.features == name]
        assert mine.n.sum() == len(table) and mine[mine.actual == mine.predicted].n.sum() == (table.label == table.prediction).sum()
        p, y = np.stack(table.probability), table.label.to_numpy()
        areas = [np.mean([(u > v) + 0.5 * (u == v) for u in p[y == k, k] for v in p[y != k, k]]) for k in range(3)]
        assert rows[name].auc_macro == pytest.approx(np.mean(areas))
    assert rows["reduced"].accuracy_change == pytest.approx(rows["reduced"].accuracy - rows["all"].accuracy)


def test_permuted_copies_only_move_one_column(blobs):
    rows = blobs.select("id", "a", "b", F.lit(0).alias("label"))
    got = classify.permuted_copies(rows, ["a", "b"], ["id"], 2, 1, per_bucket=200).toPandas()
    whole = rows.toPandas()
    assert len(got) == 4 * len(whole)
    for (feature, _), part in got.groupby(["feature", "repeat"]):
        np.testing.assert_allclose(np.sort(part[feature]), np.sort(whole[feature]))
        merged = set(zip(part.a, part.b)) & set(zip(whole.a, whole.b))
        assert len(merged) < 0.05 * len(whole)


def test_regression_report_picks_the_model_by_target(spark):
    _, df = frame(spark, 400)
    df = df.withColumn("side", (F.col("a") > 3).cast("int"))
    assert {r.model for r in reports.regression_report(df, ["a", "b"], "side", ["id"]).collect()} == {"logistic"}
    assert {r.model for r in reports.regression_report(df, ["a", "b"], "y", ["id"]).collect()} == {"linear", "ridge"}


def test_search_on_parts_ends_at_the_minimum_of_all_rows(blobs, monkeypatch):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    rows, n = classify.spread_out(task.train.select(*task.features, "label"))
    rows = rows.persist()
    options = [machines.KernelOptions("linear"), machines.KernelOptions(random_features=30)]
    plain, whole = machines.train_machines(rows, task.features, 3, options), softmax.fit_softmax(rows, task.features, 3, 1.0 / n)
    monkeypatch.setattr(sums, "START_ROWS", 60)
    monkeypatch.setattr(sums, "GROWTH", 4)
    assert sums.shares(n) == [16, 4] and sums.shares(200) == []
    jobs, measured = [], newton._measured
    monkeypatch.setattr(newton, "_measured", lambda rows, *rest: jobs.append(rows.count()) or measured(rows, *rest))
    parted, fit = machines.train_machines(rows, task.features, 3, options), softmax.fit_softmax(rows, task.features, 3, 1.0 / n)
    x, y = rows.toPandas()[task.features].to_numpy(), rows.toPandas().label.to_numpy()
    np.testing.assert_allclose(fit.weights, whole.weights, atol=1e-3)
    for a, b in zip(plain, parted):
        assert b.jobs < a.jobs
        for i, (p, q) in enumerate(a.pairs):
            mine = (y == p) | (y == q)
            objective = [np.maximum(0, 1 - np.where(y[mine] == p, 1, -1) * m.sides()(x[mine])[:, i]).mean()
                         + (m.coefficients[i] ** 2).sum() / 2 / mine.sum() for m in (a, b)]
            assert objective[1] == pytest.approx(objective[0], rel=0.01, abs=1e-3)
    assert jobs[-1] == n and jobs.count(n) < len(jobs) / 2


def test_perceptron_on_parts_ends_on_all_rows(blobs, monkeypatch):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    monkeypatch.setattr(sums, "START_ROWS", 200)
    monkeypatch.setattr(sums, "GROWTH", 4)
    monkeypatch.setattr(perceptron, "BLOCK", 32)
    seen, step = [], perceptron._step
    monkeypatch.setattr(perceptron, "_step", lambda *given: seen.append(given[0].count()) or step(*given))
    o = classify.PerceptronOptions(hidden=(12, 6), learning_rate=0.02, batch=50, max_iter=5, patience=2)
    model = classify.train_perceptron(task.train, task.features, task.keys, 3, o)
    most = max(seen)
    assert seen[-1] == most and most >= 32 and min(seen) < most / 2
    assert len(model.losses) == model.iterations == seen.count(most) // perceptron.MOST_STEPS
    assert classify.accuracy_of(model, task.test) > 0.9
    again = classify.train_perceptron(task.train.repartition(3, "noise"), task.features, task.keys, 3, o)
    assert (again.weights == model.weights).all()
    run = perceptron.Run(1, 2, 10, o)
    run.best, run.best_score = run.weights + 1, 1.0
    run.go_on(100)
    start, size = run.weights, len(run.weights)
    run.advance(np.concatenate([np.ones(size), [1.0, 10.0, 4.0, 4.0]]))
    while run.epoch < 1:
        run.advance(np.concatenate([np.ones(size), [1.0, 10.0, 0.0, 0.0]]))
    run.advance(np.concatenate([np.ones(size), [1.0, 10.0, 4.0, 3.0]]))
    assert (run.best != start).any()  # worse on the held-back rows, but trained on all


def test_probabilities_of_few_and_many_classes_agree(spark, monkeypatch):
    model = softmax.Softmax(RNG.normal(size=(3, 2)), RNG.normal(size=3))
    df = spark.createDataFrame([(1.0, 2.0), (-800.0, 900.0), (0.0, 0.0)], "a double, b double")
    plain = df.select(model.probability([F.col("a"), F.col("b")]).alias("p"))
    assert "lambda" not in plain._jdf.queryExecution().analyzed().toString()
    got = [r.p for r in plain.collect()]
    monkeypatch.setattr(softmax, "PLAIN_CLASSES", 0)
    assert got == [r.p for r in df.select(model.probability([F.col("a"), F.col("b")]).alias("p")).collect()]


def test_parts_take_little_patience_and_all_rows_take_short_steps(blobs, monkeypatch):
    run = perceptron.Run(3, 2, 10 ** 7, classify.PerceptronOptions())
    first = run.rate
    run.go_on(10 ** 8)
    assert run.rate < first and run.patience == 10
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    monkeypatch.setattr(sums, "START_ROWS", 200)
    monkeypatch.setattr(sums, "GROWTH", 4)
    waits, ends = [], perceptron.Run._ends
    monkeypatch.setattr(perceptron.Run, "_ends", lambda self, score: waits.append((self.went_on, self.patience, self.kind)) or ends(self, score))
    classify.train_perceptron(task.train, task.features, task.keys, 3, classify.PerceptronOptions(hidden=(6,), max_iter=3, patience=9))
    assert set(waits) == {(False, perceptron.PART_PATIENCE, np.float32), (True, 9, np.float32)}


def test_classes_alone_are_those_of_the_prediction(blobs, monkeypatch):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    models = {"net": classify.train_perceptron(task.train, task.features, task.keys, 3, classify.PerceptronOptions(hidden=(8,), max_iter=3)),
              "svm": classify.train_svm(task.train, task.features, 3, machines.KernelOptions("linear")),
              "logit": classify.train_logistic(task.train, task.features)}
    for model in models.values():
        got = model.predict_class(task.test, "class").toPandas().sort_values("id")
        assert (got["class"].to_numpy() == model.predict(task.test).toPandas().sort_values("id").prediction.to_numpy()).all()
    dealt, copies = [], classify.permuted_copies
    monkeypatch.setattr(classify, "permuted_copies", lambda *a: dealt.append(1) or copies(*a))
    together = {(r.model, r.feature): r.importance for r in classify.permutation_importance(
        models, task.test, task.features, task.keys, 2).collect()}
    apart = {(r.model, r.feature): r.importance for n, m in models.items() for r in classify.permutation_importance(
        {n: m}, task.test, task.features, task.keys, 2).collect()}
    assert together == pytest.approx(apart) and len(together) == 9 and len(dealt) == 4


def test_copies_are_scored_where_they_are_made(blobs):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    models = {"net": classify.train_perceptron(task.train, task.features, task.keys, 3, classify.PerceptronOptions(hidden=(8,), max_iter=3)),
              "logit": classify.train_logistic(task.train, task.features)}
    test = task.test.select("id", *task.features, "label")
    copies = classify.permuted_copies(test, task.features, ["id"], 3, 5, 100)
    counted = classify.permuted_copies(test, task.features, ["id"], 3, 5, 100, models)
    whole, found = test.count(), {}
    for r in counted.groupBy("feature", "repeat").agg(F.sum("n"), F.sum("class 0"), F.sum("class 1")).collect():
        assert r[2] == whole
        found[r.feature, r.repeat] = r[3:]
    for i, model in enumerate(models.values()):
        for r in model.predict_class(copies, "c").groupBy("feature", "repeat").agg(F.sum((F.col("c") == F.col("label")).cast("int"))).collect():
            assert found[r.feature, r.repeat][i] == r[2]
        assert found[None, None][i] == model.predict_class(test, "c").filter("c = label").count()
    # no sort of every copy is left, and no copy reaches another operator
    assert "Window" not in counted._jdf.queryExecution().toString() and "Generate" not in counted._jdf.queryExecution().toString()


def test_first_part_keeps_its_size_on_any_table():
    # most steps of a search are taken there, so their cost must not grow with the table
    for n in (1_600_000, 2_520_000, 10_000_000, 25_200_000, 151_200_000, 2_000_000_000):
        found = sums.shares(n)
        assert sums.START_ROWS <= n / found[0] < sums.LEAST_GROWTH * sums.START_ROWS and found == sorted(found, reverse=True)
        assert found[-1] == sums.GROWTH or len(found) == 1
    assert sums.shares(25_200_000) == [128, 16] and sums.shares(1_000_000) == []


def test_networks_of_a_step_share_rows_and_stay_apart(blobs):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    rows = perceptron.spread_out(task.train.select(*task.features, "label", F.xxhash64("id").alias("dealt"), perceptron.key_hash(["id"], 43).alias("held 42")))[0]
    blocks = perceptron._blocks(rows, task.features, [(42, 0.1)])
    runs = [perceptron.Run(3, 3, 100, classify.PerceptronOptions(hidden=h, batch=20), k)
            for h, k in (((8,), np.float64), ((6, 4), np.float64), ((8,), np.float32))]
    plan = {i: r.task() for i, r in enumerate(runs)}
    together = perceptron._step(blocks, 8, 3, plan)
    for i, given in plan.items():
        np.testing.assert_allclose(perceptron._step(blocks, 8, 3, {i: given})[i], together[i], rtol=1e-12, atol=1e-12)
    pdf = task.train.withColumn("dealt", F.xxhash64("id")).withColumn("held", perceptron.key_hash(["id"], 43)).toPandas()
    away = pdf.held.to_numpy() < 0.1 * 16.0 ** perceptron.HASH_DIGITS
    pick = ~away & (perceptron.batch_numbers(pdf.dealt.to_numpy(), 42, 0, runs[0].steps) == 0)
    g, loss = perceptron.gradient(runs[0].weights, runs[0].shapes, pdf[task.features].to_numpy()[pick], pdf.label.to_numpy()[pick])
    np.testing.assert_allclose(together[0], [*g, loss, pick.sum(), away.sum(), together[0][-1]], rtol=1e-9, atol=1e-9)


def test_gradients_of_single_precision_are_those_of_double():
    run, rng = perceptron.Run(3, 3, 100, classify.PerceptronOptions(hidden=(9, 5))), np.random.default_rng(3)
    x, y = rng.normal(size=(700, 3)), rng.integers(0, 3, 700)
    (exact, loss), (single, other) = (perceptron.gradient(run.weights.astype(kind), run.shapes, x.astype(kind), y) for kind in (np.float64, np.float32))
    np.testing.assert_allclose(single, exact, rtol=1e-3, atol=1e-2)
    assert single.dtype == np.float32 and other == pytest.approx(loss, rel=1e-5)
    many = rng.normal(size=(5, 12))
    np.testing.assert_allclose(perceptron.softmax(many), np.exp(many) / np.exp(many).sum(axis=1, keepdims=True))


def test_large_systems_are_eliminated_and_singular_ones_are_not():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(150, 150))
    for system in (a @ a.T + np.eye(150), np.diag([1.0] * 149 + [0.0])):
        gradient = system @ rng.normal(size=150)
        np.testing.assert_allclose(newton._eliminated(system, gradient), newton._least_squares(system, gradient), rtol=1e-6, atol=1e-6)


def test_waves_of_single_precision_keep_far_values():
    o, x = machines.KernelOptions(), np.array([[0.3, -1.2], [1e5, -3e5], [2e6, 1.0]])
    for kernel in ("rbf", "linear", "poly"):
        exact, single = (machines.feature_map(2, machines.KernelOptions(kernel), 0.5, kind)(x) for kind in (np.float64, np.float32))
        assert single.dtype == np.float32
        np.testing.assert_allclose(single, exact, rtol=1e-6, atol=1e-6)


def test_machines_of_large_tables_are_those_of_double_precision(blobs, monkeypatch):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    rows = classify.spread_out(task.train.select(*task.features, "label"))[0].persist()
    options = [machines.KernelOptions(random_features=30), machines.KernelOptions("poly")]
    double = machines.train_machines(rows, task.features, 3, options)
    monkeypatch.setattr(machines, "shares", lambda n: [16])
    single = machines.train_machines(rows, task.features, 3, options)
    x = task.test.toPandas()[task.features].to_numpy()
    for a, b in zip(double, single):
        assert (a.kind, b.kind) == (np.float64, np.float32)
        assert (a.rule()(x) == b.rule()(x)).mean() > 0.98
        assert (machines.with_probabilities(b, rows).predict(task.test).toPandas().prediction.to_numpy() == b.rule()(x)).all()


def test_sweep_trains_all_models_once(blobs, monkeypatch):
    task = classify.classification_task(blobs, ["a", "b", "noise"], "k", ["id"])
    calls, train = [], {n: getattr(classify, n) for n in ("train_perceptrons", "train_machines")}
    for name in train:
        monkeypatch.setattr(classify, name, lambda *given, name=name: calls.append(name) or train[name](*given))
    o, kernel = classify.PerceptronOptions(hidden=(6,), max_iter=2), machines.KernelOptions(random_features=20, max_iter=8)
    trained = classify.sweep_models(task, o, kernel, probabilities=True)
    assert trained["support vector"]["base"].predict(task.test).select("probability").first()[0]
    given = {(r.family, r.configuration): (r.accuracy, r.iterations) for r in classify.parameter_sweep(task, o, kernel, trained).collect()}
    assert calls == ["train_perceptrons", "train_machines"] and len(given) == 12
    alone = classify.train_perceptron(task.train, task.features, task.keys, 3, o)
    assert given["perceptron", "base"] == (pytest.approx(classify.accuracy_of(alone, task.test)), alone.iterations)
