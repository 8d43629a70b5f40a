"""Tree fits of the searches read every row of their part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardwise.operators import batch as B
from wardwise.operators import evaluate as E
from wardwise.operators import train as R
from wardwise.operators.batch import Fit


@pytest.fixture(scope="module")
def data(spark):
    """6,000 training rows: more than the 4,000 that a fit once drew."""
    df = spark.range(9000).select(F.col("id").alias("encounter_id"), F.when(F.col("id") % 3 == 0, "val").otherwise("train").alias("split"),
                                  *[F.floor(F.rand(i) * n).cast("double").alias(c) for i, (c, n) in enumerate(zip("abc", (2, 9, 100)))])
    return df.withColumn("label", (F.rand(7) < 0.2 + 0.3 * F.col("a") + F.col("c") / 400).cast("int")).localCheckpoint()


def test_a_tree_counts_all_rows(data):
    """One round over one feature of two values: the chances follow from the counts of all rows."""
    train = data.where("split = 'train'").groupBy("a").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()
    assert sum(r.n for r in train) == 6000
    fit = Fit.of("GradientBoosting", ["a"], {"n_estimators": 1, "learning_rate": 1.0})
    got = {r.probability for r in R.search_batch(data, ["a"]).scores([fit]).select("probability").distinct().collect()}
    want = [1 / (1 + np.exp(-(r.y - r.n / 2) / (r.n / 4 + 1))) for r in train]
    assert np.allclose(sorted(got), sorted(want), rtol=0, atol=1e-12)


@pytest.mark.parametrize(("model", "params"), [
    ("RandomForest", {"n_estimators": 9, "max_depth": 12}),
    ("GradientBoosting", {"n_estimators": 6, "subsample": 0.7, "colsample_bytree": 0.7})])
def test_steps_partitions_and_tasks_do_not_matter(data, model, params):
    fit, others = Fit.of(model, list("abc"), params), [Fit.of("RandomForest", list(f), {"n_estimators": 1}) for f in ("a", "b", "c", "ab", "ac", "bc", "cb", "ba")]
    told = lambda batch, fits: sorted(map(tuple, batch.scores(fits).where("config = 0").select("label", "probability").collect()))
    batch = R.search_batch(data, list("abc"))
    whole = told(batch, [fit])
    assert len(whole) == 3000 and whole == told(R.search_batch(data.repartition(3), list("abc"), fit_rows=50), [fit])
    assert whole == told(batch, [fit, *others])  # the trees of a forest in one task
    assert batch.metrics([fit])[fit, "val"]["auc"] > 0.6


@pytest.mark.parametrize("known", [True, False])
def test_both_ways_to_split_agree(known):
    rng = np.random.default_rng(4)
    bins, y, w = np.asfortranarray(rng.integers(0, 32, (3000, 5)).astype(np.uint8)), rng.integers(0, 2, 3000), rng.integers(0, 3, 3000)
    rows = None if known else np.sort(rng.choice(3000, 2500, replace=False))
    slot = rng.integers(0, 400, 3000 if known else 2500)
    looked = np.array([rng.choice(5, 3, replace=False) for _ in range(400)])
    for leaf in (1, 4):
        a, b = (way(bins, rows, slot, (w * y).astype(float), w.astype(float), 400, looked, leaf, 0.0, 128) for way in (B._by_histogram, B._by_order))
        found = np.isfinite(a[0])
        assert found.any() and (found == np.isfinite(b[0])).all() and all((p[found] == q[found]).all() for p, q in zip(a, b))
        assert (a[5] == b[5]).all() and (a[6] == b[6]).all()


def test_cuts_are_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 20, 3000), rng.exponential(size=3000)])
    x[:700, 2] = 1.0
    df = spark.createDataFrame([(i, i % 2, "train" if i % 3 else "val", *map(float, r)) for i, r in enumerate(x)],
                               "encounter_id long, label int, split string, a double, b double, c double")
    got = R.search_batch(df, list("abc"), 2).edges([0, 2])
    train = x[np.arange(3000) % 3 > 0]
    for c, cut in zip((0, 2), (got[0][0], got[0][2])):
        assert np.array_equal(cut, np.unique(np.quantile(train[:, c], np.arange(1, 32) / 32, method="lower")))
    assert np.array_equal(got[0][1], np.arange(19) + 0.5) and len(got[2]) == 3 and not np.array_equal(got[2][0], got[0][0])


def test_draws_are_of_rows():
    rng = np.random.default_rng(6)
    bins, w0, w1 = rng.integers(0, 9, (4000, 6)).astype(np.uint8), rng.integers(0, 40, 4000), rng.integers(0, 3, 4000)
    pos, n = np.mean([B.Draws(bins, w0, w1, 1).of(t) for t in range(20)], axis=0)
    assert abs(n.sum() / (w0 + w1).sum() - 1) < 0.01 and abs(pos.sum() / w1.sum() - 1) < 0.02 and not pos[w1 == 0].any()
    some = B.Draws(bins, w0, w1, 1, 0.8)
    (pos, n), (again, _) = some.of(0), some.of(1)
    assert (pos <= w1).all() and (n - pos <= w0).all() and (pos != again).any()
    assert abs(n.sum() / (w0 + w1).sum() - 0.8) < 0.01 and abs(pos.sum() / w1.sum() - 0.8) < 0.02


def test_weighted_metrics_equal_those_of_the_rows(frame):
    rng = np.random.default_rng(4)
    rows = [("t", int(y), int(p > 0.5), float(p), int(n)) for y, p, n in zip(rng.integers(0, 2, 200), np.round(rng.random(200), 2), rng.integers(1, 4, 200))]
    df = frame(rows, "split string, label int, prediction int, probability double, n long")
    many = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    assert E.evaluate_split(df, weight="n").first().asDict() == E.evaluate_split(many).first().asDict()


def test_missing_numbers_are_scored_where_they_were_fitted(spark):
    """With the largest values in a fit, they were scored with the smallest."""
    df = spark.range(600).select(F.col("id").alias("encounter_id"), F.when(F.col("id") % 3 == 0, "val").otherwise("train").alias("split"),
                                 F.when(F.col("id") % 2 == 0, F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("label"))
    fits = [Fit.of("RandomForest", ["a"], {"n_estimators": 5}), Fit.of("GradientBoosting", ["a"], {"n_estimators": 5})]
    got = R.search_batch(df, ["a"]).metrics(fits)
    assert all(got[f, "val"]["auc"] > 0.9 for f in fits)


def test_folds_fit_no_spark_boosting(data, monkeypatch):
    """Spark's boosting ran one fold after the other, some jobs a level of every round."""
    fitted, plain = [], R.fit
    monkeypatch.setattr(R, "fit", lambda train, features, name, *rest: fitted.append(name) or plain(train, features, name, *rest))
    params, train = {"GradientBoosting": {"n_estimators": 5, "max_depth": 3}}, data.where("split = 'train'")
    kept, rows = R.train_all(train, list("abc"), params, ["GradientBoosting"], folds=3)
    assert fitted == [] and 0.6 < rows[0]["cv_auc"] < 1
    assert R.train_feature_sets(train, {(3, "M"): list("abc")}, params, ["GradientBoosting"], folds=3).first().cv_auc == rows[0]["cv_auc"]
    # a single fit is Spark's; both models tell the same rows apart
    model = kept["GradientBoosting"]
    val = data.where("split = 'val'")
    mine = R.held_metrics(train, val, list("abc"), "GradientBoosting", params["GradientBoosting"])
    assert fitted == ["GradientBoosting"] and abs(mine["auc"] - R.metrics_of(R.score(model, val, list("abc")))["auc"]) < 0.03
