"""The forest behind the tree ranking."""

import time

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from wardwise.operators import forest as T
from wardwise.operators import select as G
from wardwise.operators import train as R


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(1500, 5)), 2)
    x[:, 4] = rng.integers(0, 4, 1500)
    y = (2 * x[:, 0] + x[:, 1] * x[:, 4] / 2 + rng.normal(size=1500) > 0.5).astype(int)
    rows = [(*map(float, r), int(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows + rows[:200], "a double, b double, c double, d double, e double, label int")


def _rows(df):
    return df.select(F.array(*"abcde").alias("x"), "label")


def test_importances_are_near_those_of_spark(data):
    got = T.forest_importances(_rows(data), 60, 30)
    model = RandomForestClassifier(numTrees=60, maxDepth=30, seed=1).fit(
        G.assemble(data, list("abcde")).select("features", F.col("label").cast("double")))
    assert np.isclose(got.sum(), 1) and np.abs(got - model.featureImportances.toArray()).max() < 0.03


def test_partitions_do_not_matter_and_upper_nodes_are_split_in_passes(data):
    whole = T.forest_importances(_rows(data), 20, 30)
    assert np.allclose(whole, T.forest_importances(_rows(data.repartition(7)), 20, 30))
    passes = T.forest_importances(_rows(data), 20, 30, node_rows=150)
    assert np.allclose(passes, T.forest_importances(_rows(data.repartition(5)), 20, 30, node_rows=150))
    assert np.abs(whole - passes).max() < 0.05
    # a tree of one split sees the same whether a pass or a task makes it
    assert T.forest_importances(_rows(data), 30, 1, node_rows=10).argmax() == T.forest_importances(_rows(data), 30, 1).argmax() == 0


def test_scores_of_held_rows(data):
    rest, held = data.where("hash(a, b) % 3 <> 0"), data.where("hash(a, b) % 3 = 0")
    told = lambda cells: R.metrics_of(cells.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), "n")
    cells = T.forest_scores(_rows(rest), _rows(held), 60, 30)
    assert cells.agg(F.sum("n")).first()[0] == held.count()
    model = R.fit(rest, list("abcde"), "RandomForest", {"n_estimators": 60})
    spark_s = R.metrics_of(R.score(model, held, list("abcde")))
    assert all(abs(told(cells)[m] - spark_s[m]) < 0.03 for m in R.METRICS)
    # upper nodes by passes, whatever the partitions
    passes = T.forest_scores(_rows(rest), _rows(held), 60, 30, node_rows=150)
    again = T.forest_scores(_rows(rest.repartition(5)), _rows(held.repartition(3)), 60, 30, node_rows=150)
    assert sorted(map(tuple, passes.collect())) == sorted(map(tuple, again.collect()))
    assert abs(told(passes)["auc"] - spark_s["auc"]) < 0.03
    # one split by a pass: both sides are upper leaves
    stump = T.forest_scores(_rows(rest), _rows(held), 1, 1, node_rows=10).collect()
    assert sum(r.n for r in stump) == held.count() and len({r.probability for r in stump}) <= 2
    # leaves of all rows
    flat = T.forest_scores(_rows(rest), _rows(held), 3, 30, leaf=10_000).select("probability").distinct().collect()
    assert len(flat) == 1 and 0 < flat[0][0] < 1


def test_a_subtree_is_the_best_of_all_splits():
    rng = np.random.default_rng(1)
    bins, y, w = rng.integers(0, 6, (80, 3)).astype(np.uint8), rng.integers(0, 3, 80), rng.integers(1, 3, 80)
    _, gains = T.grow_subtree(bins, y, w, 3, 1, lambda level, m: np.tile(np.arange(3), (m, 1)))

    def score(some):
        c = np.bincount(y[some], w[some], 3)
        return (c * c).sum() / c.sum()

    best = max((score(bins[:, f] <= b) + score(bins[:, f] > b) - score(np.ones(80, bool)), f) for f in range(3) for b in range(5))
    assert gains.sum() == 0 or np.isclose(gains[best[1]], best[0])  # or cut back, as both sides predict the same


def test_odd_tables(spark, data):
    constant = data.withColumn("label", F.lit(0))
    assert not T.forest_importances(_rows(constant), 5, 30).any()
    three = data.withColumn("label", F.col("e").cast("int") % 3)
    assert T.forest_importances(_rows(three), 20, 30).argmax() == 4
    for wrong in (data.withColumn("label", F.when(F.col("a") > 0, 1)), data.withColumn("a", F.when(F.col("a") > 0, F.col("a")))):
        with pytest.raises(Exception, match="whole number|null"):
            G.rank_tree(wrong, list("abcde"), trees=2)


def test_deep_trees_end_soon(spark):
    """One pass a group of deep nodes took minutes."""
    df = spark.range(40_000).select((F.rand(1) < 0.2).cast("int").alias("label"), *[F.rand(i).alias(f"f{i}") for i in range(2, 14)])
    began = time.perf_counter()
    G.rank_tree(df, [f"f{i}" for i in range(2, 14)])
    assert time.perf_counter() - began < 60
