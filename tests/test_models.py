"""Invariants of what has no SQL twin: splits, encoders, rankings, fits, scoring, anomalies."""

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wardwise.operators import cohort as H
from wardwise.operators import evaluate as E
from wardwise.operators import prepare as M
from wardwise.operators import select as G
from wardwise.operators import stats as X
from wardwise.operators import train as R
from wardwise.operators import unsupervised as U
from wardwise.plans import study as S
from wardwise.session import scratch_path
from wardwise.streaming.scoring import score_new_files

TREES = {"RandomForest": {"n_estimators": 5, "max_depth": 3},
         "GradientBoosting": {"n_estimators": 2, "max_depth": 2}}


@pytest.fixture(scope="module")
def table(clinic):
    return S.analysis_table(clinic, "Main")


def test_split_shares_and_determinism(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 9 == 0).cast("int").alias("label"))
    a = M.stratified_split(df, "label", "id", hot_rows=100)
    b = M.stratified_split(df.repartition(11), "label", "id")
    assert a.join(b, ["id", "split"]).count() == 5000
    shares = {(r.label, r.split): r["count"] for r in a.groupBy("label", "split").count().collect()}
    for label, n in ((0, 4444), (1, 556)):
        assert shares[label, "test"] == round(n * 0.2)
        assert shares[label, "val"] == round((n - round(n * 0.2)) * 0.2)
    loose = M.stratified_split(df, "label", "id", exact=False).groupBy("split").count().collect()
    assert all(abs(r["count"] / 5000 - {"test": .2, "val": .16, "train": .64}[r.split]) < .02
               for r in loose)


def test_folds_are_even(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("label"))
    n = M.stratified_folds(df, "label", "id").groupBy("label", "fold").count().toPandas()["count"]
    assert len(n) == 15 and n.max() - n.min() <= 1


def test_label_encode_unseen(frame):
    train, test = frame([("b",), ("a",)], "c string"), frame([("a",), ("z",), (None,)], "c string")
    encoder = M.fit_label_encoder(train, ["c"])
    assert [r.c for r in M.label_encode(train, encoder).collect()] == [1, 0]
    assert [r.c for r in M.label_encode(test, encoder).collect()] == [0, -1, -1]
    fitted = M.fit_one_hot(train, ["c"])
    out, names = M.one_hot(test, fitted)
    assert names == {"c": ["c_a", "c_b"]}
    assert [list(r["c__hot"].toArray()) for r in out.collect()] == [[1, 0], [0, 0], [0, 0]]


def test_constant_column_scales_to_zero(frame):
    df = frame([(3, 1), (3, 2), (3, 3)], "a int, b int")
    out = M.standard_scale(df, M.fit_scaler(df, ["a", "b"])).collect()
    assert [r.a for r in out] == [0, 0, 0]
    assert np.isclose(out[0].b, -np.sqrt(1.5))


def test_yates_and_f_test(frame):
    rows = [("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "x")] * 9 + [("b", "y")] * 20
    r = X.association(frame(rows, "u string, v string"), F.col("u"), F.col("v")).first()
    e = np.outer([17, 29], [21, 25]) / 46
    o = np.array([[12, 5], [9, 20]])
    assert r.dof == 1 and np.isclose(r.chi2, ((np.abs(o - e) - 0.5) ** 2 / e).sum())
    assert np.isclose(r.cramers_v, np.sqrt(r.chi2 / 46))
    # closed forms: F(2, d) has tail (1 + 2f/d)^(-d/2); F(1, 1) is the square of a Cauchy variable
    assert np.isclose(X.f_test_p_value(3.2, 2, 10), (1 + 2 * 3.2 / 10) ** -5)
    assert np.isclose(X.f_test_p_value(4.0, 1, 1), 1 - 2 / np.pi * np.arctan(2.0))
    assert X.f_test_p_value(0.0, 2, 5) == 1.0


def test_correlation_with_nulls(frame):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(a + b) if i % 4 else None, 7.0) for i, (a, b) in
            enumerate(rng.normal(100, 1, (80, 2)))]
    got = {(r.feature_a, r.feature_b): r["corr"]
           for r in X.correlation_matrix(frame(rows, "a double, b double, c double")).collect()}
    pair = np.array([(a, b) for a, b, _ in rows if b is not None])
    assert set(got) == {("a", "a"), ("b", "b"), ("a", "b"), ("b", "a")}
    assert np.isclose(got["a", "b"], np.corrcoef(pair.T)[0, 1])


def test_auc_against_pairs(frame):
    rng = np.random.default_rng(4)
    p, y = np.round(rng.random(300), 2), rng.integers(0, 2, 300)
    df = frame(list(zip(map(float, p), map(int, y), map(int, p > .5))),
               "probability double, label int, prediction int").withColumn("split", F.lit("t"))
    pos, neg = p[y == 1][:, None], p[y == 0][None, :]
    auc = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert np.isclose(E.evaluate_split(df).first().auc, auc)
    assert np.isclose(E.exact_auc(df, ["split"], hot_rows=5).first().auc, auc)
    assert np.isclose(R.metrics_of(df)["auc"], auc)


def test_training_table(table):
    train = table.train
    row = train.agg(*[F.avg(F.col(f"`{f}`")).alias(f) for f in table.features]).first()
    assert all(abs(v) < 1e-6 for v in row)
    assert "patient_nbr" not in table.features and "readmitted" not in table.features
    assert table.data.filter("split = 'val'").count() > 0


def test_full_raw_columns(clinic):
    """The raw file has hyphenated drug columns and two laboratory texts."""
    extra = {"max_glu_serum": F.lit(None).cast("string"), "A1Cresult": F.lit("Norm"),
             "glyburide-metformin": F.col("insulin"), "diabetesMed": F.lit("Yes")}
    raw = clinic.encounters.withColumns(extra)
    t = S.training_table(S.engineered(H.merged_cohort(clinic, raw)))
    assert "glyburide-metformin" in t.features and "max_glu_serum" not in t.features
    ranked = G.rank_mutual_info(t.train, t.features)
    assert ranked.filter("feature = 'glyburide-metformin'").count() == 1
    model = R.fit(t.train, t.features, "LogisticRegression")
    scored = R.batch_score(R.build_scorer(t.encoder, t.scaler, t.features, model), t.raw)
    assert 0 < scored.agg(F.avg("prediction_probability")).first()[0] < 1


def test_balanced(table):
    made = S.balanced(table)
    n = {r.label: r["count"] for r in made.filter("split = 'train'").groupBy("label").count().collect()}
    assert n[0] == n[1]
    assert made.filter("copy > 0 AND split <> 'train'").count() == 0


def test_rankings(table):
    ranked = G.rank_all(table.train, table.features, methods=["L1", "MutualInfo"])
    chosen = G.cut(ranked, [5, 10])
    sizes = {(r.top_n, r.method): r["count"] for r in chosen.groupBy("top_n", "method").count().collect()}
    assert sizes == {(n, m): n for n in (5, 10) for m in ("L1", "MutualInfo")}
    five = set(G.feature_lists(chosen)[5, "L1"])
    assert five < set(G.feature_lists(chosen)[10, "L1"])
    with pytest.raises(ValueError):
        G.select_features("Nothing", table.train, table.features)


def test_rank_tree_finds_the_signal(spark):
    df = spark.range(600).select((F.col("id") % 2).cast("int").alias("label"),
                                 (F.col("id") % 2 * 3.0 + F.rand(1)).alias("signal"),
                                 F.rand(2).alias("noise"))
    for rank in (G.rank_tree, G.rank_l1, G.rank_mutual_info):
        assert rank(df, ["noise", "signal"]).orderBy("rank").first().feature == "signal"


def test_train_and_search(table, spark):
    features = table.features[:6]
    kept, rows = R.train_all(table.train, features, TREES, folds=2)
    assert set(kept) == {"LogisticRegression", "RandomForest", "GradientBoosting"}
    assert all(0 <= r["cv_auc"] <= 1 for r in rows)
    grids = {"LogisticRegression": {"C": [0.1, 1.0]}}
    val, test = R.batch_search(table.data, ["M"], {(6, "M"): features}, [6], grids)
    assert val.count() == 2 and test.count() == 1
    tables, best = R.cv_search_all_methods(table.data, ["M"], {(6, "M"): features}, 6, grids, 2)
    assert best["M", "LogisticRegression"] in R.param_grid(grids["LogisticRegression"])
    cv = tables["M"]["cv"].toPandas()
    assert sorted(cv["rank_test_score"])[0] == 1
    assert np.allclose(cv["mean_test_score"], cv[["split0_test_score", "split1_test_score"]].mean(axis=1))
    assert tables["M"]["val"].first().n_iter is not None


def test_folds_fit_no_spark_forest(table, monkeypatch):
    """Spark's forest of deep trees on all rows did not end; the kept one is fitted when it is asked for."""
    fitted, plain = [], R.fit
    monkeypatch.setattr(R, "fit", lambda train, features, name, *rest: fitted.append(name) or plain(train, features, name, *rest))
    kept, rows = R.train_all(table.train, table.features[:4], TREES, ["LogisticRegression", "RandomForest"], folds=2, balance=S.balance)
    assert fitted == ["LogisticRegression"] * 2 and [r["model_name"] for r in rows] == list(kept)
    assert kept["RandomForest"] is kept["RandomForest"] and fitted[2:] == ["RandomForest"]
    with pytest.raises(KeyError):
        kept["GradientBoosting"]


@pytest.mark.parametrize("name", ["LogisticRegression", "RandomForest", "GradientBoosting"])
def test_fitted_models_score_after_an_observation(spark, name):
    """A session that has taken an Observation is no longer serializable."""
    df = spark.range(200).select((F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 2 * 2.0 + F.rand(1)).alias("a"))
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).collect()
    model = R.fit(df, ["a"], name, TREES.get(name))
    assert seen.get["n"] == 200 and R.metrics_of(R.score(model, df, ["a"]))["auc"] == 1.0


def test_make_model():
    with pytest.raises(ValueError):
        R.make_model("Nothing")


def test_defaults(spark):
    names = {r.model for r in R.model_registry_table(spark).collect()}
    assert names == {"LogisticRegression", "RandomForest", "GradientBoosting"}


def test_saved_scorer_and_stream(table, spark):
    features = table.features[:8]
    model = R.fit(table.train, features, "LogisticRegression")
    path = R.save_models({"m": R.build_scorer(table.encoder, table.scaler, features, model)},
                         scratch_path(spark, "models"))
    scorer = R.load_model(path, "m")
    new = table.raw.drop("label", "split")
    scored = R.batch_score(scorer, new)
    direct = R.score(model, table.data, features, keep=["encounter_id"])
    both = scored.join(direct, "encounter_id").select(
        F.max(F.abs(F.col("prediction_probability") - direct["probability"])).alias("gap"),
        F.count("*").alias("n")).first()
    assert both.n == new.count() and both.gap < 1e-9
    source, target = scratch_path(spark, "arrivals"), scratch_path(spark, "scored")
    state = scratch_path(spark, "state")
    new.repartition(3).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        assert score_new_files(spark, scorer, source, new.schema, target, state).awaitTermination(120)
    assert spark.read.parquet(target).count() == new.count()


def test_clusters_and_components(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.2, (60, 4)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, i % 2, *map(float, r)) for i, r in enumerate(x)],
                               "id int, label int, a double, b double, c double, d double")
    parts, shares = U.pca_2d(df, list("abcd"), "id")
    assert shares[0] > 0.95 and parts.count() == 180
    clustered, inertia = U.kmeans_clusters(parts, ["pc1", "pc2"])
    profile = U.cluster_profile(clustered, ["pc1", "pc2"], "label").toPandas()
    assert list(profile["rows"]) == [60, 60, 60] and 0 < inertia < 180


def test_isolation_forest(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (570, 3)), rng.uniform(8, 12, (30, 3))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "id int, a double, b double, c double")
    out = U.isolation_forest_flags(df, list("abc"), "id").toPandas()
    assert out["anomaly"].sum() == 30 and set(out.loc[out["anomaly"], "id"]) == set(range(570, 600))
    again = U.isolation_forest_flags(df.repartition(9), list("abc"), "id").toPandas()
    assert np.allclose(out.sort_values("id")["anomaly_score"], again.sort_values("id")["anomaly_score"])
