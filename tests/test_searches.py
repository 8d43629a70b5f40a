"""Searches run with the study's settings, on balanced rows in search and final fit."""

import numpy as np
import pytest

from wardwise import constants as K
from wardwise.operators import batch as B
from wardwise.operators import train as R
from wardwise.operators.batch import Fit
from wardwise.plans import learning_queries as L
from wardwise.plans import study as S


@pytest.fixture(scope="module")
def table(clinic):
    return S.analysis_table(clinic, "Main")


def test_queries_ask_for_the_whole_search(monkeypatch):
    asked = {}
    monkeypatch.setattr(L, "table", lambda c: type("T", (), {"data": None, "train": None, "features": ["a"]}))
    monkeypatch.setattr(L, "lists", lambda c, tops=L.TOPS, methods=L.METHODS: {
        (n, m): ["a"] for n in tops for m in methods})
    empty = type("D", (), {"withColumn": lambda self, *a: self, "unionByName": lambda self, *a, **k: self})()
    monkeypatch.setattr(L.F, "lit", lambda v: v)
    monkeypatch.setattr(R, "stack_tables", lambda tables, kind: empty)
    monkeypatch.setattr(R, "batch_search", lambda data, methods, lists, tops, grids, folds, **o: asked.setdefault(
        ("batch", folds), (methods, lists, tops, grids, o["balance"])) and (empty, empty))
    monkeypatch.setattr(R, "cv_search_all_methods", lambda data, methods, lists, top, grids, folds, **o: asked.setdefault(
        "all", (methods, grids, folds, o["balance"])) and (0, 0))
    L._batch_searches(None, None)
    L._batch_searches(None, K.CV_FOLDS)
    L._all_methods(None)
    for folds in (None, 5):
        methods, lists, tops, grids, balance = asked["batch", folds]
        assert methods == K.SELECTION_METHODS and set(lists) == {(n, m) for n in (5, 10, 15) for m in K.SELECTION_METHODS}
        assert tops == [5, 10, 15] and set(grids) == set(K.MODEL_NAMES) and balance
    methods, grids, folds, balance = asked["all"]
    assert methods == K.SELECTION_METHODS and folds == 5 and balance
    assert {m: len(R.param_grid(g)) for m, g in grids.items()} == {
        "RandomForest": 6, "LogisticRegression": 4, "GradientBoosting": 4}


@pytest.mark.parametrize("folds", [None, 2])
def test_searches_fit_balanced_rows(table, folds):
    features = table.features[:4]
    batch = R.search_batch(table.data, features, folds, balance=S.balance_over(table.features[:6]))
    n = {(r.part, r.side, r.label): r["count"] for r in batch.rows.groupBy("part", "side", "label").count().collect()}
    parts = range(1 + (folds or 0))
    assert {p for p, *_ in n} == set(parts) and all(n[p, "fit", 0] == n[p, "fit", 1] for p in parts)
    kept = table.data.groupBy("split", "label").count().collect()
    for r in kept:
        if r.split == "train" and folds:
            assert sum(n.get((p, "fold", r.label), 0) for p in parts) == r["count"]
        if r.split != "train":
            assert n[0, r.split, r.label] == r["count"]


def test_rows_of_a_side_go_to_all_tasks(spark):
    """The rows of a side lay in the few files of its table, so one task scored them with all models."""
    rows = spark.range(4000).selectExpr("id encounter_id", "cast(id % 2 as int) label", "cast(id as double) a").coalesce(1)
    stored = B.Batch([B.Part(rows, {"val": rows.where("encounter_id % 4 = 0")})], ["a"]).rows
    files = {r.side: r["count"] for r in stored.selectExpr("side", "input_file_name() f").distinct().groupBy("side").count().collect()}
    assert stored.count() == 5000 and min(files["fit"], files["val"]) >= spark.sparkContext.defaultParallelism


def test_the_cohort_is_read_once(clinic, monkeypatch):
    """Null shares, class sizes, ranks and split each read the base tables and ranked all encounters."""
    wrote, plain = {}, S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, name="stage": wrote.setdefault(name, df) and plain(df, name))
    found = S.analysis_table(clinic, "Main")
    reads = lambda df: any("lineitem" in f for f in df.inputFiles())
    assert reads(wrote["cohort"]) and not reads(wrote["split"]) and found.data.count() == wrote["cohort"].count()


@pytest.fixture(scope="module")
def batch(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = (x @ [1.5, -1.0, 0.4, 0.0] + rng.normal(size=600) > 0.3).astype(int)
    rows = [(i, int(y[i]), "val" if i % 3 == 0 else "train", *map(float, x[i])) for i in range(600)]
    data = spark.createDataFrame(rows, "encounter_id long, label int, split string, a double, b double, c double, d double").repartition(5)
    return x, y, data, R.search_batch(data, list("abcd"), 2)


def test_logistic_fits_equal_single_fits(batch):
    _, _, data, rows = batch
    train = data.filter("split = 'train'")
    fits = [Fit.of("LogisticRegression", f, {"C": c, "penalty": p}) for f in (["a", "b", "c", "d"], ["d", "b"])
            for c in (0.01, 1.0, 100.0) for p in ("l1", "l2")]
    found = rows.logistic(fits)
    for fit in fits:
        p = dict(fit.params)
        single = R.make_model("LogisticRegression", p, train.count()).setTol(1e-13).setMaxIter(3000).fit(
            R._matrix(train, list(fit.features), "label"))
        want = [*single.coefficients.toArray(), single.intercept]
        assert np.allclose(found[fit][0], want, atol=1e-6), (fit, found[fit], want)
        if p["penalty"] == "l1":
            assert [w == 0 for w in found[fit][0]] == [w == 0 for w in want]


@pytest.mark.parametrize(("model", "small", "large"), [
    ("RandomForest", {"n_estimators": 4, "max_depth": 3, "min_samples_leaf": 2}, {"n_estimators": 9, "max_depth": None, "min_samples_leaf": 2}),
    ("GradientBoosting", {"n_estimators": 5, "max_depth": 2, "subsample": 0.8, "colsample_bytree": 0.5},
     {"n_estimators": 12, "max_depth": 2, "subsample": 0.8, "colsample_bytree": 0.5})])
def test_a_contained_fit_equals_a_fit_of_its_own(batch, model, small, large):
    _, _, _, rows = batch
    a, b = Fit.of(model, list("abcd"), small), Fit.of(model, list("abcd"), large)
    assert len(B._staged([a, b])) == 1 and len(B._staged([a])) == 1
    together, alone = rows.metrics([a, b]), rows.metrics([a])
    assert together[a, "val"] == alone[a, "val"] and together[a, "val"] != together[b, "val"]
    assert together[b, "val"]["auc"] > 0.75


def test_metrics_of_many_fits_equal_those_of_one(batch):
    _, _, data, rows = batch
    fits = [Fit.of("LogisticRegression", list("ab"), {"C": c}) for c in (0.1, 1.0)] + [Fit.of("RandomForest", list("abd"), {"n_estimators": 3})]
    got, scores = rows.metrics(fits), rows.scores(fits)
    for i, fit in enumerate(fits):
        want = R.metrics_of(scores.filter(f"config = {i}"))
        assert all(np.isclose(got[fit, "val"][k], v) for k, v in want.items())
    assert scores.filter("config = 0").count() == data.filter("split = 'val'").count()


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(1)
    bins, y, w = rng.integers(0, 6, (80, 3)), rng.integers(0, 2, 80).astype(float), rng.integers(0, 3, 80).astype(float)
    tree = B.grow_tree(bins, w * y, w, 1, 5, 0.0, lambda level, m: np.ones((m, 3), bool))

    def impurity(rows):
        p = (w * y)[rows].sum() / w[rows].sum()
        return w[rows].sum() * 2 * p * (1 - p)

    costs = {(f, b): impurity(bins[:, f] <= b) + impurity(bins[:, f] > b) for f in range(3) for b in range(6)
             if w[bins[:, f] <= b].sum() >= 5 and w[bins[:, f] > b].sum() >= 5}
    assert np.isclose(costs[tree["feature"][0], tree["cut"][0]], min(costs.values()))
    side = bins[:, tree["feature"][0]] <= tree["cut"][0]
    assert np.allclose(tree["value"][1:], [(w * y)[s].sum() / w[s].sum() for s in (side, ~side)])


def test_unknown_parameters_raise():
    for model, params in (("LogisticRegression", {"solver": "x"}), ("Nothing", {})):
        with pytest.raises(ValueError):
            Fit.of(model, ["a"], params)


def test_fits_read_a_bounded_sample(batch):
    _, _, data, _ = batch
    few = R.search_batch(data, list("abcd"), fit_rows=50)
    fit = Fit.of("RandomForest", list("abcd"), {"n_estimators": 5})
    assert len(few.scores([fit]).collect()) == data.filter("split = 'val'").count()
    again = R.search_batch(data.repartition(3), list("abcd"), fit_rows=50)
    assert few.metrics([fit]) == again.metrics([fit])


def test_sensitivity_study_runs_analyses_side_by_side(clinic):
    grids = {"LogisticRegression": {"C": [1.0], "penalty": ["l2"]}, "RandomForest": {"n_estimators": [2, 4], "max_depth": [3]}}
    rows = S.sensitivity_study(clinic, ["MutualInfo"], 3, grids, 2, ["Main", "Diabetes_diag1"], parallelism=2, even=False).collect()
    assert {(r.analysis, r.model) for r in rows} == {(a, m) for a in ("Main", "Diabetes_diag1") for m in grids}
