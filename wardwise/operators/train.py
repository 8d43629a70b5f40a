"""Model fits, cross-validation, parameter searches and scoring with Spark ML.

The tables that come back hold one row per configuration. Fits run over the same materialised
training table; independent fits may run in parallel threads, as the ML tuners do.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Mapping
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators import select as G
from wardwise.operators.batch import PARAMETERS, Batch, Fit, Part
from wardwise.operators.forest import forest_scores
from wardwise.operators.prepare import stratified_folds
from wardwise.operators.profile import union_all
from wardwise.session import materialize, scratch_path

Balance = Callable[[DataFrame, list[str]], DataFrame]
METRICS = ["accuracy", "precision", "recall", "f1", "auc"]


# --- estimators -------------------------------------------------------------------------------

def make_model(name: str, params: dict | None = None, rows: int = 1, seed: int = K.SEED):
    """Estimator by model name with the usual parameter names.

    ``C`` is the inverse strength of the penalty over the sum of losses, so it is divided by the
    number of rows here. Without a depth a forest grows the deepest trees that Spark grows. A
    parameter that the model does not have raises, so that no search fits one model twice.
    """
    p = params or {}
    if name in PARAMETERS and set(p) - PARAMETERS[name]:
        raise ValueError(f"{name} has no parameters {sorted(set(p) - PARAMETERS[name])}")
    if name == "LogisticRegression":
        return LogisticRegression(
            regParam=1.0 / (p.get("C", 1.0) * max(rows, 1)), standardization=False,
            elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0,
            maxIter=p.get("max_iter", 100))
    depth = p.get("max_depth", 30 if name == "RandomForest" else 6)
    depth = 30 if depth is None else depth
    leaf = p.get("min_samples_leaf", 1)
    if name == "RandomForest":
        return RandomForestClassifier(numTrees=p.get("n_estimators", 100), maxDepth=depth,
                                      minInstancesPerNode=leaf, seed=seed)
    if name == "GradientBoosting":
        model = GBTClassifier(maxIter=p.get("n_estimators", 100), maxDepth=depth, seed=seed,
                              stepSize=p.get("learning_rate", 0.3), minInstancesPerNode=leaf,
                              subsamplingRate=p.get("subsample", 1.0))
        if "colsample_bytree" in p:
            model = model.setFeatureSubsetStrategy(str(float(p["colsample_bytree"])))
        return model
    raise ValueError(f"unknown model {name!r}, expected one of {K.MODEL_NAMES}")


def model_registry(seed: int = K.SEED) -> dict[str, object]:
    return {name: make_model(name, seed=seed) for name in K.MODEL_NAMES}


def model_registry_table(spark: SparkSession) -> DataFrame:
    """Default estimators and their parameters."""
    rows = [(name, p.name, str(v)) for name, model in model_registry().items()
            for p, v in model.extractParamMap().items()]
    return spark.createDataFrame(rows, "model STRING, parameter STRING, value STRING")


def param_grid(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, combo)) for combo in itertools.product(*grid.values())]


# --- fits and metrics -------------------------------------------------------------------------

def _matrix(df: DataFrame, features: list[str], label: str, *keep: str) -> DataFrame:
    return G.assemble(df, features).select("features", F.col(label).cast("double").alias("label"),
                                           *keep)


def fit(train: DataFrame, features: list[str], name: str, params: dict | None = None,
        label: str = "label", seed: int = K.SEED):
    """Fitted model of the given features."""
    data = _matrix(train, features, label).persist()
    try:
        rows = data.count()
        return _bare(make_model(name, params, rows, seed).fit(data), train.sparkSession)
    finally:
        data.unpersist()


def _bare(model, spark: SparkSession):
    """The model as written and read back, without its training summary. The summary refers to the session, and a
    session that has taken an Observation cannot go to the tasks with the model."""
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(spark, "fitted")
    model.save(path)
    return type(model).load(path)


def score(model, df: DataFrame, features: list[str], label: str = "label",
          keep: Iterable[str] = ()) -> DataFrame:
    """(label, prediction, probability) and the kept columns."""
    out = model.transform(_matrix(df, features, label, *keep))
    return out.select(*keep, F.col("label").cast("int").alias("label"),
                      F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def metrics_of(scored: DataFrame, weight: str | None = None) -> dict[str, float]:
    """Five metrics of one scored table: one aggregation, and the exact ROC area. ``weight``: rows that a row stands for."""
    scored = scored.persist()
    try:
        n = F.col(weight) if weight else F.lit(1)
        hit = lambda y, p: F.coalesce(F.sum(F.when((F.col("label") == y) & (F.col("prediction") == p), n)), F.lit(0))
        r = scored.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(0, 0).alias("tn"),
                       hit(1, 0).alias("fn")).first()
        curve = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", numBins=0)
        auc = (curve.setWeightCol(weight) if weight else curve).evaluate(scored)
    finally:
        scored.unpersist()
    part = lambda a, b: a / b if b else 0.0
    return {"accuracy": part(r.tp + r.tn, sum(r)), "precision": part(r.tp, r.tp + r.fp),
            "recall": part(r.tp, r.tp + r.fn), "f1": part(2 * r.tp, 2 * r.tp + r.fp + r.fn),
            "auc": float(auc)}


def held_metrics(rest: DataFrame, held: DataFrame, features: list[str], name: str, params: dict | None = None,
                 label: str = "label", seed: int = K.SEED) -> dict[str, float]:
    """Metrics on ``held`` of a model fitted on ``rest``.

    A forest is grown and asked in one go (`forest_scores`): as deep as its trees are, Spark's would be as large as the
    rows, node by node on the driver. So is a boosted model (`boosted_metrics`): Spark's takes some jobs a level of every round.
    """
    if name == "GradientBoosting":
        return boosted_metrics([(rest, held)], features, params, label, seed)[0]
    if name != "RandomForest":
        return metrics_of(score(fit(rest, features, name, params, label, seed), held, features, label))
    asked = make_model(name, params, seed=seed)
    cells = forest_scores(G.forest_rows(rest, features, label), G.forest_rows(held, features, label), asked.getNumTrees(),
                          asked.getMaxDepth(), asked.getMinInstancesPerNode(), seed)
    return metrics_of(cells.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), "n")


def boosted_metrics(parts: list[tuple[DataFrame, DataFrame]], features: list[str], params: dict | None = None,
                    label: str = "label", seed: int = K.SEED) -> list[dict[str, float]]:
    """Metrics per (rows to fit on, rows to test on) of boosted models on all rows, grown side by side."""
    fits = [Fit.of("GradientBoosting", features, params, i, ("held",)) for i in range(len(parts))]
    got = Batch([Part(rest, {"held": held}) for rest, held in parts], features, label, None, seed=seed).metrics(fits)
    return [{m: float(got[f, "held"][m]) for m in METRICS} for f in fits]


def run_parallel(spark: SparkSession, jobs: list[Callable[[], object]], parallelism: int) -> list:
    """Results of independent jobs in order; a failing job raises."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs)


_TYPES = {str: T.StringType(), int: T.LongType(), float: T.DoubleType(),
          dict: T.MapType(T.StringType(), T.StringType())}


def result_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Driver-side result rows, one per configuration, as a table."""
    if not rows:
        raise ValueError("nothing was trained: every feature list is empty")
    names = list(dict.fromkeys(k for r in rows for k in r))
    kinds = {n: next((type(r[n]) for r in rows if r.get(n) is not None), str) for n in names}
    schema = T.StructType([T.StructField(n, _TYPES[kinds[n]]) for n in names])
    text = lambda v: {k: str(x) for k, x in v.items()} if isinstance(v, dict) else v
    return spark.createDataFrame([tuple(text(r.get(n)) for n in names) for r in rows], schema)


def fold_parts(train: DataFrame, features: list[str], folds: int = K.CV_FOLDS, label: str = "label",
               key: str = "encounter_id", balance: Balance | None = None,
               seed: int = K.SEED) -> list[tuple[DataFrame, DataFrame]]:
    """(rows to fit on, rows to test on) per stratified fold, written once for many fits.

    ``balance`` sees only the training part of a fold.
    """
    folded = train if "fold" in train.columns else stratified_folds(train, label, key, folds, seed)
    folded = materialize(folded, "folds")
    rest = [folded.filter(F.col("fold") != i) for i in range(folds)]
    if balance:
        rest = [materialize(balance(r, features), "balanced") for r in rest]
    return [(r, folded.filter(F.col("fold") == i)) for i, r in enumerate(rest)]


def fold_metrics(train: DataFrame, features: list[str], name: str, params: dict | None = None,
                 folds: int = K.CV_FOLDS, label: str = "label", key: str = "encounter_id",
                 balance: Balance | None = None, seed: int = K.SEED, parallelism: int = 1,
                 parts: list[tuple[DataFrame, DataFrame]] | None = None) -> list[dict[str, float]]:
    """Metrics per stratified fold, of ``parts`` if they were made before."""
    if name == "GradientBoosting":
        parts = fold_parts(train, features, folds, label, key, balance, seed) if parts is None else parts
        return boosted_metrics(parts, features, params, label, seed)
    if parts is not None:
        jobs = [lambda r=r, h=h: held_metrics(r, h, features, name, params, label, seed) for r, h in parts]
        return run_parallel(train.sparkSession, jobs, parallelism)
    folded = train if "fold" in train.columns else stratified_folds(train, label, key, folds, seed)
    folded = folded.persist()

    def one(i: int) -> dict[str, float]:
        rest = folded.filter(F.col("fold") != i)
        rest = balance(rest, features) if balance else rest
        return held_metrics(rest, folded.filter(F.col("fold") == i), features, name, params, label, seed)

    try:
        jobs = [lambda i=i: one(i) for i in range(folds)]
        return run_parallel(train.sparkSession, jobs, parallelism)
    finally:
        folded.unpersist()


def _mean(rows: list[dict], metric: str) -> float:
    return sum(r[metric] for r in rows) / len(rows)


def _std(rows: list[dict], metric: str) -> float:
    m = _mean(rows, metric)
    return (sum((r[metric] - m) ** 2 for r in rows) / len(rows)) ** 0.5


def cross_validate(train: DataFrame, features: list[str], name: str, params: dict | None = None,
                   **options) -> dict:
    """Mean AUC and F1 over the folds."""
    rows = fold_metrics(train, features, name, params, **options)
    return {"model_name": name, "cv_auc": _mean(rows, "auc"), "cv_f1": _mean(rows, "f1")}


def train_model(train: DataFrame, features: list[str], name: str, params: dict | None = None,
                **options):
    """The model fitted on all training rows, balanced if the folds are, and its cross-validated
    result."""
    balance = options.get("balance")
    whole = balance(train, features) if balance else train
    model = fit(whole, features, name, params, options.get("label", "label"))
    return model, cross_validate(train, features, name, params, **options)


def _parts(train, features, folds=K.CV_FOLDS, label="label", key="encounter_id", balance=None,
           seed=K.SEED, **_):
    return fold_parts(train, features, folds, label, key, balance, seed)


class FittedModels(Mapping):
    """Models by name, each fitted when it is first asked for."""

    def __init__(self, names: Iterable[str], fitted: Callable[[str], object]):
        self._names, self._fitted, self._made = list(names), fitted, {}

    def __getitem__(self, name: str) -> object:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._fitted(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def train_all(train: DataFrame, features: list[str], params: dict[str, dict] | None = None,
              models: list[str] | None = None, **options) -> tuple[Mapping[str, object], list[dict]]:
    """Every model by name, fitted on all training rows (balanced if the folds are) when it is first asked for, and the
    cross-validated result rows."""
    names, label, whole = list(models or K.MODEL_NAMES), options.get("label", "label"), []
    if options.get("balance") and "parts" not in options:
        options["parts"] = _parts(train, features, **options)

    def fitted(name: str):
        if not whole:
            whole.append(materialize(options["balance"](train, features), "balanced") if options.get("balance") else train)
        return fit(whole[0], features, name, (params or {}).get(name), label)

    rows = [cross_validate(train, features, name, (params or {}).get(name), **options) for name in names]
    return FittedModels(names, fitted), rows


# --- experiments over feature sets ------------------------------------------------------------

def _all(lists: dict[tuple[int, str], list[str]]) -> list[str]:
    return list(dict.fromkeys(f for some in lists.values() for f in some))


def balanced_train(data: DataFrame, features: list[str], balance: Balance | None) -> DataFrame:
    """The ``train`` rows of a split table, balanced and written once if asked."""
    train = data.filter("split = 'train'")
    return materialize(balance(train, features), "balanced") if balance else train


def search_batch(data: DataFrame, features: list[str], folds: int | None = None, label: str = "label",
                 key: str = "encounter_id", balance: Balance | None = None, **options) -> Batch:
    """The rows of a search, written once: part 0 fits on ``train`` and scores ``val`` and ``test``, the parts
    after it are the folds of ``train``. ``balance`` holds inside each fold and for part 0."""
    sides = {side: data.filter(F.col("split") == side) for side in ("val", "test")}
    parts = [Part(balanced_train(data, features, balance), sides)]
    if folds:
        train = data.filter("split = 'train'")
        parts += [Part(r, {"fold": h}) for r, h in fold_parts(train, features, folds, label, key, balance)]
    return Batch(parts, features, label, key, **options)


def train_feature_sets(train: DataFrame, lists: dict[tuple[int, str], list[str]],
                       params: dict[str, dict] | None = None, models: list[str] | None = None,
                       **options) -> DataFrame:
    """Cross-validated results for every (top_n, method) and model; empty lists are skipped."""
    keys = {k: f for k, f in lists.items() if f}
    rows = _cross_validated(train, list(keys.values()), params, models, **options)
    return result_table(train.sparkSession, [
        {**r, "top_n": n, "feature_method": m} for (n, m), found in zip(keys, rows) for r in found])


def _cross_validated(train: DataFrame, lists: list[list[str]], params=None, models=None, folds: int = K.CV_FOLDS,
                     label: str = "label", key: str = "encounter_id", balance: Balance | None = None,
                     seed: int = K.SEED, **_) -> list[list[dict]]:
    """Per feature list the mean AUC and F1 of every model; all fits are one batch."""
    every = list(dict.fromkeys(f for some in lists for f in some))
    if not every:
        raise ValueError("nothing was trained: every feature list is empty")
    parts = fold_parts(train, every, folds, label, key, balance, seed)
    batch = Batch([Part(r, {"fold": h}) for r, h in parts], every, label, key)
    of = lambda f, name: [Fit.of(name, f, (params or {}).get(name), i, ("fold",)) for i in range(folds)]
    names = models or K.MODEL_NAMES
    got = batch.metrics([x for f in lists for name in names for x in of(f, name)])

    def row(f, name):
        found = [got[x, "fold"] for x in of(f, name)]
        return {"model_name": name, "cv_auc": _mean(found, "auc"), "cv_f1": _mean(found, "f1")}

    return [[row(f, name) for name in names] for f in lists]


def evaluate_all_combinations(data: DataFrame, lists: dict[tuple[int, str], list[str]],
                              params: dict[str, dict] | None = None,
                              models: list[str] | None = None, label: str = "label",
                              balance: Balance | None = None, batch: Batch | None = None) -> DataFrame:
    """Validation and test AUC and F1 for every selection and model, fitted on ``train``."""
    batch = batch or search_batch(data, _all(lists), label=label, balance=balance)
    fits = {(n, m, name): Fit.of(name, f, (params or {}).get(name), sides=("val", "test"))
            for (n, m), f in lists.items() if f for name in models or K.MODEL_NAMES}
    got = batch.metrics(list(fits.values()))
    return result_table(data.sparkSession, [
        {"top_n": n, "fs_method": m, "model": name, **_sides(got, fit)} for (n, m, name), fit in fits.items()])


def _sides(got: dict, fit: Fit, sides=("val", "test")) -> dict[str, float]:
    return {f"{side}_{k}": got[fit, side][k] for side in sides for k in ("auc", "f1")}


def grouped_modeling(data: DataFrame, lists: dict[tuple[int, str], list[str]],
                     params: dict[str, dict] | None = None, models: list[str] | None = None,
                     label: str = "label", balance: Balance | None = None, batch: Batch | None = None) -> DataFrame:
    """Test AUC and F1 for every selection and model, with feature counts per category."""
    groups = {c: set(f) for c, f in K.FEATURE_CATEGORIES.items() if c != "Label"}
    found = evaluate_all_combinations(data, lists, params, models, label, balance, batch).collect()
    rows = [{"model": r.model, "fs": r.fs_method, "top_n": r.top_n, "auc": r.test_auc, "f1": r.test_f1,
             **{c: sum(f in members for f in lists[r.top_n, r.fs_method]) for c, members in groups.items()}} for r in found]
    return result_table(data.sparkSession, rows)


def grouped_histogram(data: DataFrame, lists: dict[tuple[int, str], list[str]], bins: int = 20,
                      params: dict[str, dict] | None = None, models: list[str] | None = None,
                      label: str = "label", balance: Balance | None = None, batch: Batch | None = None) -> DataFrame:
    """Test rows by probability bin, label, model and selection: the spread that goes with `grouped_modeling`."""
    batch = batch or search_batch(data, _all(lists), label=label, balance=balance)
    fits = {Fit.of(name, f, (params or {}).get(name), sides=("test",)): (name, m, n)
            for (n, m), f in lists.items() if f for name in models or K.MODEL_NAMES}
    scored = batch.scores(list(fits))
    names = data.sparkSession.createDataFrame(
        [(i, *fits[f]) for i, f in enumerate(fits)], "config int, model string, fs string, top_n int")
    cell = F.least(F.floor(F.col("probability") * bins), F.lit(bins - 1)).cast("int")
    return (scored.groupBy("config", cell.alias("bin"), "label").agg(F.count(F.lit(1)).alias("rows"))
            .join(F.broadcast(names), "config").select("model", "fs", "top_n", "bin", "label", "rows"))


def category_experiment(train: DataFrame, candidates: list[str], methods: list[str], top_n: int = 10,
                        params: dict[str, dict] | None = None, models: list[str] | None = None,
                        label: str = "label", parallelism: int = 1, **options) -> DataFrame:
    """Selection and training inside each feature category on its own."""
    present = {c: [f for f in members if f in candidates] for c, members in K.FEATURE_CATEGORIES.items() if c != "Label"}
    keys = [(c, m) for c, some in present.items() if some for m in methods]
    chosen = run_parallel(train.sparkSession, [
        lambda c=c, m=m: G.feature_lists(G.select_features(m, train, present[c], label, top_n))[top_n, m] for c, m in keys], parallelism)
    rows = _cross_validated(train, chosen, params, models, label=label, **options)
    return result_table(train.sparkSession, [
        {**r, "feature_category": c, "feature_selector": m, "top_n": top_n} for (c, m), found in zip(keys, rows) for r in found])


# --- searches ---------------------------------------------------------------------------------

def search_on_validation(data: DataFrame, lists: dict[tuple[int, str], list[str]], grids: dict[str, dict],
                         label: str = "label", balance: Balance | None = None, batch: Batch | None = None) -> list[dict]:
    """Validation AUC and F1 of every selection, model and parameter combination, fitted on ``train``."""
    batch = batch or search_batch(data, _all(lists), label=label, balance=balance)
    fits = [((n, m, name), params, Fit.of(name, f, params)) for (n, m), f in lists.items() if f
            for name, grid in grids.items() for params in param_grid(grid)]
    got = batch.metrics([f for *_, f in fits])
    return [{"top_n": n, "fs": m, "model": name, "params": params, **_sides(got, fit, ("val",))}
            for (n, m, name), params, fit in fits]


def param_search_all_models(data: DataFrame, features: list[str], grids: dict[str, dict],
                            balance: Balance | None = None, label: str = "label") -> DataFrame:
    """Best parameters per model by validation AUC; the first wins a draw."""
    found = search_on_validation(data, {(len(features), "given"): features}, grids, label, balance)
    rows = [max((r for r in found if r["model"] == name), key=lambda r: r["val_auc"]) for name in grids]
    return result_table(data.sparkSession, [{k: r[k] for k in ("model", "params", "val_auc", "val_f1")} for r in rows])


def evaluate_config(data: DataFrame, features: list[str], name: str, params: dict | None = None,
                    label: str = "label", sides=("test",), balance: Balance | None = None,
                    train: DataFrame | None = None) -> dict:
    train = balanced_train(data, features, balance) if train is None else train
    model = fit(train, features, name, params, label)
    return {"model": name, "params": params or {},
            **_val_test(data, model, features, label, list(sides))}


def _val_test(data: DataFrame, model, features, label, sides) -> dict[str, float]:
    out = {}
    for side in sides:
        m = metrics_of(score(model, data.filter(F.col("split") == side), features, label))
        out |= {f"{side}_auc": m["auc"], f"{side}_f1": m["f1"]}
    return out


def cv_search(batch: Batch, lists: dict, grids: dict[str, dict], folds: int) -> dict[tuple, list[dict]]:
    """By (key of the list, model) one row per parameter combination: fold AUCs, their mean, deviation and rank."""
    of = lambda f, name, params: [Fit.of(name, f, params, 1 + i, ("fold",)) for i in range(folds)]
    asked = [(key, f, name, params) for key, f in lists.items() for name, grid in grids.items() for params in param_grid(grid)]
    got = batch.metrics([x for _, f, name, params in asked for x in of(f, name, params)])
    out: dict[tuple, list[dict]] = {}
    for key, f, name, params in asked:
        found = [got[x, "fold"] for x in of(f, name, params)]
        out.setdefault((key, name), []).append({
            "model": name, "params": params, **{f"split{i}_test_score": r["auc"] for i, r in enumerate(found)},
            "mean_test_score": _mean(found, "auc"), "std_test_score": _std(found, "auc")})
    for rows in out.values():
        for r in rows:
            r["rank_test_score"] = 1 + sum(o["mean_test_score"] > r["mean_test_score"] for o in rows)
    return out


def batch_search(data: DataFrame, methods: list[str], lists: dict[tuple[int, str], list[str]],
                 top_ns: list[int], grids: dict[str, dict], folds: int | None = None,
                 label: str = "label", balance: Balance | None = None,
                 batch: Batch | None = None) -> tuple[DataFrame, DataFrame]:
    """Tuned models of some selection methods: (validation results, test results).

    With ``folds`` the parameters are chosen by cross-validation on ``train``, else on ``val``.
    ``balance`` holds for the search, inside each fold, and for the final fits.
    """
    mine = {(n, fs): lists[n, fs] for fs in methods for n in top_ns}
    batch = batch or search_batch(data, _all(mine), folds, label, balance=balance)
    val, test = [], []
    if folds is None:
        asked = {(n, fs, name): [(p, Fit.of(name, f, p, sides=("val", "test"))) for p in param_grid(grid)]
                 for (n, fs), f in mine.items() for name, grid in grids.items()}
        got = batch.metrics([x for some in asked.values() for _, x in some])
        for (n, fs, name), some in asked.items():
            head = {"model": name, "fs": fs, "top_n": n}
            val += [{**head, "params": p, **_sides(got, x, ("val",))} for p, x in some]
            p, best = max(some, key=lambda s: got[s[1], "val"]["auc"])
            test.append({**head, "params": p, **_sides(got, best, ("test", "val"))})
    else:
        searched = cv_search(batch, mine, grids, folds)
        for (key, name), found, best, got in _finals(batch, mine, searched):
            head = {"model": name, "fs": key[1], "top_n": key[0]}
            tail = {"params": best["params"], "cv_score": best["mean_test_score"]}
            val.append({**head, **_sides(got, found, ("val",)), **tail})
            test.append({**head, **_sides(got, found, ("test",)), **tail})
    spark = data.sparkSession
    return result_table(spark, val), result_table(spark, test)


def _finals(batch: Batch, lists: dict, searched: dict[tuple, list[dict]]):
    """((key, model), final fit, best row, metrics) of every search; the first row wins a draw."""
    best = {k: max(rows, key=lambda r: r["mean_test_score"]) for k, rows in searched.items()}
    fits = {(key, name): Fit.of(name, lists[key], r["params"], sides=("val", "test")) for (key, name), r in best.items()}
    got = batch.metrics(list(fits.values()))
    return [(k, fit, best[k], got) for k, fit in fits.items()]


def cv_search_all_methods(data: DataFrame, methods: list[str],
                          lists: dict[tuple[int, str], list[str]], top_n: int,
                          grids: dict[str, dict], folds: int = 3, label: str = "label",
                          balance: Balance | None = None
                          ) -> tuple[dict[str, dict[str, DataFrame]], dict]:
    """Per selection method the val, test and cv tables, and the best parameters by (method, model).

    ``balance`` holds for the search, inside each fold, and for the final fits. `fit` makes a Spark model of
    the best parameters.
    """
    mine = {fs: lists[top_n, fs] for fs in methods}
    batch = search_batch(data, _all(mine), folds, label, balance=balance)
    searched = cv_search(batch, mine, grids, folds)
    rows = {(fs, kind): [] for fs in methods for kind in ("val", "test", "cv")}
    for (fs, name), found in searched.items():
        rows[fs, "cv"] += [{"fs": fs, "top_n": top_n, **r} for r in found]
    best_params = {}
    for (fs, name), found, best, got in _finals(batch, mine, searched):
        best_params[fs, name] = best["params"]
        for side in ("val", "test"):
            rows[fs, side].append({"model": name, "fs": fs, "top_n": top_n, **_sides(got, found, (side,)),
                                   "params": best["params"], "n_iter": got[found, side].get("n_iter")})
    spark = data.sparkSession
    return {fs: {kind: result_table(spark, rows[fs, kind]) for kind in ("val", "test", "cv")} for fs in methods}, best_params


def stack_tables(tables: dict[str, dict[str, DataFrame]], kind: str) -> DataFrame:
    return union_all([t[kind] for t in tables.values()])


# --- saved scorers ----------------------------------------------------------------------------

def build_scorer(encoder: StringIndexerModel, scaler: dict[str, tuple[float, float]],
                 features: list[str], model) -> PipelineModel:
    """Encoding, scaling, assembling and the model as one object that can be saved."""
    sizes = dict(zip(encoder.getInputCols(), map(len, encoder.labelsArray)))

    def value(f: str) -> str:
        out = f"CAST(`{f}` AS DOUBLE)"
        if f in sizes:
            out = f"CASE WHEN `{f}__code` >= {sizes[f]} THEN -1D ELSE `{f}__code` END"
        if f in scaler:
            mean, std = scaler[f]
            out = f"(({out}) - CAST('{mean!r}' AS DOUBLE)) / CAST('{std!r}' AS DOUBLE)"
        return f"{out} AS `{f}__in`"

    prepared = SQLTransformer(
        statement=f"SELECT *, {', '.join(map(value, features))} FROM __THIS__")
    vector = VectorAssembler(inputCols=[f"{f}__in" for f in features], outputCol="features")
    return PipelineModel(stages=[encoder, prepared, vector, model])


def save_models(models: dict[str, PipelineModel], path: str) -> str:
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/{name}")
    return path


def load_model(path: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/{name}")


def batch_score(scorer: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with prediction and probability of the positive class."""
    return scorer.transform(df).select(
        *[C.col(c) for c in df.columns], F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("prediction_probability"))
