"""Queries that fit models. They have no SQL twin; the tests check their invariants.

All run with the study's full settings: three models, three rankings, 5, 10 and 15 features, five folds,
its grids, and rows balanced in search and final fit. The searches fit hundreds to thousands of models.
"""

from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.operators import neighbours as B
from wardwise.operators import select as G
from wardwise.operators import train as R
from wardwise.operators import unsupervised as U
from wardwise.plans import study as S
from wardwise.plans.registry import register
from wardwise.plans.views import Clinic
from wardwise.session import materialize, scratch_path

#: The study's grids. Its `solver` and `min_samples_split` have no counterpart in Spark.
GRIDS = {"RandomForest": {"n_estimators": [100, 300], "max_depth": [5, 10, 20]},
         "LogisticRegression": {"C": [0.1, 1.0, 10.0, 100.0]},
         "GradientBoosting": {"n_estimators": [100, 300], "learning_rate": [0.1, 0.2]}}
SENSITIVITY_GRIDS = {
    "RandomForest": {"n_estimators": [100, 500], "max_depth": [None, 10, 20],
                     "min_samples_leaf": [1, 4]},
    "LogisticRegression": {"C": [0.1, 1.0, 10.0], "penalty": ["l1", "l2"], "max_iter": [1000]},
    "GradientBoosting": {"n_estimators": [100, 500], "learning_rate": [0.05, 0.1, 0.2],
                         "max_depth": [3, 7], "subsample": [0.8, 1.0],
                         "colsample_bytree": [0.8, 1.0]}}
METHODS, TOPS = K.SELECTION_METHODS, K.TOP_N_SWEEP
SEARCH_TOP, CATEGORY_TOP = 5, 10


def table(c: Clinic) -> S.TrainingTable:
    """The training table, prepared once per query."""
    if "_training" not in vars(c):
        c._training = S.analysis_table(c, "Main")
    return c._training


def balance(c: Clinic):
    return S.balance_over(table(c).features)


def lists(c, top_ns=TOPS, methods=METHODS):
    return S.feature_lists(table(c), list(methods), list(top_ns))


def one_list(c):
    """The features of the queries of a single configuration."""
    return lists(c, (5,), ("MutualInfo",))[5, "MutualInfo"]


def _study_frame(c):
    return table(c).data


register("training_table", _study_frame)
register("balanced_training", lambda c: S.balanced(table(c)))
register("model_registry", lambda c: R.model_registry_table(c.spark).join(
    c.model_results.groupBy(F.col("model_name").alias("model")).agg(F.count("*").alias("stored_results")),
    "model", "left"))
register("rank_l1", lambda c: G.rank_l1(table(c).train, table(c).features))
register("rank_tree", lambda c: G.rank_tree(table(c).train, table(c).features))
register("select_features",
         lambda c: G.select_features("MutualInfo", table(c).train, table(c).features, top_n=15))
register("select_all", lambda c: G.cut(
    G.rank_all(table(c).train, table(c).features), [5, 10, 15]))


def _selection_tables(c):
    """The selection tables of the study's own rankings and sizes, one row per feature."""
    chosen = materialize(G.cut(G.rank_all(table(c).train, table(c).features), list(TOPS)), "chosen")
    return G.selection_detail(chosen, list(TOPS), list(METHODS)).join(
        G.selection_summary(chosen, list(TOPS)), "feature").join(
        G.common_features(chosen, 1).groupBy("feature").pivot("top_n", list(TOPS)).agg(F.max("methods")).select(
            "feature", *[F.coalesce(f"`{n}`", F.lit(0)).alias(f"methods_{n}") for n in TOPS]), "feature")


def _l1_path(c):
    found = G.l1_path(table(c).train, table(c).features)
    return R.result_table(c.spark, [{"c": strength, "feature": f, "weight": w} for strength, some in found.items() for f, w in some.items()])


register("selection_tables", _selection_tables)
register("l1_path", _l1_path)
register("cross_validate", lambda c: R.result_table(c.spark, [R.cross_validate(
    table(c).train, one_list(c), "LogisticRegression", parallelism=4)]))
register("cross_validate_balanced", lambda c: R.result_table(c.spark, [R.cross_validate(
    table(c).train, one_list(c), "LogisticRegression", balance=S.balance, parallelism=5)]))
register("train_all", lambda c: R.result_table(c.spark, R.train_all(
    table(c).train, one_list(c), balance=balance(c), parallelism=2)[1]))
register("train_feature_sets", lambda c: R.train_feature_sets(
    table(c).train, lists(c), balance=balance(c)))
register("grouped_modeling", lambda c: R.grouped_modeling(
    table(c).data, lists(c), balance=balance(c)))
register("grouped_histogram", lambda c: R.grouped_histogram(
    table(c).data, lists(c), balance=balance(c)))
register("category_experiment", lambda c: R.category_experiment(
    table(c).train, table(c).features, METHODS, CATEGORY_TOP, parallelism=4, balance=balance(c)))
register("evaluate_all_combinations", lambda c: R.evaluate_all_combinations(
    table(c).data, lists(c), balance=balance(c)))
register("param_search", lambda c: R.result_table(c.spark, R.search_on_validation(
    table(c).data, lists(c), GRIDS, balance=balance(c))))
register("param_search_all_models", lambda c: R.param_search_all_models(
    table(c).data, one_list(c), GRIDS, balance=balance(c)))
register("evaluate_config", lambda c: R.result_table(c.spark, [R.evaluate_config(
    table(c).data, one_list(c), "LogisticRegression", {"C": 10.0}, balance=balance(c))]))


def _batch_searches(c, folds):
    """The batch search of every selection method: validation and test rows, told apart by `side`."""
    val, test = R.batch_search(table(c).data, METHODS, lists(c), TOPS, GRIDS, folds, balance=balance(c))
    return val.withColumn("side", F.lit("val")).unionByName(test.withColumn("side", F.lit("test")), allowMissingColumns=True)


register("batch_search_holdout", lambda c: _batch_searches(c, None))
register("batch_search_cv", lambda c: _batch_searches(c, K.CV_FOLDS))


def _all_methods(c):
    """The val, test and cv rows of every selection method, told apart by `side`."""
    tables, _ = R.cv_search_all_methods(
        table(c).data, METHODS, lists(c, (SEARCH_TOP,)), SEARCH_TOP, GRIDS, K.CV_FOLDS, balance=balance(c))
    stacked = [R.stack_tables(tables, kind).withColumn("side", F.lit(kind)) for kind in ("val", "test", "cv")]
    return stacked[0].unionByName(stacked[1], allowMissingColumns=True).unionByName(stacked[2], allowMissingColumns=True)


register("cv_search_all_methods", _all_methods)


def scorer(c):
    """A scorer that was saved and loaded again."""
    t = table(c)
    features = lists(c, (10,), ("MutualInfo",))[10, "MutualInfo"]
    model = R.fit(t.train, features, "LogisticRegression")
    path = scratch_path(c.spark, "models")
    R.save_models({"LogisticRegression": R.build_scorer(t.encoder, t.scaler, features, model)}, path)
    return R.load_model(path, "LogisticRegression")


register("batch_score", lambda c: R.batch_score(scorer(c), table(c).raw.drop("label", "split")))
register("sensitivity_study", lambda c: S.sensitivity_study(
    c, METHODS, K.TOP_N, SENSITIVITY_GRIDS, K.CV_FOLDS, parallelism=len(S.ANALYSES)))


def balanced_rows(c):
    """The balanced training rows; `row` tells the copies of an encounter apart."""
    if "_balanced" not in vars(c):
        c._balanced = S.balanced(table(c)).filter("split = 'train'")
    copies = c._balanced.agg(F.max("copy")).first()[0]
    return c._balanced.withColumn("row", F.col(S.KEY).cast("long") * (copies + 1) + F.col("copy"))


def _components(c):
    return U.pca_2d(balanced_rows(c), table(c).features, "row")[0].drop("row")


def _noise(c):
    """Every balanced training row with its flags, over all encoded features."""
    rows = balanced_rows(c)
    found = B.density_noise(rows, table(c).features, "row", eps=0.5, min_samples=10)
    return rows.select("row", S.KEY, "copy").join(found, "row").drop("row")


def _clusters(c):
    parts, _ = U.pca_2d(balanced_rows(c), table(c).features, "row")
    clustered, inertia = U.kmeans_clusters(parts, ["pc1", "pc2"])
    return U.cluster_profile(clustered, ["pc1", "pc2"], "label").withColumn("inertia",
                                                                            F.lit(inertia))


register("pca_2d", _components)
register("kmeans_clusters", _clusters)
register("density_noise_balanced", _noise)
register("isolation_forest_flags", lambda c: U.isolation_forest_flags(
    balanced_rows(c), table(c).features, "row").select(S.KEY, "copy", "anomaly_score", "anomaly"))
