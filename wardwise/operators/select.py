"""Feature rankings and the tables about selected features.

A ranking is long: (method, rank, feature, score). A selection adds ``top_n``. Rankings are made
once; every ``top_n`` is a filter on the rank.
"""

from __future__ import annotations

import json

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators.batch import Batch, Fit, Part
from wardwise.operators.forest import forest_importances


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def ranking(spark: SparkSession, method: str, scores: dict[str, float]) -> DataFrame:
    """Ranking of driver-side model weights: one number per feature."""
    order = sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))
    rows = json.dumps([{"method": method, "rank": i + 1, "feature": f, "score": float(s)}
                       for i, (f, s) in enumerate(order)])
    kind = "ARRAY<STRUCT<method: STRING, rank: INT, feature: STRING, score: DOUBLE>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), kind)))


def l1_path(df: DataFrame, features: list[str], label: str = "label", cs: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0)
            ) -> dict[float, dict[str, float]]:
    """Weights of an L1 logistic regression for every inverse strength. All strengths share one pass over the
    rows per step, which gives a gradient and a Gram matrix; coordinate descent on these needs no rows."""
    batch = Batch([Part(df.filter(F.col(label).isNotNull()))], features, label, None)
    fits = {c: Fit.of("LogisticRegression", features, {"C": c, "penalty": "l1"}) for c in cs}
    found = batch.logistic(list(fits.values()))
    return {c: dict(zip(features, found[f][0][:-1].tolist())) for c, f in fits.items()}


def rank_l1(df: DataFrame, features: list[str], label: str = "label", c: float = 1.0) -> DataFrame:
    """By absolute coefficient of an L1 logistic regression with inverse strength ``c``."""
    weights = l1_path(df, features, label, (c,))[c]
    return ranking(df.sparkSession, "L1", {f: abs(w) for f, w in weights.items()})


def forest_rows(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """(x, label) as the forest reads them; a label that is no whole number from 0 raises."""
    y = F.col(label).cast("double")
    known = F.when((y >= 0) & (y == F.floor(y)), y.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("a label is a whole number from 0, not "), F.coalesce(y.cast("string"), F.lit("null")))).cast("int"))
    return assemble(df, features).select(vector_to_array("features").alias("x"), known.alias("label"))


def rank_tree(df: DataFrame, features: list[str], label: str = "label", trees: int = 100,
              depth: int = 30, seed: int = K.SEED) -> DataFrame:
    """By importance in a random forest over all rows."""
    found = forest_importances(forest_rows(df, features, label), trees, depth, seed)
    return ranking(df.sparkSession, "TreeImportance", dict(zip(features, map(float, found))))


def rank_mutual_info(df: DataFrame, features: list[str], label: str = "label",
                     bins: int = 32) -> DataFrame:
    """By mutual information with the label over equal-width bins of each feature.

    A first pass finds the ranges (one row). The joint counts are partial sums per map task, so
    only features x bins x labels cells are shuffled.
    """
    x = {f: C.col(f).cast("double") for f in features}
    span = df.agg(*[F.struct(F.min(x[f]).alias("lo"), F.max(x[f]).alias("hi")).alias(f)
                    for f in features]).first()

    def place(f):
        lo, hi = span[f]["lo"], span[f]["hi"]
        if lo is None or hi == lo:
            return F.when(x[f].isNotNull(), 0)
        width = (hi - lo) / bins
        return F.least(F.floor((x[f] - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")

    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), place(f).alias("bin"))
                                for f in features]))
    joint = (df.filter(F.col(label).isNotNull())
             .select(F.col(label).alias("y"), cells.alias("_c")).select("y", "_c.*")
             .filter("bin IS NOT NULL")
             .groupBy("feature", "bin", "y").agg(F.count("*").cast("double").alias("n")))
    total = lambda *keys: F.sum("n").over(Window.partitionBy(*keys))
    parts = joint.select("feature", "n", total("feature").alias("rows"),
                         total("feature", "bin").alias("nx"), total("feature", "y").alias("ny"))
    score = F.sum(F.col("n") / F.col("rows") * F.ln(F.col("n") * F.col("rows")
                                                 / (F.col("nx") * F.col("ny"))))
    scores = parts.groupBy("feature").agg(F.greatest(score, F.lit(0.0)).alias("score"))
    order = Window.partitionBy("method").orderBy(F.desc("score"), "feature")
    return (scores.withColumn("method", F.lit("MutualInfo"))
            .withColumn("rank", F.row_number().over(order))
            .select("method", "rank", "feature", "score"))


SELECTORS = {"L1": rank_l1, "MutualInfo": rank_mutual_info, "TreeImportance": rank_tree}


def rank_features(method: str, df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    if method not in SELECTORS:
        raise ValueError(f"unknown selection method {method!r}, expected one of {list(SELECTORS)}")
    return SELECTORS[method](df, features, label)


def select_features(method: str, df: DataFrame, features: list[str], label: str = "label",
                    top_n: int = K.TOP_N) -> DataFrame:
    return cut(rank_features(method, df, features, label), [top_n])


def rank_all(df: DataFrame, features: list[str], label: str = "label",
             methods: list[str] | None = None) -> DataFrame:
    """Importance scores of every method, long."""
    out = None
    for method in methods or list(SELECTORS):
        one = rank_features(method, df, features, label)
        out = one if out is None else out.unionByName(one)
    return out


def importance_long(ranked: DataFrame) -> DataFrame:
    return ranked.select("method", "feature", F.col("score").alias("importance_score"))


def cut(ranked: DataFrame, top_ns: list[int]) -> DataFrame:
    """Selections (top_n, method, rank, feature, score) for every ``top_n``."""
    sizes = F.array(*[F.lit(n) for n in top_ns])
    return (ranked.select(F.explode(sizes).alias("top_n"), "method", "rank", "feature", "score")
            .filter(F.col("rank") <= F.col("top_n")))


def feature_lists(selected: DataFrame) -> dict[tuple[int, str], list[str]]:
    """Feature names per (top_n, method) in rank order, for the model fits."""
    out: dict[tuple[int, str], list[str]] = {}
    for r in selected.orderBy("top_n", "method", "rank").collect():
        out.setdefault((r["top_n"], r["method"]), []).append(r["feature"])
    return out


def feature_union(selected: DataFrame) -> DataFrame:
    return selected.select("feature").distinct()


def common_features(selected: DataFrame, min_methods: int = 2) -> DataFrame:
    """Features that at least ``min_methods`` methods select, per ``top_n``."""
    return (selected.groupBy("top_n", "feature")
            .agg(F.count_distinct("method").alias("methods"))
            .filter(F.col("methods") >= min_methods))


def common_summary(selected: DataFrame, methods: int = 3) -> DataFrame:
    """Sorted features shared by two or more, and by all, methods, per ``top_n``."""
    counted = common_features(selected, 1)
    picked = lambda least: F.array_sort(F.collect_list(
        F.when(F.col("methods") >= least, F.col("feature"))))
    return counted.groupBy("top_n").agg(picked(2).alias("shared_by_two"),
                                        picked(methods).alias("shared_by_all"))


def selection_summary(selected: DataFrame, top_ns: list[int]) -> DataFrame:
    """One row per feature, 1 where any method selects it for a ``top_n``."""
    return (selected.withColumn("_c", F.concat(F.lit("top_"), F.col("top_n")))
            .groupBy("feature").pivot("_c", [f"top_{n}" for n in top_ns]).agg(F.max(F.lit(1)))
            .fillna(0).orderBy("feature"))


def selection_counts(selected: DataFrame) -> DataFrame:
    """Number of selected features per ``top_n`` and their share of all selected features."""
    everything = selected.agg(F.count_distinct("feature")).scalar()
    return (selected.groupBy("top_n").agg(F.count_distinct("feature").alias("features"))
            .withColumn("percentage", F.col("features").cast("double") * 100.0 / everything))


def selection_detail(selected: DataFrame, top_ns: list[int], methods: list[str]) -> DataFrame:
    """One row per feature, 1 where a method selects it for a ``top_n``."""
    names = [f"Top{n}_{m}" for n in top_ns for m in methods]
    key = F.concat(F.lit("Top"), F.col("top_n"), F.lit("_"), F.col("method"))
    return (selected.withColumn("_c", key).groupBy("feature").pivot("_c", names)
            .agg(F.max(F.lit(1))).fillna(0).orderBy("feature"))


def category_profile(selected: DataFrame) -> DataFrame:
    """Number of selected features per category for every (top_n, method)."""
    names = [*(c for c in K.FEATURE_CATEGORIES if c != "Label"), "Unknown"]
    return (selected.withColumn("category", C.feature_category(F.col("feature")))
            .groupBy("top_n", "method").pivot("category", names).agg(F.count(F.lit(1)))
            .fillna(0).orderBy("top_n", "method"))
