"""Principal components, clusters and isolation-forest anomalies."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.functions.hashing import HASH_BITS, seeded_hash
from wardwise.operators.prepare import fit_scaler
from wardwise.operators.quantiles import exact_quantiles


def _array(features: list[str]) -> Column:
    return F.array(*[C.col(f).cast("double") for f in features])


def pca_2d(df: DataFrame, features: list[str], key: str) -> tuple[DataFrame, list[float]]:
    """(key, pc1, pc2) of the centred features, and the explained shares of variance."""
    means = fit_scaler(df, features)
    centred = df.withColumns({f: C.col(f) - F.lit(means[f][0]) for f in features})
    data = centred.withColumn("_x", array_to_vector(_array(features)))
    model = PCA(k=2, inputCol="_x", outputCol="_p").fit(data)
    out = model.transform(data).withColumn("_a", vector_to_array("_p"))
    kept = [c for c in df.columns if c not in features]
    return (out.select(*kept, F.col("_a")[0].alias("pc1"), F.col("_a")[1].alias("pc2")),
            [float(v) for v in model.explainedVariance.toArray()])


def kmeans_clusters(df: DataFrame, features: list[str], k: int = 3,
                    seed: int = K.SEED) -> tuple[DataFrame, float]:
    """Rows with their ``cluster``, and the inertia."""
    data = df.withColumn("_x", array_to_vector(_array(features)))
    model = KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster").fit(data)
    return model.transform(data).drop("_x"), float(model.summary.trainingCost)


def cluster_profile(clustered: DataFrame, features: list[str], label: str) -> DataFrame:
    """Size, feature means and class mix per cluster."""
    return (clustered.groupBy("cluster")
            .agg(F.count("*").alias("rows"), *[F.avg(C.col(f)).alias(f"mean_{f}") for f in features],
                 F.avg(F.col(label).cast("double")).alias(f"share_{label}"))
            .orderBy("cluster"))


# --- isolation forest -------------------------------------------------------------------------

def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    return np.where(big, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma)
                    - 2 * (n - 1) / np.maximum(n, 1), out)


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, path) of one tree; a leaf has feature -1."""
    nodes: list[tuple] = [()]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        free = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(free):
            nodes[node] = (node, -1, 0.0, -1, -1, float(depth + _expected_path(len(rows))))
            continue
        f = int(rng.choice(free))
        cut = float(rng.uniform(low[f], high[f]))
        left, right = len(nodes), len(nodes) + 1
        nodes += [(), ()]
        nodes[node] = (node, f, cut, left, right, 0.0)
        goes = part[:, f] <= cut
        todo += [(left, rows[goes], depth + 1), (right, rows[~goes], depth + 1)]
    return nodes


def isolation_forest(df: DataFrame, features: list[str], key: str, trees: int = 100,
                     sample: int = 256, seed: int = K.SEED) -> dict[str, np.ndarray]:
    """Forest as arrays (tree, node): each tree grows from its own random sample of ``sample`` rows.

    The samples are slices of the rows with the smallest hashes: trees x sample rows at most,
    whatever the size of the table.
    """
    wanted = trees * sample
    hashed = df.select(seeded_hash(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"),
                       _array(features).alias("x"))
    # A hash limit that lets about twice the wanted rows through, so that the ordered limit
    # merges a bounded number of rows however many partitions the table has.
    share = min(1.0, 2.0 * wanted / max(df.count(), 1))
    pool = (hashed.filter(F.col("_h") <= int(share * (1 << HASH_BITS)))
            .orderBy("_h", "_k").limit(wanted))
    numbered = pool.withColumn("_r", F.expr("row_number() OVER (ORDER BY _h, _k) - 1"))
    size = pool.count()
    taken = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                     lambda t: F.pmod(F.col("_r") - t * sample, F.lit(size)) < sample)
    rows = numbered.select(F.explode(taken).alias("tree"), "x")
    limit = math.ceil(math.log2(max(min(sample, size), 2)))

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        x = np.stack(part["x"])
        x = x[np.lexsort(x.T[::-1])]  # the same tree whatever the order of arrival
        nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "l", "r", "path"])
        return out.assign(tree=tree)

    grown = rows.groupBy("tree").applyInPandas(
        grow, "node INT, feature INT, threshold DOUBLE, l INT, r INT, path DOUBLE, tree INT")
    table = grown.toPandas()  # trees x (2 x sample - 1) nodes at most
    width = int(table["node"].max()) + 1
    forest = {c: np.zeros((trees, width), dtype=table[c].dtype)
              for c in ("feature", "threshold", "l", "r", "path")}
    for c, array in forest.items():
        array[table["tree"], table["node"]] = table[c]
    forest["scale"] = np.array(float(_expected_path(min(sample, size))) or 1.0)
    forest["limit"] = np.array(limit)
    return forest


def anomaly_scores(df: DataFrame, features: list[str], forest: dict[str, np.ndarray]) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1): short paths score high."""
    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        x = np.stack(rows) if len(rows) else np.zeros((0, len(features)))
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for t in range(len(forest["feature"])):
            at = np.zeros(len(x), dtype=int)
            feature, cut = forest["feature"][t], forest["threshold"][t]
            for _ in range(int(forest["limit"])):
                f = feature[at]
                goes = x[every, np.maximum(f, 0)] <= cut[at]
                at = np.where(f < 0, at, np.where(goes, forest["l"][t][at], forest["r"][t][at]))
            total += forest["path"][t][at]
        mean = total / len(forest["feature"])
        return pd.Series(np.power(2.0, -mean / float(forest["scale"])))

    return df.withColumn("anomaly_score", score(_array(features)))


def isolation_forest_flags(df: DataFrame, features: list[str], key: str,
                           contamination: float = 0.05, trees: int = 100, sample: int = 256,
                           seed: int = K.SEED) -> DataFrame:
    """Rows with score and flag; the cut is the exact quantile of the scores."""
    scored = anomaly_scores(df, features, isolation_forest(df, features, key, trees, sample, seed))
    # scores that differ only by rounding count as one
    scored = scored.withColumn("anomaly_score", F.round("anomaly_score", 12))
    cut = exact_quantiles(scored, ["anomaly_score"], [1 - contamination]).select("value").scalar()
    return scored.withColumn("anomaly", F.col("anomaly_score") > cut)
