"""Metrics of scored rows and tables that compare model results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise.operators.ordered import HOT_ROWS, running_sums
from wardwise.session import materialize


def _ratio(part: Column, whole: Column) -> Column:
    """Zero where the denominator is zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _rows_where(condition: Column, weight: str | None) -> Column:
    """Number of rows, ``weight`` saying how many a row stands for."""
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)) if weight else F.count_if(condition)


def _score_counts(scored: DataFrame, by: list[str], label: str, probability: str, weight: str | None = None) -> DataFrame:
    """Positives and negatives per distinct probability, written once for the passes over them."""
    return materialize(scored.groupBy(*by, F.col(probability).alias("p")).agg(
        _rows_where(F.col(label) == 1, weight).alias("pos"), _rows_where(F.col(label) != 1, weight).alias("neg")),
        "score-counts")


def exact_auc(scored: DataFrame, by: list[str], label: str = "label",
              probability: str = "probability", hot_rows: int = HOT_ROWS, weight: str | None = None) -> DataFrame:
    """Area under the ROC curve as the rank sum, ties counted half."""
    counts = _score_counts(scored, by, label, probability, weight)
    run = running_sums(counts, by, [F.col("p")], F.col("p"), {"_below": F.col("neg")}, hot_rows,
                       by_rank=True)
    won = F.col("pos") * (F.col("_below") - F.col("neg") / 2.0)
    return run.groupBy(*by).agg(
        F.try_divide(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def evaluate_split(scored: DataFrame, by: list[str] | None = None, label: str = "label",
                   prediction: str = "prediction", probability: str = "probability", weight: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC per group; ``weight``: rows that a row stands for."""
    by = ["split"] if by is None else by
    hit = lambda y, p: _rows_where((F.col(label) == y) & (F.col(prediction) == p), weight)
    cells = scored.groupBy(*by).agg(_rows_where(F.lit(True), weight).alias("rows"), hit(1, 1).alias("tp"),
                                    hit(0, 1).alias("fp"), hit(0, 0).alias("tn"),
                                    hit(1, 0).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.join(exact_auc(scored, by, label, probability, weight=weight), by).select(
        *by, "rows", _ratio(tp + F.col("tn"), F.col("rows")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), "auc")


def confusion_matrix(scored: DataFrame, by: list[str] | None = None, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    by = by or []
    return (scored.groupBy(*by, F.col(label).alias("actual"))
            .agg(F.count_if(F.col(prediction) == 0).alias("predicted_0"),
                 F.count_if(F.col(prediction) == 1).alias("predicted_1"))
            .orderBy(*by, "actual"))


def class_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means and accuracy."""
    cells = materialize(scored.groupBy(label, prediction).agg(F.count("*").alias("n")), "cells")
    actual = cells.groupBy(F.col(label).cast("string").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)).alias("hits"))
    guessed = cells.groupBy(F.col(prediction).cast("string").alias("class")).agg(
        F.sum("n").alias("guesses"))
    rows = actual.join(guessed, "class", "full").select(
        "class", F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("guesses", F.lit(0)).alias("guesses"))
    hits, support, guesses = F.col("hits"), F.col("support"), F.col("guesses")
    rows = rows.select("class", _ratio(hits, guesses).alias("precision"),
                       _ratio(hits, support).alias("recall"),
                       _ratio(2 * hits, support + guesses).alias("f1"), "support", "hits")
    names = ["precision", "recall", "f1"]
    macro = rows.agg(F.lit("macro avg").alias("class"), *[F.avg(n).alias(n) for n in names],
                     F.sum("support").alias("support"))
    weighted = rows.agg(F.lit("weighted avg").alias("class"),
                        *[_ratio(F.sum(F.col(n) * support), F.sum(support)).alias(n)
                          for n in names], F.sum("support").alias("support"))
    accuracy = rows.agg(F.lit("accuracy").alias("class"),
                        *[_ratio(F.sum(hits), F.sum(support)).alias(n) for n in names],
                        F.sum("support").alias("support"))
    return reduce(DataFrame.unionByName, [rows.drop("hits"), accuracy, macro, weighted])


def pr_curve(scored: DataFrame, by: list[str] | None = None, label: str = "label",
             probability: str = "probability", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Precision and recall at every distinct threshold, and the end point without a threshold."""
    by = by or []
    counts = _score_counts(scored, by, label, probability)
    run = running_sums(counts, by, [F.col("p").desc()], -F.col("p"),
                       {"tp": F.col("pos"), "fp": F.col("neg")}, hot_rows, by_rank=True)
    if by:
        whole = materialize(counts.groupBy(*by).agg(F.sum("pos").alias("_all")), "totals")
        run = run.join(whole, by)
    else:
        run = run.withColumn("_all", counts.agg(F.sum("pos")).scalar())
    points = run.select(*by, F.col("p").alias("threshold"),
                        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                        _ratio(F.col("tp"), F.col("_all")).alias("recall"))
    end = counts.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"),
                                  F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def calibration_curve(scored: DataFrame, by: list[str] | None = None, label: str = "label",
                      probability: str = "probability", bins: int = 10) -> DataFrame:
    """Observed and mean predicted share per uniform bin; a bin holds its upper edge."""
    by = by or []
    p = F.col(probability)
    edges = [i / bins for i in range(1, bins)]
    place = reduce(lambda a, b: a + b, [F.when(p > e, 1).otherwise(0) for e in edges])
    return (scored.groupBy(*by, place.alias("bin"))
            .agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
                 F.avg(p).alias("mean_predicted"))
            .orderBy(*by, "bin"))


# --- result tables ----------------------------------------------------------------------------

def best_config(results: DataFrame, by: list[str], metric: str, tie: str) -> DataFrame:
    """The row with the largest metric per group; the smallest ``tie`` value wins a draw.

    The maximum is a partial aggregate: map tasks send one candidate per group.
    """
    order = F.struct(F.col(metric), -F.col(tie))
    best = F.max_by(F.struct(*[F.col(c) for c in results.columns]), order)
    return (results.filter(F.col(metric).isNotNull()).groupBy(*[F.col(b).alias(f"_{b}") for b in by])
            .agg(best.alias("_best")).select("_best.*"))


def compare_splits(cv: DataFrame, val: DataFrame, test: DataFrame, on: str = "model_name") -> DataFrame:
    """AUC and F1 of cross-validation, validation and test side by side."""
    named = lambda df, tag: df.select(
        on, F.col("auc").alias(f"auc_{tag}"), F.col("f1").alias(f"f1_{tag}"))
    return named(cv, "cv").join(named(val, "val"), on).join(named(test, "test"), on)


def overfit_check(compared: DataFrame, tolerance: float = 0.05) -> DataFrame:
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    return compared.withColumns({
        "cv_val_difference": gap("auc_cv", "auc_val"),
        "val_test_difference": gap("auc_val", "auc_test"),
        "verdict": F.when(gap("auc_val", "auc_test") > tolerance, "may be overfitting")
        .otherwise("generalises"),
    })


def collect_sensitivity(val: DataFrame, test: DataFrame, order: str) -> DataFrame:
    """Validation rows with the first test row of the same analysis, selection and model."""
    keys = ["analysis", "fs", "model"]
    first = test.groupBy(*keys).agg(
        F.min_by(F.struct("test_auc", "test_f1"), F.col(order)).alias("_t"))
    return val.join(first, keys, "left").select(
        *keys, "val_auc", "val_f1", "_t.test_auc", "_t.test_f1",
        *[c for c in val.columns if c not in (*keys, "val_auc", "val_f1", order)])


def compare_settings(default: DataFrame, tuned: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of each metric with default and tuned parameters, the change and its percentage."""
    both = (default.select(F.lit("d").alias("s"), *metrics)
            .unionByName(tuned.select(F.lit("t").alias("s"), *metrics)))
    long = both.unpivot(["s"], metrics, "metric", "value")
    mean = lambda s: F.avg(F.when(F.col("s") == s, F.col("value")))
    change = F.col("tuned_mean") - F.col("default_mean")
    return (long.groupBy("metric").agg(mean("d").alias("default_mean"), mean("t").alias("tuned_mean"))
            .withColumns({"change": change, "change_percent": F.when(
                F.col("default_mean") != 0, change / F.col("default_mean") * 100).otherwise(0.0)}))


def setting_differences(default: DataFrame, tuned: DataFrame, keys: list[str],
                        metric: str) -> DataFrame:
    """Tuned minus default mean of a metric per configuration that has both."""
    mean = lambda df, name: df.groupBy(*keys).agg(F.avg(metric).alias(name))
    return mean(default, "default_mean").join(mean(tuned, "tuned_mean"), keys).withColumn(
        "difference", F.col("tuned_mean") - F.col("default_mean"))


def results_pivot(results: DataFrame, index: list[str], column: str, values: list[str], metric: str,
                  how=F.avg) -> DataFrame:
    return results.groupBy(*index).pivot(column, values).agg(how(metric)).orderBy(*index)


def cv_vs_test_long(cv: DataFrame, test: DataFrame, key: str = "model_name") -> DataFrame:
    """Scores of both kinds, long: (model, metric, score, type)."""
    def melt(df, kind):
        names = [c for c in df.columns if c != key]
        return df.unpivot([key], names, "metric", "score").withColumn("type", F.lit(kind))
    return melt(cv, "Cross-validation").unionByName(melt(test, "Test Set"))
