"""Exact quantiles with linear interpolation, without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise.functions import clinical as C
from wardwise.operators.ordered import HOT_ROWS, running_sums
from wardwise.session import materialize

def value_counts_long(df: DataFrame, columns: list[str], by: list[Column] | None = None) -> DataFrame:
    """Rows (by..., column, value, n) of the non-null values; repeated values are one row."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), C.col(c).cast("double").alias("value"))
        for c in columns]))
    long = df.select(*(by or []), cells.alias("_cell")).select("*", "_cell.*").drop("_cell")
    keys = [c for c in long.columns if c != "value"]
    return (long.filter(F.col("value").isNotNull())
            .groupBy(*keys, "value").agg(F.count("*").alias("n")))


def quantiles_of_counts(counts: DataFrame, probs: list[float], weight: str = "n",
                        hot_rows: int = HOT_ROWS) -> DataFrame:
    """Quantiles (keys..., prob, value) of weighted values: linear between closest ranks.

    The counts are read several times, so pass a written or cheap table.
    """
    keys = [c for c in counts.columns if c not in ("value", weight)]
    ranked = running_sums(counts, keys, [F.col("value")], F.col("value"),
                          {"_through": F.col(weight)}, hot_rows, by_rank=True)
    # Written, so that Spark knows the size when it chooses between broadcast and shuffle.
    totals = materialize(counts.groupBy(*[F.col(k).alias(f"{k}_t") for k in keys]).agg(
        F.sum(weight).alias("_total")), "totals")
    same = [ranked[k].eqNullSafe(totals[f"{k}_t"]) for k in keys]
    both = ranked.join(totals, same).drop(*[f"{k}_t" for k in keys])
    at = F.array(*[F.struct(F.lit(float(p)).alias("prob"),
                            ((F.col("_total") - 1) * F.lit(float(p))).alias("pos")) for p in probs])
    low, high = F.floor("pos"), F.ceil("pos")
    holds = lambda rank: (rank >= F.col("_through") - F.col(weight)) & (rank < F.col("_through"))
    hits = (both.select(*keys, "value", weight, "_through", F.explode(at).alias("_at"))
            .select(*keys, "value", weight, "_through", "_at.prob", "_at.pos")
            .filter(holds(low) | holds(high)))
    ends = hits.groupBy(*keys, "prob").agg(
        F.max("pos").alias("pos"),
        F.max(F.when(holds(low), F.col("value"))).alias("_a"),
        F.max(F.when(holds(high), F.col("value"))).alias("_b"))
    share = F.col("pos") - F.floor("pos")
    return ends.select(*keys, "prob",
                       (F.col("_a") + (F.col("_b") - F.col("_a")) * share).alias("value"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    by: list[Column] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows (by..., column, prob, value)."""
    counts = materialize(value_counts_long(df, columns, by), "value-counts")
    return quantiles_of_counts(counts, probs, hot_rows=hot_rows)
