"""Correlation, association and variance tests from one pass of sums."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise.functions import clinical as C
from wardwise.operators.cleaning import numeric_columns
from wardwise.session import materialize


def correlation_matrix(df: DataFrame, columns: list[str] | None = None,
                       drop=("encounter_id", "patient_nbr", "rolling_avg")) -> DataFrame:
    """Pearson correlation of every pair of varying numeric columns, long and symmetric.

    A first pass finds constant columns, nulls and means (one row). The second takes all products
    about the means in one aggregation: plain sums stay in generated code where dozens of ``corr``
    aggregates do not. A pair with nulls gets its own sums over the rows where both are present.
    """
    names = [c for c in (columns or numeric_columns(df)) if c not in drop]
    x = {n: C.col(n).cast("double") for n in names}
    first = df.agg(
        *[F.struct(F.avg(x[n]).alias("mean"), (F.min(x[n]) < F.max(x[n])).alias("varies"),
                   F.count_if(C.col(n).isNull()).alias("nulls")).alias(n) for n in names]).first()
    names = [n for n in names if first[n]["varies"]]
    off = {n: x[n] - F.lit(first[n]["mean"]) for n in names}
    gaps = {n for n in names if first[n]["nulls"]}
    parts = {f"s_{n}": F.sum(off[n]) for n in names} | {
        f"q_{n}": F.sum(off[n] * off[n]) for n in names}
    picked = {}
    for a, b in combinations(names, 2):
        key = f"{a}|{b}"
        parts[f"p_{key}"] = F.sum(off[a] * off[b])
        if a in gaps or b in gaps:
            for tag, mine, other in (("a", a, b), ("b", b, a)):
                seen = F.when(C.col(other).isNotNull(), off[mine])
                parts[f"s{tag}_{key}"], parts[f"q{tag}_{key}"] = F.sum(seen), F.sum(seen * seen)
            parts[f"n_{key}"] = F.count(off[a] * off[b])
            picked[a, b] = [f"{t}_{key}" for t in ("n", "sa", "sb", "qa", "qb", "p")]
        else:
            picked[a, b] = ["n", f"s_{a}", f"s_{b}", f"q_{a}", f"q_{b}", f"p_{key}"]
    row = df.agg(F.count("*").alias("n"), *[e.alias(k) for k, e in parts.items()])

    def pearson_of(sums):
        n, sa, sb, qa, qb, p = [C.col(k) for k in sums]
        return F.try_divide(n * p - sa * sb, F.sqrt(n * qa - sa * sa) * F.sqrt(n * qb - sb * sb))

    found = row.select(*[F.lit(1.0).alias(f"{n}|{n}") for n in names],
                       *[pearson_of(sums).alias(f"{a}|{b}") for (a, b), sums in picked.items()])
    pair = F.split("pair", r"\|")
    one, two = pair[0], pair[1]
    way = lambda a, b: F.struct(a.alias("feature_a"), b.alias("feature_b"))
    ways = F.when(one == two, F.array(way(one, two))).otherwise(
        F.array(way(one, two), way(two, one)))
    return (found.unpivot([], [C.col(c) for c in found.columns], "pair", "corr")
            .filter("corr IS NOT NULL")
            .select("corr", F.explode(ways).alias("_w")).select("_w.*", "corr"))


def pearson(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.agg(F.corr(a.cast("double"), b.cast("double")).alias("pearson"))


def association(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Chi-square with Yates correction for two by two tables, degrees of freedom, Cramér's V.

    The sum over all cells, empty ones too, follows from the filled cells and the margins. The
    cells are written once; the data is read in one pass.
    """
    cells = materialize(
        df.select(a.alias("a"), b.alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
        .groupBy("a", "b").agg(F.count("*").cast("double").alias("o")), "cells")
    margin = lambda k: cells.groupBy(F.col(k).alias(f"{k}_k")).agg(F.sum("o").alias(f"{k}_n"))  # noqa: E731,E501
    rows, cols = margin("a"), margin("b")
    summary = lambda m, k: m.agg(
        F.struct(F.count("*").alias("k"), F.sum(f"{k}_n").alias("n"),
                 F.sum(1.0 / F.col(f"{k}_n")).alias("inverse"))).scalar()
    by_row, by_col = summary(rows, "a"), summary(cols, "b")
    joined = (cells.join(rows, cells["a"] == rows["a_k"]).join(cols, cells["b"] == cols["b_k"])
              .withColumn("_e", F.col("a_n") * F.col("b_n")))
    total = joined.agg(
        F.sum(F.col("o") * F.col("o") / F.col("_e")).alias("ratio"),
        F.max(F.struct(F.col("o"), F.col("_e"))).alias("any"),
    ).withColumns({"r": by_row, "c": by_col})
    n = F.col("r.n")
    dof = (F.col("r.k") - 1) * (F.col("c.k") - 1)
    gap = F.abs(F.col("any.o") - F.col("any._e") / n)
    kept = gap - F.least(F.lit(0.5), gap)
    yates = kept * kept * n * F.col("r.inverse") * F.col("c.inverse")
    chi2 = F.when(dof == 1, yates).otherwise(n * F.col("ratio") - n)
    smaller = F.least(F.col("r.k"), F.col("c.k")) - 1
    return (total.select(n.cast("bigint").alias("n"), dof.alias("dof"), chi2.alias("chi2"),
                         smaller.alias("_m"))
            .withColumn("cramers_v", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.col("_m"))))
            .drop("_m"))


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """F statistic of a value over groups, its degrees of freedom and p-value.

    Groups are reduced to count, mean and variance, which Spark merges without sums of squares.
    """
    v = F.col(value).cast("double")
    g = (df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group)
         .agg(F.count("*").alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v")))
    # the variance between groups is that of the means, weighted by n: two passes over the groups
    centre = g.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("c")).first()[0]
    off = F.col("m") - F.lit(centre)
    t = g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("k"),
              F.sum(F.col("n") * off * off).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"))
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    statistic = F.try_divide(F.try_divide(F.col("between"), df1), F.try_divide(F.col("within"), df2))
    row = t.select(df1.alias("a"), df2.alias("b"), statistic.alias("f")).first()
    p = None if row.f is None else f_test_p_value(row.f, row.a, row.b)
    return t.select(F.col("k").alias("groups"), F.col("n"), df1.alias("df_between"),
                    df2.alias("df_within"), statistic.alias("f_statistic"), F.lit(p).cast("double").alias("p_value"))


def f_test_p_value(statistic: float, df1: float, df2: float) -> float:
    """Upper tail of the F distribution for one statistic."""
    if statistic <= 0:
        return 1.0
    x, a, b = df2 / (df2 + df1 * statistic), df2 / 2.0, df1 / 2.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(b, a, 1.0 - x)
    return _beta_tail(a, b, x)


def _beta_tail(a: float, b: float, x: float, steps: int = 500) -> float:
    """Regularised incomplete beta function by its continued fraction, evaluated backwards."""
    if x <= 0.0:
        return 0.0
    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    tail = 1.0
    for m in range(steps, 0, -1):
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        tail = 1.0 + odd / (1.0 + even / tail)
    return math.exp(log_front) / (a * tail)
