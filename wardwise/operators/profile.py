"""Column profiles, value counts, histograms and descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators.cleaning import numeric_columns, replace_sentinel
from wardwise.operators.quantiles import quantiles_of_counts, value_counts_long
from wardwise.session import materialize


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the non-null values, largest first."""
    return (df.filter(C.col(column).isNotNull())
            .groupBy(C.col(column).alias("value")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.asc("value")))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of several categorical columns as (column, value, n)."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), C.col(c).cast("string").alias("value"))
        for c in columns]))
    return (df.select(cells.alias("_c")).select("_c.*").filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count("*").alias("n")))


def _profile(df: DataFrame, test) -> DataFrame:
    """(column, n, rows) of the cells that satisfy ``test``: one pass, one row, then unpivoted."""
    names = df.columns
    row = df.agg(F.count("*").alias("_rows"),
                 *[F.count_if(test(C.col(n))).alias(f"c{i}") for i, n in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"c{i}").alias("n"))
                      for i, n in enumerate(names)])
    return row.select("_rows", F.explode(cells).alias("_c")).select(
        "_c.column", "_c.n",
        F.try_divide(F.col("n").cast("double") * 100.0, F.col("_rows")).alias("percentage"))


def missing_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    out = _profile(df, lambda c: c.isNull())
    out = out.filter("n > 0") if only_missing else out
    return out.withColumnsRenamed({"n": "missing_count", "percentage": "missing_percentage"}).orderBy(
        F.desc("missing_percentage"), "column")


def data_info(df: DataFrame) -> DataFrame:
    """Missing profile with the type of each column and the shape of the table."""
    types = C.literal_map(dict(df.dtypes))
    return (missing_profile(df)
            .withColumn("dtype", types[F.col("column")])
            .withColumn("n_columns", F.lit(len(df.columns))))


def sentinel_profile(df: DataFrame, sentinel: str = K.SENTINEL) -> DataFrame:
    text = df.select(*[C.col(n).cast("string").alias(n) for n in df.columns])
    return (_profile(text, lambda c: F.coalesce(c == sentinel, F.lit(False))).filter("n > 0")
            .withColumnsRenamed({"n": "sentinel_count", "percentage": "sentinel_percentage"})
            .orderBy(F.desc("sentinel_percentage"), "column"))


def missing_decisions(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    """What the cleaning does with each column that has missing values."""
    profile = missing_profile(replace_sentinel(df), only_missing=True)
    action = (F.when(F.col("missing_percentage") > threshold, "drop")
              .when(F.col("column").isin(*K.FILL_UNKNOWN_COLUMNS), "fill Unknown")
              .otherwise("keep"))
    return profile.select("column", "missing_percentage", action.alias("action"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns.

    Rows are compared through a 128-bit digest of their values, so the shuffle carries the digest
    instead of the row.
    """
    row = F.to_json(F.struct(*[C.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return (df.groupBy(F.md5(row).alias("_digest")).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")))


def distinct_patients(df: DataFrame, patient: str = "patient_nbr", approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(count(F.col(patient)).alias("patients"))


def average_age(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(C.age_midpoint(F.col("age"))).alias("average_age"))


def histogram(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Equal-width bins over the range of each column; empty bins are kept.

    Returns (column, bin, low, high, n), bins numbered from zero, the last one closed.
    """
    x = {c: C.col(c).cast("double") for c in columns}
    ends = df.agg(*[f(v).alias(f"{n}_{c}") for c, v in x.items() for n, f in (("lo", F.min), ("hi", F.max))]).first()
    spans = [(c, ends[f"lo_{c}"], (ends[f"hi_{c}"] - ends[f"lo_{c}"]) / bins)  # one per column
             for c in columns if ends[f"lo_{c}"] is not None]

    def place(c: str, low: float, width: float) -> Column:
        if not width:
            return F.when(x[c].isNotNull(), F.lit(0))
        return F.least(F.floor((x[c] - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")

    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), place(c, lo, w).alias("bin"))
                                for c, lo, w in spans]))
    # only bins are shuffled, columns x bins rows from each task
    filled = (df.select(cells.alias("_c")).select("_c.*").filter("bin IS NOT NULL")
              .groupBy("column", "bin").agg(F.count("*").alias("n"))) if spans else None
    grid = df.sparkSession.createDataFrame(
        [(c, b, lo + b * w, lo + (b + 1) * w) for c, lo, w in spans for b in range(bins)],
        "column string, bin int, low double, high double")
    if filled is None:
        return grid.withColumn("n", F.lit(0).cast("bigint"))
    return grid.join(filled, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _describe_plain(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, min and max of all columns: one partial aggregate, one row."""
    x = {c: C.col(c).cast("double") for c in columns}
    named = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    one = df.agg(*[F.struct(F.lit(c).alias("column"), *[f(v).alias(n) for n, f in named]).alias(f"_{i}")
                   for i, (c, v) in enumerate(x.items())])
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))]))).filter("count > 0")


def crosstab(df: DataFrame, rows: str | Column, columns: str | Column,
             values: list | None = None) -> DataFrame:
    """Counts of every pair; a missing pair is zero."""
    named = df.select((F.col(rows) if isinstance(rows, str) else rows).alias("row"),
                      (F.col(columns) if isinstance(columns, str) else columns).alias("col"))
    return (named.filter("row IS NOT NULL AND col IS NOT NULL")
            .groupBy("row").pivot("col", values).agg(F.count(F.lit(1))).fillna(0))


def describe_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max per numeric column."""
    columns = columns or numeric_columns(df)
    counts = materialize(value_counts_long(df, columns), "value-counts")
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quartiles = (quantiles_of_counts(counts, list(names))
                 .groupBy("column")
                 .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                        for p, name in names.items()]))
    return (_describe_plain(df, columns).join(quartiles, "column")
            .select("column", "count", "mean", "std", "min", *names.values(), "max"))


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """Preview; the row limit is the purpose."""
    return df.limit(n)
