"""Stratified splits and folds, encoders and scaling."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.functions.hashing import HASH_BITS, seeded_hash
from wardwise.operators.ordered import HOT_ROWS, running_sums

# A uniform 60-bit hash falls into 2^16 blocks and 2^8 super blocks.
HASH_SHIFTS = (HASH_BITS - 16, HASH_BITS - 8)


def _label_rank(df: DataFrame, label: str, key: str, seed: int, hot_rows: int) -> DataFrame:
    """Seeded random rank of every row within its label, from one."""
    hashed = df.withColumn("_h", seeded_hash(seed, F.col(key)))
    return running_sums(hashed, [label], [F.col("_h"), F.col(key)], F.col("_h"),
                        {"_rank": F.lit(1)}, hot_rows, HASH_SHIFTS).drop("_h")


def stratified_split(df: DataFrame, label: str, key: str, test: float = K.TEST_SHARE,
                     val: float = K.VALIDATION_SHARE, seed: int = K.SEED, exact: bool = True,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``split``: test, val (a share of the rest) or train, drawn within each label.

    Exact sizes per label need one shuffle. ``exact=False`` draws by hash alone: no shuffle, and
    sizes that are right up to chance. ``val=0`` gives the two-way form.
    """
    if not exact:
        u = F.shiftright(seeded_hash(seed, F.col(key)), HASH_BITS - 30) / float(1 << 30)
        cut = test + (1 - test) * val
        return df.withColumn("split", F.when(u < test, "test").when(u < cut, "val")
                             .otherwise("train"))
    sizes = df.groupBy(label).agg(F.count("*").alias("n")).collect()  # one row per class
    ranked = _label_rank(df, label, key, seed, hot_rows)
    name = F.lit("train")
    for row in sizes:
        n_test = round(row["n"] * test)
        n_val = round((row["n"] - n_test) * val)
        mine = F.col(label).eqNullSafe(F.lit(row[label]))
        name = (F.when(mine & (F.col("_rank") <= n_test), "test")
                .when(mine & (F.col("_rank") <= n_test + n_val), "val").otherwise(name))
    return ranked.withColumn("split", name).drop("_rank")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = K.CV_FOLDS,
                     seed: int = K.SEED, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``fold`` from zero; every label is spread evenly."""
    ranked = _label_rank(df, label, key, seed, hot_rows)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")


def fit_label_encoder(train: DataFrame, columns: list[str]) -> StringIndexerModel:
    """Alphabetical codes of the values of the training rows."""
    return StringIndexer(inputCols=columns, outputCols=[f"{c}__code" for c in columns],
                         stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)


def label_encode(df: DataFrame, encoder: StringIndexerModel) -> DataFrame:
    """Codes instead of the values; a value unknown to the training rows, or null, is -1."""
    coded = encoder.transform(df)
    sizes = dict(zip(encoder.getInputCols(), map(len, encoder.labelsArray)))
    out = {c: F.when(C.col(f"{c}__code") >= n, -1).otherwise(C.col(f"{c}__code")).cast("int")
           for c, n in sizes.items()}
    return coded.withColumns(out).drop(*[f"{c}__code" for c in sizes])


def fit_one_hot(train: DataFrame, columns: list[str]):
    """Fitted indexer and encoder with the names ``column_value`` of the slots."""
    encoder = fit_label_encoder(train, columns)
    # The indexer keeps one extra code for unseen values; dropLast removes exactly its slot.
    hot = OneHotEncoder(inputCols=[f"{c}__code" for c in columns],
                        outputCols=[f"{c}__hot" for c in columns],
                        dropLast=True).fit(encoder.transform(train))
    names = {c: [f"{c}_{v}" for v in values]
             for c, values in zip(columns, encoder.labelsArray)}
    return encoder, hot, names


def one_hot(df: DataFrame, fitted, drop: bool = True) -> tuple[DataFrame, dict[str, list[str]]]:
    """Sparse 0/1 vectors ``column__hot`` and the names of their slots; unseen is all zeros."""
    encoder, hot, names = fitted
    out = hot.transform(encoder.transform(df)).drop(*[f"{c}__code" for c in names])
    return (out.drop(*names) if drop else out), names


def one_hot_columns(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """The same as named 0/1 columns, for columns of few values."""
    flags = {}
    for c, names in columns.items():
        for name in names:
            value = name[len(c) + 1:]
            flags[name] = F.coalesce((C.col(c) == value).cast("double"), F.lit(0.0))
    return df.withColumns(flags).drop(*columns)


def fit_scaler(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column gets deviation one."""
    row = train.agg(*[F.struct(F.avg(C.col(c)).alias("m"), F.stddev_pop(C.col(c)).alias("s"))
                      .alias(c) for c in columns]).first()
    return {c: (row[c]["m"] or 0.0, row[c]["s"] or 1.0) for c in columns}


def standard_scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (C.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})
