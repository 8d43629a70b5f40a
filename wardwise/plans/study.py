"""The study from encounters to tuned models: training tables, cohorts and sensitivity analyses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators import cleaning as N
from wardwise.operators import cohort as H
from wardwise.operators import evaluate as E
from wardwise.operators import neighbours as B
from wardwise.operators import prepare as M
from wardwise.operators import select as G
from wardwise.operators import train as R
from wardwise.operators.profile import union_all
from wardwise.session import materialize, scratch_path
from wardwise.sources import readers, writers

KEY, LABEL = "encounter_id", "label"
_NOT_FEATURES = [*(c for c in K.SPLIT_DROP_COLUMNS if c != KEY), "created_at"]


@dataclass
class TrainingTable:
    """Prepared rows (key, label, split, features) with what was fitted to prepare them."""

    raw: DataFrame
    data: DataFrame
    features: list[str]
    encoder: StringIndexerModel
    scaler: dict[str, tuple[float, float]]

    @property
    def train(self) -> DataFrame:
        return self.data.filter("split = 'train'")


def engineered(cohort: DataFrame) -> DataFrame:
    """Cleaned cohort with derived features and the binary target."""
    derived = N.derive_features(N.handle_missing(cohort))
    return derived.withColumn(LABEL, C.encode_target(F.col("readmitted")))


def training_table(df: DataFrame, drop: list[str] | None = None) -> TrainingTable:
    """Split, encode and scale; encoder and scaler see the training rows only.

    The split table is written once: encoder, scaler and every fit read it from there. Ranks within a label leave
    up to `HOT_ROWS` of its rows in one task, so the scaled rows are dealt out again by their key.
    """
    rows = H.drop_columns(df, *_NOT_FEATURES, *(drop or []))
    raw = materialize(M.stratified_split(rows, LABEL, KEY), "split")
    features = [c for c in raw.columns if c not in (KEY, LABEL, "split")]
    train = raw.filter("split = 'train'")
    text = [c for c in N.string_columns(raw) if c in features]
    encoder = M.fit_label_encoder(train, text)
    coded = M.label_encode(raw, encoder)
    scaler = M.fit_scaler(coded.filter("split = 'train'"), features)
    data = materialize(M.standard_scale(coded, scaler).repartition(KEY), "training")
    return TrainingTable(raw, data, features, encoder, scaler)


def balance(train: DataFrame, features: list[str]) -> DataFrame:
    """SMOTE over the given rows, for use inside a fold."""
    return B.smote(train, features, LABEL, KEY)


def balance_over(features: list[str]) -> Callable[[DataFrame, list[str]], DataFrame]:
    """SMOTE over the given features, whichever of them a fit uses."""
    return lambda train, _: balance(train, features)


def balanced(table: TrainingTable) -> DataFrame:
    """Validation and test rows as they are, training rows balanced; written once."""
    made = balance(table.train, table.features).withColumn("split", F.lit("train"))
    rest = table.data.filter("split <> 'train'").withColumn("copy", F.lit(0))
    return materialize(made.unionByName(rest.select(made.columns)), "balanced")


def feature_lists(table: TrainingTable, methods: list[str], top_ns: list[int]):
    return G.feature_lists(G.cut(G.rank_all(table.train, table.features, LABEL, methods), top_ns))


# --- sensitivity ------------------------------------------------------------------------------

ANALYSES: dict[str, tuple[Callable, Callable, list[str]]] = {
    # name: (filter of the encounters, change of the engineered rows, dropped columns)
    "Main": (lambda df: df, lambda df: df, []),
    "Comorbidity_1": (lambda df: df, lambda df: H.comorbidity_cohort(df, 1),
                      ["comorbidity", "number_diagnoses"]),
    "Comorbidity_2": (lambda df: df, lambda df: H.comorbidity_cohort(df, 2),
                      ["comorbidity", "number_diagnoses"]),
    "Diabetes_diag_all": (H.diabetes_any, H.mask_diabetes_diagnoses, []),
    "Diabetes_diag1": (H.diabetes_primary, lambda df: df, ["diag_1", "diag_1_category"]),
}


def analysis_table(clinic, analysis: str) -> TrainingTable:
    """Training table of one analysis; the cohort filter comes before the index admissions. The cohort is written
    once, as the share of nulls, the class sizes and the split each read it."""
    before, after, drop = ANALYSES[analysis]
    cohort = materialize(H.merged_cohort(clinic, before(clinic.encounters)), "cohort")
    return training_table(after(engineered(cohort)), drop)


def sensitivity_study(clinic, methods: list[str], top_n: int, grids: dict[str, dict],
                      folds: int = K.CV_FOLDS, analyses: list[str] | None = None,
                      parallelism: int = 1, even: bool = True) -> DataFrame:
    """Tuned results of every analysis: search, store the result sets, read back and stack."""
    path = scratch_path(clinic.spark, "sensitivity")

    def one(analysis: str) -> list[DataFrame]:
        table = analysis_table(clinic, analysis)
        lists = feature_lists(table, methods, [top_n])
        found, _ = R.cv_search_all_methods(table.data, methods, lists, top_n, grids, folds, LABEL,
                                           balance_over(table.features) if even else None)
        writers.write_result_sets({(analysis, fs, kind): df for fs, kinds in found.items()
                                   for kind, df in kinds.items()}, path)
        rows = []
        for fs in methods:
            side = {k: readers.read_result_set(clinic.spark, path, analysis, fs, k)
                    .withColumns({"analysis": F.lit(analysis), "fs": F.lit(fs)})
                    for k in ("val", "test")}
            rows.append(E.collect_sensitivity(side["val"], side["test"].withColumn(
                "pos", F.monotonically_increasing_id()), "pos"))
        return rows

    jobs = [lambda a=a: one(a) for a in analyses or list(ANALYSES)]
    return union_all([df for rows in R.run_parallel(clinic.spark, jobs, parallelism) for df in rows])
