"""Queries of splits, encoders, feature selections and evaluation that SQL can state."""

from pyspark.sql import functions as F

from wardwise import constants as K
from wardwise.functions import clinical as C
from wardwise.operators import evaluate as E
from wardwise.operators import prepare as M
from wardwise.operators import select as G
from wardwise.operators.profile import union_all
from wardwise.plans.registry import register
from wardwise.plans.suite_queries import rounded
from wardwise.plans.table_queries import union_sql
from wardwise.session import materialize

# --- preparation ------------------------------------------------------------------------------
HASH = "CAST('0x' || substr(md5(CAST({0} AS VARCHAR) || ':{1}'), 1, 15) AS BIGINT)"
TARGET = "CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END"


def labelled(c):
    return c.encounters.select(
        "encounter_id", "race", "diag_1", "insulin", "time_in_hospital", "num_lab_procedures",
        "num_medications", C.encode_target(F.col("readmitted")).alias("label"))


LABELLED = f"""labelled AS (SELECT encounter_id, race, diag_1, insulin, time_in_hospital,
  num_lab_procedures, num_medications, {TARGET} AS label FROM {{encounters}}),
hashed AS (SELECT *, {HASH.format('encounter_id', 42)} AS h FROM labelled),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY h, encounter_id) AS r,
  COUNT(*) OVER (PARTITION BY label) AS n FROM hashed),
sized AS (SELECT *, round_even(n * CAST(0.2 AS DOUBLE), 0) AS n_test,
  round_even((n - round_even(n * CAST(0.2 AS DOUBLE), 0)) * CAST(0.2 AS DOUBLE), 0) AS n_val
  FROM ranked),
parts AS (SELECT * EXCLUDE (h, r, n, n_test, n_val), CASE WHEN r <= n_test THEN 'test'
  WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split FROM sized)"""


def parts(c):
    return M.stratified_split(labelled(c), "label", "encounter_id")


def stored_parts(c):
    """The split, written once for the fit and the transformation."""
    return materialize(parts(c), "split")


register("stratified_split", parts, f"WITH {LABELLED} SELECT * FROM parts")
register("stratified_split_two_way",
         lambda c: M.stratified_split(labelled(c), "label", "encounter_id", val=0.0).select(
             "encounter_id", "split"),
         f"WITH {LABELLED} SELECT encounter_id, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END "
         "AS split FROM sized")
register("stratified_split_hash",
         lambda c: M.stratified_split(labelled(c), "label", "encounter_id", exact=False).select(
             "encounter_id", "split"),
         f"""WITH {LABELLED}, u AS (SELECT encounter_id, CAST(h >> 30 AS DOUBLE) / 1073741824 AS u
  FROM hashed) SELECT encounter_id, CASE WHEN u < 0.2 THEN 'test'
  WHEN u < CAST(0.2 AS DOUBLE) + (1 - CAST(0.2 AS DOUBLE)) * CAST(0.2 AS DOUBLE) THEN 'val'
  ELSE 'train' END AS split FROM u""")
register("stratified_folds",
         lambda c: M.stratified_folds(labelled(c), "label", "encounter_id").select(
             "encounter_id", "label", "fold"),
         f"WITH {LABELLED} SELECT encounter_id, label, CAST((r - 1) % 5 AS INT) AS fold FROM ranked")
_CODED = ["race", "diag_1", "insulin"]


def _encoded(c):
    rows = stored_parts(c)
    return M.label_encode(rows, M.fit_label_encoder(rows.filter("split = 'train'"), _CODED))


_CODES = ", ".join(f"""COALESCE((SELECT code FROM (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1
  AS INT) AS code FROM (SELECT DISTINCT {n} AS v FROM parts WHERE split = 'train')) k
  WHERE k.v = parts.{n}), -1) AS {n}""" for n in _CODED)
register("label_encode", _encoded, f"WITH {LABELLED} SELECT * REPLACE ({_CODES}) FROM parts")
_HOT = ["race", "insulin"]


def _hot(c):
    rows = stored_parts(c)
    fitted = M.fit_one_hot(rows.filter("split = 'train'"), _HOT)
    return M.one_hot_columns(rows.select("encounter_id", *_HOT), fitted[2])


_FLAGS = ", ".join(
    f"CAST({n} = '{v}' AS INT)::DOUBLE AS \"{n}_{v}\""
    for n, values in (("race", ["?", "AfricanAmerican", "Asian", "Caucasian", "Hispanic", "Other"]),
                      ("insulin", ["Down", "No", "Steady", "Up"])) for v in values)
register("one_hot", _hot, f"SELECT encounter_id, {_FLAGS} FROM {{encounters}}")


def _hot_vectors(c):
    """Sum of every slot of the sparse vectors, by name."""
    from pyspark.ml.functions import vector_to_array

    rows = stored_parts(c)
    fitted = M.fit_one_hot(rows.filter("split = 'train'"), _HOT)
    out, names = M.one_hot(rows, fitted)
    def slots(n):
        return F.transform(vector_to_array(f"{n}__hot"), lambda v, i: F.struct(
            F.lit(n).alias("feature"), i.alias("slot"), v.alias("v")))

    cells = F.explode(F.concat(*[slots(n) for n in _HOT]))
    lookup = C.literal_map({f"{n}#{i}": s for n in _HOT for i, s in enumerate(names[n])})
    return (out.select(cells.alias("_c")).select("_c.*")
            .groupBy(lookup[F.concat("feature", F.lit("#"), "slot")].alias("slot_name"))
            .agg(F.sum("v").alias("ones")))


register("one_hot_vectors", _hot_vectors, union_sql(
    f"SELECT '{n}_' || {n} AS slot_name, CAST(COUNT(*) AS DOUBLE) AS ones FROM {{encounters}} "
    f"GROUP BY {n}" for n in _HOT))
_SCALED = ["time_in_hospital", "num_lab_procedures", "num_medications"]


def _scaled(c):
    rows = stored_parts(c)
    scaler = M.fit_scaler(rows.filter("split = 'train'"), _SCALED)
    return rounded(M.standard_scale(rows.select("encounter_id", "split", *_SCALED), scaler), 7)


_Z = ", ".join(f"""ROUND(({n} - (SELECT AVG({n}) FROM parts WHERE split = 'train'))
  / (SELECT STDDEV_POP({n}) FROM parts WHERE split = 'train'), 7) AS {n}""" for n in _SCALED)
register("standard_scale", _scaled, f"WITH {LABELLED} SELECT encounter_id, split, {_Z} FROM parts")

# --- selection --------------------------------------------------------------------------------
FEATURES = ["time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
            "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
            "admission_type_id", "discharge_disposition_id", "admission_source_id"]
BINS = 16


def _target(c):
    return c.encounters.select(*FEATURES, C.encode_target(F.col("readmitted")).alias("label"))


def _ranked(c):
    """Three deterministic rankings: binned information, correlation and difference of means."""
    df = _target(c)
    info = G.rank_mutual_info(df, FEATURES, bins=BINS)
    y = F.col("label")
    score = {"Correlation": lambda f: F.abs(F.corr(f, "label")),
             "MeanGap": lambda f: F.abs(F.avg(F.when(y == 1, F.col(f)))
                                        - F.avg(F.when(y == 0, F.col(f)))) / F.stddev_pop(f)}
    frames = []
    for method, of in score.items():
        row = df.agg(*[of(f).alias(f) for f in FEATURES])
        frames.append(row.unpivot([], FEATURES, "feature", "score")
                      .withColumn("method", F.lit(method)))
    both = union_all([*frames, info.select("feature", "score", "method")])
    return (both.withColumn("score", F.round("score", 9))
            .withColumn("rank", F.expr(
                "row_number() OVER (PARTITION BY method ORDER BY score DESC, feature)"))
            .select("method", "rank", "feature", "score"))


def _place(f):
    lo, hi = f"(SELECT MIN({f}) FROM y)", f"(SELECT MAX({f}) FROM y)"
    return (f"CAST(least(floor((CAST({f} AS DOUBLE) - {lo}) / ((CAST({hi} AS DOUBLE) - {lo}) "
            f"/ {BINS})), {BINS - 1}) AS INT)")


_RANKED = f"""y AS (SELECT {', '.join(FEATURES)}, {TARGET} AS label FROM {{encounters}}),
cells AS ({union_sql(f"SELECT '{f}' AS feature, {_place(f)} AS bin, label FROM y" for f in FEATURES)}),
joint AS (SELECT feature, bin, label, CAST(COUNT(*) AS DOUBLE) AS n FROM cells GROUP BY 1, 2, 3),
joined AS (SELECT *, SUM(n) OVER (PARTITION BY feature) AS t,
  SUM(n) OVER (PARTITION BY feature, bin) AS nx, SUM(n) OVER (PARTITION BY feature, label) AS ny
  FROM joint),
scores AS (SELECT 'MutualInfo' AS method, feature, SUM(n / t * ln(n * t / (nx * ny))) AS score
  FROM joined GROUP BY 2
UNION ALL {union_sql(f"SELECT 'Correlation', '{f}', abs(CORR({f}, label)) FROM y" for f in FEATURES)}
UNION ALL {union_sql(f"SELECT 'MeanGap', '{f}', abs(AVG({f}) FILTER (WHERE label = 1) - AVG({f}) FILTER (WHERE label = 0)) / STDDEV_POP({f}) FROM y" for f in FEATURES)}),
ranked AS (SELECT method, CAST(ROW_NUMBER() OVER (PARTITION BY method
  ORDER BY ROUND(score, 9) DESC, feature) AS INT) AS rank, feature, ROUND(score, 9) AS score
  FROM scores),
selected AS (SELECT s.top_n, ranked.* FROM ranked,
  (SELECT CAST(unnest([3, 5, 8]) AS INT) AS top_n) s WHERE rank <= top_n)"""
TOPS = [3, 5, 8]
METHODS = ["Correlation", "MeanGap", "MutualInfo"]


def _selected(c):
    return G.cut(_ranked(c), TOPS)


register("rank_mutual_info",
         lambda c: rounded(G.rank_mutual_info(_target(c), FEATURES, bins=BINS)).drop("rank"),
         f"WITH {_RANKED} SELECT method, feature, score FROM ranked WHERE method = 'MutualInfo'")
register("importance_long", lambda c: G.importance_long(_ranked(c)),
         f"WITH {_RANKED} SELECT method, feature, score AS importance_score FROM ranked")
register("selection_sweep", _selected, f"WITH {_RANKED} SELECT * FROM selected")
register("feature_union", lambda c: G.feature_union(_selected(c)),
         f"WITH {_RANKED} SELECT DISTINCT feature FROM selected")
register("common_features", lambda c: G.common_features(_selected(c)),
         f"WITH {_RANKED} SELECT top_n, feature, COUNT(DISTINCT method) AS methods FROM selected "
         "GROUP BY 1, 2 HAVING COUNT(DISTINCT method) >= 2")
register("common_summary",
         lambda c: G.common_summary(_selected(c)).select(
             "top_n", *[F.array_join(n, ",").alias(n) for n in ("shared_by_two", "shared_by_all")]),
         f"""WITH {_RANKED}, f AS (SELECT top_n, feature, COUNT(DISTINCT method) AS m FROM selected
  GROUP BY 1, 2)
SELECT top_n, COALESCE(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE m >= 2), '')
    AS shared_by_two,
  COALESCE(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE m >= 3), '') AS shared_by_all
FROM f GROUP BY 1""")
register("selection_summary", lambda c: G.selection_summary(_selected(c), TOPS),
         f"WITH {_RANKED} SELECT feature, " + ", ".join(
             f"CAST(MAX(CAST(top_n = {n} AS INT)) AS INT) AS top_{n}" for n in TOPS)
         + " FROM selected GROUP BY 1")
register("selection_counts", lambda c: G.selection_counts(_selected(c)), f"""
WITH {_RANKED} SELECT top_n, COUNT(DISTINCT feature) AS features, CAST(COUNT(DISTINCT feature)
  AS DOUBLE) * 100.0 / (SELECT COUNT(DISTINCT feature) FROM selected) AS percentage
FROM selected GROUP BY 1""")
register("selection_detail", lambda c: G.selection_detail(_selected(c), TOPS, METHODS),
         f"WITH {_RANKED} SELECT feature, " + ", ".join(
             f"CAST(MAX(CAST(top_n = {n} AND method = '{m}' AS INT)) AS INT) AS \"Top{n}_{m}\""
             for n in TOPS for m in METHODS) + " FROM selected GROUP BY 1")
_PROFILE = {"Demographic": "FALSE", "Administrative": "FALSE",
            "Clinical": "feature LIKE 'number_%'",
            "Utilization": "feature IN ('time_in_hospital', 'num_lab_procedures', "
                           "'num_procedures', 'num_medications')",
            "Medication": "FALSE", "Unknown": "feature LIKE '%_id'"}
register("category_profile", lambda c: G.category_profile(_selected(c)),
         f"WITH {_RANKED} SELECT top_n, method, " + ", ".join(
             f"COUNT(*) FILTER (WHERE {cond}) AS \"{n}\"" for n, cond in _PROFILE.items())
         + " FROM selected GROUP BY 1, 2")

# --- evaluation -------------------------------------------------------------------------------
register("evaluate_split", lambda c: rounded(E.evaluate_split(c.scored)), """
WITH c AS (SELECT split, COUNT(*) AS rows,
  CAST(COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
  CAST(COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
  CAST(COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn
  FROM {scored} GROUP BY 1),
r AS (SELECT split, label, RANK() OVER w + (COUNT(*) OVER (PARTITION BY split, probability) - 1)
  / 2.0::DOUBLE AS r FROM {scored} WINDOW w AS (PARTITION BY split ORDER BY probability)),
a AS (SELECT split, (SUM(r) FILTER (WHERE label = 1) - p * (p + 1) / 2) / (p * n) AS auc FROM r
  JOIN (SELECT split, CAST(SUM(label) AS DOUBLE) AS p, CAST(SUM(1 - label) AS DOUBLE) AS n
    FROM {scored} GROUP BY 1) USING (split) GROUP BY split, p, n)
SELECT split, rows, ROUND((tp + tn) / rows, 9) AS accuracy, ROUND(tp / (tp + fp), 9) AS precision,
  ROUND(tp / (tp + fn), 9) AS recall, ROUND(2 * tp / (2 * tp + fp + fn), 9) AS f1,
  ROUND(auc, 9) AS auc
FROM c JOIN a USING (split)""")
register("confusion_matrix", lambda c: E.confusion_matrix(c.scored, ["split"]), """
SELECT split, label AS actual, COUNT(*) FILTER (WHERE prediction = 0) AS predicted_0,
  COUNT(*) FILTER (WHERE prediction = 1) AS predicted_1 FROM {scored} GROUP BY 1, 2""")
register("class_report", lambda c: rounded(E.class_report(c.scored)), """
WITH k AS (SELECT CAST(k AS VARCHAR) AS class,
  (SELECT COUNT(*) FROM {scored} WHERE label = k AND prediction = k)::DOUBLE AS h,
  (SELECT COUNT(*) FROM {scored} WHERE prediction = k)::DOUBLE AS g,
  (SELECT COUNT(*) FROM {scored} WHERE label = k) AS s FROM (SELECT unnest([0, 1]) AS k)),
m AS (SELECT class, h / g AS p, h / s AS r, 2 * h / (g + s) AS f, s, h FROM k)
SELECT class, ROUND(p, 9) AS precision, ROUND(r, 9) AS recall, ROUND(f, 9) AS f1, s AS support FROM m
UNION ALL SELECT 'accuracy', ROUND(SUM(h) / SUM(s), 9), ROUND(SUM(h) / SUM(s), 9),
  ROUND(SUM(h) / SUM(s), 9), CAST(SUM(s) AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', ROUND(AVG(p), 9), ROUND(AVG(r), 9), ROUND(AVG(f), 9),
  CAST(SUM(s) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', ROUND(SUM(p * s) / SUM(s), 9), ROUND(SUM(r * s) / SUM(s), 9),
  ROUND(SUM(f * s) / SUM(s), 9), CAST(SUM(s) AS BIGINT) FROM m""")
register("pr_curve", lambda c: rounded(E.pr_curve(c.scored, ["split"])), """
WITH t AS (SELECT split, probability, SUM(label) AS pos, COUNT(*) AS n FROM {scored} GROUP BY 1, 2),
u AS (SELECT split, probability, SUM(pos) OVER w AS tp, SUM(n) OVER w AS n,
  SUM(pos) OVER (PARTITION BY split) AS p FROM t
  WINDOW w AS (PARTITION BY split ORDER BY probability DESC))
SELECT split, probability AS threshold, ROUND(CAST(tp AS DOUBLE) / n, 9) AS precision,
  ROUND(CAST(tp AS DOUBLE) / p, 9) AS recall FROM u
UNION ALL SELECT DISTINCT split, CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE FROM {scored}""")
register("calibration_curve", lambda c: rounded(E.calibration_curve(c.scored, ["split"])), """
SELECT split, CAST(greatest(ceil(probability * 10) - 1, 0) AS INT) AS bin, COUNT(*) AS n,
  ROUND(AVG(label), 9) AS fraction_positive, ROUND(AVG(probability), 9) AS mean_predicted
FROM {scored} GROUP BY 1, 2""")
register("subgroup_evaluation",
         lambda c: rounded(E.evaluate_split(
             c.scored.join(c.encounters.select("encounter_id", C.comorbidity_level(
                 F.col("number_diagnoses")).alias("comorbidity")), "encounter_id"),
             ["split", "comorbidity"])), """
WITH s AS (SELECT s.*, CASE WHEN number_diagnoses <= 1 THEN 0 WHEN number_diagnoses <= 3 THEN 1
  ELSE 2 END AS comorbidity FROM {scored} s JOIN {encounters} USING (encounter_id)),
c AS (SELECT split, comorbidity, COUNT(*) AS rows,
  CAST(COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
  CAST(COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
  CAST(COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn
  FROM s GROUP BY 1, 2)
SELECT split, comorbidity, rows, ROUND((tp + tn) / rows, 9) AS accuracy,
  ROUND(COALESCE(tp / NULLIF(tp + fp, 0), 0), 9) AS precision,
  ROUND(COALESCE(tp / NULLIF(tp + fn, 0), 0), 9) AS recall,
  ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 9) AS f1, ROUND(auc, 9) AS auc
FROM c JOIN (
  SELECT split, comorbidity, SUM(place - (p + 1) / 2.0) / (MAX(p) * MAX(n - p)) AS auc FROM (
    SELECT *, COUNT(*) OVER (PARTITION BY split, comorbidity) AS n, SUM(label) OVER (PARTITION BY split, comorbidity) AS p,
      RANK() OVER (PARTITION BY split, comorbidity ORDER BY probability)
        + (COUNT(*) OVER (PARTITION BY split, comorbidity, probability) - 1) / 2.0 AS place FROM s)
  WHERE label = 1 GROUP BY 1, 2) USING (split, comorbidity)""")


# Model results read as the tables that the comparisons take.
SIDES = {"cv": "L1", "val": "MutualInfo", "test": "TreeImportance"}


def _by_model(c, side):
    mine = F.col("feature_selection_method") == SIDES[side]
    return (c.model_results.filter(mine).groupBy("model_name")
            .agg(F.avg("auc_score").alias("auc"), F.avg("f1_score").alias("f1")))


def _compared(c):
    return E.compare_splits(*[_by_model(c, side) for side in SIDES])


_SIDE = ", ".join(
    f"AVG({m}_score) FILTER (WHERE feature_selection_method = '{fs}') AS {m}_{tag}"
    for tag, fs in SIDES.items() for m in ("auc", "f1"))
_SIDES = f"sides AS (SELECT model_name, {_SIDE} FROM {{model_results}} GROUP BY 1)"
_ROUNDED = ", ".join(f"ROUND({m}_{t}, 9) AS {m}_{t}" for t in ("cv", "val", "test")
                     for m in ("auc", "f1"))
register("compare_splits", lambda c: rounded(_compared(c)),
         f"WITH {_SIDES} SELECT model_name, {_ROUNDED} FROM sides")
register("overfit_check", lambda c: rounded(E.overfit_check(_compared(c), 0.0005)), f"""
WITH {_SIDES} SELECT model_name, {_ROUNDED}, ROUND(abs(auc_cv - auc_val), 9) AS cv_val_difference,
  ROUND(abs(auc_val - auc_test), 9) AS val_test_difference,
  CASE WHEN abs(auc_val - auc_test) > 0.0005 THEN 'may be overfitting' ELSE 'generalises' END
    AS verdict FROM sides""")
_CUT = "2024-01-16"


def _sensitivity(c):
    rows = c.model_results.select(
        "id", "created_at", F.concat(F.lit("Top"), "top_n_features").alias("analysis"),
        F.col("feature_selection_method").alias("fs"), F.col("model_name").alias("model"),
        "auc_score", "f1_score", "accuracy")
    early = F.col("created_at") < F.lit(_CUT)
    val = rows.filter(early).withColumnsRenamed({"auc_score": "val_auc", "f1_score": "val_f1"})
    test = rows.filter(~early).withColumnsRenamed({"auc_score": "test_auc", "f1_score": "test_f1"})
    return E.collect_sensitivity(val.drop("created_at"), test, "id")


register("collect_sensitivity", _sensitivity, f"""
WITH r AS (SELECT id, created_at, 'Top' || top_n_features AS analysis,
  feature_selection_method AS fs, model_name AS model, auc_score, f1_score, accuracy
  FROM {{model_results}}),
t AS (SELECT * FROM r WHERE created_at >= TIMESTAMP '{_CUT}'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY analysis, fs, model ORDER BY id) = 1)
SELECT v.analysis, v.fs, v.model, v.auc_score AS val_auc, v.f1_score AS val_f1,
  t.auc_score AS test_auc, t.f1_score AS test_f1, v.accuracy
FROM r v LEFT JOIN t ON v.analysis = t.analysis AND v.fs = t.fs AND v.model = t.model
WHERE v.created_at < TIMESTAMP '{_CUT}'""")


def _settings(c):
    early = F.col("created_at") < F.lit(_CUT)
    return c.model_results.filter(early), c.model_results.filter(~early)


_DIFF = ["auc_score", "f1_score"]
register("compare_settings",
         lambda c: rounded(E.compare_settings(*_settings(c), _DIFF)), union_sql(f"""
SELECT '{m}' AS metric, ROUND(d, 9) AS default_mean, ROUND(t, 9) AS tuned_mean,
  ROUND(t - d, 9) AS change, ROUND((t - d) / d * 100, 9) AS change_percent FROM (
  SELECT AVG({m}) FILTER (WHERE created_at < TIMESTAMP '{_CUT}') AS d,
    AVG({m}) FILTER (WHERE created_at >= TIMESTAMP '{_CUT}') AS t FROM {{model_results}})"""
                                                                        for m in _DIFF))
_KEYS = ["model_name", "feature_selection_method", "top_n_features"]
register("setting_differences",
         lambda c: rounded(E.setting_differences(*_settings(c), _KEYS, "auc_score")), f"""
WITH x AS (SELECT {', '.join(_KEYS)}, AVG(auc_score) FILTER (WHERE created_at < TIMESTAMP '{_CUT}')
  AS d, AVG(auc_score) FILTER (WHERE created_at >= TIMESTAMP '{_CUT}') AS t
  FROM {{model_results}} GROUP BY 1, 2, 3)
SELECT {', '.join(_KEYS)}, ROUND(d, 9) AS default_mean, ROUND(t, 9) AS tuned_mean,
  ROUND(t - d, 9) AS difference FROM x WHERE d IS NOT NULL AND t IS NOT NULL""")
for _name, _how, _sql in (("results_pivot", F.avg, "AVG"), ("results_pivot_max", F.max, "MAX")):
    register(_name,
             lambda c, how=_how: rounded(E.results_pivot(
                 c.model_results, ["top_n_features", "feature_selection_method"], "model_name",
                 K.MODEL_NAMES, "auc_score", how)),
             "SELECT top_n_features, feature_selection_method, " + ", ".join(
                 f"ROUND({_sql}(auc_score) FILTER (WHERE model_name = '{m}'), 9) AS \"{m}\""
                 for m in K.MODEL_NAMES) + " FROM {model_results} GROUP BY 1, 2")
register("best_config",
         lambda c: E.best_config(c.model_results, ["model_name"], "f1_score", "id"), """
SELECT * FROM {model_results}
QUALIFY ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY f1_score DESC, id) = 1""")
register("cv_vs_test_long",
         lambda c: rounded(E.cv_vs_test_long(_by_model(c, "cv"), _by_model(c, "test"))),
         f"WITH {_SIDES} " + union_sql(
             f"SELECT model_name, '{m}' AS metric, ROUND({m}_{t}, 9) AS score, '{kind}' AS type "
             "FROM sides" for t, kind in (("cv", "Cross-validation"), ("test", "Test Set"))
             for m in ("auc", "f1")))
register("union_results",
         lambda c: union_all([c.model_results.filter(F.col("top_n_features") == n).select(
             "id", "model_name", *extra) for n, extra in ((5, ["auc_score"]), (10, ["f1_score"]),
                                                          (15, ["auc_score", "f1_score"]))]), """
SELECT id, model_name, CASE WHEN top_n_features <> 10 THEN auc_score END AS auc_score,
  CASE WHEN top_n_features <> 5 THEN f1_score END AS f1_score FROM {model_results}""")
