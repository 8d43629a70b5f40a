"""Domain constants shared by the operators."""

# ---------------------------------------------------------------------------
# They decide results and must stay exactly as given.
# ---------------------------------------------------------------------------

SENTINEL = "?"

# First matching range wins; both ends are part of the range.
ICD9_RANGES = [
    ("circulatory", 390, 459),
    ("respiratory", 460, 519),
    ("digestive", 520, 579),
    ("diabetes", 250.0, 251.0),
    ("injuries", 800, 999),
    ("musculoskeletal", 710, 739),
    ("genitourinary", 580, 629),
    ("neoplasms", 140, 239),
]
ICD9_CATEGORY_ORDER = [
    "diabetes", "circulatory", "respiratory", "digestive", "genitourinary",
    "musculoskeletal", "neoplasms", "injuries", "other",
]

DIAGNOSIS_COLUMNS = ["diag_1", "diag_2", "diag_3"]

# Discharge dispositions of patients who died or went to a hospice.
DEATH_OR_HOSPICE_IDS = [11, 13, 14, 19, 20, 21]

FILL_UNKNOWN_COLUMNS = [
    "medical_specialty", "payer_code", "race", "diag_1", "diag_2", "diag_3",
    "admission_type_desc", "discharge_disposition_desc", "admission_source_desc",
]
MEDIAN_COLUMNS = ["age", "time_in_hospital", "num_medications", "num_lab_procedures"]
INTEGER_COLUMNS = [
    "age", "time_in_hospital", "num_medications", "num_lab_procedures", "num_procedures",
]
SPLIT_DROP_COLUMNS = [
    "encounter_id", "patient_nbr", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "readmitted",
]
READMITTED_VALUES = ["<30", ">30", "NO"]
TARGET_CODES = {
    "multiclass": {"NO": 0, ">30": 1, "<30": 2},
    "risk_level": {"NO": 0, ">30": 1, "<30": 3},
}

AGE_BINS_7 = ([0, 30, 40, 50, 60, 70, 80, 100],
              ["<30", "30-39", "40-49", "50-59", "60-69", "70-79", "80+"])
AGE_BINS_10 = ([0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100],
               ["0-10", "10-20", "20-30", "30-40", "40-50", "50-60", "60-70", "70-80",
                "80-90", "90-100"])

# Three-digit prefixes of the disease groups.
DISEASE_PREFIXES = [
    ("Diabetes", ["250"]),
    ("Hypertension", ["401", "402", "403", "404", "405"]),
    ("Heart Disease", ["410", "411", "412", "413", "414", "428"]),
    ("Kidney Disease", ["580", "581", "582", "583", "584", "585", "586", "587", "588", "589"]),
    ("Respiratory Disease", [
        "460", "461", "462", "463", "464", "465", "466", "490", "491", "492", "493", "494", "495",
        "496", "497", "498", "499", "500", "501", "502", "503", "504", "505", "506", "507", "508",
        "509", "510", "511", "512", "513", "514", "515", "516", "517", "518", "519"]),
]

# Labels of frequent diagnosis main codes; the zero-padded form of a code has the same label.
DIAGNOSIS_LABELS = {
    "250": "Diabetes mellitus\n糖尿病",
    "428": "Congestive heart failure\n充血性心力衰竭",
    "401": "Essential hypertension\n原发性高血压",
    "414": "Other chronic ischemic heart disease\n慢性缺血性心脏病",
    "276": "Fluid/electrolyte/acid-base disorder\n水电解质代谢紊乱",
    "427": "Cardiac dysrhythmias\n心律不齐",
    "599": "Urinary system disorder\n泌尿系统其他疾病",
    "786": "Respiratory/chest symptoms\n呼吸系统症状",
    "496": "COPD\n慢性阻塞性肺病",
    "486": "Pneumonia\n肺炎",
}
UNKNOWN_DIAGNOSIS = "未知"

# Keywords of a CCS description, first matching category wins.
CCS_KEYWORDS = [
    ("circulatory", ["circulatory"]),
    ("respiratory", ["respiratory"]),
    ("digestive", ["digestive"]),
    ("diabetes", ["diabetes"]),
    ("injuries", ["injury", "fracture", "wound", "burn", "trauma"]),
    ("musculoskeletal", ["musculoskeletal"]),
    ("genitourinary", ["genitourinary", "urinary", "renal", "kidney"]),
    ("neoplasms", ["neoplasm", "cancer", "tumor", "carcinoma"]),
]

DOSE_TEXT = {"Up": "Increased", "Down": "Decreased", "Steady": "No Change", "No": "Not Given"}
DOSE_MISSING = "Not Given"
RATE_DRUGS = [
    "metformin", "glimepiride", "glipizide", "glyburide", "pioglitazone", "rosiglitazone",
    "insulin", "glyburide-metformin", "glipizide-metformin",
]
ICU_SOURCE_PATTERN = (
    "Emergency Room|Transfer from critical access hospital|Transfer from a hospital"
)

DRUG_COLUMNS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone",
    "acarbose", "miglitol", "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
]
FEATURE_CATEGORIES = {
    "Demographic": ["race", "gender", "age", "age_midpoint", "age_group"],
    "Administrative": [
        "encounter_index", "admission_type_desc", "admission_source_desc",
        "discharge_disposition_desc", "payer_code", "change",
    ],
    "Clinical": [
        "diag_1", "diag_2", "diag_3", "number_diagnoses", "number_inpatient",
        "number_outpatient", "number_emergency", "medical_specialty", "comorbidity",
        "diag_1_category", "diag_2_category", "diag_3_category",
    ],
    "Utilization": [
        "num_lab_procedures", "num_procedures", "num_medications", "time_in_hospital",
        "rolling_avg",
    ],
    "Medication": [*DRUG_COLUMNS, "diabetesMed"],
    "Label": ["readmitted"],
}

STAY_CATEGORIES = [
    (3, "Short Stay (1-3 days)"),
    (7, "Medium Stay (4-7 days)"),
    (14, "Long Stay (8-14 days)"),
]
STAY_OVERFLOW = "Extended Stay (15+ days)"
COMORBIDITY_NAMES = [
    (0, "No Comorbidities"), (1, "Single Comorbidity"), (2, "Two Comorbidities"),
]
COMORBIDITY_OVERFLOW = "Multiple Comorbidities (3+)"

VALID_AGE = (0, 120)
VALID_STAY = (1, 365)

TEST_SHARE = 0.2
VALIDATION_SHARE = 0.2
SEED = 42
CV_FOLDS = 5
TOP_N = 15
TOP_N_SWEEP = [5, 10, 15]
SELECTION_METHODS = ["L1", "MutualInfo", "TreeImportance"]
MODEL_NAMES = ["LogisticRegression", "RandomForest", "GradientBoosting"]
