"""DuckDB expressions shared by several oracle statements."""

NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def icd9(code: str, closed: bool = True) -> str:
    number = f"CASE WHEN regexp_matches(trim({code}), '{NUMBER}') THEN TRY_CAST(trim({code}) AS DOUBLE) END"
    top = "<=" if closed else "<"
    return f"""CASE WHEN {number} BETWEEN 390 AND 459 THEN 'circulatory'
      WHEN {number} BETWEEN 460 AND 519 THEN 'respiratory'
      WHEN {number} BETWEEN 520 AND 579 THEN 'digestive'
      WHEN {number} >= 250 AND {number} {top} 251 THEN 'diabetes'
      WHEN {number} BETWEEN 800 AND 999 THEN 'injuries'
      WHEN {number} BETWEEN 710 AND 739 THEN 'musculoskeletal'
      WHEN {number} BETWEEN 580 AND 629 THEN 'genitourinary'
      WHEN {number} BETWEEN 140 AND 239 THEN 'neoplasms' ELSE 'other' END"""


MIDPOINT = ("((CAST(regexp_extract(age, '(\\d+)-(\\d+)', 1) AS INT)"
            " + CAST(regexp_extract(age, '(\\d+)-(\\d+)', 2) AS INT)) / 2.0::DOUBLE)")
MIDPOINT_COMPAT = ("CAST(CAST(regexp_extract(age, '(\\d+)-(\\d+)', 1) AS INT)"
                   " + CAST(regexp_extract(age, '(\\d+)-(\\d+)', 2) AS INT) // 2 AS DOUBLE)")
AGE_GROUP = "NULLIF(regexp_extract(age, '(\\d+-\\d+)', 1), '')"
LEVEL = "CASE WHEN number_diagnoses <= 1 THEN 0 WHEN number_diagnoses <= 3 THEN 1 ELSE 2 END"
CODE3 = "CASE readmitted WHEN 'NO' THEN 0 WHEN '>30' THEN 1 WHEN '<30' THEN 2 END"
TARGET = "CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END"


def disease(code: str) -> str:
    p = f"substr({code}, 1, 3)"
    return f"""CASE WHEN {code} IS NULL THEN 'None' WHEN {p} = '250' THEN 'Diabetes'
      WHEN {p} BETWEEN '401' AND '405' THEN 'Hypertension'
      WHEN {p} BETWEEN '410' AND '414' OR {p} = '428' THEN 'Heart Disease'
      WHEN {p} BETWEEN '580' AND '589' THEN 'Kidney Disease'
      WHEN {p} BETWEEN '460' AND '466' OR {p} BETWEEN '490' AND '519'
        THEN 'Respiratory Disease' ELSE 'Other' END"""


def mode3(a: str, b: str, c: str) -> str:
    return (f"CASE WHEN {a} = {b} OR {a} = {c} THEN {a} WHEN {b} = {c} THEN {b}"
            f" ELSE least({a}, {b}, {c}) END")


DOMINANT = f"""diseases AS (SELECT *, {disease('diag_1')} AS c1, {disease('diag_2')} AS c2,
  {disease('diag_3')} AS c3 FROM {{encounters}}),
grouped AS (SELECT *, {mode3('c1', 'c2', 'c3')} AS comorbidity_group FROM diseases)"""


def normalized(code: str) -> str:
    d = f"regexp_replace({code}, '[^0-9.]', '', 'g')"
    pad = lambda t, n: f"CASE WHEN length({t}) < {n} THEN lpad({t}, {n}, '0') ELSE {t} END"
    head, tail = f"split_part({d}, '.', 1)", f"split_part({d}, '.', 2)"
    return (f"CASE WHEN contains({d}, '.') THEN ({pad(head, 3)}) || '.' || {tail}"
            f" WHEN {d} = '' THEN '' ELSE {pad(d, 5)} END")


_LABELS = [
    ("250", "Diabetes mellitus\n糖尿病"), ("428", "Congestive heart failure\n充血性心力衰竭"),
    ("401", "Essential hypertension\n原发性高血压"),
    ("414", "Other chronic ischemic heart disease\n慢性缺血性心脏病"),
    ("276", "Fluid/electrolyte/acid-base disorder\n水电解质代谢紊乱"),
    ("427", "Cardiac dysrhythmias\n心律不齐"), ("599", "Urinary system disorder\n泌尿系统其他疾病"),
    ("786", "Respiratory/chest symptoms\n呼吸系统症状"), ("496", "COPD\n慢性阻塞性肺病"),
    ("486", "Pneumonia\n肺炎"),
]


def label(code: str) -> str:
    """Label of a normalised code; its main part decides, padded or not."""
    main = f"split_part({code}, '.', 1)"
    whens = " ".join(f"WHEN {main} IN ('{k}', '00{k}') THEN '{v}'" for k, v in _LABELS)
    return f"CASE {whens} ELSE '未知' END"


STACKED = """SELECT diag_1 AS code FROM {encounters} WHERE diag_1 IS NOT NULL
  UNION ALL SELECT diag_2 FROM {encounters} WHERE diag_2 IS NOT NULL
  UNION ALL SELECT diag_3 FROM {encounters} WHERE diag_3 IS NOT NULL"""

MERGED = """merged AS (SELECT e.* EXCLUDE (admission_type_id, admission_source_id),
  t.admission_type_desc, d.discharge_disposition_desc, s.admission_source_desc
  FROM {encounters} e
  LEFT JOIN {admission_type} t ON e.admission_type_id = t.admission_type_id
  LEFT JOIN {discharge_disposition} d ON e.discharge_disposition_id = d.discharge_disposition_id
  LEFT JOIN {admission_source} s ON e.admission_source_id = s.admission_source_id)"""

FIRST = """firsts AS (SELECT * FROM {encounters}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1)"""
COHORT = FIRST + """, cohort AS (SELECT * FROM firsts
  WHERE discharge_disposition_id IS NULL
    OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21))"""

DOSE = ("COALESCE(CASE {0} WHEN 'Up' THEN 'Increased' WHEN 'Down' THEN 'Decreased'"
        " WHEN 'Steady' THEN 'No Change' WHEN 'No' THEN 'Not Given' END, 'Not Given')")
