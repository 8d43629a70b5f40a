"""Clinical scalar expressions. Every function maps Columns to a Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardwise import constants as K

def col(name: str) -> Column:
    """Column by exact name; drug names contain hyphens."""
    return F.col(f"`{name}`")


def case(pairs, default=None) -> Column:
    """CASE over (condition, value) pairs, in order."""
    (cond, value), *rest = list(pairs)
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out if default is None else out.otherwise(default)


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == K.SENTINEL)


def is_diabetes(code: Column) -> Column:
    """True for 250.x codes, never null."""
    return F.coalesce(F.trim(code).startswith("250"), F.lit(False))


def any_diabetes(*codes: Column) -> Column:
    return reduce(lambda a, b: a | b, [is_diabetes(c) for c in codes])


def plain_number(text: Column) -> Column:
    """Number of a text, null where it is none; a cast alone would take 250d or 0x1p8 as well."""
    return F.translate(F.trim(text), "dDfFxX", "??????").try_cast("double")


def icd9_category(code: Column, diabetes_closed: bool = True) -> Column:
    """One of nine diagnosis groups; anything that is not a plain number is ``other``.

    The ranges do not overlap, so they are walked from the top with one comparison per edge: the
    number is the common part of all conditions and is taken once, and the code stays short.
    """
    number = plain_number(code)
    steps = []
    for name, low, high in sorted(K.ICD9_RANGES, key=lambda r: -r[1]):
        above = number >= high if name == "diabetes" and not diabetes_closed else number > high
        steps += [(above, "other"), (number >= low, name)]
    return case(steps, "other")


def age_midpoint(age: Column, compat: bool = False) -> Column:
    """Middle of an age range ``[lo-hi)``. ``compat`` gives lo + hi // 2 instead."""
    low = F.regexp_extract(age, r"(\d+)-(\d+)", 1).try_cast("int")
    high = F.regexp_extract(age, r"(\d+)-(\d+)", 2).try_cast("int")
    if compat:
        return (low + F.floor(high / 2)).cast("double")
    return (low + high) / 2


def age_group(age: Column) -> Column:
    return F.nullif(F.regexp_extract(age, r"(\d+-\d+)", 1), F.lit(""))


def bin_age(years: Column, bins=K.AGE_BINS_7) -> Column:
    """Half-open bins; null outside of them."""
    edges, labels = bins
    return case([((years >= lo) & (years < hi), label)
                 for lo, hi, label in zip(edges, edges[1:], labels)])


def comorbidity_level(number_diagnoses: Column) -> Column:
    return F.when(number_diagnoses <= 1, 0).when(number_diagnoses <= 3, 1).otherwise(2)


def categorize_disease(code: Column) -> Column:
    prefix = F.substring(code, 1, 3)
    named = [(prefix.isin(codes), name) for name, codes in K.DISEASE_PREFIXES]
    return case([(code.isNull(), "None"), *named], "Other")


def dominant(a: Column, b: Column, c: Column) -> Column:
    """Most frequent of three values, nulls ignored, ties to the smallest."""
    return F.when((a == b) | (a == c), a).when(b == c, b).otherwise(F.least(a, b, c))


def zero_pad(text: Column, width: int) -> Column:
    """Left pad with zeros without ever cutting."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def normalize_icd9(code: Column) -> Column:
    """Digits and dots only, zero-padded to three digits before a dot and to five without."""
    digits = F.regexp_replace(code, r"[^0-9.]", "")
    parts = F.split(digits, r"\.")
    dotted = F.concat(zero_pad(F.get(parts, F.lit(0)), 3), F.lit("."), F.get(parts, F.lit(1)))
    return (F.when(digits.contains("."), dotted)
            .when(digits == "", "")
            .otherwise(zero_pad(digits, 5)))


def diagnosis_label(normalized: Column) -> Column:
    """Name of a normalised code: by full code, then by the part before the dot."""
    names = {**K.DIAGNOSIS_LABELS, **{k.zfill(5): v for k, v in K.DIAGNOSIS_LABELS.items()}}
    table = literal_map(names)
    main = F.get(F.split(normalized, r"\."), F.lit(0))
    return F.coalesce(table[normalized], table[main], F.lit(K.UNKNOWN_DIAGNOSIS))


def ccs_category(description: Column) -> Column:
    text = F.lower(description)
    return case([(reduce(lambda a, b: a | b, [text.contains(w) for w in words]), name)
                 for name, words in K.CCS_KEYWORDS], "other")


def dose_change(dose: Column) -> Column:
    return F.coalesce(literal_map(K.DOSE_TEXT)[dose], F.lit(K.DOSE_MISSING))


def icu_flag(source_text: Column) -> Column:
    return F.coalesce(source_text.rlike(f"(?i){K.ICU_SOURCE_PATTERN}"), F.lit(False)).cast("int")


def encode_target(readmitted: Column, kind: str = "binary") -> Column:
    if kind == "binary":
        return F.when(readmitted == "<30", 1).otherwise(0)
    if kind not in K.TARGET_CODES:
        raise ValueError(f"unknown target type {kind!r}")
    return literal_map(K.TARGET_CODES[kind])[readmitted]


def readmit_bin(readmitted: Column, suffix: str = "") -> Column:
    return (F.when(readmitted.eqNullSafe("<30"), f"Early Readmission{suffix}")
            .otherwise(f"No Early Readmission{suffix}"))


def stay_category(days: Column) -> Column:
    return case([(days <= top, name) for top, name in K.STAY_CATEGORIES], K.STAY_OVERFLOW)


def comorbidity_count(*codes: Column) -> Column:
    """Number of recorded diagnoses in a row."""
    return reduce(lambda a, b: a + b, [F.when(is_missing(c), 0).otherwise(1) for c in codes])


def comorbidity_name(count: Column) -> Column:
    return case([(count == n, name) for n, name in K.COMORBIDITY_NAMES], K.COMORBIDITY_OVERFLOW)


def risk_score(medications: Column, days: Column, labs: Column) -> Column:
    terms = [medications > 10, days > 7, labs > 20]
    return reduce(lambda a, b: a + b, [F.when(t, 1).otherwise(0) for t in terms])


def feature_category(feature: Column, default: str = "Unknown") -> Column:
    """Category of a feature by its name, else by the ``base_`` prefix of a one-hot name."""
    owner = {f: name for name, features in K.FEATURE_CATEGORIES.items() for f in features}
    prefixed = case([(feature.startswith(f"{base}_"), name) for base, name in owner.items()],
                    default)
    return F.coalesce(literal_map(owner)[feature], prefixed)
