"""Code categories for dim_diagnosis / dim_procedure.

Diagnosis: the ICD-10-CM chapter of the three-character category (letter,
digit, digit or letter).  Procedure: the CPT section of the five-digit code.  Codes that do
not follow the pattern get 'Unclassified'.  ``icd_category`` and ``cpt_category`` are
expressions over the ranges below; ``code_ranges`` gives them as a table for ``operators.ranges``, where
a site's own table can take their place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNCLASSIFIED = "Unclassified"

# ICD-10-CM chapters as (first category, last category, chapter name).
ICD10_CHAPTERS = [
    ("A00", "B99", "Infectious and parasitic"),
    ("C00", "D49", "Neoplasms"),
    ("D50", "D89", "Blood and immune"),
    ("E00", "E89", "Endocrine and metabolic"),
    ("F00", "F99", "Mental and behavioural"),
    ("G00", "G99", "Nervous system"),
    ("H00", "H59", "Eye and adnexa"),
    ("H60", "H95", "Ear and mastoid"),
    ("I00", "I99", "Circulatory system"),
    ("J00", "J99", "Respiratory system"),
    ("K00", "K95", "Digestive system"),
    ("L00", "L99", "Skin and subcutaneous"),
    ("M00", "M99", "Musculoskeletal"),
    ("N00", "N99", "Genitourinary system"),
    ("O00", "O9A", "Pregnancy and childbirth"),
    ("P00", "P96", "Perinatal conditions"),
    ("Q00", "Q99", "Congenital anomalies"),
    ("R00", "R99", "Symptoms and signs"),
    ("S00", "T88", "Injury and poisoning"),
    ("U00", "U99", "Special purposes"),
    ("V00", "Y99", "External causes"),
    ("Z00", "Z99", "Health status factors"),
]

# CPT sections as (first code, last code, section name).
CPT_SECTIONS = [
    (100, 1999, "Anesthesia"),
    (10004, 69990, "Surgery"),
    (70010, 79999, "Radiology"),
    (80047, 89398, "Pathology and Laboratory"),
    (99202, 99499, "Evaluation and Management"),
    (90281, 99607, "Medicine"),
]


def icd_category(code: Column) -> Column:
    cat = F.upper(F.substring(code, 1, 3))
    ladder = F.when(~cat.rlike("^[A-Z][0-9][0-9A-Z]$") | cat.isNull(), F.lit(UNCLASSIFIED))
    for lo, hi, name in ICD10_CHAPTERS:
        ladder = ladder.when(cat.between(lo, hi), F.lit(name))
    return ladder.otherwise(F.lit(UNCLASSIFIED))


def cpt_category(code: Column) -> Column:
    num = F.when(code.rlike("^[0-9]{5}$"), code.cast("int"))
    ladder = F.when(num.isNull(), F.lit(UNCLASSIFIED))
    for lo, hi, name in CPT_SECTIONS:
        ladder = ladder.when(num.between(lo, hi), F.lit(name))
    return ladder.otherwise(F.lit(UNCLASSIFIED))


# ---- the same ranges as a table, for the range lookup ----
def icd_position(code: Column) -> Column:
    """Place of the three-character category in the order of codes; null for codes off the pattern."""
    cat = F.upper(F.substring(code, 1, 3))
    return F.when(cat.rlike("^[A-Z][0-9][0-9A-Z]$"), F.conv(cat, 36, 10).cast("bigint"))


def cpt_position(code: Column) -> Column:
    return F.when(code.rlike("^[0-9]{5}$"), code.cast("bigint"))


def code_ranges(spark, system: str):
    """(low, high, category) of ``icd10`` or ``cpt``."""
    if system == "icd10":
        rows = [(int(a, 36), int(b, 36), name) for a, b, name in ICD10_CHAPTERS]
    else:
        rows = [tuple(r) for r in CPT_SECTIONS]
    return spark.createDataFrame(rows, "low bigint, high bigint, category string")
