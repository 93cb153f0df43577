"""Report queries on the normalised source model (R1a, R2a, R3a, R3d, R4a, J17).

``src`` is the dict of ten source frames; each report is one Spark SQL
statement over temp views of them (``{table}`` placeholders).  Result columns
keep the reference's names; counts are BIGINT, money DECIMAL(22,2), rates
DECIMAL(10,4) with MySQL's four-decimal division.

Report rows are groups of months, specialties and types, so their order is made in one task (``ordered``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.numeric import rate_percent_text
from ..operators.pairs import code_pairs_sql
from ..operators.readmission import return_flags_sql
from .views import sql

MONEY_SUM = "decimal(22,2)"


def ordered(select: str, sort_by: str) -> str:
    """A report in its order: one task sorts the groups, which are as many as the calendar's months, the specialties
    and the types allow, whatever the volume.  A range sort would run a sampling job and one more exchange for them."""
    return f"SELECT /*+ REPARTITION(1) */ * FROM ({select}) SORT BY {sort_by}"


def q1_source(src) -> DataFrame:
    """Monthly encounters and unique patients by specialty and type."""
    return sql(src, ordered("""
        WITH visits AS (
          SELECT provider_id, encounter_type, patient_id, date_format(encounter_date, 'yyyy-MM') AS encounter_month,
                 COUNT(encounter_id) AS visits
          FROM {encounters} GROUP BY ALL)
        SELECT encounter_month, specialty_name, encounter_type, SUM(visits) AS total_encounters,
               COUNT(DISTINCT patient_id) AS unique_patients
        FROM visits JOIN {providers} USING (provider_id) JOIN {specialties} USING (specialty_id)
        GROUP BY encounter_month, specialty_name, encounter_type""",
        "encounter_month, specialty_name"))


def q2_source(src, k: int = 10) -> DataFrame:
    """Top-k diagnosis/procedure code pairs (ties broken by both codes)."""
    return sql(src, """
        WITH dx AS (SELECT ed.encounter_id, d.icd10_code FROM {encounter_diagnoses} ed
                    JOIN {diagnoses} d ON ed.diagnosis_id = d.diagnosis_id),
             px AS (SELECT ep.encounter_id, pr.cpt_code FROM {encounter_procedures} ep
                    JOIN {procedures} pr ON ep.procedure_id = pr.procedure_id)
        """ + code_pairs_sql("dx", "px", "encounter_id", "icd10_code", "cpt_code", k))


def readmission_summary_sql(rows: str, group_col: str, patient_col: str) -> str:
    """count(distinct patient) and count(distinct patient with a return), per group.

    Two plain aggregations instead of two DISTINCT aggregates: one row per
    (group, patient) with ``max(within)``, then counts per group.
    """
    readm = f"CAST(SUM(CASE WHEN {patient_col} IS NOT NULL THEN _w ELSE 0 END) AS BIGINT)"
    total = f"COUNT({patient_col})"
    return ordered(f"""
        SELECT {group_col}, {total} AS total_discharges, {readm} AS readmitted_patients,
               {rate_percent_text(readm, total)} AS readmission_rate
        FROM (SELECT {group_col}, {patient_col}, MAX(CAST(within AS INT)) AS _w
              FROM {rows} GROUP BY {group_col}, {patient_col})
        GROUP BY {group_col}""", f"readmission_rate DESC NULLS LAST, {group_col}")


_SOURCE_FLAGS = """
WITH dis AS (SELECT patient_id, discharge_date, department_id, provider_id FROM {encounters}
             WHERE encounter_type = 'Inpatient' AND discharge_date IS NOT NULL),
     arr AS (SELECT patient_id, encounter_date FROM {encounters}),"""


def q3_source(src, days: int = 30) -> DataFrame:
    """Readmission by specialty, discharges attributed through the department.

    The department join fans out to every provider of the department; only the
    distinct (department, specialty) pairs matter for distinct counts (rewrite 1).
    """
    return sql(src, _SOURCE_FLAGS + return_flags_sql("dis", "arr", "patient_id", "discharge_date",
                                                     "encounter_date", days) + """,
        dept_spec AS (SELECT DISTINCT p.department_id, s.specialty_name
                      FROM (SELECT DISTINCT department_id, specialty_id FROM {providers}) p
                      JOIN {specialties} s ON p.specialty_id = s.specialty_id),
        per_patient AS (SELECT department_id, patient_id, bool_or(within) AS within
                 FROM flagged GROUP BY department_id, patient_id),
        attributed AS (SELECT ds.specialty_name, f.patient_id, f.within
                 FROM per_patient f JOIN dept_spec ds ON f.department_id = ds.department_id)
        """ + readmission_summary_sql("attributed", "specialty_name", "patient_id"))


def q3_source_provider(src, days: int = 30) -> DataFrame:
    """R3d: as R3a, attributed through the encounter's own provider."""
    return sql(src, _SOURCE_FLAGS + return_flags_sql("dis", "arr", "patient_id", "discharge_date",
                                                     "encounter_date", days) + """,
        attributed AS (SELECT s.specialty_name, f.patient_id, f.within
                 FROM flagged f JOIN {providers} p ON f.provider_id = p.provider_id
                 JOIN {specialties} s ON p.specialty_id = s.specialty_id)
        """ + readmission_summary_sql("attributed", "specialty_name", "patient_id"))


def q4_source(src) -> DataFrame:
    """Allowed amount by claim month and specialty.

    Encounters carry their specialty before they meet billing, so claims are shuffled once
    (a hot encounter is split by the skew join) and summed by month and specialty map-side.
    """
    return sql(src, ordered(f"""
        WITH owner AS (
          SELECT encounters.encounter_id, named.specialty_name FROM {{encounters}} AS encounters
          JOIN (SELECT provider_id, specialty_name FROM {{providers}} JOIN {{specialties}} USING (specialty_id)) AS named
            USING (provider_id))
        SELECT date_format(claims.claim_date, 'yyyy-MM') AS billing_month, owner.specialty_name,
               CAST(SUM(claims.allowed_amount) AS {MONEY_SUM}) AS total_revenue
        FROM {{billing}} AS claims JOIN owner USING (encounter_id)
        GROUP BY 1, 2""", "billing_month, total_revenue DESC"))


def scalar_subquery_counts(src) -> DataFrame:
    """Per encounter, correlated scalar subqueries in Spark SQL.

    Catalyst decorrelates each subquery into an aggregate plus a left outer join,
    the same plan as the pre-aggregated joins of the fact load, written the way
    the design notes write it.
    """
    return sql(src, """
        SELECT e.encounter_id,
               (SELECT COUNT(*) FROM {encounter_diagnoses} ed WHERE ed.encounter_id = e.encounter_id)
                 AS diagnosis_count,
               (SELECT COUNT(*) FROM {encounter_procedures} ep WHERE ep.encounter_id = e.encounter_id)
                 AS procedure_count,
               (SELECT CAST(SUM(b.allowed_amount) AS DECIMAL(22,2)) FROM {billing} b
                 WHERE b.encounter_id = e.encounter_id) AS total_allowed_amount
        FROM {encounters} e""")
