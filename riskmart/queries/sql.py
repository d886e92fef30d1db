"""SQL texts shared by the checks, written independently of the operators."""

from __future__ import annotations

from .. import schema as S
from .tables import DIMENSION, ENCOUNTERS, RECORDS, plain

NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def hash_fraction(text: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"


def split_case(entity: str, seed: int = 42) -> str:
    u = hash_fraction(f"'{seed}:' || CAST({entity} AS VARCHAR)")
    return (f"CASE WHEN {u} < CAST(0.4 AS DOUBLE) THEN 'train' WHEN {u} < CAST(0.5 AS DOUBLE) THEN 'validation' "
            f"WHEN {u} < CAST(0.6 AS DOUBLE) THEN 'test' ELSE 'production' END")


def group_case(code: str) -> str:
    """Diagnosis group of a code column."""
    text = f"trim({code}, ' ')"
    v = f"CAST(CASE WHEN regexp_matches({text}, {NUMBER}) THEN {text} END AS DOUBLE)"
    return f"""CASE WHEN {code} IS NULL THEN 'Missing' WHEN substr({text}, 1, 1) IN ('V', 'E') THEN 'Other'
      WHEN NOT regexp_matches({text}, {NUMBER}) THEN 'Other'
      WHEN {v} >= 250 AND {v} < 251 THEN 'Diabetes'
      WHEN {v} BETWEEN 390 AND 459 OR trunc({v}) = 785 THEN 'Circulatory'
      WHEN {v} BETWEEN 460 AND 519 OR trunc({v}) = 786 THEN 'Respiratory'
      WHEN {v} BETWEEN 520 AND 579 OR trunc({v}) = 787 THEN 'Digestive'
      WHEN {v} BETWEEN 580 AND 629 OR trunc({v}) = 788 THEN 'Genitourinary'
      WHEN {v} BETWEEN 800 AND 999 THEN 'Injury' WHEN {v} BETWEEN 710 AND 739 THEN 'Musculoskeletal'
      WHEN {v} BETWEEN 140 AND 239 THEN 'Neoplasms' ELSE 'Other' END"""


def age_case(band: str) -> str:
    whens = " ".join(f"WHEN '{b}' THEN {i}" for i, b in enumerate(S.AGE_BANDS))
    return f"CAST(CASE {band} {whens} END AS INT)"


def _clean_select() -> str:
    drugs = [d for d in S.DRUG_COLUMNS if d not in S.LOW_VALUE_COLUMNS]
    changes = " + ".join(f"CASE WHEN \"{d}\" IN ('Up', 'Down') THEN 1 ELSE 0 END" for d in drugs)
    meds = " + ".join(f"CASE WHEN \"{d}\" = 'No' THEN 0 ELSE 1 END" for d in drugs)
    texts = ["race", "gender", "age", "diag_1", "diag_2", "diag_3", "max_glu_serum", "A1Cresult", "insulin",
             "metformin", "change", "diabetesMed"]
    parts = ["e.encounter_id", "e.patient_nbr", *[f'"{c}"' for c in texts]]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in S.COUNTER_COLUMNS]
    parts += [f"{group_case(c)} AS {c}_group" for c in S.DIAGNOSIS_COLUMNS]
    parts += [
        "CAST(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS INT) AS readmit_30",
        f"{age_case('age')} AS age_ordinal",
        f"CAST({changes} AS INT) AS n_med_changes", f"CAST({meds} AS INT) AS n_diabetes_meds",
        "CAST(\"A1Cresult\" IS NOT NULL AS INT) AS a1c_tested", "coalesce(\"A1Cresult\", 'NotTested') AS a1c_level",
        "CAST(max_glu_serum IS NOT NULL AS INT) AS glu_tested", "coalesce(max_glu_serum, 'NotTested') AS glu_level",
        "CAST(medical_specialty IS NULL AS INT) AS specialty_missing",
        "coalesce(medical_specialty, 'Unknown') AS medical_specialty",
        "CAST(payer_code IS NULL AS INT) AS payer_missing", "coalesce(payer_code, 'Unknown') AS payer_code",
        "CAST(number_inpatient AS BIGINT) + CAST(number_emergency AS BIGINT) + CAST(number_outpatient AS BIGINT) AS prior_visits_total",
        "l1.description AS admission_type", "l2.description AS discharge_disposition",
        "l3.description AS admission_source",
    ]
    return ",\n  ".join(parts)


LOOKUP = "SELECT dim_id, arg_max(description, line_no) AS description FROM dimension GROUP BY dim_id"

# The cleaned 44-column table with its split, over the encounters and dimension roles.
_MARKED = ",\n  ".join(f"CASE WHEN \"{c}\" <> '?' THEN \"{c}\" END AS \"{c}\"" for c in S.ENCOUNTER_COLUMNS)
CLEAN = f"""marked AS (SELECT {_MARKED} FROM encounters),
lookup AS ({LOOKUP}),
clean AS (SELECT {_clean_select()}, {split_case('patient_nbr')} AS split
  FROM marked e
  LEFT JOIN lookup l1 ON l1.dim_id = admission_type_id
  LEFT JOIN lookup l2 ON l2.dim_id = discharge_disposition_id
  LEFT JOIN lookup l3 ON l3.dim_id = admission_source_id
  WHERE NOT coalesce(CAST(discharge_disposition_id AS DOUBLE) IN (11, 13, 14, 19, 20, 21), false))"""

SPLIT_RECORDS = f"split_records AS (SELECT *, {split_case('entity')} AS split FROM records)"


def check(body: str) -> str:
    """``body`` with the roles it mentions as common table expressions."""
    ctes = []
    if "records" in body:
        ctes.append(f"records AS ({plain(RECORDS)})")
    if "split_records" in body:
        ctes.append(SPLIT_RECORDS)
    if "encounters" in body or "clean" in body or "marked" in body:
        ctes.append(f"encounters AS ({plain(ENCOUNTERS)})")
    if "dimension" in body or "clean" in body or "marked" in body or "lookup" in body:
        ctes.append(f"dimension AS ({plain(DIMENSION)})")
    if "clean" in body or "marked" in body:
        ctes.append(CLEAN)
    elif "lookup" in body:
        ctes.append(f"lookup AS ({LOOKUP})")
    body = body.strip()
    if not ctes:
        return body
    head = "WITH " + ",\n".join(ctes)
    return f"{head},\n{body[5:]}" if body.upper().startswith("WITH ") else f"{head}\n{body}"
