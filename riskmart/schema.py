"""Declared schemas of the hospital-encounter data set. Every raw column is a string."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------------------------------------------
DRUG_COLUMNS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide", "glipizide",
    "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol", "troglitazone",
    "tolazamide", "examide", "citoglipton", "insulin", "glyburide-metformin", "glipizide-metformin",
    "glimepiride-pioglitazone", "metformin-rosiglitazone", "metformin-pioglitazone",
]
ENCOUNTER_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id",
    "discharge_disposition_id", "admission_source_id", "time_in_hospital", "payer_code", "medical_specialty",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "diag_1", "diag_2", "diag_3", "number_diagnoses", "max_glu_serum", "A1Cresult",
    *DRUG_COLUMNS, "change", "diabetesMed", "readmitted",
]
DIAGNOSIS_DICTIONARY_COLUMNS = ["dgns_cd", "longdesc", "shortdesc", "version", "fyear"]
DIMENSIONS = {
    "admission_type": "admission_type_id",
    "discharge_disposition": "discharge_disposition_id",
    "admission_source": "admission_source_id",
}
KEPT_DRUGS = ["insulin", "metformin"]
LOW_VALUE_COLUMNS = ["weight", "citoglipton", "examide"]
EXCLUDED_DISPOSITIONS = [11, 13, 14, 19, 20, 21]
POSITIVE_OUTCOME = "<30"
AGE_BANDS = [
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
]
DIAGNOSIS_COLUMNS = ["diag_1", "diag_2", "diag_3"]
COUNTER_COLUMNS = [
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses",
]
VISIT_COUNTERS = ["number_inpatient", "number_emergency", "number_outpatient"]
TARGET = "readmit_30"
NON_FEATURE_COLUMNS = [
    "encounter_id", "patient_nbr", "split", "event_time", "write_time", "api_invocation_time", "is_deleted",
]
# ----------------------------------------------------------------------------------------------------------------


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


ENCOUNTERS = all_strings(ENCOUNTER_COLUMNS)
DIAGNOSIS_DICTIONARY = all_strings(DIAGNOSIS_DICTIONARY_COLUMNS)


def dimension_schema(name: str) -> T.StructType:
    return all_strings([DIMENSIONS[name], "description"])
