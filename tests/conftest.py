from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskmart import schema as S  # noqa: E402
from riskmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("riskmart-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def encounter(number, **overrides):
    """One raw encounter, all text: an elderly patient on insulin, every optional field filled."""
    row = dict.fromkeys(S.ENCOUNTER_COLUMNS, "Steady")
    row |= {c: "No" for c in S.DRUG_COLUMNS if c != "insulin"}
    row |= {c: str(number % 7 + 2) for c in S.COUNTER_COLUMNS}
    row |= {
        "encounter_id": f"e{number}", "patient_nbr": f"p{number}", "race": "Asian", "gender": "Male", "age": "[80-90)",
        "weight": "[75-100)", "discharge_disposition_id": "25", "payer_code": "MC", "medical_specialty": "Neurology",
        "diag_1": "786", "diag_2": "V45.1", "diag_3": "276", "max_glu_serum": "Norm", "A1Cresult": ">7", "change": "Ch",
        "diabetesMed": "Yes", "readmitted": ">30",
    }
    return [{**row, **overrides}[c] for c in S.ENCOUNTER_COLUMNS]


SPELLINGS = [text for i in S.EXCLUDED_DISPOSITIONS for text in (str(i), f"{i}.0", f" {i} ")]  # all of them leave


@pytest.fixture(scope="session")
def raw(spark):
    """Three encounters that stay, and one for every spelling of every excluded disposition."""
    stay = [
        encounter(1, readmitted="<30", diag_1="250.02", diag_2="410", diag_3="?", payer_code="?"),
        encounter(2, patient_nbr="p1", readmitted="NO", medical_specialty="?", A1Cresult="?", max_glu_serum="?"),
        encounter(3, metformin="Up", glipizide="Down", discharge_disposition_id="3.0", number_inpatient="4", number_emergency="0", number_outpatient="1"),
    ]
    leave = [encounter(100 + i, discharge_disposition_id=text) for i, text in enumerate(SPELLINGS)]
    return spark.createDataFrame(stay + leave, S.ENCOUNTERS)


@pytest.fixture(scope="session")
def dimensions(spark):
    """Keys 3 to 5 of each dimension, each written twice; the later text counts."""
    def frame(name):
        rows = [(str(k), f"{when} {name} {k}", line) for line, (when, k) in enumerate((w, k) for w in ("early", "late") for k in (3, 4, 5, 25))]
        return spark.createDataFrame(rows, f"{S.DIMENSIONS[name]} string, description string, line_no int")

    return {name: frame(name) for name in S.DIMENSIONS}
