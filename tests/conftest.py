import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.schema import SURVEY_SCHEMA  # noqa: E402
from cohortlens.session import local_session  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="cohortlens-tests")
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-test-ckpt-"))
    yield s
    s.stop()


def survey_rows(spark, rows):
    """Survey frame with the declared schema from dicts (missing keys → null)."""
    names = SURVEY_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SURVEY_SCHEMA)


_FIELDS = (
    "id", "Gender", "Age", "City", "Profession", "Academic Pressure", "Work Pressure", "Financial Stress", "CGPA",
    "Sleep Duration", "Degree", "Depression",
)
# Six respondents whose results are worked out by hand in the tests: stress 4, 2, 5, 4, 3, 3.
COHORT = [
    dict(zip(_FIELDS, row))
    for row in [
        (11, "Female", 19.0, "Arden", "Tutor", 2.0, 4.0, 6.0, 8.0, "4-5 hours", "BSc", 0),
        (12, "Male", 21.0, "Arden", "Tutor", 1.0, 2.0, 3.0, 6.0, "6-6.5 hours", "BSc", 1),
        (13, "Female", 22.0, "Brook", "Nurse", 5.0, 5.0, 5.0, 7.0, "More than 8 hours", "MSc", 1),
        (14, "Male", 26.0, "Brook", "Nurse", 0.0, 3.0, 9.0, 9.0, "less than 5 HOURS", "MSc", 1),
        (15, "Male", 30.0, "Brook", None, 3.0, 3.0, 3.0, None, "8-8 hours", "PhD", 0),
        (16, "Female", 31.0, "Arden", "Nurse", 4.0, 4.0, 1.0, 5.0, "6-8 hours", "BSc", 1),
    ]
]


@pytest.fixture
def cohort(spark):
    return survey_rows(spark, COHORT)
