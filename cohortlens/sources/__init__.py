"""Sources and sinks: CSV/Parquet files and the survey view over lineitem."""

from cohortlens.sources.files import materialize, preview, read_csv, write_csv, write_outputs, write_parquet
from cohortlens.sources.published import Run, drop_old_runs, published
from cohortlens.sources.stored_schema import read_csv_inferred
from cohortlens.sources.survey_view import read_survey, survey_from_lineitem

__all__ = [
    "Run",
    "drop_old_runs",
    "materialize",
    "preview",
    "published",
    "read_csv",
    "read_csv_inferred",
    "read_survey",
    "survey_from_lineitem",
    "write_csv",
    "write_outputs",
    "write_parquet",
]
