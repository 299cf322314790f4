"""cohortlens: survey-table analytics as Spark DataFrame operators."""

from cohortlens import functions, operators, schema, sources

__all__ = ["functions", "operators", "schema", "sources"]
__version__ = "0.1.0"
