"""Inferred CSV schemas that stay the same from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.schema import safe_col
from cohortlens.sources.files import read_csv
from cohortlens.sources.published import _Files


def read_csv_inferred(
    spark: SparkSession, path: str | list[str], schema_path: str, header: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    """CSV scan with the schema stored at ``schema_path``; the first run infers and stores it.

    Inference follows the data, so a column may change its type when files are
    added.  Later runs keep the stored types: the data's own types are inferred
    again, and the columns where they differ are checked in one more pass over
    those columns.  Values that do not fit their stored type raise, by column
    name, instead of becoming null; so do other column names than the stored
    ones.  Delete the stored file to infer anew.
    """
    files = _Files(spark, schema_path)
    found = read_csv(spark, path, schema=None, header=header, mode=mode).schema
    if not files.exists(schema_path):
        files.write(schema_path, found.jsonValue())
    stored = T.StructType.fromJson(files.read(schema_path))
    if found.names != stored.names:
        raise ValueError(f"columns {found.names} are not the stored ones, {stored.names}")
    changed = [s for s, f in zip(stored, found) if s.dataType != f.dataType and s.dataType != T.StringType()]
    if changed:
        texts = read_csv(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in stored.names]), header, mode)
        fits = [F.count_if(safe_col(s.name).isNotNull() & safe_col(s.name).try_cast(s.dataType).isNull()) for s in changed]
        bad = [f"{s.name} ({n} not {s.dataType.simpleString()})" for s, n in zip(changed, texts.agg(*fits).first()) if n]
        if bad:
            raise ValueError(f"values do not fit the stored schema: {', '.join(bad)}")
    return read_csv(spark, path, stored, header, mode)
