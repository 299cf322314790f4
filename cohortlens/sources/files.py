"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.schema import SURVEY_SCHEMA, safe_col


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = SURVEY_SCHEMA,
    header: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV scan with a declared schema (columns bind by position, bad fields become null).

    With ``schema=None`` the schema is inferred, which costs an extra pass over
    the files; give a schema for large inputs.
    """
    reader = spark.read.option("header", str(header).lower()).option("mode", mode)
    if schema is None:
        reader = reader.option("inferSchema", "true")
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header that keeps leading/trailing spaces of strings (Spark trims them by default)."""
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    mode: str = "overwrite",
    compression: str = "snappy",
    max_records_per_file: int | None = None,
    tasks_per_value: int | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Parquet sink; with ``partition_by`` one directory per value (null → default partition).

    By default no shuffle is added before a partitioned write: every task writes
    its own file per value it holds, so a value holding a third of all rows is
    still written by many tasks in parallel.  With many tasks and values that
    makes many small files; ``tasks_per_value`` then deals each value's rows, by
    a hash of the row, to so many tasks.  ``rows_per_file`` instead counts the
    rows of each value first and deals a value to as many tasks as its rows need,
    so a value with a third of all rows gives many files of like size and each
    rare one a single file; no file has more rows.  ``max_records_per_file`` caps
    file size.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if cols and rows_per_file:
        df = _dealt_by_weight(df, cols, rows_per_file)
        max_records_per_file = min(max_records_per_file or rows_per_file, rows_per_file)
    elif cols and tasks_per_value:
        salt = F.pmod(F.xxhash64(*[safe_col(c) for c in df.columns]), F.lit(tasks_per_value))
        df = df.repartition(*[safe_col(c) for c in cols], salt)
    writer = df.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


#: Values with rows for more than one file that may be broadcast; above it the counts are joined by a shuffle.
_BROADCAST_VALUES = 100_000


def _dealt_by_weight(df: DataFrame, cols: Sequence[str], rows_per_file: int) -> DataFrame:
    """``df`` by value of ``cols`` and a salt whose range is in proportion to the value's rows.

    Values of fewer rows than a file need no salt; those with more are at most
    the rows divided by ``rows_per_file``.  The salt is a hash of the row, so a
    task that runs again deals alike; rows equal in all columns stay together.
    """
    names = [f"__cohortlens_k{i}" for i in range(len(cols))]
    counts = df.groupBy(*[safe_col(c).alias(n) for c, n in zip(cols, names)]).agg(F.count(F.lit(1)).alias("__cohortlens_n"))
    heavy = materialize(counts.where(F.col("__cohortlens_n") > rows_per_file), "heavy-values")
    if heavy.count() <= _BROADCAST_VALUES:
        heavy = F.broadcast(heavy)
    # A tenth more salts than full files, so chance rarely makes a file overflow into a small second one.
    salts = F.coalesce(F.ceil(F.col("__cohortlens_n") * F.lit(1.1 / rows_per_file)), F.lit(1))
    salt = F.pmod(F.xxhash64(*[safe_col(c) for c in df.columns]), salts)
    match = [safe_col(c).eqNullSafe(F.col(n)) for c, n in zip(cols, names)]
    salted = df.join(heavy, reduce(and_, match), "left").select(*[safe_col(c) for c in df.columns], salt.alias("__cohortlens_salt"))
    return salted.repartition(*[safe_col(c) for c in cols], F.col("__cohortlens_salt")).drop("__cohortlens_salt")


def write_outputs(outputs: Mapping[str, DataFrame], root: str, **kwargs) -> dict[str, str]:
    """Write several named results as ``<root>/<name>.parquet``; return name → path."""
    paths = {}
    for name, df in outputs.items():
        path = f"{root.rstrip('/')}/{name}.parquet"
        write_parquet(df, path, **kwargs)
        paths[name] = path
    return paths


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Bounded preview: the first ``n`` rows, in a deterministic order when ``order_by`` is given."""
    if order_by:
        df = df.orderBy(*[safe_col(c) if isinstance(c, str) else c for c in order_by])
    return df.limit(n)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage before an operator that reads its input several times
    (stats pass, category discovery, main pass): those passes then scan a
    columnar table, pruned to the columns each needs, instead of recomputing
    the input; a lost executor only re-runs tasks of the current step.
    """
    from cohortlens.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)
