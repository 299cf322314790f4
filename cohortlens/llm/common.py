"""Helpers shared by the corpus operators: input columns, scratch tables, skew-safe lookups, Python columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.schema import safe_col
from cohortlens.session import scratch_path, ship_package

#: Words of all contracts: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A key that holds at least 1 / HOT_SHARE of all rows is hot; so there are at most HOT_SHARE hot keys.
HOT_SHARE = 256
#: A small side of at most this many rows may be broadcast; above it the join shuffles.
BROADCAST_ROWS = 100_000

#: Rows of a narrow scratch table that one task writes, at least.
STAGE_ROWS = 50_000
#: Rows handed to a Python function at once, and about how many bytes of them.
ROWS = 1024
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(df: DataFrame, **columns: str | None) -> DataFrame:
    """Only the named input columns, under internal names (``name=input column``), so no clash is possible."""
    return df.select(*[safe_col(source).alias(name) for name, source in columns.items()])


def without(df: DataFrame, outputs: Iterable[str]) -> DataFrame:
    """Drop input columns whose names (any case) the operator is about to produce."""
    taken = {c.lower() for c in outputs}
    return df.select(*[safe_col(c) for c in df.columns if c.lower() not in taken])


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write under the shared checkpoint folder and read back: cuts the lineage, survives lost executors.

    ``rows``, if known, is about how many rows of a narrow table there are: no
    more tasks write it than STAGE_ROWS each make sense for.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(1 + rows // STAGE_ROWS)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def lookup(rows: DataFrame, groups: DataFrame, key: Sequence[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with the one row per key in ``groups``, safe for hot keys.

    ``size`` (rows of the key) splits the keys: those holding 1/HOT_SHARE of
    ``total`` or more (at most HOT_SHARE keys, by arithmetic) are broadcast,
    so a hot key's rows never meet in one task; all other keys are joined by a
    shuffle.  Keys must not be null.
    """
    key = list(key)
    is_hot = F.col(size) * F.lit(HOT_SHARE) >= F.lit(total)
    hot = groups.filter(is_hot)
    cold = groups.filter(~is_hot)
    by_broadcast = rows.join(F.broadcast(hot), key)
    by_shuffle = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(cold, key)
    return by_broadcast.unionByName(by_shuffle)


def bounded_broadcast(df: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast hint when the counted size allows it; otherwise the join stays a shuffle join."""
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def add_columns(
    df: DataFrame,
    column: str,
    carry: Sequence[str] | None,
    functions: Sequence[Callable[[pa.Array, object], pa.Array]],
    new: dict[str, str],
    shared: object,
) -> DataFrame:
    """``df`` with the columns ``new`` (name → type), each made by one of ``functions``.

    The first function gets the values of ``column``, every other one what the
    function before it gave; all get ``shared``, which is broadcast.  ``carry``
    names the input columns to return (default: all); input columns named like
    a new one (in any case) are replaced.
    """
    spark = df.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(shared)
    carried = without(df.select(*[safe_col(c) for c in (df.columns if carry is None else carry)]), new).columns
    inner = df.select(safe_col(column).alias("value"), *[safe_col(c).alias(f"c{i}") for i, c in enumerate(carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = max(1, min(ROWS, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, each):
                part = batch.slice(at, each)
                made = [part.column(0)]
                for f in functions:
                    made.append(f(made[-1], sent.value))
                columns = [*part.columns[1:], *made[1:]]
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    types = [f.dataType.simpleString() for f in inner.schema.fields[1:]] + list(new.values())
    out = inner.mapInArrow(run, ", ".join(f"c{i} {t}" for i, t in enumerate(types)))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate([*carried, *new])])
