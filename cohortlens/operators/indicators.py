"""Indicator columns without a bound on the number of categories: a distributed index and one sparse column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.schema import require_columns, safe_col
from cohortlens.sources.files import materialize

#: Categories of a column, and bytes of their text, up to which its part of the index is broadcast whole.
BROADCAST_CATEGORIES = 100_000
BROADCAST_BYTES = 32 << 20
#: A category that holds at least 1 / HOT_SHARE of the rows is hot, so a column has at most HOT_SHARE hot ones.
HOT_SHARE = 256
#: The most ``top_values`` ranks: up to here every task passes on no more than its own best k (Spark's default bound).
MOST_RANKS = 1000
#: Places over which rows that need no lookup are spread in a shuffle join.
SPREAD = 1 << 20


def category_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, category, position, n_rows): the distinct non-null values of ``cols``, numbered from 0.

    Positions run through the columns in the order given and, within a column,
    through its values as text by code point, the order of ``one_hot``.  Values
    are counted by partial aggregation, sorted by range over all tasks and
    numbered by the row's place in its task plus the rows of the tasks before;
    only one number a task meets in one place, nothing reaches the driver.  The
    index is written to the shared scratch folder.  Columns that are given twice
    raise; without values the index is empty.
    """
    cols = list(cols)
    require_columns(df, cols)
    if len({c.lower() for c in cols}) < len(cols) or not cols:
        raise ValueError(f"give every column once: {cols}")
    entries = [F.struct(F.lit(i).alias("ord"), safe_col(c).cast("string").alias("category")) for i, c in enumerate(cols)]
    pairs = df.select(F.inline(F.array(*entries))).where(F.col("category").isNotNull())
    counts = pairs.groupBy("ord", "category").agg(F.count(F.lit(1)).alias("n_rows"))
    # The id holds the task in its upper and the row's place in the task in its lower 33 bits; it is written
    # together with the sorted rows, so a later pass sees the same places.
    placed = materialize(counts.orderBy("ord", "category").withColumn("id", F.monotonically_increasing_id()), "categories")
    task = F.shiftright("id", 33)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("task", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))  # one row a task
    names = F.array(*[F.lit(c) for c in cols])
    numbered = placed.withColumn("task", task).join(F.broadcast(offsets), "task").select(
        names[F.col("ord")].alias("column"),
        "category",
        (F.col("offset") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).alias("position"),
        "n_rows",
    )
    return materialize(numbered, "category-index")


def _positions(rows: DataFrame, key: str, found: str, entries: DataFrame, size: dict) -> DataFrame:
    """``rows`` with ``found``: the position of the category ``key`` (null where there is none)."""
    table = entries.select(F.col("category").alias(key), F.col("position").alias(found), "n_rows")
    if size["n"] <= BROADCAST_CATEGORIES and size["bytes"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table.drop("n_rows")), key, "left")
    # Rows of hot categories find their position in a small broadcast table.  They and rows without a category
    # then pass the shuffle join under keys that match nothing, spread by the task they come from.  The key is a
    # struct: two plain columns would let the planner drop the constant one and join all these rows by null.
    is_hot = F.col("n_rows") * HOT_SHARE >= F.lit(size["rows"])
    hot = table.where(is_hot).select(key, F.col(found).alias("hot"))
    cold = table.where(~is_hot).select(_place(F.lit(-1), F.col(key)).alias("want"), F.col(found).alias("cold"))
    looked = rows.join(F.broadcast(hot), key, "left").withColumn("task", F.spark_partition_id())
    settled = F.col(key).isNull() | F.col("hot").isNotNull()
    spread = F.when(settled, F.pmod(F.xxhash64("task"), F.lit(SPREAD)).cast("int")).otherwise(F.lit(-1))
    joined = looked.withColumn("want", _place(spread, F.when(~settled, F.col(key)))).join(cold, "want", "left")
    return joined.withColumn(found, F.coalesce("hot", "cold")).select(*rows.columns, found)


def _place(place: Column, key: Column) -> Column:
    return F.struct(place.alias("place"), F.coalesce(key, F.lit("")).alias("key"))


def sparse_one_hot(
    df: DataFrame, cols: Sequence[str], index: DataFrame | None = None, output: str = "indicators"
) -> DataFrame:
    """``df`` with ``output``: struct(size, indices), the one-hot indicators of all ``cols`` as one sparse column.

    ``size`` is the number of categories of all columns together, ``indices``
    the ascending positions (``category_index``) that are 1; all others are 0.
    A null adds no position, and neither does a value that a given ``index``
    lacks.  ``index`` may come from another table, so training and new rows
    share positions; by default it is made here.  A column's part of it is
    broadcast up to a checked size; beyond, rows meet it in a shuffle join that
    hot categories pass untouched.  An input column named like ``output`` raises.
    """
    cols = list(cols)
    require_columns(df, cols)
    if output.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {output!r} already")
    index = category_index(df, cols) if index is None else index
    measures = index.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_rows").alias("rows"),
        F.sum(F.octet_length("category")).alias("bytes"),
    )
    sizes = {r["column"]: r.asDict() for r in measures.where(F.col("column").isin(cols)).collect()}  # a row a column
    n_all = index.count()
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.select(
        *[safe_col(c).alias(n) for c, n in zip(df.columns, names)],
        *[safe_col(c).cast("string").alias(f"key{i}") for i, c in enumerate(cols)],
    )
    for i, c in enumerate(cols):
        if c in sizes:
            rows = _positions(rows, f"key{i}", f"found{i}", index.where(F.col("column") == F.lit(c)), sizes[c])
        else:
            rows = rows.withColumn(f"found{i}", F.lit(None).cast("bigint"))
    found = F.array_sort(F.array_compact(F.array(*[F.col(f"found{i}") for i in range(len(cols))])))
    return rows.select(
        *[F.col(n).alias(c) for c, n in zip(df.columns, names)],
        F.struct(F.lit(n_all).cast("bigint").alias("size"), found.alias("indices")).alias(output),
    )


def top_values(df: DataFrame, k: int, columns: Sequence[str] | None = None, buckets: int = 1 << 14) -> DataFrame:
    """(column, value, count, rank): the ``k`` most frequent values of each column, exact, however many values there are.

    The first pass counts rows by hash bucket of the value, at most ``buckets``
    numbers a column and task; a bucket's count bounds that of each value in it.
    The second counts the values in the ``k`` largest buckets of each column.
    The least of the best ``k`` found is a floor: the last pass counts the values
    of all buckets that reach it, so no other value is shuffled.  Where frequent
    values stand out, these are few; where all are alike, it is a plain count.

    Null is a value like others.  Ties go to the smaller value by code point,
    null last.  By default all string columns; others are counted as text.  A
    column with fewer than ``k`` values gives them all; an empty table gives no rows.
    """
    if not 1 <= k <= MOST_RANKS or buckets < 1:
        raise ValueError(f"k must be 1 to {MOST_RANKS} (beyond, rank value_counts) and buckets at least 1")
    cols = list(columns) if columns is not None else [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    require_columns(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint, rank int")
    entries = [F.struct(F.lit(i).alias("ord"), safe_col(c).cast("string").alias("value")) for i, c in enumerate(cols)]
    pairs = df.select(F.inline(F.array(*entries))).withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    weights = materialize(pairs.groupBy("ord", "bucket").agg(F.count(F.lit(1)).alias("weight")), "value-buckets")
    # At most ``buckets`` rows a column; beyond the broadcast bound the joins shuffle partial counts instead.
    small = len(cols) * buckets <= BROADCAST_CATEGORIES * 10

    def ranked(counts: DataFrame, size: str, *ties) -> DataFrame:
        order = Window.partitionBy("ord").orderBy(F.col(size).desc(), *ties)
        return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def counted(wanted: DataFrame) -> DataFrame:
        wanted = wanted.select("ord", "bucket")
        if small:
            some = pairs.join(F.broadcast(wanted), ["ord", "bucket"])
            return some.groupBy("ord", "value").agg(F.count(F.lit(1)).alias("count"))
        each = pairs.groupBy("ord", "bucket", "value").agg(F.count(F.lit(1)).alias("count"))
        return each.join(wanted, ["ord", "bucket"]).select("ord", "value", "count")

    by_value = F.col("value").asc_nulls_last()
    best = ranked(counted(ranked(weights, "weight", F.col("bucket"))), "count", by_value)
    floors = best.groupBy("ord").agg(F.min("count").alias("least"), F.count(F.lit(1)).alias("found"))
    floors = {r["ord"]: r["least"] if r["found"] == k else 1 for r in floors.collect()}  # a row a column
    enough = [(F.col("ord") == i) & (F.col("weight") >= least) for i, least in floors.items()]
    wanted = weights.where(reduce(lambda a, b: a | b, enough, F.lit(False)))
    names = F.array(*[F.lit(c) for c in cols])
    return ranked(counted(wanted), "count", by_value).select(names[F.col("ord")].alias("column"), "value", "count", "rank")
