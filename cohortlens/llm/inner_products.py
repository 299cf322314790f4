"""Exact top-k search by inner product (operator 11).

Vectors are processed by descending length.  All of them are rotated by the
right singular vectors of the whole table, so the first coordinates hold most of
every product; the product over a few of them plus the product of the lengths of
the rests (Cauchy-Schwarz) bounds the whole product.  A pair whose bound is below
the k-th best score its query already has is dropped; a query whose length times
that of the next vector is below it is done with the block.  What is left is
multiplied out in whole numbers, so results do not depend on the rotation.

The work is cut into cells, a block of queries by a block of vectors of like
length, each a bounded group.  Queries are blocked by the length that a vector
must have to reach their first bound (their k-th best among the HEAD longest
vectors), so a cell whose vectors are all too short is never made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import bounded_broadcast, ship_package, stage
from cohortlens.llm.vectors import EXACT_DOUBLE, embeddings, matrix, products, whole_vectors

#: The longest vectors, which give every query its first bound.
HEAD = 1024
#: Rows of a block of queries and of a block of vectors.
BLOCK = 8192
#: Pairs looked at together in a cell.
PAIRS = 1 << 20
#: The tables of products are merged in so many tasks before the driver adds them up.
MERGES = 16
#: Rounding of double arithmetic, relative to the product of two lengths; generous.
SLACK = 1e-9


# --- the rotation -----------------------------------------------------------


def _tables(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((width, width))
        for batch in batches:
            rows = matrix(batch.column(0), width).astype(np.float64)
            held += rows.T @ rows
        part = TaskContext.get().partitionId() % MERGES
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([held.tobytes()], pa.binary())], ["part", "held"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        for table in batch.column(1):
            one = np.frombuffer(table.as_py())
            held = one if held is None else held + one
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([held.tobytes()], pa.binary())], ["part", "held"])


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows' ``ints``, those of the largest singular values first (width x width).

    Products of components are summed in the tasks, added up in MERGES tasks and
    then here: what the driver gets depends on the width alone.
    """
    parts = rows.select("ints").mapInArrow(_tables(width), "part int, held binary")
    table = np.zeros(width * width)
    for row in parts.repartition(MERGES, "part").mapInArrow(_added, "part int, held binary").toLocalIterator():
        table = table + np.frombuffer(row.held)
    if not width or not np.isfinite(table).all():
        return np.eye(width)
    return np.linalg.eigh(table.reshape(width, width))[1][:, ::-1].copy()


# --- a cell -----------------------------------------------------------------


class Best:
    """The k best results (by score, then smaller id, those without id last) of each of n queries."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.astype(np.float64)  # what a score must reach at least
        self.query, self.score, self.id, self.no_id = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        old, new = (self.query, self.score, self.id, self.no_id), (query, score, ids, no_id)
        query, score, ids, no_id = (np.concatenate([a, b]) for a, b in zip(old, new))
        order = np.lexsort((ids, no_id, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kth = rank == self.k - 1
        self.floors[query[kth]] = np.maximum(self.floors[query[kth]], score[order][kth])
        order = order[rank < self.k]
        self.query, self.score, self.id, self.no_id = query[rank < self.k], score[order], ids[order], no_id[order]


class Side:
    """Queries or vectors of a cell: whole numbers, rotated coordinates, lengths, lengths of the rests."""

    def __init__(self, table: pa.Table, turn: np.ndarray, cuts: list[int]):
        self.ints = matrix(table["ints"], len(turn))
        ids = table["id"].combine_chunks()
        self.no_id = np.asarray(ids.is_null())
        self.id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.turned = self.ints.astype(np.float64) @ turn
        rest = np.cumsum(self.turned[:, ::-1] ** 2, 1)[:, ::-1]
        self.rest = {c: np.sqrt(rest[:, c]) for c in cuts}
        self.length = np.sqrt(table["squared"].to_numpy().astype(np.float64))


def cuts(width: int) -> list[int]:
    """After how many coordinates a product is looked at."""
    return sorted({width // 8, width // 4, width // 2} - {0})


def search(queries: Side, vectors: Side, best: Best, steps: list[int]) -> None:
    """Put the vectors, which come by descending length, that are among the best of a query into ``best``."""
    n = len(queries.id)
    bound = float(queries.length.max(initial=0)) * float(vectors.length.max(initial=0))
    many = max(64, PAIRS // max(1, n))
    for start in range(0, len(vectors.id), many):
        part = slice(start, start + many)
        live = np.flatnonzero(queries.length * vectors.length[start] * (1 + SLACK) >= best.floors)
        if not len(live):
            return
        slack = SLACK * queries.length[live][:, None] * vectors.length[part]
        if steps:
            first = steps[0]
            partial = queries.turned[live, :first] @ vectors.turned[part, :first].T
            reach = partial + queries.rest[first][live][:, None] * vectors.rest[first][part] + slack
            hit = reach >= best.floors[live][:, None]
        else:
            partial, hit = np.zeros_like(slack), np.ones(slack.shape, bool)
        hit &= (queries.id[live][:, None] != vectors.id[part]) | queries.no_id[live][:, None] | vectors.no_id[part]
        i, j = np.nonzero(hit)
        if len(i) * 8 > hit.size:
            score = products(queries.ints[live], vectors.ints[part], bound)[i, j]
            i, j = live[i], j + start
        else:
            i, j, score = _few(queries, vectors, best.floors, live[i], j + start, partial[i, j], steps, bound)
        enough = score >= best.floors[i]
        i, j = i[enough], j[enough]
        best.add(i, score[enough], vectors.id[j], vectors.no_id[j])


def _few(queries, vectors, floors, i, j, partial, steps, bound) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) that still reach their floor after every cut, with their whole-number scores."""
    for a, b in zip(steps, steps[1:]):
        partial = partial + _dots(queries.turned[:, a:b], vectors.turned[:, a:b], i, j)
        slack = SLACK * queries.length[i] * vectors.length[j]
        stay = partial + queries.rest[b][i] * vectors.rest[b][j] + slack >= floors[i]
        i, j, partial = i[stay], j[stay], partial[stay]
    if bound < EXACT_DOUBLE:
        return i, j, _dots(queries.ints.astype(np.float64), vectors.ints.astype(np.float64), i, j).astype(np.int64)
    return i, j, _dots(queries.ints, vectors.ints, i, j)


def _dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of row i of a and row j of b, some pairs at a time."""
    out = np.empty(len(i), a.dtype)
    many = max(1, PAIRS // max(1, a.shape[1]))
    for at in range(0, len(i), many):
        part = slice(at, at + many)
        out[part] = np.einsum("ij,ij->i", a[i[part]], b[j[part]])
    return out


# --- the operator -----------------------------------------------------------

_FOUND = "row bigint, query_id bigint, vec_id bigint, score bigint"


def _blocks(rows: DataFrame, order: list[Column], total: int, name: str) -> DataFrame:
    """Rows with ``block``, in ranges of the order of about BLOCK rows, written."""
    dealt = rows.repartitionByRange(1 + total // BLOCK, *order)
    return stage(dealt.withColumn("block", F.spark_partition_id()), name)


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """For each row of ``queries`` its ``k`` best rows of ``vectors``: query_id, rank (from 1), vec_id, score.

    Both have id (bigint), ints (array<bigint>) and squared (its squared length),
    as ``whole_vectors`` makes them.  The score is the inner product, exactly; a
    shorter vector counts as filled up with zeros.  Equal scores rank by smaller
    id, those without id last (rows that agree in id and score too stand in any
    order: they look alike).  Rows with a query's own id are no results of it; a
    query without id has no own rows.  Every query row gets results of its own,
    a repeated one too; fewer than ``k`` vectors give fewer rows, none give none.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    keyed = [d.select("id", "ints", "squared", F.monotonically_increasing_id().alias("row")) for d in (vectors, queries)]
    vectors, queries = stage(keyed[0], "vectors"), stage(keyed[1], "vector-queries")
    seen = vectors.select("ints").unionByName(queries.select("ints"))
    width = seen.agg(F.max(F.size("ints"))).first()[0] or 0
    n_vectors, n_queries = vectors.count(), queries.count()
    longest_first = [F.col("squared").desc(), F.col("row")]

    # At most HEAD rows; they bound what the k-th best score of a query is at least.
    longest = vectors.orderBy(*longest_first).limit(HEAD).select("id", "ints", "squared").toArrow()
    shared = spark.sparkContext.broadcast((rotation(vectors, width), longest))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, head = shared.value
        top = Side(head, turn, [])
        for batch in batches:
            mine = Side(pa.Table.from_batches([batch]), turn, [])
            bound = float(mine.length.max(initial=0)) * float(top.length.max(initial=0))
            floor = np.full(len(mine.id), -np.inf)
            for at in range(0, len(mine.id), HEAD):
                some = slice(at, at + HEAD)
                score = products(mine.ints[some], top.ints, bound).astype(np.float64)
                own = (mine.id[some][:, None] == top.id) & ~mine.no_id[some][:, None] & ~top.no_id
                score[own] = -np.inf
                if score.shape[1] >= k:
                    floor[some] = np.partition(score, -k, 1)[:, -k]
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(floor > 0, floor / mine.length * (1 - SLACK), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor), pa.array(need)], [*batch.schema.names, "floor", "need"])

    kind = "id bigint, ints array<bigint>, squared bigint, row bigint"
    bounded = queries.mapInArrow(floors, f"{kind}, floor double, need double")
    q = _blocks(bounded, [F.col("need"), F.col("row")], n_queries, "query-blocks").withColumnRenamed("block", "qb")
    v = _blocks(vectors, longest_first, n_vectors, "vector-blocks").withColumnRenamed("block", "vb")

    # One row a block: a cell is made where the longest vector of the one reaches the least need of the other.
    reach = v.groupBy("vb").agg(F.sqrt(F.max("squared").cast("double")).alias("longest"))
    asked = q.groupBy("qb").agg(F.min("need").alias("least"))
    cells = stage(reach.join(asked, F.col("longest") >= F.col("least")).select("vb", "qb"), "cells")
    n_cells = cells.count()
    left = q.join(bounded_broadcast(cells, n_cells), "qb")
    right = v.join(bounded_broadcast(cells, n_cells), "vb")

    def cell(mine: pa.Table, others: pa.Table) -> pa.Table:
        turn, _ = shared.value
        steps = cuts(len(turn))
        others = others.sort_by([("squared", "descending")])
        asked = Side(mine, turn, steps)
        best = Best(mine["floor"].to_numpy(), k)
        search(asked, Side(others, turn, steps), best, steps)
        found = pa.array(best.id, mask=best.no_id)
        whose = pa.array(best.query)
        columns = [mine["row"].take(whose), mine["id"].take(whose), found, pa.array(best.score)]
        return pa.Table.from_arrays(columns, ["row", "query_id", "vec_id", "score"])

    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(cell, _FOUND)
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


EVERY = 50
SCALE = 256
TOP = 5


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vector whose vec_id is divisible by 50 the 5 others of the highest whole-number inner product."""
    rows = whole_vectors(embeddings(spark, sf_dir), "embedding", SCALE, id="vec_id")
    return top_inner_products(rows, rows.filter(F.col("id") % EVERY == 0), TOP)


ORACLE_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.ints AS DOUBLE[]), CAST(v.ints AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
