"""Compressing vectors to short codes with a metric tree over the codebooks (operator 12).

Vectors of whole numbers are cut into equal parts; every part position has a
codebook, fitted by rounds of assigning each part to its nearest entry and
replacing each entry by its parts' mean, rounded down.  A code is the index of
the nearest entry for each part.

The nearest entry is found with a geometric near-neighbour access tree over the
codebook: a node has some entries as split points, every other one goes to the
child of its nearest split point, and a split point stores, for each child, the
range of its distances to the child's entries.  A query at distance d from a
split point and r from its best entry so far can have nothing as near in a child
whose range lies wholly outside [d - r, d + r]: the whole subtree goes.  Ranges
and distances are widened against rounding and the test is strict, so no entry
at the same distance is lost; entries are compared by whole-number squared
distances, ties by lower index.

An assignment is a pass over a written table; the sums of an entry's parts are
added up in the tasks first.  The driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import lookup, ship_package, stage
from cohortlens.llm.vectors import EXACT_DOUBLE, embeddings, matrix, whole_vectors

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Split points of a node, and entries that a leaf holds at most.
SPLITS = 8
LEAF = 12
#: Vectors worked on together.
ROWS = 4096
#: Widening of distances, relative; generous against double rounding.
ROUNDING = 1e-9


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance of every row of a and every row of b, exactly (whole numbers)."""
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    if 4 * max(int(aa.max(initial=0)), int(bb.max(initial=0))) < EXACT_DOUBLE:
        return aa[:, None] + bb - 2 * (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return aa[:, None] + bb - 2 * (a @ b.T)


class Tree:
    """Geometric near-neighbour access tree over the entries of a codebook (rows of whole numbers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members, None, None, []
        distance = squared_distances(self.entries[members], self.entries[members])
        chosen = [0]  # split points far from each other: the next is the farthest from those chosen
        while len(chosen) < SPLITS:
            chosen.append(int(distance[chosen].min(0).argmax()))
        chosen = sorted(set(chosen))
        others = np.setdiff1d(np.arange(len(members)), chosen)
        nearest = distance[chosen][:, others].argmin(0)
        low, high, children = [], [], []
        for c in range(len(chosen)):
            inside = others[nearest == c]
            if len(inside):
                ranges = np.sqrt(distance[chosen][:, inside].astype(np.float64))
                low.append(ranges.min(1) * (1 - ROUNDING))
                high.append(ranges.max(1) * (1 + ROUNDING))
                children.append((c, members[inside]))
        if len(children) == 1 and len(children[0][1]) == len(members) - 1:
            return members, None, None, []  # all entries alike: splitting them leads nowhere
        return members[chosen], np.array(low), np.array(high), [(c, self._node(m)) for c, m in children]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index of the nearest entry of each row (ties: lower), its squared distance, and how many distances were taken."""
        self.best = np.full(len(rows), np.iinfo(np.int64).max)
        self.index = np.full(len(rows), len(self.entries))
        self.taken = 0
        self._visit(self.root, rows, np.arange(len(rows)))
        return self.index, self.best, self.taken

    def _visit(self, node, rows: np.ndarray, at: np.ndarray) -> None:
        if not len(at):
            return
        members, low, high, children = node
        found = squared_distances(rows[at], self.entries[members])
        self.taken += found.size
        least = found.min(1)
        index = np.where(found == least[:, None], members, len(self.entries)).min(1)
        better = (least < self.best[at]) | ((least == self.best[at]) & (index < self.index[at]))
        self.best[at[better]], self.index[at[better]] = least[better], index[better]
        if not children:
            return
        distance = np.sqrt(found.astype(np.float64))
        near, far = distance * (1 - ROUNDING), distance * (1 + ROUNDING)
        home = found.argmin(1)
        for first in (True, False):  # each row's own child first: it gives the small radius that rules out the others
            for k, (c, child) in enumerate(children):
                mine = np.flatnonzero((home == c) == first)
                radius = (np.sqrt(self.best[at[mine]].astype(np.float64)) * (1 + ROUNDING))[:, None]
                out = (near[mine] - radius > high[k]) | (far[mine] + radius < low[k])
                self._visit(child, rows, at[mine[~out.any(1)]])


def assign(ints: np.ndarray, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (row by part) and squared distances summed over the parts."""
    width = ints.shape[1] // len(trees)
    codes, error = np.zeros((len(ints), len(trees)), np.int64), np.zeros(len(ints), np.int64)
    for p, tree in enumerate(trees):
        codes[:, p], distance, _ = tree.nearest(ints[:, p * width : (p + 1) * width])
        error += distance
    return codes, error


def _some_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _sums(width: int, books):
    """Per task: for each entry used the number and the sum of its parts, place by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(b) for b in books.value]
        parts, each = len(trees), width // len(trees)
        count = np.zeros((parts, ENTRIES), np.int64)
        total = np.zeros((parts, ENTRIES, each), np.int64)
        for batch in _some_rows(batches):
            ints = matrix(batch.column(0), width)
            codes, _ = assign(ints, trees)
            for p in range(parts):
                np.add.at(total[p], codes[:, p], ints[:, p * each : (p + 1) * each])
                count[p] += np.bincount(codes[:, p], minlength=ENTRIES)
        part, entry = np.nonzero(count)
        if len(part):
            ends = pa.array(np.arange(len(part) + 1) * each, pa.int32())
            sums = pa.ListArray.from_arrays(ends, pa.array(total[part, entry].ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), sums], ["part", "entry", "n", "sums"]
            )

    return run


def refit(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round: each used entry is its parts' mean, rounded down."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(books)
    by_task = rows.select("ints").mapInArrow(_sums(width, sent), "part int, entry int, n bigint, sums array<bigint>")
    places = by_task.select("part", "entry", "n", F.posexplode("sums").alias("place", "sum"))
    # One row for each entry and place: as many as the codebooks have numbers.
    merged = places.groupBy("part", "entry", "place").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")).toArrow()
    part, entry, place, total, n = (c.to_numpy() for c in merged.columns)
    new = [b.copy() for b in books]
    for p, book in enumerate(new):
        of = part == p
        book[entry[of], place[of]] = total[of] // n[of]
    sent.destroy()
    return new


def fit(rows: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks (one matrix a part) of ``rows`` (id, ints): from the ENTRIES smallest ids, then ``rounds`` rounds."""
    first = rows.select("id", "ints").orderBy(F.col("id").asc_nulls_last(), "ints").limit(ENTRIES).toArrow()
    first = matrix(first["ints"], width)
    books = [np.ascontiguousarray(b) for b in np.split(first, PARTS, axis=1)]
    for _ in range(rounds):
        books = refit(rows, books, width)
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all numbers of the codebooks, decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame) -> DataFrame:
    """Code and error of every row of ``rows`` (id, label, ints): vec_id, code, error, label_error, codebooks_sha256.

    Vectors are filled up with zeros to the longest one's length and to a multiple
    of PARTS.  The codebooks start as the vectors of the ENTRIES smallest ids
    (equal ids by their numbers, null ids last; fewer rows give fewer entries).
    ``code`` has two hex digits a part; ``error`` is the squared distance to the
    entries; ``label_error`` sums it over the rows of the label, null labels
    together.  Every row is kept, repeated ones too; no rows give none.
    """
    spark = rows.sparkSession
    ship_package(spark)
    rows = stage(rows.select("id", "label", "ints"), "vectors")
    longest = rows.agg(F.max(F.size("ints"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = fit(rows, width)
    sent = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(b) for b in sent.value]
        for batch in _some_rows(batches):
            codes, error = assign(matrix(batch.column(2), width), trees)
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    coded = stage(rows.mapInArrow(code, f"id bigint, label {kind}, code string, error bigint"), "codes")
    # A label may hold most of the rows, so its sum is handed back by the skew-safe lookup.
    key = [F.col("label").isNull().alias("no_label"), F.coalesce(F.col("label"), F.lit(0).cast(kind)).alias("of_label")]
    labelled = coded.select("id", "code", "error", *key)
    sums = labelled.groupBy("no_label", "of_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return lookup(labelled, sums, ["no_label", "of_label"], "n", coded.count()).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, its error and its label's."""
    return compress(whole_vectors(embeddings(spark, sf_dir), "embedding", SCALE, id="vec_id", label="label"))


def _round_sql(name: str, books: str) -> str:
    """Parts with the nearest entry of the codebook table ``books``."""
    return f"""
{name} AS MATERIALIZED (
  SELECT vec_id, label, part, ints, min(squared) AS squared, arg_min(entry, (squared, entry)) AS entry
  FROM (
    SELECT p.vec_id, p.label, p.part, p.ints, b.entry,
           list_sum(list_transform(generate_series(1, len(p.ints)), lambda i: (p.ints[i] - b.ints[i]) * (p.ints[i] - b.ints[i]))) AS squared
    FROM parts p JOIN {books} b ON p.part = b.part
  )
  GROUP BY vec_id, label, part, ints
)"""


def _books_sql(name: str, assigned: str, books: str) -> str:
    """The codebooks after a round: means rounded down, unused entries as they were."""
    return f"""
{name} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.ints, b.ints) AS ints
  FROM {books} b LEFT JOIN (
    SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS ints
    FROM (
      SELECT part, entry, place, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
      FROM (SELECT part, entry, unnest(ints) AS x, unnest(generate_series(1, len(ints))) AS place FROM {assigned})
      GROUP BY part, entry, place
    )
    GROUP BY part, entry
  ) m ON b.part = m.part AND b.entry = m.entry
)"""


ORACLE_SQL = (
    """
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
  SELECT vec_id, label, part, ints[1 + part * (len(ints) // 4) : (part + 1) * (len(ints) // 4)] AS ints
  FROM (SELECT *, unnest([0, 1, 2, 3]) AS part FROM whole)
),
books0 AS MATERIALIZED (
  SELECT part, ints, CAST(row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS INTEGER) AS entry
  FROM parts QUALIFY entry < 256
),"""
    + ",".join(
        x
        for r in range(ROUNDS)
        for x in (_round_sql(f"assigned{r}", f"books{r}"), _books_sql(f"books{r + 1}", f"assigned{r}", f"books{r}"))
    )
    + ","
    + _round_sql("final", f"books{ROUNDS}")
    + f""",
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(squared) AS BIGINT) AS error
  FROM final GROUP BY vec_id, label
),
whole_books AS (
  SELECT sha256(string_agg(array_to_string(ints, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes, whole_books
"""
)
