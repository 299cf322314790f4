"""Document fingerprints from prefix polynomial hashes (operator 6).

The prefix array of a text holds, for two bases modulo 2^31 - 1, the sum of its
code points times powers of the base.  Two reads of it give the hash of any span
whatever its place, so spans are compared in constant time and the longest
common extension of two places is found by binary search.

A fingerprint is the hash of the whole text followed by the SKETCH smallest of
the (scrambled) hashes of all its spans, which the prefix array gives in one
pass.  The spans of a text are its stretches of SPAN code points and the shorter
ones at its two ends (a window of SPAN places moved over the text from its first
to its last code point), so texts of any length share spans where they agree.
The share of common values among the smallest of two fingerprints estimates how
many of their texts' spans are common; it is exact for up to SKETCH spans in all.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import HOT_SHARE, add_columns, documents, pick, same, ship_package, stage
from cohortlens.schema import safe_col

PRIME = (1 << 31) - 1
BASES = (1_000_003, 7_368_787)
SPAN = 8
SKETCH = 32
#: Code points hashed at once: bounds the tables of powers and the memory of a very long text.
BLOCK = 1 << 18
_P = np.uint64(PRIME)


@functools.lru_cache(maxsize=1)
def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers and their inverses, for every place in a block."""
    out = []
    for base in BASES:
        both = []
        for b in (base, pow(base, -1, PRIME)):
            table = np.ones(1, np.uint64)
            while len(table) < BLOCK + SPAN:
                table = np.concatenate([table, table * np.uint64(pow(b, len(table), PRIME)) % _P])
            both.append(table)
        out.append(tuple(both))
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class PrefixHashes:
    """Prefix arrays of at most BLOCK + SPAN code points."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.prefix = []
        for powers, _ in _powers():
            terms = (codes + np.uint64(1)) * powers[: self.n] % _P
            self.prefix.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % _P]))

    def spans(self, starts: slice | np.ndarray | int, ends: slice | np.ndarray | int) -> np.ndarray:
        """62-bit hashes of the spans; equal for equal spans wherever they start."""
        high, low = (
            (p[ends] + _P - p[starts]) * inverse[starts] % _P for p, (_, inverse) in zip(self.prefix, _powers())
        )
        return high << np.uint64(31) | low

    def windows(self, count: int, first: bool) -> np.ndarray:
        """Hashes of the spans from the first ``count`` places, cut at the end; before a text's ``first`` place too."""
        whole = max(0, min(count, self.n - SPAN + 1))
        tail = np.arange(whole, count)
        head = np.arange(1, min(SPAN, self.n) if first else 1)
        return np.concatenate([
            self.spans(np.zeros_like(head), head),
            self.spans(slice(0, whole), slice(SPAN, SPAN + whole)),
            self.spans(tail, np.minimum(tail + SPAN, self.n)),
        ])

    def equal(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        return bool(
            self.spans(start, start + length) == other.spans(other_start, other_start + length)
        )

    def common_extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """Length of the longest common stretch that begins at both places."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


def _smallest(values: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct values."""
    few = 4 * SKETCH
    if len(values) > few:
        least = np.unique(np.partition(values, few)[:few])
        if len(least) >= SKETCH:
            return least[:SKETCH]
    return np.unique(values)[:SKETCH]


class Fingerprint:
    """Whole-text hash, sketch, and prefix arrays of the first block of a text."""

    def __init__(self, text: str):
        self.text = text
        codes = code_points(text)
        self.n = len(codes)
        whole, sketch, self.first = [0, 0], np.empty(0, np.uint64), None
        for start in range(0, max(1, self.n), BLOCK):
            hashes = PrefixHashes(codes[start : start + BLOCK + SPAN - 1])
            if self.first is None:
                self.first = hashes
            inside = min(BLOCK, self.n - start)
            for i, base in enumerate(BASES):
                whole[i] = (whole[i] + int(hashes.prefix[i][inside]) * pow(base, start, PRIME)) % PRIME
            if self.n:
                scrambled = hashes.windows(inside, start == 0) * np.uint64(0x9E3779B97F4A7C15)
                scrambled ^= scrambled >> np.uint64(29)
                scrambled *= np.uint64(0xBF58476D1CE4E5B9)
                sketch = _smallest(np.concatenate([sketch, _smallest(scrambled >> np.uint64(32))]))
        self.whole = (whole[0] << 31 | whole[1]) + (self.n << 62)
        self.sketch = set(sketch.tolist())

    def __str__(self) -> str:
        return f"{self.whole & (1 << 64) - 1:016x}" + "".join(f"{v:08x}" for v in sorted(self.sketch))

    def likeness(self, other: Fingerprint) -> float:
        return _likeness(self.whole == other.whole, self.sketch, other.sketch)

    def _block(self, start: int) -> PrefixHashes:
        return PrefixHashes(code_points(self.text[start : start + BLOCK])) if start else self.first

    def common_prefix(self, other: Fingerprint) -> int:
        """Length of the longest common prefix of the two texts, block by block."""
        for start in range(0, min(self.n, other.n), BLOCK):
            length = min(BLOCK, self.n - start, other.n - start)
            found = min(length, self._block(start).common_extension(0, other._block(start), 0))
            if found < length:
                return start + found
        return min(self.n, other.n)


def _likeness(same_text: bool, a: set[int], b: set[int]) -> float:
    if same_text:
        return 1.0
    union = sorted(a | b)[:SKETCH]
    return sum(v in a and v in b for v in union) / len(union) if union else 1.0


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1: 1 for equal texts, else the estimated share of common spans."""
    parts = [{int(f[i : i + 8], 16) for i in range(16, len(f), 8)} for f in (a, b)]
    return _likeness(a == b, *parts)


_COLUMNS = "kind int, part int, times bigint, id bigint, text string, n_chars bigint, edited_sha256 string, fingerprint string, "
_COLUMNS += "edited_fingerprint string, near_edited double, near_next double, common_next bigint"
_DONE, _LAST, _FIRST = 0, 1, 2
#: Results held in a worker until they are sent on.
_HELD = 256


class _Doc(NamedTuple):
    id: int | None
    text: str
    prints: Fingerprint
    more: int  # further rows of the same id and text


def _compare(doc: _Doc, following: _Doc, times: int = 1) -> tuple:
    half = len(doc.text) // 2
    edited = doc.text[: len(doc.text) - half] + following.text[:half]
    edited_prints = Fingerprint(edited)
    return (
        _DONE, None, times, doc.id, None, len(doc.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        str(doc.prints), str(edited_prints), doc.prints.likeness(edited_prints), doc.prints.likeness(following.prints),
        doc.prints.common_prefix(following.prints),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    types += [pa.float64(), pa.float64(), pa.int64()]
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each text with the one after it; the partition's first and last text are handed on."""
    part = TaskContext.get().partitionId()
    blank = (None,) * 7
    before = None
    for batch in batches:
        for key, text, more in zip(*batch.columns):
            doc = _Doc(key.as_py(), text.as_py(), Fingerprint(text.as_py()), more.as_py())
            if before is None:
                yield (_FIRST, part, 1, doc.id, doc.text, *blank)
            else:
                yield _compare(before, doc)
            if doc.more:
                yield _compare(doc, doc, doc.more)
            before = doc
    if before is not None:
        yield (_LAST, part, 1, before.id, before.text, *blank)


def _along_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in _results(batches):
        held.append(row)
        if len(held) >= _HELD:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text, following in zip(*[c.to_pylist() for c in batch.columns]):
            yield _batch([_compare(_Doc(key, text, Fingerprint(text), 0), _Doc(None, following, Fingerprint(following), 0))])


_KEY = ["id", "h1", "h2"]


def _repeats_apart(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, h1, h2) with ``more``; rows of an id and text that hold 1/HOT_SHARE of all or more become one row.

    So a range of the order never has to hold them: their texts would all have
    the same place.  At most HOT_SHARE such keys; they are told apart by the id
    and 128 bits of the text's hash.
    """
    keys = stage(rows.select(*_KEY), "next-keys")
    counts = keys.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
    hot = stage(counts.filter((F.col("n") > 1) & (F.col("n") * HOT_SHARE >= F.lit(keys.count()))), "next-repeated")
    if hot.isEmpty():
        return rows.withColumn("more", F.lit(0).cast("long"))
    named = F.broadcast(hot.select(*[F.col(c).alias(f"hot_{c}") for c in _KEY]))
    match = reduce(and_, [same(F.col(c), F.col(f"hot_{c}")) for c in _KEY])
    once = rows.join(named, match, "left_semi").groupBy(*_KEY).agg(F.first("text").alias("text"), (F.count(F.lit(1)) - 1).alias("more"))
    return rows.join(named, match, "left_anti").withColumn("more", F.lit(0).cast("long")).unionByName(once)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, fingerprints of its text and of an edited text, and likenesses.

    The next text follows by descending id (null ids last, equal ids by a hash
    of the text); the first follows the last.  The edited text has the last half
    of the code points replaced by as many first ones of the next text.  Returns
    id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, common_next (length of the common prefix with the next text).
    Null texts count as empty; an empty text has the fingerprint of no spans, and
    two of them are alike.  Repeated rows follow each other.  A table of one row
    is followed by itself; an empty table gives an empty result.

    Rows are dealt by ranges of the id, so the text is shuffled once; only the
    first and last text of each range are joined in a second step.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(safe_col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        safe_col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")
    )
    order = [F.col("id").desc_nulls_last(), F.col("h1"), F.col("h2")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _repeats_apart(rows).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    held = stage(dealt.select("id", "text", "more").mapInArrow(_along_partition, _COLUMNS), "next-texts")

    first = held.filter(F.col("kind") == _FIRST)
    # One row a range, without its text.
    ring = Window.orderBy("part")
    whole = Window.partitionBy()
    following = first.select("part").select(
        "part", F.coalesce(F.lead("part").over(ring), F.min("part").over(whole)).alias("next_part")
    )
    heads = first.select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = held.filter(F.col("kind") == _LAST).select("part", "id", "text")
    borders = last.join(following, "part").join(heads, "next_part").select("id", "text", "following")
    result = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_next"]
    done = held.filter(F.col("kind") == _DONE)
    alike = done.filter(F.col("times") > 1).select(*result, F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("time"))
    return (
        done.filter(F.col("times") == 1).select(*result)
        .unionByName(alike.select(*result))
        .unionByName(borders.mapInArrow(_pairs, _COLUMNS).select(*result))
        .withColumnRenamed("id", id_col)
    )


def _extension(text: str, start: int, other: str, other_start: int) -> int:
    """Length of the longest common stretch of two whole texts from the two places, block by block."""
    n = min(len(text) - start, len(other) - other_start)
    for at in range(0, n, BLOCK):
        size = min(BLOCK, n - at)
        a, b = (PrefixHashes(code_points(t[i + at : i + at + size])) for t, i in ((text, start), (other, other_start)))
        if (found := a.common_extension(0, b, 0)) < size:
            return at + found
    return max(n, 0)


def _span_column(queries: pa.Array, _: object) -> pa.Array:
    out = []
    for q in queries.to_pylist():
        text, start, other, other_start, length = q.values()
        if None in (text, start, other, other_start) or not (0 <= start <= len(text) and 0 <= other_start <= len(other)):
            out.append({"common": None, "equal": None})
            continue
        common = _extension(text, start, other, other_start)
        out.append({"common": common, "equal": None if length is None or length < 0 else common >= length})
    return pa.array(out, pa.struct([("common", pa.int64()), ("equal", pa.bool_())]))


def compare_spans(
    rows: DataFrame, text_col: str, start_col: str, other_col: str, other_start_col: str, length_col: str, carry: list[str] | None = None
) -> DataFrame:
    """``rows`` with ``common_length`` and ``spans_equal``: what two texts share from two places on.

    A row holds two whole texts, a place in each (code points, from 0) and a
    length.  ``common_length`` (long) is the longest common extension of the two
    places, ``spans_equal`` whether the spans of that length are equal; a span
    that ends beyond its text equals none.  Both are null when a text or place is
    null or a place lies outside its text; ``spans_equal`` also when the length is
    null or negative.  ``carry`` names the columns to return (default: all); input
    columns named like the outputs are replaced.  Rows keep their number; an empty
    table gives an empty result.  Nothing is shuffled.
    """
    outputs = ("common_length", "spans_equal")
    carried = [c for c in (rows.columns if carry is None else carry) if c.lower() not in outputs]
    query = F.struct(
        safe_col(text_col).cast("string").alias("a"), safe_col(start_col).cast("long").alias("i"),
        safe_col(other_col).cast("string").alias("b"), safe_col(other_start_col).cast("long").alias("j"),
        safe_col(length_col).cast("long").alias("n"),
    )
    asked = rows.withColumn("__query", query)
    found = add_columns(asked, "__query", carried, [_span_column], {"__found": "struct<common:bigint,equal:boolean>"}, None)
    return found.select(*[safe_col(c) for c in carried], F.col("__found.common").alias(outputs[0]), F.col("__found.equal").alias(outputs[1]))


def op6_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike they and its neighbour's are."""
    return with_next(pick(documents(spark, sf_dir), doc_id="doc_id", text="text"))
