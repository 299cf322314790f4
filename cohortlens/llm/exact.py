"""Exact deduplication by two-pass Bloom filtering (operator 5).

Pass one hashes every text and sets ``HASHES`` bits of a filter for it; a second
filter of the same size marks bits set more than once.  A text can only be
repeated if all its bits are marked.  Pass two reads the rows again: those that
cannot be repeated pass straight through, only the others are shuffled and
grouped by the SHA-256 of their text, so false positives cost a shuffled row and
never change the result.

The filter has 16 bits a row, rounded up to a power of two, and at most MAX_BITS
(64 MB) unless ``max_bits`` says otherwise: that is the size broadcast.  A larger
input fills it and sends more rows to the shuffle; the result stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import documents, lookup, pick, same, ship_package, stage, without
from cohortlens.schema import safe_col

MAX_BITS = 1 << 29
BITS_PER_ROW = 16
HASHES = 2
_SECTION = 1 << 20  # bits of a filter section; sections are merged independently
OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")


def filter_bits(n_rows: int, max_bits: int | None = None) -> int:
    """Size of the filter: BITS_PER_ROW for each row, a power of two of at least one section, at most ``max_bits`` (default MAX_BITS)."""
    return max(_SECTION, min(max_bits or MAX_BITS, 1 << (max(1, n_rows * BITS_PER_ROW) - 1).bit_length()))


def bit_positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The HASHES filter bits of each 64-bit text hash (bits is a power of two)."""
    h = hashes.view(np.uint64)
    step = ((h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(HASHES)]


def _task_sections(bits: int):
    """Per task: bits set, and bits set more than once, as positions within each section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [b.column(0).to_numpy(zero_copy_only=False) for b in batches if b.num_rows]
        if not hashes:
            return
        positions, counts = np.unique(np.concatenate(bit_positions(np.concatenate(hashes), bits)), return_counts=True)
        section = positions // _SECTION
        edges = np.concatenate([[0], np.flatnonzero(np.diff(section)) + 1, [len(positions)]])
        for a, b in zip(edges[:-1], edges[1:]):
            within = (positions[a:b] % _SECTION).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(section[a])], pa.int32()),
                    pa.array([within.tobytes()], pa.binary()),
                    pa.array([within[counts[a:b] > 1].tobytes()], pa.binary()),
                ],
                ["section", "seen", "again"],
            )

    return run


def _merge_sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per section: the packed filter of the bits set more than once over all tasks."""
    seen: dict[int, np.ndarray] = {}
    again: dict[int, np.ndarray] = {}
    for batch in batches:
        for section, some, more in zip(*[c.to_pylist() for c in batch.columns]):
            if section not in seen:
                seen[section], again[section] = np.zeros(_SECTION, bool), np.zeros(_SECTION, bool)
            some, more = np.frombuffer(some, np.uint32), np.frombuffer(more, np.uint32)
            again[section][some] |= seen[section][some]
            again[section][more] = True
            seen[section][some] = True
    for section, flags in again.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([section], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())],
            ["section", "bits"],
        )


def repeat_filter(hashes: DataFrame, bits: int) -> bytes:
    """Packed filter (``bits`` / 8 bytes) of the bits that more than one row set; ``hashes`` has one long column."""
    sections = max(1, bits // _SECTION)
    merged = (
        hashes.mapInArrow(_task_sections(bits), "section int, seen binary, again binary")
        .repartition(sections, "section")
        .mapInArrow(_merge_sections, "section int, bits binary")
    )
    packed = bytearray(bits // 8)
    size = _SECTION // 8
    for row in merged.toLocalIterator():
        packed[row.section * size : (row.section + 1) * size] = row.bits
    return bytes(packed)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    max_bits: int | None = None,
) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256; of equal texts the largest id stays.

    ``carry`` names the columns to return (default: all); the four outputs
    replace input columns of the same names.  ``max_bits`` (a power of two,
    default MAX_BITS) bounds the filter: raise it, as far as executors have
    memory for it, beyond MAX_BITS / BITS_PER_ROW rows.  A null text counts as empty, and
    all empty texts are one group.  A null id ranks below every other, and of
    rows with equal id and text exactly one is kept.  Very long texts are
    hashed in the JVM and never leave it.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    carried = without(docs.select(*[safe_col(c) for c in (carry or docs.columns)]), OUTPUTS).columns
    out = [f"c{i}" for i in range(len(carried))]
    text = F.coalesce(safe_col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        *[safe_col(c).alias(o) for c, o in zip(carried, out)],
        safe_col(id_col).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("hash"),
    )

    bits = filter_bits(docs.count(), max_bits)
    packed = spark.sparkContext.broadcast(repeat_filter(rows.select("hash"), bits))

    @F.pandas_udf("boolean")
    def may_repeat(hashes):
        import pandas as pd

        flags = np.frombuffer(packed.value, np.uint8)
        hit = np.ones(len(hashes), bool)
        for at in bit_positions(hashes.to_numpy(np.int64), bits):
            hit &= (flags[at >> 3] >> (at & 7)) & 1 == 1
        return pd.Series(hit)

    flagged = rows.withColumn("may_repeat", may_repeat("hash"))
    sha = F.sha2("text", 256).alias("sha")
    candidates = stage(
        flagged.filter("may_repeat").select(*out, "id", sha, F.monotonically_increasing_id().alias("row")), "dedup-candidates"
    )
    groups = candidates.groupBy("sha").agg(
        F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    repeated = lookup(candidates, groups, ["sha"], "n", candidates.count()).select(
        *out,
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        same(F.col("keep.row"), F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    single = flagged.filter("not may_repeat").select(
        *out,
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    return single.unionByName(repeated).select(*[F.col(o).alias(c) for o, c in zip(out, carried)], *OUTPUTS)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the doc_id of the copy that stays."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text")
    return exact_dedup(docs, carry=["doc_id"])


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
