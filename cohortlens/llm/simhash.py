"""SimHash near-duplicates by covering locality-sensitive hashing (operator 8).

A document's fingerprint has bit i set when more than half of the 64-bit hashes
of its word shingles have it set.  Documents link when their fingerprints differ
in at most ``radius`` bits.

Covering: every bit position gets a non-zero vector of ``radius + 1`` bits, and
for every non-zero vector v a table keeps the bits whose vector has odd parity
with v.  At most ``radius`` differing bits span less than the whole space, so
some v is even with all of them: that table's mask hides every difference and
the pair surely collides in it.  For radius 2 there are seven tables that keep
36 or 37 bits each.

Inside a table's bucket pairs are not compared.  Each fingerprint is put
under every value that flips at most one of the bits its mask hides; two
fingerprints of the bucket that differ in at most two bits meet under one, and
a value gathers at most 65 fingerprints.  Linking all under a value to the
smallest keeps every component and emits no pairs.  Only distinct fingerprints
take part, so copies cost nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import add_columns, documents, lookup, pick, stage, without
from cohortlens.llm.components import components
from cohortlens.llm.pieces import blocks
from cohortlens.schema import safe_col

SHINGLE = 3
RADIUS = 2
SEED = 42
_BIT_SUMS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
OUTPUTS = ("fingerprint", "component_id", "first")


def _bits_set(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, most significant first."""
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        return np.unpackbits(octets, axis=1).sum(0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BIT_SUMS for i in range(8)])


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a whole text, as a signed 64-bit integer; 0 without words."""
    n, ones, words = 0, np.zeros(64, np.int64), []
    for block in blocks(text or ""):  # memory does not follow the longest text
        # Of bytes: A-Z only, ASCII white space only.
        words = words[max(0, len(words) - shingle + 1) :] + block.encode().lower().split()
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64)
        if len(hashes):
            n += len(hashes)
            ones += _bits_set(hashes)
    if not n:  # fewer words than a shingle has: their whole sequence
        return int.from_bytes(xxhash.xxh64_digest(b" ".join(words), SEED), "big", signed=True) if words else 0
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _simhash_column(texts: pa.Array, shingle: int) -> pa.Array:
    return pa.array([simhash(t, shingle) for t in texts.to_pylist()], pa.int64())


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks (bits kept) of the covering tables, as signed 64-bit integers."""
    if not 0 <= radius <= 5:
        raise ValueError("radius must be from 0 to 5")
    vectors = range(1, 1 << (radius + 1))
    masks = []
    for v in vectors:
        kept = sum(1 << i for i in range(64) if bin(v & (i % len(vectors) + 1)).count("1") % 2)
        masks.append(kept - (1 << 64) if kept >> 63 else kept)
    return masks


def _signed(bit: int) -> int:
    return (1 << bit) - (1 << 64) if bit == 63 else 1 << bit


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``radius`` bits; input: distinct longs ``fp``.

    A radius above 2 puts each fingerprint under the values that flip up to
    radius / 2 (rounded up) hidden bits, and then checks the distance of a link.
    """
    masks = covering_masks(radius)
    keyed = stage(
        fingerprints.select(
            "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("table", "key")
        ),
        "simhash-keys",
    )
    n_keys = keyed.count()
    buckets = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = lookup(keyed, buckets, ["table", "key"], "n", n_keys)
    flips = F.array(
        *[
            F.array(F.lit(0).cast("long"), *[F.lit(_signed(b)) for b in range(64) if not (m >> b) & 1])
            for m in masks
        ]
    )
    met = shared.select("fp", F.col("table"), F.explode(flips[F.col("table")]).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "table"
    )
    for _ in range(1, (radius + 1) // 2):
        met = met.select("fp", "table", F.col("value"), F.explode(flips[F.col("table")]).alias("flip")).select(
            "fp", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), "table"
        )
    met = stage(met.select("fp", "value").distinct(), "simhash-values", n_keys)
    if radius % 2 == 0:  # two flips of radius / 2 bits each are within the radius
        smallest = met.groupBy("value").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        return met.join(smallest, "value").select(F.col("fp").alias("a"), "b").filter("a <> b").distinct()
    other = met.select("value", F.col("fp").alias("b"))
    return (
        met.join(other, "value").select(F.col("fp").alias("a"), "b").filter("a > b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with fingerprint (16 hex digits), component_id (smallest id its fingerprint reaches) and first.

    ``first`` marks one row of each component, one with the smallest id.

    ``carry`` names the columns to return (default: all); the outputs replace
    input columns of the same names.  Null and empty texts and texts without
    words have fingerprint zero and link like any other.  Equal fingerprints
    are one component.  Null ids are never the smallest, unless all are null.
    Rows keep their number, repeated ones too; an empty table gives an empty
    result.
    """
    kept = without(docs.select(*[safe_col(c) for c in (docs.columns if carry is None else carry)]), OUTPUTS).columns
    inner = docs.select(
        safe_col(text_col).cast("string").alias("text"),
        safe_col(id_col).alias("id"),
        *[safe_col(c).alias(f"k{i}") for i, c in enumerate(kept)],
    )
    names = [f"k{i}" for i in range(len(kept))]
    prints = stage(
        add_columns(inner, "text", ["id", *names], [_simhash_column], {"fp": "bigint"}, shingle).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "simhash-fingerprints",
    )
    n_rows = prints.count()
    rank = F.struct(F.col("id").isNull().alias("unknown"), "id", "row")
    distinct = stage(
        prints.groupBy("fp").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")), "simhash-distinct", n_rows
    )
    roots = components(fingerprint_links(distinct.select("fp"), radius), n_rows)
    rooted = stage(
        distinct.join(roots, distinct.fp == roots.node, "left").select(
            "fp", "n", "first", F.coalesce("root", "fp").alias("root")
        ),
        "simhash-roots",
        n_rows,
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("members"))
    per_print = lookup(rooted, firsts, ["root"], "members", rooted.count()).select("fp", "n", "least")
    return lookup(prints, per_print, ["fp"], "n", n_rows).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.id").alias("component_id"),
        (F.col("least.row") == F.col("row")).alias("first"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text")
    return near_duplicates(docs, carry=["doc_id"]).select("doc_id", "fingerprint", "component_id")
