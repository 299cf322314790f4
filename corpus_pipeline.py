"""The corpus pipeline: raw documents to a mixed, encoded training set.

Stages: line-level quality, exact duplicates, near duplicates, source mixing,
byte-pair encoding.  Every stage gets the rows the one before it kept; all but
the last return the columns of the documents, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bpe, exact, line_crf, mixing, simhash
from cohortlens.llm.common import documents, stage
from cohortlens.schema import safe_col

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Columns the operators work on; all columns of the documents travel beside them under names of their own.
KEYS = ("doc_id", "text", "source")


def _beside(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    carried = [f"c{i}" for i in range(len(docs.columns))]
    return docs.select(*KEYS, *[safe_col(c).alias(n) for c, n in zip(docs.columns, carried)]), carried


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; learnt from the labels beside the documents."""
    rows, carried = _beside(docs)
    crf = line_crf.quality_model(spark, docs, sf_dir)
    scored = line_crf.score(rows, crf, carry=carried)
    return _back(scored.filter(F.col("score") >= line_crf.THRESHOLD), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    rows, carried = _beside(docs)
    return _back(exact.exact_dedup(rows, carry=carried).filter("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near duplicates."""
    rows, carried = _beside(docs)
    return _back(simhash.near_duplicates(rows, carry=carried).filter("first"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    rows, carried = _beside(docs)
    return _back(mixing.repeat_rows(mixing.mix_sources(rows, carry=carried)), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number and digests of the ids and of the text decoded from them."""
    return bpe.encode_decode(docs.select("doc_id", "text"), carry=["doc_id"]).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix),
    ("encode", encode),
]

#: SQL expresses neither the quality model nor the encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared scratch folder and read again."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
