"""Token counts by a map-side two-tier lookup (operator 7).

Tier one is a table of the frequent pieces (white space and the word after it, so
one or a few pre-tokens) and their token counts, counted over all documents: every
piece of at most PIECE_CHARS characters that is 1 / FREQUENT of them or more is in
it, and at most 2 * FREQUENT are; that bounds what is broadcast.  Tier two is a
bounded cache in each Python worker; pieces in neither are encoded by the tokenizer
library, a batch's together.  All of it happens where the row is: no piece of a text
is shuffled, only the counts of those frequent within a task.
"""

from __future__ import annotations

import functools
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.bpe import tokenizer_spec
from cohortlens.llm.common import add_columns, documents, pick, ship_package, stage
from cohortlens.llm.pieces import WorkerCache, blocks, by_blocks, pieces
from cohortlens.schema import safe_col

FREQUENT = 65_536
PIECE_CHARS = 32
#: Distinct pieces a task counts at once; beyond, it reports the frequent ones and counts anew.
HELD_PIECES = 1 << 18
CACHE_ENTRIES = 300_000
#: Pieces encoded as one text.
JOINED = 256
_SPACE = " \t\n\v\f\r"
TOKEN_LIMIT = 512


def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def _lengths(tokenizer, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def piece_lengths(tokenizer, found: list[str]) -> list[int]:
    """Token count of every piece.

    Pieces of white space and a word are encoded as texts of JOINED pieces, since
    no token runs from a word into the white space of the next piece; a token
    belongs to the piece in which it starts.  All others, and long ones, are texts of their own.
    """
    lengths = np.zeros(len(found), np.int64)
    alone = [i for i, p in enumerate(found) if not 0 < len(p) <= 2 * PIECE_CHARS or p[0] not in _SPACE or p[-1] in _SPACE]
    lengths[alone] = _lengths(tokenizer, [found[i] for i in alone])
    led = np.delete(np.arange(len(found)), alone)
    runs = [led[i : i + JOINED] for i in range(0, len(led), JOINED)]
    texts = [[found[i] for i in run] for run in runs]
    encoded = tokenizer.encode_batch(["".join(t) for t in texts], add_special_tokens=False)
    for run, text, e in zip(runs, texts, encoded):
        ends = np.cumsum([len(p) for p in text])
        starts = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
        lengths[run] = np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(run))
    return lengths.tolist()


def check_spec(spec: str) -> None:
    """Raise unless counting piece by piece equals counting whole texts: byte-level pre-tokens, texts not normalised."""
    parsed = json.loads(spec)
    pre = parsed.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    added = [t for t in parsed.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])]
    if not plain or parsed.get("normalizer") or added:
        raise ValueError("needs a byte-level tokenizer without normalizer whose added tokens hold no white space")


def _piece_counts(batches: Iterator[pa.RecordBatch], frequent: int, held: int) -> Iterator[pa.RecordBatch]:
    """Counts of the pieces that are 1 / (2 * frequent) or more of those counted together; all of these under a null piece."""
    counts: Counter = Counter()

    def reported() -> pa.RecordBatch:
        total = sum(counts.values())
        found = [(p, n) for p, n in counts.items() if 2 * frequent * n >= total and "\0" not in p]
        counts.clear()
        names, numbers = zip((None, total), *found)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int64())], ["piece", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            for block in blocks(text or ""):
                counts.update([p for p in pieces(block) or [] if len(p) <= PIECE_CHARS])
                if len(counts) > held:
                    yield reported()
    if counts:
        yield reported()


def frequent_lengths(texts: DataFrame, spec: str, frequent: int = FREQUENT, held: int = HELD_PIECES) -> tuple[str, bytes]:
    """Compact table of the frequent pieces: the pieces joined by NUL, and their token counts as 16-bit integers.

    ``texts`` has one string column, all of which is counted.  What tasks leave
    unreported of a piece is below 1 / (2 * frequent) of all pieces, so every
    piece that is 1 / frequent of them reaches the bound here, which at most
    2 * frequent can reach.
    """
    partial = texts.mapInArrow(lambda batches: _piece_counts(batches, frequent, held), "piece string, n bigint")
    partial = stage(partial, "frequent-pieces")
    total = partial.filter("piece is null").agg(F.sum("n")).first()[0] or 0
    counts = partial.filter("piece is not null").groupBy("piece").agg(F.sum("n").alias("n"))
    found = sorted(r.piece for r in counts.filter(F.col("n") * F.lit(2 * frequent) >= F.lit(total)).select("piece").collect())
    return "\0".join(found), np.array(piece_lengths(_tokenizer(spec), found), np.uint16).tobytes()


@functools.lru_cache(maxsize=2)
def _worker_tiers(shared: tuple[str, str, bytes]) -> tuple[object, dict[str, int], WorkerCache]:
    spec, joined, lengths = shared
    tokenizer = _tokenizer(spec)
    names = joined.split("\0") if joined else []
    table = dict(zip(names, np.frombuffer(lengths, np.uint16).tolist()))
    return tokenizer, table, WorkerCache(lambda p: _lengths(tokenizer, [p])[0], CACHE_ENTRIES)


def _count_blocks(texts: list[str], tokenizer, table: dict[str, int], cache: WorkerCache) -> list[int]:
    cuts = [pieces(t) for t in texts]
    distinct = set().union(*[c for c in cuts if c])
    known = {p: n for p in distinct if (n := table.get(p) or cache.held(p))}
    new = list(distinct.difference(known))
    for piece, n in zip(new, piece_lengths(tokenizer, new)):
        known[piece] = n
        if len(piece) <= 2 * PIECE_CHARS:
            cache.remember(piece, n)
    # A text with other white space is encoded whole.
    return [_lengths(tokenizer, [text])[0] if cut is None else sum(map(known.__getitem__, cut)) for cut, text in zip(cuts, texts)]


def _count_column(texts: pa.Array, shared: tuple[str, str, bytes]) -> pa.Array:
    tiers = _worker_tiers(shared)
    counts = by_blocks([t or "" for t in texts.to_pylist()], lambda held: _count_blocks(held, *tiers))
    return pa.array([sum(c) for c in counts], pa.int64())


def token_counts(
    docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, spec: str | None = None
) -> DataFrame:
    """``docs`` with ``n_tokens``, long: tokens of every whole text as the tokenizer library counts them.

    ``carry`` names the columns to return (default: all); an input column
    ``n_tokens`` is replaced.  A null or empty text has 0 tokens; a special
    token's string inside a text is one token.  Rows keep their number, repeated
    ones too; an empty table gives an empty result.
    """
    spec = spec or tokenizer_spec()
    check_spec(spec)
    ship_package(docs.sparkSession)
    table = frequent_lengths(docs.select(safe_col(text_col)), spec)
    return add_columns(docs, text_col, carry, [_count_column], {"n_tokens": "bigint"}, (spec, *table))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    )
    counted = token_counts(docs, carry=["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
