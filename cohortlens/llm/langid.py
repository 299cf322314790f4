"""Language identification by multilingual mixture inference (operator 2).

Model: for every language the smoothed relative frequency of letter trigrams,
hashed into BUCKETS buckets, counted over all training texts.

A document is a mixture of languages.  Expectation-maximisation estimates the
mixture's proportions from the likelihoods of the document's trigrams.  Then
nested sets of its likeliest languages are fitted anew, one more language at a
time, as long as the log-likelihood less a penalty for each language beyond the
first rises; the last set that raised it is the document's, its largest language
the prediction, its share the score.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import add_columns, documents, pick, ship_package, stage
from cohortlens.llm.pieces import by_blocks
from cohortlens.schema import safe_col

BUCKETS = 1 << 16
#: Counts above zero that a model may hold (12 bytes each); more raise an error, no language is left out.
MAX_COUNTS = 1 << 24
#: Languages a task counts at once (half a MB each).
HELD_LANGUAGES = 64
#: Numbers of a batch of texts: its counts above zero by language, and texts times languages.
CELLS = 1 << 22
SMOOTHING = 0.05
ROUNDS, SET_ROUNDS = 10, 5
#: Penalty for a language, in halves of the log of the number of trigrams.
PENALTY = 6.0
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every letter trigram of the texts, and the index of its text.

    Texts are lower-cased; a run of other characters counts as one gap.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(f"\n{t}\n" for t in lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 2 for t in lowered])
    letter = _letters()[codes]
    kept = letter.copy()
    kept[:-1] |= letter[1:]  # the character before a letter
    kept[1:] |= letter[:-1]
    gap_after_gap = ~letter
    gap_after_gap[1:] &= ~letter[:-1] & kept[:-1]
    gap_after_gap[0] = False
    kept &= ~gap_after_gap
    codes, owner = np.where(letter, codes, 0)[kept].astype(np.uint64), owner[kept]
    if len(codes) < 3:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (codes[2:] * np.uint64(0x165667B19E3779F9))) * np.uint64(0xD6E8FEB86659FD93)
    inside = (owner[:-2] == owner[2:]) & (codes[1:-1] > 0)
    return (mixed >> np.uint64(48)).astype(np.int32)[inside], owner[1:-1][inside]


def _counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their counts."""
    buckets, owner = trigram_buckets(texts)
    keys, counts = np.unique(owner.astype(np.int64) * BUCKETS + buckets, return_counts=True)
    edges = np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS)
    return [(keys[a:b] % BUCKETS, counts[a:b]) for a, b in zip(edges, edges[1:])]


class LanguageModel:
    def __init__(self, languages: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        """``n``: trigrams by language (its index) and bucket, those above zero in any order."""
        self.languages = languages
        order = np.argsort(bucket, kind="stable")
        totals = np.bincount(lang, n, len(languages)) + SMOOTHING * BUCKETS
        self.edges = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        self.lang = lang[order].astype(np.int32)
        # Likelihood of a trigram: the language's least, and what its count adds to that.
        self.least = SMOOTHING / totals
        self.more = n[order] / totals[self.lang]

    def _entries(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> tuple:
        """Counts, their texts, and for the model's entries of their buckets: place of the count, cell of the shares, likelihood."""
        buckets = np.concatenate([b for b, _ in grams])
        counts = np.concatenate([c for _, c in grams]).astype(float)
        text = np.repeat(np.arange(len(grams)), [len(b) for b, _ in grams])
        some = self.edges[buckets + 1] - self.edges[buckets]
        at = np.repeat(np.arange(len(buckets)), some)
        entry = np.arange(len(at)) + np.repeat(self.edges[buckets] - np.cumsum(some) + some, some)
        return counts, text, at, text[at] * len(self.languages) + self.lang[entry], self.more[entry]

    def _fit(self, entries: tuple, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares after ``rounds`` of expectation-maximisation, and the log-likelihood before the last round."""
        counts, text, at, cell, more = entries
        n = len(shares)
        total = np.bincount(text, counts, n)[:, None]
        for _ in range(rounds):
            mix = (shares @ self.least)[text] + np.bincount(at, shares.ravel()[cell] * more, len(counts))
            part = counts / mix
            weight = np.bincount(cell, part[at] * more, shares.size).reshape(shares.shape)
            shares = shares * (weight + np.bincount(text, part, n)[:, None] * self.least) / total
        return shares, np.bincount(text, counts * np.log(mix), n)

    def batches(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[slice]:
        """Runs of texts of at most 256 that have about CELLS numbers at most."""
        start = size = 0
        for i, (buckets, _) in enumerate(grams):
            cells = len(self.languages) + int((self.edges[buckets + 1] - self.edges[buckets]).sum())
            if i > start and (size + cells > CELLS or i - start == 256):
                yield slice(start, i)
                start, size = i, 0
            size += cells
        if grams:
            yield slice(start, len(grams))

    def shares(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Language shares (rows: texts) of the selected set of each text; all texts have trigrams."""
        n, k = len(grams), len(self.languages)
        full, _ = self._fit(self._entries(grams), np.full((n, k), 1.0 / k), ROUNDS)
        rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
        best = (rank == 0).astype(float)
        penalty = PENALTY * 0.5 * np.log1p([c.sum() for _, c in grams])
        _, top = self._fit(self._entries(grams), best, 1)
        live, size = np.arange(n), 2  # texts whose set still grows
        while len(live) and size <= k:
            start = np.where(rank[live] < size, np.maximum(full[live], 1e-9), 0.0)
            start /= start.sum(1, keepdims=True)
            found, fit = self._fit(self._entries([grams[i] for i in live]), start, SET_ROUNDS)
            value = fit - penalty[live] * (size - 1)
            better = value > top[live]
            live = live[better]
            top[live], best[live] = value[better], found[better]
            size += 1
        return best


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def add(held: list[str]) -> list[None]:
        nonlocal language
        sums.setdefault(language, np.zeros(BUCKETS, np.int64))
        sums[language] += np.bincount(trigram_buckets(held)[0], minlength=BUCKETS)
        return [None] * len(held)

    def counted() -> Iterator[pa.RecordBatch]:
        for name, row in sums.items():
            found = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(row[found], pa.int64())],
                ["lang", "bucket", "n"],
            )
        sums.clear()

    for batch in batches:
        texts: dict[str, list[str]] = {}
        for text, language in zip(*[c.to_pylist() for c in batch.columns]):
            texts.setdefault(language, []).append(text)
        for language, some in texts.items():
            if len(sums) >= HELD_LANGUAGES and language not in sums:
                yield from counted()
            by_blocks(some, add)
    yield from counted()


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Model from all rows with text and language; trigram counts are summed on the executors.

    The driver gets the counts above zero of every language, at most MAX_COUNTS; more raise an error.
    """
    ship_package(training.sparkSession)
    rows = training.select(safe_col(text_col).cast("string").alias("text"), safe_col(lang_col).cast("string").alias("lang"))
    counts = (
        rows.filter("text is not null and lang is not null")
        .mapInArrow(_count_by_language, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    counts = stage(counts, "language-trigrams")
    if (size := counts.count()) > MAX_COUNTS:
        raise ValueError(f"{size} trigram counts of the languages are more than MAX_COUNTS = {MAX_COUNTS}")
    table = counts.toArrow()
    lang = table["lang"].combine_chunks().dictionary_encode()
    names = lang.dictionary.to_pylist()
    languages = sorted(names)
    index = {name: i for i, name in enumerate(languages)}
    place = np.array([index[name] for name in names], np.int32)
    return LanguageModel(languages, place[lang.indices.to_numpy()], table["bucket"].to_numpy(), table["n"].to_numpy())


_RESULT = pa.struct(
    [("lang", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))]
)


def _predict_column(texts: pa.Array, model: LanguageModel) -> pa.Array:
    grams = []
    for parts in by_blocks([t or "" for t in texts.to_pylist()], _counted):
        if len(parts) == 1:
            grams.append(parts[0])
        else:
            buckets, at = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
            grams.append((buckets, np.bincount(at, np.concatenate([c for _, c in parts]), len(buckets))))
    known = [i for i, (b, _) in enumerate(grams) if len(b) and model.languages]
    out = [{"lang": UNDETERMINED, "score": 0.0, "languages": [], "shares": []} for _ in grams]
    for part in model.batches([grams[i] for i in known]):
        some = known[part]
        for i, row in zip(some, model.shares([grams[i] for i in some])):
            order = [j for j in np.argsort(-row, kind="stable") if row[j] > 0]
            shares = [min(1.0, float(row[j])) for j in order]
            names = [model.languages[j] for j in order]
            out[i] = {"lang": names[0], "score": shares[0], "languages": names, "shares": shares}
    return pa.array(out, _RESULT)


def identify(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``docs`` with lang_pred, score (share of that language), languages and shares of the selected set.

    ``carry`` names the columns to return (default: all); outputs replace input
    columns of the same names.  A text that is null or has no letters gets
    ``und``, score 0 and empty lists; so does every text when the model knows no
    language.  Ties go to the language first by name.  Rows keep their number;
    an empty table gives an empty result.
    """
    outputs = ("lang_pred", "score", "languages", "shares")
    carried = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    found = add_columns(
        docs, text_col, carried, [_predict_column],
        {"__found": "struct<lang:string,score:double,languages:array<string>,shares:array<double>>"}, model,
    )
    return found.select(
        *[safe_col(c) for c in carried],
        F.col("__found.lang").alias("lang_pred"),
        *[F.col(f"__found.{c}").alias(c) for c in outputs[1:]],
    )


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language; learnt from the documents that are not held out."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text", lang="lang").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    )
    model = fit(docs.filter("not held_out"))
    docs = docs.withColumn("held_out", F.coalesce("held_out", F.lit(False)))
    return identify(docs, model, carry=["doc_id", "held_out"])
