"""Document quality by a linear-chain conditional random field over lines (operator 4).

Every line that is not blank is labelled good or bad.  A line's features are
counts and ratios of its characters and words, cut into bins; its score sums the
weights of its own bins and of the bins of the lines before and after it.  The
chain's transition weights tie neighbouring labels together.  Forward-backward
gives each line's probability of being good; their mean, weighted by line
length, is calibrated to the document's score.

Training labels are those of documents, given to each of their lines.  The fit
uses at most FIT_DOCS labelled documents, chosen by a hash of their id: line
features of that sample (17 bytes a line) reach the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import add_columns, documents, pick, same, ship_package
from cohortlens.llm.pieces import BLOCK
from cohortlens.schema import safe_col

FIT_DOCS = 4_000
#: Lines of all documents of the fit together.
FIT_LINES = 250_000
FIT_ROUNDS = 120
LEARNING_RATE = 0.1
#: Weight decay of the line weights and of the transition weights.
DECAY, TRANSITION_DECAY = 0.5, 20.0
THRESHOLD = 0.3
_LIMIT = 30.0

# Character classes.
_OTHER, _LOWER, _UPPER, _DIGIT, _SPACE, _NEWLINE, _MARK = range(7)
#: Upper bin edges of ratios and of counts.
RATIO_EDGES = np.array([0.0, 0.01, 0.03, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95])
COUNT_EDGES = np.array([1, 2, 4, 6, 9, 14, 24, 48, 96, 250])
LENGTH_EDGES = np.array([1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5, 9.0, 12.0, 20.0])
FEATURES = 17
_REPEAT = 15  # the feature that tells a line its text has had before
#: Bins of a feature; the last one stands for a neighbour that does not exist.
BINS = 12
_NO_LINE = BINS - 1


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x30000):
        char = chr(c)
        if char.isalpha():
            table[c] = _UPPER if char.isupper() else _LOWER
        elif char.isdigit():
            table[c] = _DIGIT
        elif char.isspace():
            table[c] = _SPACE
    table[ord("\n")] = _NEWLINE
    table[[ord(c) for c in ".,;:?'\"()-"]] = _MARK
    return table


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (lines by FEATURES), lengths in characters and text index of all lines of the texts that are not blank."""
    bins, length, text_of, line_hash = _own_features(texts)
    bins[:, _REPEAT] = _repeats(line_hash, text_of)
    return bins, length, text_of


def _repeats(line_hash: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Lines that their text has had before."""
    order = np.lexsort((np.arange(len(line_hash)), line_hash, text_of))
    repeat = np.zeros(len(line_hash), bool)
    repeat[order[1:]] = (line_hash[order[1:]] == line_hash[order[:-1]]) & (text_of[order[1:]] == text_of[order[:-1]])
    return repeat


def _own_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``line_features`` but for repeated lines; and a hash of every line."""
    codes = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _classes()[codes]
    ends = np.flatnonzero(kind == _NEWLINE)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_of = np.repeat(np.arange(len(texts)), [t.count("\n") + 1 for t in texts])

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return total[ends] - total[starts]

    blank = (kind == _SPACE) | (kind == _NEWLINE)
    inked = per_line(~blank)
    filled = inked > 0
    if not filled.any():
        return np.empty((0, FEATURES), np.uint8), np.empty(0), np.empty(0, int), np.empty(0, np.uint64)
    starts, ends, text_of, inked = starts[filled], ends[filled], text_of[filled], inked[filled]

    counts = [per_line(kind == k) for k in (_OTHER, _LOWER, _UPPER, _DIGIT, _MARK)]
    other, lower, upper, digit, mark = counts
    letters = lower + upper
    bangs, pipes = per_line(codes == ord("!")), per_line(codes == ord("|"))

    # Words: place, length, last character's class, and a hash of their characters.
    word_start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    word_end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    line_of = np.searchsorted(ends, word_start)
    mixed = (codes.astype(np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(23)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    hashed = (sums[word_end] - sums[word_start]) ^ (word_end - word_start).astype(np.uint64)
    n_lines = len(starts)
    of_lines = functools.partial(np.bincount, line_of, minlength=n_lines)
    words = of_lines()
    length = (word_end - word_start).astype(float)
    plain = np.concatenate([[0], np.cumsum((kind == _LOWER) | (kind == _UPPER) | (kind == _DIGIT), dtype=np.int32)])
    symbol_word = plain[word_end] == plain[word_start]
    symbol_end = (kind[word_end - 1] == _OTHER) & ~symbol_word
    again = np.zeros(len(word_start), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (line_of[1:] == line_of[:-1])
    keys = np.unique((line_of.astype(np.uint64) << np.uint64(40)) | (hashed & np.uint64((1 << 40) - 1)))
    distinct = np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=n_lines)
    longest = np.zeros(n_lines)
    np.maximum.at(longest, line_of, length)

    total = (ends - starts).astype(float)
    ratios = [
        upper / np.maximum(1, letters), digit / inked, other / inked, mark / inked, letters / inked, bangs / words,
        pipes / words, of_lines(weights=again) / words, 1 - distinct / words, of_lines(weights=symbol_end) / words,
        of_lines(weights=symbol_word) / words, (total - inked) / total,
    ]
    bins = [np.searchsorted(RATIO_EDGES, r) for r in ratios]
    bins += [np.searchsorted(COUNT_EDGES, words), np.searchsorted(LENGTH_EDGES, of_lines(weights=length) / words)]
    bins += [np.searchsorted(COUNT_EDGES, longest), np.zeros(n_lines, int), (kind[ends - 1] == _MARK).astype(int)]
    return np.stack(bins, 1).astype(np.uint8), total, text_of, sums[ends] - sums[starts]


def _neighbours(bins: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Flat weight indices (lines by 3 * FEATURES): bins of the line itself, of the one before, of the one after."""
    before, after = np.full_like(bins, _NO_LINE), np.full_like(bins, _NO_LINE)
    linked = text_of[1:] == text_of[:-1]
    before[1:][linked] = bins[:-1][linked]
    after[:-1][linked] = bins[1:][linked]
    places = np.concatenate([bins, before, after], 1).astype(np.int32)
    return places + np.arange(3 * FEATURES, dtype=np.int32) * BINS


def _chains(text_of: np.ndarray) -> list[np.ndarray]:
    """Lines by step: entry i has the i-th line of every text that has one, longest texts first."""
    starts = np.flatnonzero(np.concatenate([[True], text_of[1:] != text_of[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(text_of)]]))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    having = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    return [starts[:n] + i for i, n in enumerate(having)]


def _messages(scores: np.ndarray, chains: list[np.ndarray], step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of good against bad at every line: from the lines up to it, and from the lines after it.

    ``step[a, b]`` is the weight factor of label b following label a.
    """
    forward, backward = scores.copy(), np.zeros_like(scores)
    for lines, following in zip(chains, chains[1:]):
        odds = np.exp(np.clip(forward[lines[: len(following)]], -_LIMIT, _LIMIT))
        forward[following] += np.log((odds * step[1, 1] + step[0, 1]) / (odds * step[1, 0] + step[0, 0]))
    for lines, following in zip(chains[-2::-1], chains[:0:-1]):
        odds = np.exp(np.clip(scores[following] + backward[following], -_LIMIT, _LIMIT))
        backward[lines[: len(following)]] = np.log((odds * step[1, 1] + step[1, 0]) / (odds * step[0, 1] + step[0, 0]))
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -_LIMIT, _LIMIT)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class LineCrf:
    weights: np.ndarray  # by feature place and bin, flat
    bias: float
    transitions: np.ndarray  # log weights, previous label by label
    slope: float
    offset: float
    prior: float  # score of a text without lines

    def marginals(self, bins: np.ndarray, text_of: np.ndarray) -> np.ndarray:
        """Probability of every line to be good; lines of a text are consecutive."""
        scores = self.weights[_neighbours(bins, text_of)].sum(1) + self.bias
        forward, backward = _messages(scores, _chains(text_of), np.exp(self.transitions))
        return _sigmoid(forward + backward)

    def document_scores(self, bins: np.ndarray, length: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
        """Calibrated length-weighted mean of the lines' probabilities for ``n`` texts."""
        out = np.full(n, self.prior)
        if len(bins):
            mean = mean_marginal(self.marginals(bins, text_of), length, text_of, n)
            has = np.bincount(text_of, minlength=n) > 0
            out[has] = _sigmoid(self.slope * _logit(mean[has]) + self.offset)
        return out


def mean_marginal(good: np.ndarray, length: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text_of, good * length, n) / np.maximum(1e-9, np.bincount(text_of, length, n))


def train(bins: np.ndarray, length: np.ndarray, text_of: np.ndarray, label: np.ndarray, prior: float) -> LineCrf:
    """Maximum-likelihood chain (with weight decay) by gradient steps; ``label`` is 0 or 1 by text."""
    places = _neighbours(bins, text_of)
    chains = _chains(text_of)
    y = label[text_of].astype(float)
    size, n_texts = 3 * FEATURES * BINS, len(label)
    params = np.zeros(size + 1 + 4)
    decay = np.concatenate([np.full(size, DECAY), [0.0], np.full(4, TRANSITION_DECAY)])
    linked = np.flatnonzero(text_of[1:] == text_of[:-1])
    seen = np.bincount((2 * y[linked] + y[linked + 1]).astype(int), minlength=4).astype(float)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, FIT_ROUNDS + 1):
        step = np.exp(params[-4:].reshape(2, 2))
        scores = params[places].sum(1) + params[size]
        forward, backward = _messages(scores, chains, step)
        error = y - _sigmoid(forward + backward)
        # Expected pairs of labels of neighbouring lines.
        left = np.exp(np.clip(forward[linked], -_LIMIT, _LIMIT))
        right = np.exp(np.clip(scores[linked + 1] + backward[linked + 1], -_LIMIT, _LIMIT))
        pairs = np.stack([step[0, 0] + 0 * left, step[0, 1] * right, step[1, 0] * left, step[1, 1] * left * right], 1)
        expected = (pairs / pairs.sum(1, keepdims=True)).sum(0)
        by_place = np.bincount(places.ravel(), np.repeat(error, 3 * FEATURES), size)
        gradient = np.concatenate([by_place, [error.sum()], seen - expected]) - decay * params
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        params += LEARNING_RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    crf = LineCrf(params[:size], params[size], params[-4:].reshape(2, 2), 1.0, 0.0, prior)
    found = _logit(mean_marginal(crf.marginals(bins, text_of), length, text_of, n_texts))
    has = np.bincount(text_of, minlength=n_texts) > 0
    crf.slope, crf.offset = _calibrate(found[has], label[has].astype(float))
    return crf


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (kept positive) and offset of a logistic fit, lightly drawn to 1 and 0."""
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(at[0] * x + at[1])
        w = np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([((y - p) * x).sum(), (y - p).sum()]) - (at - [1.0, 0.0])
        hessian = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        move = np.linalg.solve(hessian, gradient)
        at += np.clip(move, -0.5, 0.5)
        at[0] = max(at[0], 0.01)
    return float(at[0]), float(at[1])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for place, text, label in zip(*[c.to_pylist() for c in batch.columns]):
            bins, length, _ = line_features([text or ""])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([place], pa.int32()),
                    pa.array([label], pa.int32()),
                    pa.array([bins.tobytes()], pa.binary()),
                    pa.array([length.astype(np.float32).tobytes()], pa.binary()),
                ],
                ["place", "label", "bins", "length"],
            )


_ROW = ["draw", "id", "digest", "label"]


def _drawn(rows: DataFrame) -> DataFrame:
    """The rows (place, text, label) to learn from: at most FIT_DOCS, with at most FIT_LINES lines in all.

    Rows are taken by a hash of the id, then the id and a hash of the text, those
    left out whose lines would be too many; repeated rows count once.  So reruns,
    and other partitionings, learn from the same rows in the same order.
    """
    spark = rows.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = rows.select(
        F.xxhash64(F.lit("fit"), "id").alias("draw"), F.col("id").cast("string").alias("id"), F.xxhash64(text).alias("digest"), "label", "text"
    )
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    first = keyed.select(*_ROW, lines.alias("lines")).distinct().orderBy(*_ROW).limit(FIT_DOCS).collect()
    chosen, left = [], FIT_LINES
    for r in first:
        if r.lines <= left:
            left -= r.lines
            chosen.append((len(chosen), *[r[c] for c in _ROW]))
    named = spark.createDataFrame(chosen, "place int, draw_ bigint, id_ string, digest_ bigint, label_ int")
    match = reduce(and_, [same(F.col(c), F.col(f"{c}_")) for c in _ROW])
    return keyed.join(F.broadcast(named), match).dropDuplicates(["place"]).select("place", "text", "label")


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LineCrf:
    """Chain fitted on the labelled rows (label 0 or 1; others are left out), at most FIT_DOCS of them and FIT_LINES lines.

    The bound makes the fit a small job of the driver, which gets the line
    features alone (some 30 bytes a line).  Without labelled rows every text
    scores 0.5; with labels of one kind only, every text scores near that label.
    """
    ship_package(labelled.sparkSession)
    rows = labelled.select(
        safe_col(id_col).alias("id"), safe_col(text_col).cast("string").alias("text"), safe_col(label_col).cast("int").alias("label")
    ).filter("label in (0, 1)")
    found = _drawn(rows).mapInArrow(_feature_rows, "place int, label int, bins binary, length binary").collect()
    found.sort(key=lambda r: r.place)
    label = np.array([r.label for r in found], int)
    prior = float((label.sum() + 1) / (len(label) + 2))
    bins = [np.frombuffer(r.bins, np.uint8).reshape(-1, FEATURES) for r in found]
    text_of = np.repeat(np.arange(len(found)), [len(b) for b in bins])
    if not len(text_of):
        return LineCrf(np.zeros(3 * FEATURES * BINS), 0.0, np.zeros((2, 2)), 0.0, float(_logit(np.array(prior))), prior)
    length = np.concatenate([np.frombuffer(r.length, np.float32) for r in found]).astype(float)
    return train(np.concatenate(bins), length, text_of, label, prior)


def _score_column(texts: pa.Array, crf: LineCrf) -> pa.Array:
    held = [t or "" for t in texts.to_pylist()]
    out = np.empty(len(held))
    start = 0
    while start < len(held):
        stop, size = start, 0
        while stop < len(held) and (stop == start or size + len(held[stop]) <= BLOCK // 4):
            size += len(held[stop])
            stop += 1
        if size <= BLOCK:
            bins, length, text_of = line_features(held[start:stop])
        else:  # one very long text: its lines in blocks
            bins, length, text_of = _long_features(held[start])
        out[start:stop] = crf.document_scores(bins, length, text_of, stop - start)
        start = stop
    return pa.array(out, pa.float64())


def _long_features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a very long text, block by block."""
    parts, start = [], 0
    while start < len(text):
        cut = text.find("\n", start + BLOCK)
        stop = len(text) if cut < 0 else cut
        parts.append(_own_features([text[start:stop]]))
        start = stop + 1
    bins, length, _, line_hash = (np.concatenate(x) for x in zip(*parts))
    text_of = np.zeros(len(bins), int)
    bins[:, _REPEAT] = _repeats(line_hash, text_of)
    return bins, length, text_of


def score(docs: DataFrame, crf: LineCrf, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, double: how likely the whole text's label is 1, from 0 to 1.

    ``carry`` names the columns to return (default: all); an input column
    ``score`` is replaced.  Null texts and texts of blank lines get the share of
    label 1 in the fit.  Rows keep their number, repeated ones get equal scores;
    an empty table gives an empty result.
    """
    return add_columns(docs, text_col, carry, [_score_column], {"score": "double"}, crf)


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, quality) of the labelled documents that may be learnt from; a document's largest label counts.

    At most FIT_DOCS of them, drawn from the labels by a hash of the id before
    the documents are read; that bounds what is broadcast.
    """
    known = labels.filter("quality is not null and crc32(cast(doc_id as string)) % 5 <> 0").groupBy("doc_id").agg(
        F.max("quality").alias("quality")
    )
    drawn = known.orderBy(F.xxhash64(F.lit("labels"), "doc_id"), "doc_id").limit(FIT_DOCS)
    return pick(docs, doc_id="doc_id", text="text").join(F.broadcast(drawn), "doc_id")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> LineCrf:
    return fit(labelled_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; learnt from labelled documents that are not held out."""
    docs = documents(spark, sf_dir)
    crf = quality_model(spark, docs, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("held_out", held_out)
    return score(rows, crf, carry=["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
