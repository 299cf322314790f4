"""Byte-pair encoding and decoding on a contiguous rank array (operator 9).

A text is cut into pre-tokens; each is encoded on its own.  For a short pre-token
contiguous arrays hold its parts and the merge rank of every pair of adjacent
parts.  The smallest rank is looked up by a scan, its boundary deleted, and the
two neighbouring ranks refreshed, until no pair merges.  New words of a batch of
texts are merged together: words of equal length are the rows of one matrix, and
every round scans, deletes and refreshes in all rows at once.  Pre-tokens above
SHORT bytes, where the scan would be quadratic, use a heap over linked parts.
All merge the lowest rank first, leftmost first.

Encodings are memoised per Python worker in a bounded cache, because words
repeat; rows are not shuffled.  The vocabulary (one tokenizer file) is broadcast.
"""

from __future__ import annotations

import functools
import heapq
import json
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import add_columns, documents, pick
from cohortlens.llm.pieces import WorkerCache, by_blocks, pieces

TOKENIZER = "byte_bpe_50k.json"
#: Longest pre-token, in bytes, that is merged by scanning.
SHORT = 256
CACHE_ENTRIES = 200_000
#: Longest piece of text that is memoised, in characters.
CACHED_PIECE = 64
_NEVER = (1 << 31) - 1
#: Fewer words of one length than this are merged one by one.
_FEW = 24
_SLOTS = 1 << 20
_DECODED_AT_ONCE = 1 << 16


def byte_characters() -> dict[str, int]:
    """Character → byte of the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class BytePairModel:
    """Vocabulary, merges and special tokens of a byte-level BPE tokenizer file (its JSON text)."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model = parsed["model"]
        byte_of = byte_characters()
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.specials.items()}
        self.byte_id = [0] * 256
        for c, b in byte_of.items():
            self.byte_id[b] = vocab[c]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[vocab[left] << 32 | vocab[right]] = r
            self.merged.append(vocab[left + right])
        self._pair_keys, self._pair_ranks = self._pair_table()
        self._token_bytes, self._token_start, self._token_length = self._byte_table()
        self._byte_ids, self._merged_ids = np.array(self.byte_id), np.array(self.merged)
        self._pre_token = regex.compile(public_tokenizers.PATTERN)
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash table with linear probing: pair of ids → rank."""
        keys, ranks = np.full(_SLOTS, -1, np.int64), np.full(_SLOTS, _NEVER, np.int32)
        pairs, found = np.array(list(self.rank), np.int64), np.array(list(self.rank.values()), np.int32)
        for slot, key, r in zip(self._slots(pairs).tolist(), pairs.tolist(), found.tolist()):
            while keys[slot] >= 0:
                slot = (slot + 1) % _SLOTS
            keys[slot], ranks[slot] = key, r
        return keys, ranks

    @staticmethod
    def _slots(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        slots = self._slots(pairs)
        held = self._pair_keys[slots]
        out = np.where(held == pairs, self._pair_ranks[slots], np.int32(_NEVER))
        open_ = np.nonzero((held != pairs) & (held >= 0))
        while len(open_[0]):
            slots[open_] = (slots[open_] + 1) % _SLOTS
            held = self._pair_keys[slots[open_]]
            hit = held == pairs[open_]
            out[tuple(x[hit] for x in open_)] = self._pair_ranks[slots[tuple(x[hit] for x in open_)]]
            on = ~hit & (held >= 0)
            open_ = tuple(x[on] for x in open_)
        return out

    def merge_equal(self, words: list[bytes]) -> list[bytes]:
        """Ids, packed as 32-bit integers, of words of one length: one rank array a row.

        Every round takes one part from each row that still merges; rows that
        are done leave, so all rows have the same number of parts.
        """
        out: list[bytes] = [b""] * len(words)
        row = np.arange(len(words))
        ids = self._byte_ids[np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)]
        ranks = self._ranks_of(ids[:, :-1], ids[:, 1:])
        while len(row):
            if ranks.shape[1]:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(row)), at]
                going = best < _NEVER
            else:
                going = np.zeros(len(row), bool)
            if not going.all():
                done = np.ascontiguousarray(ids[~going], np.int32)
                for r, packed in zip(row[~going].tolist(), done):
                    out[r] = packed.tobytes()
                if not going.any():
                    break
                row, ids, ranks, at, best = row[going], ids[going], ranks[going], at[going], best[going]
            n, each, at_col = ids.shape[1], np.arange(len(row)), at[:, None]
            column = np.arange(n - 1)
            ids = np.take_along_axis(ids, column + (column > at_col), 1)
            ids[each, at] = self._merged_ids[best]
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at_col), 1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._ranks_of(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < n - 2)
            ranks[right, at[right]] = self._ranks_of(ids[right, at[right]], ids[right, at[right] + 1])
        return out

    def merge_many(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids, packed as 32-bit integers, of distinct pre-tokens."""
        by_length: dict[int, list[bytes]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        out = {}
        for n, group in by_length.items():
            if n <= SHORT and len(group) >= _FEW:
                out.update(zip(group, self.merge_equal(group)))
            else:
                one = self.merge_short if n <= SHORT else self.merge_long
                out.update((w, array("i", one(w)).tobytes()) for w in group)
        return out

    def merge_short(self, word: bytes) -> list[int]:
        """Ids of one pre-token by scanning its rank array."""
        rank, merged = self.rank, self.merged
        ids = [self.byte_id[b] for b in word]
        bounds = list(range(len(word) + 1))
        ranks = [rank.get(a << 32 | b, _NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            del bounds[i + 1], ids[i + 1], ranks[i]
            ids[i] = merged[best]
            if i:
                ranks[i - 1] = rank.get(ids[i - 1] << 32 | ids[i], _NEVER)
            if i < len(ranks):
                ranks[i] = rank.get(ids[i] << 32 | ids[i + 1], _NEVER)
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges with a heap of pairs over linked parts."""
        rank, n = self.rank, len(word)
        ids = [self.byte_id[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i) for i in range(n - 1) if (p := ids[i] << 32 | ids[i + 1]) in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank.get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := rank.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (found, a))
        return [x for x in ids if x >= 0]

    def pre_tokens(self, text: str) -> list[bytes | int]:
        """Pre-tokens of a text; a special token's string becomes its id."""
        if not any(s in text for s in self.specials):
            return [w.encode() for w in self._pre_token.findall(text)]
        out: list[bytes | int] = []
        for part in self._special.split(text):
            out += [self.specials[part]] if part in self.specials else [w.encode() for w in self._pre_token.findall(part)]
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, packed as 32-bit integers; special tokens' strings become their ids."""
        # The usual piece, a space and letters, is one pre-token.
        cut = [t.encode() if t[t[:1] == " " :].isalpha() else self.pre_tokens(t) for t in texts]
        words = {w for w in cut if isinstance(w, bytes)}
        words.update(w for c in cut if isinstance(c, list) for w in c if isinstance(w, bytes))
        ids_of = self.merge_many(words) | {i: array("i", [i]).tobytes() for i in self.specials.values()}
        return [ids_of[c] if isinstance(c, bytes) else b"".join([ids_of[w] for w in c]) for c in cut]

    def _byte_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in one array; start and length by id."""
        tokens = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        length = np.array([len(t) for t in tokens])
        return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows of ids (row i: ``offsets[i]`` to ``offsets[i + 1]``), and the rows' byte offsets.

        Special tokens are included; ids outside the vocabulary give nothing.
        """
        parts, bytes_before = [np.empty(0, np.uint8)], np.zeros(len(ids) + 1, np.int64)
        for start in range(0, len(ids), _DECODED_AT_ONCE):
            some = ids[start : start + _DECODED_AT_ONCE]
            known = (some >= 0) & (some < len(self._token_length))
            at = np.where(known, some, 0)
            length = np.where(known, self._token_length[at], 0)
            ends = np.cumsum(length)
            places = np.repeat(self._token_start[at] - (ends - length), length)
            places += np.arange(len(places))
            parts.append(self._token_bytes[places])
            bytes_before[start + 1 : start + 1 + len(some)] = bytes_before[start] + ends
        return np.concatenate(parts), bytes_before[offsets]


@functools.lru_cache(maxsize=2)
def _worker_model(spec: str) -> tuple[BytePairModel, WorkerCache]:
    """Model and cache (piece → packed ids) of this worker process; kept from task to task."""
    model = BytePairModel(spec)
    return model, WorkerCache(lambda piece: model.encode_many([piece])[0], CACHE_ENTRIES)


def _encode_blocks(texts: list[str], model: BytePairModel, cache: WorkerCache) -> list[bytes]:
    cuts = [pieces(t) or [t] for t in texts]
    distinct = set().union(*cuts)
    new = [p for p in cache.unknown(distinct) if len(p) <= CACHED_PIECE]
    for piece, packed in zip(new, model.encode_many(new)):
        cache.remember(piece, packed)
    large = [p for p in distinct if len(p) > CACHED_PIECE]
    if not large:
        return [b"".join(map(cache.__getitem__, cut)) for cut in cuts]
    once = dict(zip(large, model.encode_many(large)))
    return [b"".join([once[p] if p in once else cache[p] for p in cut]) for cut in cuts]


def encode_texts(texts: list[str], model: BytePairModel, cache: WorkerCache) -> list[bytes]:
    """Ids of whole texts, packed as 32-bit integers.

    Texts are cut at white space; pieces the worker has not met are encoded
    together.  Long pieces, and texts with other white space, are not memoised.
    """
    return [b"".join(parts) for parts in by_blocks(texts, lambda held: _encode_blocks(held, model, cache))]


def _encode_column(texts: pa.Array, spec: str) -> pa.ListArray:
    packed = encode_texts([t or "" for t in texts.to_pylist()], *_worker_model(spec))
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _decode_column(ids: pa.ListArray, spec: str) -> pa.Array:
    """Decoded texts; bytes that are not UTF-8 become replacement characters, null ids an empty text."""
    model, _ = _worker_model(spec)
    counts = np.array(ids.value_lengths().fill_null(0))
    rows = np.concatenate([[0], np.cumsum(counts)])
    data, offsets = model.decode_many(ids.flatten().to_numpy(zero_copy_only=False), rows)
    raw = data.tobytes()
    starts = data[offsets[:-1][offsets[:-1] < len(data)]]
    try:
        if ((starts & 0xC0) == 0x80).any():  # a row begins inside a character
            raise UnicodeDecodeError("utf-8", b"", 0, 1, "row")
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())
    return pa.StringArray.from_buffers(
        len(counts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw)
    )


def tokenizer_spec(path: str | None = None) -> str:
    """Text of a tokenizer file; default: the public byte-level BPE vocabulary of 50,257 entries."""
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, spec: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, array<int>: every whole text as the tokenizer library encodes it, nothing added.

    ``carry`` names the columns to return (default: all); an input column
    ``ids`` is replaced.  A null or empty text gives an empty array.  Rows keep
    their number, repeated ones too; an empty table gives an empty result.
    """
    return add_columns(docs, text_col, carry, [_encode_column], {"ids": "array<int>"}, spec or tokenizer_spec())


def decode(tokens: DataFrame, ids_col: str = "ids", carry: list[str] | None = None, spec: str | None = None) -> DataFrame:
    """``tokens`` with ``decoded``, string: the text of ``ids_col``, special tokens included.

    Null or empty ids give an empty text, ids outside the vocabulary nothing.
    """
    return add_columns(tokens, ids_col, carry, [_decode_column], {"decoded": "string"}, spec or tokenizer_spec())


def encode_decode(
    docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, spec: str | None = None
) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass: ``docs`` with ``ids`` and ``decoded``."""
    new = {"ids": "array<int>", "decoded": "string"}
    return add_columns(docs, text_col, carry, [_encode_column, _decode_column], new, spec or tokenizer_spec())


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and digests of its ids and of the text decoded from them."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text")
    return encode_decode(docs, carry=["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
