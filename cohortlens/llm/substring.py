"""Substring deduplication with an FM-index per shard (operator 3).

A window is WINDOW consecutive words of a document.  Words covered by a window
whose words also start earlier (smaller id, or earlier in the document) go.

Sharding by content makes the work linear: a window belongs to the shard of its
minimizer, the smallest hash of its GRAM-word grams, which equal windows share.
Consecutive windows with the same minimizing gram form a segment; equal windows
are never in one segment.

1. Every document's segments are listed as (minimizer, place), without text; a
   document is known by its id and a 64-bit hash of its text, and rows equal in
   both are listed as one.  Minimizers met once cannot belong to a repeated window and are dropped.  The
   most frequent minimizers are found first, by partial counts, and their rows
   dealt out by place, so none of them is counted in one task.
2. The texts of the other segments go to their shards.  Equal segments met in
   one task are sent once, as the earliest of them: the later ones are already
   known to be repeats and are dealt out by place.  A minimizer with over HOT
   segments (a very common line) is dealt out by whole windows instead, so no
   shard grows with it.
3. Each shard indexes its distinct segments in document order and streams them
   through the index: backward search gives the matching statistics, and every
   interval of WINDOW words gives the first place where they occur.  Windows of
   a segment placed after that are repeats.  A task works through its shards one
   by one, so shards stay small while tasks do not become too many.
4. Repeats are gathered by document and its words taken out.

Documents are shuffled by id once; steps 2 and 4 read the same exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import add_columns, documents, pick, same, ship_package, stage, without
from cohortlens.llm.fmindex import FmIndex, matching_statistics
from cohortlens.schema import safe_col

WINDOW = 20
GRAM = 8
#: Windows of a segment, at most (its place is packed with 4 bits for it).
LONGEST_RUN = 15
#: Segments of one minimizer above which its windows are dealt out one by one.
HOT = 4_096
#: Minimizers whose rows are dealt out by place: the most frequent above HOT; any other holds under 1 / HOT_KEYS of all rows.
HOT_KEYS = 256
#: Words of a shard, about.
SHARD_WORDS = 400_000
#: Shards a task works through, at most, once there are more than shuffle partitions.
TASK_SHARDS = 32
#: Distinct segments, or documents, held while a task looks for equal ones.
HELD = 50_000
_CHUNK_WORDS = 200_000
_LAST_ID = (1 << 63) - 1
_PLACE_BITS = np.uint64(28)
_MIX = np.uint64(0x9E3779B97F4A7C15)
OUTPUTS = ("n_words", "n_removed", "kept_text", "removed")


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def segments(words: list[bytes], texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimizer of every segment; ``texts`` has the text index of each word."""
    n = len(words)
    if n < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = _scramble(np.fromiter(map(crc32, words), np.uint64, n) * _MIX)
    for width in (1, 2, 4):  # grams of 2, 4, GRAM words
        grams = _scramble(grams[:-width] * _MIX + grams[width:])
    # Hash above, place below: the leftmost of the smallest grams, which equal windows have at the same offset.
    least = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    for width in (1, 2, 4, 5):  # least of 2, 4, 8, 13 = WINDOW - GRAM + 1 grams
        least = np.minimum(least[:-width], least[width:])
    chosen = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    valid = texts[: n - WINDOW + 1] == texts[WINDOW - 1 :]
    joined = np.zeros(len(least), bool)
    joined[1:] = valid[1:] & valid[:-1] & (chosen[1:] == chosen[:-1])
    place = np.arange(len(least))
    run_start = np.maximum.accumulate(np.where(joined, 0, place))
    begins = np.flatnonzero(valid & ((place - run_start) % LONGEST_RUN == 0))
    group = np.cumsum(valid & ((place - run_start) % LONGEST_RUN == 0)) - 1
    counts = np.bincount(group[valid], minlength=len(begins))
    return begins, counts, grams[chosen[begins]].view(np.int64)


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []  # of bytes: ASCII white space only


class _Met(set):
    """Keys met lately, at most HELD of them."""

    def again(self, key: tuple[int, int]) -> bool:
        if key in self:
            return True
        if len(self) >= HELD:
            self.clear()
        self.add(key)
        return False


def _list_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text hash, text) → (minimizer, id, text hash, packed first word and number of windows).

    A document that the task has met lately is left out.
    """

    def emit(rows: list[tuple[int, int, list[bytes]]]) -> pa.RecordBatch:
        sizes = np.array([len(w) for _, _, w in rows])
        first = np.cumsum(sizes) - sizes
        begins, counts, minimizers = segments([x for _, _, w in rows for x in w], np.repeat(np.arange(len(rows)), sizes))
        row = np.searchsorted(first, begins, side="right") - 1
        ids = np.array([r[0] for r in rows], np.int64)[row]
        hashes = np.array([r[1] for r in rows], np.int64)[row]
        packed = (begins - first[row]) << 4 | counts
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (minimizers, ids, hashes, packed)], ["min", "ord", "th", "pk"])

    held: list[tuple[int, int, list[bytes]]] = []
    met = _Met()
    size = 0
    for batch in batches:
        for ord_, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = _words(text.as_py())
            if len(words) < WINDOW or met.again((ord_, th)):
                continue
            held.append((ord_, th, words))
            size += len(words)
            if size >= _CHUNK_WORDS:
                yield emit(held)
                held, size = [], 0
    if held:
        yield emit(held)


_ROUTED = pa.schema([("route", pa.int64()), ("ord", pa.int64()), ("th", pa.int64()), ("pk", pa.int64()), ("seg", pa.binary())])


def _route_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text hash, text, [(place, minimizer, hot)]) → (route, id, text hash, place, words).

    Of equal segments the task has met, only the earliest keeps its words; a
    row without words is a segment whose windows are all repeats, and as no shard
    needs it, its route is one of its own.  Of rows equal in id and text hash one
    is routed, unless the task met the others long before.
    """
    held: dict[bytes, tuple[int, int, int, int]] = {}
    out: list[tuple] = []
    met = _Met()

    def add(route: int, ord_: int, th: int, pk: int, seg: bytes) -> None:
        before = held.get(seg)
        if before is None:
            held[seg] = (ord_, th, pk, route)
        elif before[:3] < (ord_, th, pk):
            out.append((ord_ ^ th ^ pk, ord_, th, pk, None))
        else:
            if before[:3] != (ord_, th, pk):
                out.append((before[0] ^ before[1] ^ before[2], *before[:3], None))
            held[seg] = (ord_, th, pk, route)

    def flush() -> pa.RecordBatch:
        out.extend((route, ord_, th, pk, seg) for seg, (ord_, th, pk, route) in held.items())
        held.clear()
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROUTED)], schema=_ROUTED)
        out.clear()
        return batch

    for batch in batches:
        for ord_, th, text, places in zip(*batch.columns[:4]):
            ord_, th = ord_.as_py(), th.as_py()
            if met.again((ord_, th)):
                continue
            words = _words(text.as_py())
            flat = places.values
            for pk, minimizer, hot in zip(*[flat.field(i).to_pylist() for i in range(3)]):
                start, count = pk >> 4, pk & 15
                if not hot:
                    add(minimizer, ord_, th, pk, b" ".join(words[start : start + count + WINDOW - 1]))
                    continue
                for at in range(start, start + count):
                    seg = b" ".join(words[at : at + WINDOW])
                    add(xxhash.xxh64_intdigest(seg) - (1 << 63), ord_, th, at << 4 | 1, seg)
            if len(held) >= HELD or len(out) >= HELD:
                yield flush()
    if held or out:
        yield flush()


def shard_repeats(ord_: np.ndarray, th: np.ndarray, pk: np.ndarray, segs: list[bytes]) -> np.ndarray:
    """Bit mask of the repeated windows of every segment of a shard (rows: id, text hash, packed place, words)."""
    place = pk >> 4  # first word
    order = np.lexsort((place, th, ord_))
    # Rank of the document of each row, by id and text hash.
    new = np.ones(len(order), bool)
    new[1:] = (ord_[order[1:]] != ord_[order[:-1]]) | (th[order[1:]] != th[order[:-1]])
    doc = np.empty(len(order), np.int64)
    doc[order] = np.cumsum(new)
    number: dict[bytes, int] = {}
    owner = np.empty(len(segs), np.int64)
    firsts: list[int] = []  # row of the earliest occurrence of each distinct segment, in document order
    vocabulary: dict[bytes, int] = {}
    symbols: list[int] = []
    starts: list[int] = []
    for row in order.tolist():
        seg = segs[row]
        at = number.setdefault(seg, len(firsts))
        owner[row] = at
        if at == len(firsts):
            firsts.append(row)
            starts.append(len(symbols))
            symbols.extend([vocabulary.setdefault(w, len(vocabulary) + 1) for w in seg.split(b" ")])
            symbols.append(0)
    text = np.array(symbols, np.int64)
    begin = np.array(starts, np.int64)
    end = np.append(begin[1:], len(text)) - 1
    index = FmIndex(text, WINDOW)
    length, found = matching_statistics(index, text, begin, end)
    earliest = index.first_places()[found]  # meaningful where a whole window matches
    first_row = np.array(firsts, np.int64)

    # Every window of every row against the first place of its words.
    counts = pk & 15
    row_of = np.repeat(np.arange(len(segs)), counts)
    offset = np.arange(len(row_of)) - np.repeat(np.cumsum(counts) - counts, counts)
    here = begin[owner[row_of]] + offset
    source = np.searchsorted(begin, earliest[here], side="right") - 1
    source_row = first_row[source]
    source_place = place[source_row] + earliest[here] - begin[source]
    earlier = (doc[source_row] < doc[row_of]) | (
        (doc[source_row] == doc[row_of]) & (source_place < place[row_of] + offset)
    )
    repeated = earlier & (length[here] >= WINDOW)
    return np.bincount(row_of, (repeated.astype(np.int64) << offset).astype(float), len(segs)).astype(np.int64)


_REPEATS = pa.schema([("ord", pa.int64()), ("th", pa.int64()), ("at", pa.int64()), ("mask", pa.int32())])


def _repeats(ord_: np.ndarray, th: np.ndarray, pk: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    some = mask > 0
    columns = [ord_[some], th[some], pk[some] >> 4, mask[some].astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_REPEATS)


def _search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards one after the other (rows: shard, id, text hash, packed place, words): index the segments, stream them, report repeats."""
    ids, hashes, places, segs, shard = [], [], [], [], None

    def search() -> pa.RecordBatch:
        ord_, th, pk = np.concatenate(ids), np.concatenate(hashes), np.concatenate(places)
        return _repeats(ord_, th, pk, shard_repeats(ord_, th, pk, segs))

    for batch in batches:
        of = batch.column(0).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if start == stop:
                continue
            if of[start] != shard and segs:
                yield search()
                ids, hashes, places, segs = [], [], [], []
            shard = of[start]
            part = batch.slice(start, stop - start)
            ord_, th, pk = (part.column(i).to_numpy() for i in (1, 2, 3))
            with_words = np.array(part.column(4).is_valid())
            known = ~with_words
            if known.any():
                yield _repeats(ord_[known], th[known], pk[known], (1 << (pk[known] & 15)) - 1)
            ids.append(ord_[with_words])
            hashes.append(th[with_words])
            places.append(pk[with_words])
            segs += part.column(4).drop_null().to_pylist()
    if segs:
        yield search()


_CUT = "struct<n_words:bigint,n_removed:bigint,kept:string,starts:array<int>,ends:array<int>>"
_CUT_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("starts", pa.list_(pa.int32())),
     ("ends", pa.list_(pa.int32()))]
)


def _cut_column(rows: pa.StructArray, _: object) -> pa.Array:
    out = []
    for text, repeats in zip(rows.field("text"), rows.field("repeats")):
        words = _words(text.as_py())
        cover = np.zeros(len(words) + 1, np.int32)
        if repeats.is_valid:
            at, mask = (repeats.values.field(i).to_numpy() for i in range(2))
            for bit in range(LONGEST_RUN):
                start = at[(mask >> bit) & 1 == 1] + bit
                np.add.at(cover, start, 1)
                np.add.at(cover, start + WINDOW, -1)
        gone = np.cumsum(cover[:-1]) > 0
        n_gone = int(gone.sum())
        kept = [w for w, g in zip(words, gone.tolist()) if not g] if n_gone else words
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).astype(np.int32)
        out.append((len(words), n_gone, b" ".join(kept).decode(), edges[::2], edges[1::2]))
    return pa.array([dict(zip(("n_words", "n_removed", "kept", "starts", "ends"), row)) for row in out], _CUT_ARROW)


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Every row with n_words, n_removed, kept_text (kept words joined by a space) and removed (word intervals).

    ``carry`` names the columns to return (default: all); outputs replace input
    columns of the same names.  Null texts and texts below WINDOW words lose
    nothing.  A null id ranks last; rows with equal id rank by a hash of their
    text, and rows equal in both are one document met twice: neither counts as
    earlier than the other.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kept = without(docs.select(*[safe_col(c) for c in (docs.columns if carry is None else carry)]), OUTPUTS).columns
    names = [f"k{i}" for i in range(len(kept))]
    text = safe_col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(safe_col(id_col).cast("long"), F.lit(_LAST_ID)).alias("ord"),
        F.xxhash64(text).alias("th"),
        text.cast("binary").alias("text"),
        *[safe_col(c).alias(n) for c, n in zip(kept, names)],
    )

    listed = rows.select("ord", "th", "text").mapInArrow(_list_segments, "min bigint, ord bigint, th bigint, pk bigint")
    frequent = listed.groupBy("min").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT)
    hottest = [r.min for r in frequent.orderBy(F.desc("n"), "min").limit(HOT_KEYS).collect()]  # at most HOT_KEYS numbers
    known_hot = F.col("min").isin(hottest) if hottest else F.lit(False)
    dealt = listed.withColumn("known", known_hot).withColumn("by", F.when(F.col("known"), F.xxhash64("ord", "th", "pk")).otherwise(0))
    # Rows of one place (of a document met in several tasks) count once; equal ones lie side by side.
    group = Window.partitionBy("min", "by")
    place = F.struct("ord", "th", "pk")
    once = dealt.withColumn("new", ~same(F.lag(place).over(group.orderBy("ord", "th", "pk")), place))
    met = F.count(F.when(F.col("new"), 1)).over(group)
    shared = stage(
        once.withColumn("n", F.when(F.col("known"), HOT + 1).otherwise(met))
        .filter("new and n > 1")
        .select("ord", "th", "pk", "min", (F.col("n") > HOT).alias("hot")),
        "substring-candidates",
    )
    size = F.when(F.col("hot"), F.col("pk").bitwiseAND(F.lit(15)) * WINDOW).otherwise(
        F.col("pk").bitwiseAND(F.lit(15)) + WINDOW - 1
    )
    shards = 1 + int((shared.agg(F.sum(size)).first()[0] or 0) // SHARD_WORDS)
    places = (
        shared.select("ord", "th", F.struct("pk", "min", "hot").alias("place"))
        .groupBy("ord", "th")
        .agg(F.collect_list("place").alias("places"))  # of one document, each once
    )
    routed = (
        rows.join(places.hint("shuffle_hash"), ["ord", "th"])
        .select("ord", "th", "text", "places", *names)  # the same columns as below: one exchange serves both
        .mapInArrow(_route_segments, "route bigint, ord bigint, th bigint, pk bigint, seg binary")
    )
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + (shards - 1) // TASK_SHARDS))
    repeats = (
        routed.select(F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard"), "ord", "th", "pk", "seg")
        .repartition(tasks, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_search_shards, "ord bigint, th bigint, at bigint, mask int")
        .groupBy("ord", "th")
        .agg(F.collect_set(F.struct("at", "mask")).alias("repeats"))  # of one document, each once
    )
    marked = rows.join(repeats.hint("shuffle_hash"), ["ord", "th"], "left").select(
        F.struct("text", "repeats").alias("value"), *names
    )
    cut = add_columns(marked, "value", names, [_cut_column], {"cut": _CUT}, None)
    return cut.select(
        *[F.col(n).alias(c) for n, c in zip(names, kept)],
        F.col("cut.n_words").alias("n_words"),
        F.col("cut.n_removed").alias("n_removed"),
        F.col("cut.kept").alias("kept_text"),
        F.arrays_zip(F.col("cut.starts").alias("start"), F.col("cut.ends").alias("end")).alias("removed"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, removed words, and the digest of what is kept."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text")
    return substring_dedup(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE_SQL = """
WITH split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
spots AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS pos FROM split WHERE len(words) >= 20),
windows AS (SELECT doc_id, pos, sha256(array_to_string(words[pos : pos + 19], ' ')) AS window_hash FROM spots),
firsts AS (SELECT window_hash, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM windows GROUP BY window_hash),
repeats AS (
  SELECT w.doc_id, w.pos FROM windows w JOIN firsts f USING (window_hash)
  WHERE f.first <> struct_pack(doc_id := w.doc_id, pos := w.pos)),
covered AS (SELECT DISTINCT doc_id, pos + step AS pos FROM repeats, generate_series(0, 19) AS steps(step)),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.pos) AS kept_text, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM split) w
  ANTI JOIN covered c ON c.doc_id = w.doc_id AND c.pos = w.pos
  GROUP BY w.doc_id)
SELECT s.doc_id, len(s.words) AS n_words, len(s.words) - coalesce(k.n_kept, 0) AS n_removed,
       sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""
