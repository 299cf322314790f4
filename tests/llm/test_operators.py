"""Every operator on the odd documents and on none, and against plain Python."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm import bpe, components, exact, langid, line_crf, mixing, prefix_hash, sharding, simhash, substring, token_counts
from tests.conftest import SMALL_SF
from tests.llm.conftest import PROSE, clash


def pairs(df, key="doc_id"):
    return sorted(((r[key] is None, r[key] or 0), tuple(r)) for r in df.collect())


def small(spark):
    return spark.read.parquet(f"{SMALL_SF}/documents.parquet")


def texts(spark):
    return {r.doc_id: r.text for r in small(spark).collect()}


# --- 1 mixing ---------------------------------------------------------------


@pytest.mark.parametrize("buckets, levels", [(1024, 2), (2, 3), (16, 1)])
def test_water_filling_and_nearness(spark, monkeypatch, buckets, levels):
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    monkeypatch.setattr(mixing, "LEVELS", levels)
    rows = [(i, " ".join(["w"] * (1 + i % 50)), s) for s, n in (("big", 900), ("mid", 60), ("tiny", 3)) for i in range(n)]
    docs = spark.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("big", 1.0), ("mid", 5.0), ("tiny", 50.0)], "source string, weight double")
    got = mixing.mix_sources(docs, weights).collect()
    size = Counter()
    for r in got:
        size[r.source] += r.size
    total = sum(size.values())
    target = {r.source: r.target for r in got}
    assert target["tiny"] == 3 * size["tiny"] and target["mid"] == 3 * size["mid"]
    assert target["big"] == pytest.approx(total - target["tiny"] - target["mid"])
    for s in size:
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) <= 25
    assert all(r.taken <= 3 * r.size for r in got)
    assert pairs(mixing.mix_sources(docs, weights)) == pairs(mixing.mix_sources(docs.repartition(7), weights))
    repeated = mixing.repeat_rows(mixing.mix_sources(docs, weights))
    assert repeated.columns == docs.columns and repeated.count() == sum(r.copies for r in got)


@pytest.mark.parametrize("seed", [3])
def test_mixing_of_rows_that_share_a_draw(spark, seed):
    """A third of a source in copies without id, another with one id only: each target is met to half a document."""
    rows = [(None, "w " * 10, "a")] * 300 + [(i, "w " * (1 + i % 19), "a") for i in range(600)]
    rows += [(7, "w " * (1 + i % 5), "b") for i in range(500)] + [(None, "", "a")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    weights = spark.createDataFrame([("a", 7.0), ("b", 0.9)], "source string, weight double")
    got = mixing.mix_sources(docs, weights, seed=seed).collect()
    for source, longest in (("a", 19), ("b", 5)):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= longest / 2
    assert len(got) == len(rows) and pairs(mixing.mix_sources(docs, weights, seed=seed)) == pairs(mixing.mix_sources(docs, weights, seed=seed))


@pytest.mark.parametrize("seed", [18])
def test_copies_never_exceed_the_epochs(spark, seed):
    rows = [(i, "" if i % 3 else "w", "small") for i in range(60)] + [(i, "w " * 9, "big") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("small", 50.0), ("big", 1.0)], "source string, weight double")
    got = mixing.mix_sources(docs, weights, seed=seed).collect()
    assert {r.copies for r in got if r.source == "small"} == {3} and max(r.copies for r in got) == 3


def test_mixing_of_more_sources_than_are_broadcast(spark, odd_docs, monkeypatch):
    """With a hot source (null among them) and many rare ones: the result is that of the broadcast tables."""
    sized = [(i, "w " * (1 + i % 7), None if i % 3 == 0 else "hot" if i % 3 == 1 else f"s{i % 97}") for i in range(900)]
    docs = spark.createDataFrame([*sized, *[(None, "w " * 5, "hot")] * 40], "doc_id long, text string, source string")

    def mixed(d):
        return sorted(map(repr, mixing.mix_sources(d, carry=["doc_id", "source"]).collect()))

    expected = [mixed(d) for d in (docs, odd_docs)]
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    for share in (10, 1):  # some sources hot, none
        monkeypatch.setattr(mixing, "HOT_SHARE", share)
        assert [mixed(d) for d in (docs, odd_docs)] == expected


def test_mixing_odd(odd_docs, no_docs):
    got = mixing.mix_sources(clash(odd_docs, "size", "Target"))
    assert got.count() == 13 and got.columns == [*odd_docs.columns, "size", "source_size", "target", "copies", "taken"]
    assert {r.doc_id: r.size for r in got.collect() if r.doc_id}[5] == 0
    assert mixing.mix_sources(no_docs).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(odd_docs, odd_docs.selectExpr("source", "CAST(0 AS DOUBLE) AS weight"))


# --- 2 language -------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in small(spark).collect()}
    held = [r for r in langid.op2_language_mixture(spark, SMALL_SF).collect() if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_mixture_shares(spark):
    model = langid.fit(small(spark))
    by_lang = {r.lang: r.text for r in small(spark).filter("n_chars > 3000").collect()}
    a, b = sorted(by_lang)[:2]
    mixed = spark.createDataFrame([(1, by_lang[a][:2000] + "\n" + by_lang[b][:1000]), (2, by_lang[a][:2000])], "doc_id int, text string")
    got = {r.doc_id: dict(zip(r.languages, r.shares)) for r in langid.identify(mixed, model).collect()}
    assert set(got[1]) == {a, b} and got[1][a] == pytest.approx(2 / 3, abs=0.05)
    assert set(got[2]) == {a}


def test_every_language_is_kept(spark, monkeypatch):
    """More languages than 256, the rarest of one text; one task counts them all."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), size=5)) for _ in range(12)]
        rows += [(i, " ".join(rng.permutation(words)), f"l{i:03}") for _ in range(1 if i % 3 else 4)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").coalesce(1)
    model = langid.fit(docs)
    assert model.languages == [f"l{i:03}" for i in range(300)]
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows) and all(r.lang_pred == r.lang for r in got)
    monkeypatch.setattr(langid, "MAX_COUNTS", 1000)
    with pytest.raises(ValueError):
        langid.fit(docs)


def test_mixture_and_set_against_plain_loops(spark):
    """EM text by text in plain Python, and the penalised likelihood of every subset of four languages."""
    from itertools import combinations

    docs = small(spark)
    model = langid.fit(docs)
    by_lang = {r.lang: r.text for r in docs.filter("n_chars > 3000").orderBy("doc_id").collect()}
    names = sorted(by_lang)
    assert len(names) == 4 == len(model.languages)
    held = [" ".join(by_lang[names[i]][:n] for i, n in parts) for parts in [[(0, 900)], [(0, 800), (1, 400)], [(2, 300), (3, 900)], [(0, 600), (1, 500), (2, 500)], [(1, 3000), (3, 45)], [(3, 40)]]]
    grams = langid._counted(held)
    table = np.full((4, langid.BUCKETS), 0.0) + model.least[:, None]
    for b in range(langid.BUCKETS):
        at = slice(model.edges[b], model.edges[b + 1])
        table[model.lang[at], b] += model.more[at]

    def em(buckets, counts, start, rounds):
        shares = np.array(start)
        for _ in range(rounds):
            mix = [sum(shares[k] * table[k, b] for k in range(4)) for b in buckets]
            fit = sum(c * np.log(m) for c, m in zip(counts, mix))
            shares = np.array([sum(c * shares[k] * table[k, b] / m for b, c, m in zip(buckets, counts, mix)) for k in range(4)]) / sum(counts)
        return shares, fit

    got = model.shares(grams)
    for (buckets, counts), row in zip(grams, got):
        full, _ = em(buckets, counts, [0.25] * 4, langid.ROUNDS)
        penalty = langid.PENALTY * 0.5 * np.log1p(counts.sum())
        values = {}
        for size in range(1, 5):
            for some in combinations(range(4), size):
                start = np.array([max(full[k], 1e-9) if k in some else 0.0 for k in range(4)])
                found, fit = em(buckets, counts, start / start.sum(), langid.SET_ROUNDS if size > 1 else 1)
                values[some] = (fit - penalty * (size - 1), found)
        best = max(values, key=lambda s: values[s][0])
        assert tuple(np.flatnonzero(row)) == best
        assert row == pytest.approx(values[best][1] if len(best) > 1 else (np.arange(4) == best[0]).astype(float), abs=1e-9)
    assert np.count_nonzero(got, 1).tolist()[:4] == [1, 2, 2, 3]


def test_language_odd(odd_docs, no_docs):
    model = langid.fit(odd_docs)
    got = {r.doc_id: r for r in langid.identify(clash(odd_docs, "score"), model).collect()}
    assert [got[i].lang_pred for i in (3, 4, 5, 10)] == ["und"] * 4 and got[1].lang_pred == "en"
    empty = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(odd_docs, empty).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


# --- 3 substrings -----------------------------------------------------------


def removed_words(docs):
    """doc_id → (words, removed, kept text), by a set of windows."""
    seen, out = set(), {}
    for doc_id, text in docs:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out[doc_id] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


@pytest.mark.parametrize("hot, keys, words", [(3, 256, 400_000), (3, 2, 2_000), (4096, 256, 400_000)])
def test_substrings_against_brute_force(spark, monkeypatch, hot, keys, words):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "HOT_KEYS", keys)
    monkeypatch.setattr(substring, "SHARD_WORDS", words)  # few words: many shards a task
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.substring_dedup(small(spark)).collect()}
    assert got == removed_words(sorted(texts(spark).items()))


def test_substrings_of_repetitive_texts(spark):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(rng.choice(["a", "b"], size=int(rng.integers(0, 70)), p=[0.97, 0.03]))) for i in range(60)]
    got = substring.substring_dedup(spark.createDataFrame(docs, "doc_id int, text string").repartition(5))
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got.collect()} == removed_words(docs)
    row = next(r for r in got.collect() if r.n_removed)
    assert sum(s.end - s.start for s in row.removed) == row.n_removed


def test_substrings_odd(odd_docs, no_docs):
    got = substring.substring_dedup(clash(odd_docs, "n_words", "REMOVED"))
    assert got.columns == [*odd_docs.columns, "n_words", "n_removed", "kept_text", "removed"]
    rows = got.collect()
    n = len(PROSE.split())
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0]
    assert [r.n_removed for r in rows if r.doc_id == 2] == [n, n]  # one document met twice
    assert [r.n_removed for r in rows if r.doc_id is None and r.text] == [n]  # no id: last, and one more word
    assert len(rows) == 13 and substring.substring_dedup(no_docs).count() == 0


def test_substrings_of_texts_without_id(spark):
    """Two such texts whose hashes end in the same 27 bits stay apart, and many copies are one document."""
    seen, k = {}, 0
    while True:
        text = f"{PROSE} {PROSE} " + " ".join(f"n{k}x{i}" for i in range(30 + k % 50))
        low = xxhash.xxh64_intdigest(text.encode(), 42) % (1 << 27)
        if low in seen and len(seen[low].split()) != len(text.split()):
            break
        seen[low], k = text, k + 1
    pair = [seen[low], text]
    copies = " ".join(f"c{i}" for i in range(90))
    docs = [(1, PROSE + " one"), *[(None, t) for t in pair], *[(None, copies)] * 3000, *[(5, copies + " five")] * 40]
    got = substring.substring_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == len(docs)
    # Without id by signed hash of the text, after all others; each text once.
    signed = {t: h - (1 << 64) if (h := xxhash.xxh64_intdigest(t.encode(), 42)) >> 63 else h for t in [*pair, copies]}
    order = [(t, t) for _, t in (docs[0], docs[-1])] + [(t, t) for t in sorted(signed, key=signed.get)]
    want = removed_words(order)
    assert all((r.n_words, r.n_removed, r.kept_text) == want[r.text] for r in got)


def test_places_of_copies_are_routed_once():
    import pyarrow as pa

    words = [f"w{i}" for i in range(60)]
    text = " ".join(words).encode()
    begins, counts, minimizers = substring.segments([w.encode() for w in words], np.zeros(60, np.int64))
    batch = pa.RecordBatch.from_arrays([pa.array([9] * 50), pa.array([7] * 50), pa.array([text] * 50)], ["ord", "th", "text"])
    listed = list(substring._list_segments(iter([batch, batch])))
    assert sum(b.num_rows for b in listed) == len(begins)
    places = [{"pk": int(b) << 4 | int(c), "min": int(m), "hot": False} for b, c, m in zip(begins, counts, minimizers)]
    kind = pa.struct([("pk", pa.int64()), ("min", pa.int64()), ("hot", pa.bool_())])
    batch = batch.append_column("places", pa.array([places] * 50, pa.list_(kind)))
    routed = list(substring._route_segments(iter([batch])))
    assert sum(b.num_rows for b in routed) == len(begins)


# --- 4 quality --------------------------------------------------------------


def chain_marginals(scores, transitions):
    """Probability of label 1 at each line, over all labellings."""
    n = len(scores)
    total, good = 0.0, np.zeros(n)
    for code in range(1 << n):
        labels = [(code >> i) & 1 for i in range(n)]
        weight = np.exp(sum(s * y for s, y in zip(scores, labels)) + sum(transitions[a][b] for a, b in zip(labels, labels[1:])))
        total += weight
        good += weight * np.array(labels)
    return good / total


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    sizes = [1, 6, 3, 8]
    text_of = np.repeat(range(4), sizes)
    scores, transitions = rng.normal(size=sum(sizes)), rng.normal(size=(2, 2))
    forward, backward = line_crf._messages(scores, line_crf._chains(text_of), np.exp(transitions))
    got = line_crf._sigmoid(forward + backward)
    for t in range(4):
        assert got[text_of == t] == pytest.approx(chain_marginals(scores[text_of == t], transitions))


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in line_crf.op4_line_quality(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in held if labels[r.doc_id]]
    bad = [r.score for r in held if not labels[r.doc_id]]
    assert np.mean([[(g > b) + 0.5 * (g == b) for g in good] for b in bad]) >= 0.97
    assert np.mean([r.predicted for r in held if labels[r.doc_id]]) >= 0.97


def test_long_texts_have_the_same_features(monkeypatch):
    text = "\n".join(f"line {i % 7} is here!!\n\n  " + "word " * (i % 5) for i in range(300))
    whole = line_crf.line_features([text])
    monkeypatch.setattr(line_crf, "BLOCK", 100)
    for a, b in zip(whole, line_crf._long_features(text)):
        assert np.array_equal(a, b)


def test_quality_fit_does_not_depend_on_order(spark, monkeypatch):
    """More labelled rows than the bounds, repeated ids and rows: the same fit from any partitioning."""
    monkeypatch.setattr(line_crf, "FIT_DOCS", 40)
    monkeypatch.setattr(line_crf, "FIT_LINES", 60)
    rows = [(i % 70, "\n".join(f"line {j} of {i % 90}!" * (1 + i % 3) for j in range(i % 5 + 1)), i % 2) for i in range(300)]
    docs = spark.createDataFrame(rows + rows[:50] + [(None, "a\nb", 1)] * 30, "doc_id int, text string, quality int")
    fits = [line_crf.fit(docs.repartition(n)) for n in (1, 7)]
    assert all(np.array_equal(getattr(fits[0], f), getattr(fits[1], f)) for f in vars(fits[0]))
    drawn = line_crf._drawn(docs.select(F.col("doc_id").alias("id"), "text", F.col("quality").alias("label"))).collect()
    assert 20 < len(drawn) <= 40 and sum(r.text.count("\n") + 1 for r in drawn) <= 60
    assert sorted(r.place for r in drawn) == list(range(len(drawn))) and len({(r.text, r.label) for r in drawn}) > 10


def test_quality_odd(spark, odd_docs, no_docs):
    crf = line_crf.fit(odd_docs.withColumn("quality", (F.col("doc_id") % 2).cast("int")))
    rows = line_crf.score(clash(odd_docs, "score"), crf).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if not (r.text or "").strip()} == {crf.prior}
    unknown = line_crf.fit(no_docs.withColumn("quality", F.lit(1)))
    assert {r.score for r in line_crf.score(odd_docs, unknown).collect()} == {0.5}
    assert line_crf.score(no_docs, crf).count() == 0


# --- 5 exact copies ---------------------------------------------------------


@pytest.mark.parametrize("bits", [1 << 20, 1 << 6])
def test_exact_copies(spark, monkeypatch, bits):
    """A saturated filter sends every row to the shuffle and changes nothing."""
    if bits < exact._SECTION:
        monkeypatch.setattr(exact, "bit_positions", lambda h, b: [np.zeros(len(h), np.int64)] * 2)
    docs = texts(spark)
    groups = {}
    for d, t in docs.items():
        groups.setdefault(t, []).append(d)
    got = {r.doc_id: tuple(r)[1:] for r in exact.op5_exact_dedup(spark, SMALL_SF).collect()}
    assert got == {d: (max(groups[t]), len(groups[t]), d == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in docs.items()}


def test_exact_odd(odd_docs, no_docs):
    got = exact.exact_dedup(clash(odd_docs, "kept"))
    rows = got.collect()
    assert got.columns == [*odd_docs.columns, *exact.OUTPUTS] and len(rows) == 13
    prose = [r for r in rows if r.text == PROSE]
    assert {r.keep_id for r in prose} == {2} and {r.group_size for r in prose} == {3} and sum(r.kept for r in prose) == 1
    blank = [r for r in rows if not r.text]
    assert {(r.keep_id, r.group_size) for r in blank} == {(4, 3)}
    assert exact.exact_dedup(no_docs).count() == 0


# --- 6 prefix hashes --------------------------------------------------------


def test_spans_and_extensions():
    a, b = "abracadabra abracadabra", "cadabra abra"
    x, y = (prefix_hash.PrefixHashes(prefix_hash.code_points(t)) for t in (a, b))
    for i in range(len(a)):
        for j in range(len(b)):
            want = next((n for n in range(min(len(a) - i, len(b) - j)) if a[i + n] != b[j + n]), min(len(a) - i, len(b) - j))
            assert x.common_extension(i, y, j) == want


def test_compare_spans_against_plain_texts(spark):
    rng = np.random.default_rng(5)
    held = ["", "abracadabra", "abracadabra abra", "caf\u00e9 \U0001f389 caf\u00e9", "ab" * 400_000, "ab" * 399_999 + "ax"]
    rows = []
    for _ in range(80):
        a, b = (held[i] for i in rng.integers(0, len(held), size=2))
        rows.append((a, int(rng.integers(0, min(len(a), 30) + 1)), b, int(rng.integers(0, min(len(b), 30) + 1)), int(rng.integers(0, 9))))
    rows += [(None, 0, "a", 0, 1), ("a", None, "a", 0, 1), ("a", 0, "a", 2, 1), ("a", -1, "a", 0, 1), ("a", 0, "a", 0, None), ("a", 0, "a", 0, -1)]
    docs = spark.createDataFrame([(k, *r, "mine") for k, r in enumerate(rows)], "id int, a string, i int, b string, j int, n int, Spans_Equal string")
    got = {r.id: (r.common_length, r.spans_equal) for r in prefix_hash.compare_spans(docs, "a", "i", "b", "j", "n", ["id", "Spans_Equal"]).collect()}
    assert len(got) == len(rows)
    for k, (a, i, b, j, n) in enumerate(rows[:80]):
        x, y = a[i:], b[j:]
        common = next((m for m, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
        assert got[k] == (common, len(x) >= n and len(y) >= n and x[:n] == y[:n])
    assert [got[k] for k in range(80, 86)] == [(None, None)] * 4 + [(1, None)] * 2
    assert prefix_hash.compare_spans(docs.limit(0), "a", "i", "b", "j", "n").count() == 0


def test_blocks_do_not_change_fingerprints(monkeypatch):
    long = " ".join(str(i * i) for i in range(400))
    whole, other = prefix_hash.Fingerprint(long), prefix_hash.Fingerprint(long[:900] + "!" + long[900:])
    monkeypatch.setattr(prefix_hash, "BLOCK", 100)
    assert str(prefix_hash.Fingerprint(long)) == str(whole)
    assert prefix_hash.Fingerprint(long).common_prefix(prefix_hash.Fingerprint(long[:900] + "!" + long[900:])) == 900
    assert whole.common_prefix(other) == 900


def test_next_documents(spark):
    docs = sorted(texts(spark).items(), reverse=True)
    got = {r.doc_id: r for r in prefix_hash.op6_prefix_fingerprints(spark, SMALL_SF).collect()}
    assert len(got) == len(docs)
    for k, (d, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == str(prefix_hash.Fingerprint(text))
        assert r.near_edited == prefix_hash.likeness(r.fingerprint, r.edited_fingerprint)
        common = next((i for i, (x, y) in enumerate(zip(text, following)) if x != y), min(len(text), len(following)))
        assert r.common_next == common
        a, b = true_spans(text), true_spans(following)
        want = 1.0 if text == following else len(a & b) / len(a | b)
        assert abs(r.near_next - want) < 0.35 and (want or not r.near_next) and (len(a | b) > 32 or r.near_next == pytest.approx(want))


def test_next_of_many_copies_without_id(spark):
    """Rows of one id and text, a third of all, are one row of the order and come back as many."""
    copies, other = "the same text again and again", "another text of some length"
    docs = [(None, copies)] * 700 + [(None, other)] * 2 + [(5, copies)] * 400 + [(i, f"text {i} of many others") for i in range(1000, 1900)]
    got = Counter(tuple(r) for r in prefix_hash.with_next(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect())
    signed = {t: h - (1 << 64) if (h := xxhash.xxh64_intdigest(t.encode(), 42)) >> 63 else h for t in (copies, other)}
    order = [d for d in sorted(docs, key=lambda d: -(d[0] or 0)) if d[0]] + sorted((d for d in docs if not d[0]), key=lambda d: signed[d[1]])
    want = Counter()
    for k, (d, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (prefix_hash.Fingerprint(t) for t in (text, edited, following))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want[(d, len(text), sha, str(a), str(b), a.likeness(b), a.likeness(c), a.common_prefix(c))] += 1
    assert got == want


def true_spans(text):
    size = prefix_hash.SPAN
    return {text[max(0, i) : i + size] for i in range(1 - size, len(text))} - {""}


def test_likeness_of_edited_texts_against_true_spans(spark):
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyz é中")
    docs = [(i, "".join(rng.choice(letters, size=n))) for i, n in enumerate([*range(2, 70), *range(100, 3000, 100)])]
    got = prefix_hash.with_next(spark.createDataFrame(docs, "doc_id long, text string"))
    off = []
    for r in got.collect():
        text, following = docs[r.doc_id][1], docs[r.doc_id - 1][1]
        half = len(text) // 2
        a, b = true_spans(text), true_spans(text[: len(text) - half] + following[:half])
        want = len(a & b) / len(a | b)
        if len(a | b) <= prefix_hash.SKETCH:
            assert r.near_edited == pytest.approx(want)
        assert r.near_edited > 0
        off.append(r.near_edited - want)
    assert max(map(abs, off)) < 0.35 and abs(np.mean(off)) < 0.05


@pytest.mark.parametrize("size", range(0, 40))
def test_spans_of_a_fingerprint(monkeypatch, size):
    """The sketch of a text cut into blocks anywhere holds every span there is."""
    text = "".join(chr(97 + i * i % 23) for i in range(size))
    monkeypatch.setattr(prefix_hash, "SKETCH", 1000)
    want = prefix_hash.Fingerprint(text).sketch
    assert len(want) == len(true_spans(text))
    monkeypatch.setattr(prefix_hash, "BLOCK", 13)
    assert prefix_hash.Fingerprint(text).sketch == want


def test_prefix_odd(odd_docs, no_docs):
    rows = prefix_hash.with_next(odd_docs).collect()
    assert len(rows) == 13 and len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert prefix_hash.with_next(no_docs).count() == 0
    one = prefix_hash.with_next(odd_docs.filter("doc_id = 6")).first()
    assert (one.near_next, one.common_next) == (1.0, 4)


# --- 7 and 9 tokens ---------------------------------------------------------


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("block", [50, 1 << 21])
def test_tokens_equal_the_library(spark, monkeypatch, block):
    from cohortlens.llm import pieces

    monkeypatch.setattr(pieces, "BLOCK", block)
    t = library()
    rng = np.random.default_rng(3)
    atoms = ["a", "the", " ", "  ", "\n", "\t", "'s", "1", "12", "!", "?!", "é", "中", "<|endoftext|>", " ", "\x1c", "　", "zq", "\U0001f389", "\r\n"]
    held = ["".join(rng.choice(atoms, size=int(rng.integers(0, 60)))) for _ in range(600)] + ["", "x" * 700, "ab" * 400 + " y"]
    model, cache = bpe.BytePairModel(bpe.tokenizer_spec()), None
    cache = pieces.WorkerCache(lambda p: model.encode_many([p])[0], 50)
    packed = bpe.encode_texts(held, model, cache)
    want = [e.ids for e in t.encode_batch(held, add_special_tokens=False)]
    assert [np.frombuffer(p, np.int32).tolist() for p in packed] == want
    spec = bpe.tokenizer_spec()
    import pyarrow as pa

    counted = token_counts._count_column(pa.array(held), (spec, "the\0 a", np.array([1, 1], np.uint16).tobytes()))
    assert counted.to_pylist() == [len(w) for w in want]
    ids = [rng.integers(0, 50257, size=int(rng.integers(0, 9))).tolist() for _ in range(400)]
    got = bpe._decode_column(pa.array([*ids, None, [-1, 60000]], pa.list_(pa.int32())), spec).to_pylist()
    assert got == [t.decode(i, skip_special_tokens=False) for i in ids] + ["", ""]


def test_three_ways_of_merging_agree():
    model = bpe.BytePairModel(bpe.tokenizer_spec())
    rng = np.random.default_rng(4)
    words = {bytes(rng.choice(list(b"theinga onrs'19"), size=int(rng.integers(1, 40))).tolist()) for _ in range(3000)}
    many = model.merge_many(words)
    for w in words:
        assert model.merge_short(w) == model.merge_long(w) == np.frombuffer(many[w], np.int32).tolist()


def test_token_queries_against_the_library(spark):
    t = library()
    counted = {r.doc_id: r for r in token_counts.op7_token_counts(spark, SMALL_SF).collect()}
    encoded = {r.doc_id: r for r in bpe.op9_bpe(spark, SMALL_SF).collect()}
    docs = texts(spark)
    assert set(counted) == set(encoded) == set(docs)
    for d, text in docs.items():
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert tuple(counted[d])[1:] == (len((text or "").encode()), len(ids), len(ids) > 512)
        back = t.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        assert (encoded[d].n_tokens, encoded[d].ids_sha256, encoded[d].decoded_sha256) == (len(ids), *sha)


def test_frequent_pieces_come_from_all_files(spark):
    docs = spark.range(40_000).selectExpr("concat('w', id DIV 10000, ' word rare', id) AS text").repartitionByRange(8, "text")
    found = token_counts.frequent_lengths(docs, bpe.tokenizer_spec())[0].split("\0")
    assert {"w0", "w1", "w2", "w3", " word"} <= set(found)


@pytest.mark.parametrize("frequent, held", [(20, 1 << 18), (20, 40), (200, 300)])
def test_frequent_pieces_against_all_counts(spark, frequent, held):
    from cohortlens.llm.pieces import pieces

    counts = Counter(p for t in texts(spark).values() for p in pieces(t or "") or [] if len(p) <= token_counts.PIECE_CHARS)
    total = sum(counts.values())
    docs = small(spark).select("text").repartition(5)
    joined, lengths = token_counts.frequent_lengths(docs, bpe.tokenizer_spec(), frequent, held)
    found = joined.split("\0")
    assert {p for p, n in counts.items() if n * frequent >= total} <= set(found)
    assert len(found) <= 2 * frequent and all(counts[p] * 2 * frequent >= total for p in found)
    plain = library()
    assert np.frombuffer(lengths, np.uint16).tolist() == [len(plain.encode(p, add_special_tokens=False).ids) for p in found]


def test_pieces_encoded_together():
    tokenizer = token_counts._tokenizer(bpe.tokenizer_spec())
    odd = ["a", " ", "\n\n", "  b", " \u4e2d\u6587", "\t\U0001f389x", " <|endoftext|>", " x<|endoftext|>y", "\n\n-", " don't", " 's"]
    odd += ["", "\r\u0301x", " \u200dz", "  \x00q", "\v\f'll", " 1234", "\n" * 70 + "w", " " + "long" * 40]
    plain = library()
    want = [len(plain.encode(p, add_special_tokens=False).ids) for p in odd]
    rng = np.random.default_rng(8)
    for _ in range(30):
        some = rng.integers(0, len(odd), size=600)
        assert token_counts.piece_lengths(tokenizer, [odd[i] for i in some]) == [want[i] for i in some]
    assert token_counts.piece_lengths(tokenizer, []) == []


def test_tokens_odd(odd_docs, no_docs):
    t = library()
    rows = bpe.encode_decode(clash(odd_docs, "ids", "Decoded")).collect()
    assert len(rows) == 13
    for r in rows:
        if r.doc_id != 8:
            e = t.encode(r.text or "", add_special_tokens=False).ids
            assert r.ids == e and r.decoded == t.decode(e, skip_special_tokens=False)
    counted = {r.doc_id: r.n_tokens for r in token_counts.token_counts(odd_docs).collect()}
    assert {r.doc_id: len(r.ids) for r in rows} == counted
    assert [r.decoded for r in bpe.decode(bpe.encode(odd_docs.filter("doc_id = 9"))).collect()] == [r.text for r in rows if r.doc_id == 9]
    assert bpe.encode_decode(no_docs).count() == 0 and token_counts.token_counts(no_docs).count() == 0


# --- 8 SimHash --------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def near_groups(prints, radius=2):
    """id → smallest id reachable over fingerprints that differ in at most ``radius`` bits."""
    root = {d: d for d in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: top(d) for d in ids}


def test_simhash_against_brute_force(spark):
    prints = {d: fingerprint(t) for d, t in texts(spark).items()}
    groups = near_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op8_simhash(spark, SMALL_SF).collect()}
    assert got == {d: (f"{p:016x}", groups[d]) for d, p in prints.items()}


def test_simhash_by_blocks(monkeypatch):
    from cohortlens.llm import pieces

    long = " ".join(f"W{i * i % 91}\tx" for i in range(200))
    want = [simhash.simhash(t) for t in (long, "a", "a b", " a  b c ", "", None)]
    monkeypatch.setattr(pieces, "BLOCK", 1)
    assert [simhash.simhash(t) for t in (long, "a", "a b", " a  b c ", "", None)] == want
    assert want[0] % (1 << 64) == fingerprint(long) and want[4:] == [0, 0]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_covering_links(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(0, 1 << 63, size=12)]
    prints = {b ^ sum(1 << int(k) for k in rng.choice(64, size=int(rng.integers(0, 5)), replace=False)) for b in base for _ in range(5)}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), radius).collect()
    assert all((signed[a] ^ signed[b]).bit_count() <= radius for a, b in links)
    want = near_groups({s: p for s, p in signed.items()}, radius)
    linked = {s: {s} for s in signed}
    for a, b in links:
        both = linked[a] | linked[b]
        for s in both:
            linked[s] = both
    assert {s: min(g) for s, g in linked.items()} == want


def test_simhash_odd(odd_docs, no_docs):
    got = simhash.near_duplicates(clash(odd_docs, "fingerprint"))
    rows = got.collect()
    assert got.columns == [*odd_docs.columns, *simhash.OUTPUTS] and len(rows) == 13
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {3} and sum(r.first for r in zero) == 1
    same = [r for r in rows if r.text == PROSE]
    assert {r.component_id for r in same} == {1} and [r.doc_id for r in same if r.first] == [1]
    assert simhash.near_duplicates(no_docs).count() == 0


# --- 10 sharding ------------------------------------------------------------


def test_lookup_table_against_plain_turns():
    shards, size = ["a", "b", "c", "d"], 101
    got = sharding.lookup_table(shards, size)
    orders = [[(sharding._hash(s, b"offset") + i * (sharding._hash(s, b"skip") % (size - 1) + 1)) % size for i in range(size)] for s in shards]
    table = {}
    while len(table) < size:
        for i, order in enumerate(orders):
            free = next((slot for slot in order if slot not in table), None)
            if free is not None:
                table[free] = i
    assert [table[s] for s in range(size)] == got.tolist()
    assert max(Counter(got.tolist()).values()) - min(Counter(got.tolist()).values()) <= 1


def test_few_keys_move_when_a_shard_goes():
    names = [f"s{i}" for i in range(20)]
    before, after = sharding.lookup_table(names, 10_007), sharding.lookup_table(names[:-1], 10_007)
    stayed = before != 19
    assert np.mean(before[stayed] != after[stayed]) < 0.1
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)


def test_sharding_query_and_odd(spark, odd_docs, no_docs):
    owner = sharding.lookup_table(sharding.SHARDS)
    ids = spark.range(0, 200).select("id", F.pmod(F.xxhash64("id"), F.lit(sharding.TABLE_SIZE)).alias("slot")).collect()
    want = {r.id: (r.slot, sharding.SHARDS[owner[r.slot]]) for r in ids}
    assert {r.doc_id: (r.slot, r.shard) for r in sharding.op10_sharding(spark, SMALL_SF).collect()} == want
    got = sharding.place(clash(odd_docs, "Slot"), "doc_id")
    assert got.columns == [*odd_docs.columns, "slot", "shard"] and got.count() == 13
    assert sharding.place(no_docs, "doc_id").count() == 0


# --- components --------------------------------------------------------------


def test_components_against_union_find(spark):
    """Long paths, a hub, cycles, repeated links, links of a node with itself, and null ends."""
    draw = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1200)] + [(7, 8), (8, 9), (9, 7), (7, 8)]
    links += [tuple(int(x) for x in draw.integers(2000, 2300, 2)) for _ in range(150)] + [(5, 5), (6, 6)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components.components(spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long"))
    assert sorted((r.node, r.root) for r in got.collect()) == sorted((x, find(x)) for x in root)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
