"""Inner-product search, vector codes and the filter audit against plain Python."""

import hashlib
import itertools
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import filter_audit, inner_products, vector_codes
from cohortlens.llm.vectors import MAX_SQUARED, matrix, whole_vectors
from tests.conftest import SMALL_SF
from tests.llm.conftest import clash

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, extra string"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Null and non-finite vectors, empty and short ones, zeros, copies, repeated rows, rows without id or label."""
    rng = np.random.default_rng(0)
    some = [(i, [float(x) for x in rng.normal(size=6)], i % 3, "x") for i in range(40)]
    rows = some + [
        (50, None, 1, "x"), (51, [1.0, None, 1.0], 1, "x"), (52, [NAN] * 6, 1, None), (100, [INF] * 6, 1, "x"),
        (150, [], 2, "x"), (200, [1.5], None, "x"), (250, [0.0] * 6, None, "x"), (300, some[0][1], 0, "x"),
        (300, some[0][1], 0, "x"), (None, some[1][1], 1, "x"), (None, some[1][1], 1, "x"), (None, some[0][1], None, None),
        (301, [-0.001, 3.0, 0.0, 0.0, 0.0, 1.0], 5, "x"), (-50, some[2][1], 5, "x"),
    ]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], VECTORS)


def plain_ints(df, scale):
    out = []
    for r in df.collect():
        if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            out.append((r.vec_id, [int(np.floor(scale * np.float64(x))) for x in r.embedding], r.label))
    return out


def test_whole_vectors(spark, odd_vectors):
    got = whole_vectors(clash(odd_vectors, "ints", "Squared", "id"), "embedding", 256, id="vec_id").collect()
    want = plain_ints(odd_vectors, 256)
    assert Counter((r.id, tuple(r.ints)) for r in got) == Counter((i, tuple(v)) for i, v, _ in want)
    assert all(r.squared == sum(x * x for x in r.ints) for r in got)
    assert next(r.ints for r in got if r.id == 301)[0] == -1
    long = spark.createDataFrame([(1, [3e37])], "id long, v array<float>")
    with pytest.raises(Exception, match="too long"):
        whole_vectors(long, "v", 256, id="id").collect()


def test_matrix_of_ragged_lists():
    column = pa.chunked_array([pa.array([[1, 2, 3], [], [4]], pa.list_(pa.int64())), pa.array([[5, 6]], pa.list_(pa.int64()))])
    assert matrix(column, 3).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0], [5, 6, 0]]
    assert matrix(column.slice(2), 3).tolist() == [[4, 0, 0], [5, 6, 0]]


# --- 11 inner products ------------------------------------------------------


def plain_top(queries, vectors, k):
    width = max([len(v) for _, v in vectors] + [0])
    fill = lambda v: v + [0] * (width - len(v))
    out = Counter()
    for qid, q in queries:
        found = [(-sum(a * b for a, b in zip(fill(q), fill(v))), i is None, i) for i, v in vectors if i is None or i != qid]
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            out[(qid, rank, i, -score)] += 1
    return out


@pytest.mark.parametrize("head, block, every", [(1024, 8192, 50), (4, 8, 1)])
def test_top_products_odd(monkeypatch, odd_vectors, head, block, every):
    monkeypatch.setattr(inner_products, "HEAD", head)
    monkeypatch.setattr(inner_products, "BLOCK", block)
    rows = whole_vectors(odd_vectors, "embedding", 256, id="vec_id")
    plain = [(i, v) for i, v, _ in plain_ints(odd_vectors, 256)]
    queries = rows if every == 1 else rows.filter(F.col("id") % every == 0)
    asked = [(i, v) for i, v in plain if every == 1 or i is not None and i % every == 0]
    got = inner_products.top_inner_products(rows, queries, 5).collect()
    assert Counter(tuple(r) for r in got) == plain_top(asked, plain, 5)


def test_top_products_of_none(odd_vectors, no_vectors):
    rows, none = (whole_vectors(v, "embedding", 256, id="vec_id") for v in (odd_vectors, no_vectors))
    for vectors, queries in ((none, rows), (rows, none), (none, none)):
        assert inner_products.top_inner_products(vectors, queries, 5).count() == 0


def side(ints, ids, steps, turn):
    table = pa.table({"id": pa.array(ids, pa.int64()), "ints": pa.array(ints.tolist(), pa.list_(pa.int64())), "squared": (ints * ints).sum(1)})
    return inner_products.Side(table.sort_by([("squared", "descending")]), turn, steps)


@pytest.mark.parametrize("scale, pairs", [(20, 1 << 20), (20, 200), (1 << 20, 300)])
def test_search_of_a_cell(monkeypatch, scale, pairs):
    """Ties, lengths of many sizes, products beyond exact doubles; few pairs are multiplied out."""
    monkeypatch.setattr(inner_products, "PAIRS", pairs)
    rng = np.random.default_rng(scale % 97)
    steps = inner_products.cuts(24)
    mixing = rng.normal(size=(24, 24)) * 0.6 ** np.arange(24)[:, None]
    ints = np.floor(scale * (rng.normal(size=(600, 24)) @ mixing) * rng.lognormal(size=(600, 1), sigma=1.5)).astype(np.int64)
    ints[300:] = ints[:300]
    assert (ints * ints).sum(1).max() < MAX_SQUARED
    turn = np.linalg.eigh((ints.T @ ints).astype(float) if scale < 1000 else (ints / scale).T @ (ints / scale))[1][:, ::-1]
    queries, vectors = side(ints[:40], range(40), steps, turn), side(ints, range(600), steps, turn)
    best = inner_products.Best(np.full(40, -np.inf), 5)
    seen = []
    monkeypatch.setattr(inner_products, "products", lambda a, b, bound, f=inner_products.products: seen.append(len(a) * len(b)) or f(a, b, bound))
    inner_products.search(queries, vectors, best, steps)
    got = Counter((int(queries.id[q]), int(s), int(i)) for q, s, i in zip(best.query, best.score, best.id))
    exact = ints.astype(object) @ ints.astype(object).T
    want = Counter()
    for q in range(40):
        want.update((q, int(exact[q, i]), i) for i in sorted((i for i in range(600) if i != q), key=lambda i: (-exact[q, i], i))[:5])
    assert got == want
    if pairs < 1000:
        assert sum(seen) < 40 * 600 / 2


# --- 12 vector codes --------------------------------------------------------


@pytest.mark.parametrize("spread, top", [(50, 3), (3000, 1000), (1 << 26, 1 << 25)])
def test_tree_finds_the_nearest_entry(spread, top):
    rng = np.random.default_rng(top)
    centres = rng.integers(-spread, spread, size=(12, 5))
    entries = centres[rng.integers(0, 12, size=256)] + rng.integers(-top // 10 - 1, top // 10 + 1, size=(256, 5))
    entries[100:140] = entries[:40]
    rows = np.concatenate([entries, centres[rng.integers(0, 12, size=500)] + rng.integers(-top, top + 1, size=(500, 5))])
    exact = ((rows.astype(object)[:, None] - entries.astype(object)) ** 2).sum(2)
    index, distance, taken = vector_codes.Tree(entries).nearest(rows)
    assert distance.tolist() == exact.min(1).tolist() and index.tolist() == exact.argmin(1).tolist()
    assert taken < exact.size / 2


def test_tree_of_few_or_equal_entries():
    for entries in (np.zeros((256, 3), np.int64), np.arange(6).reshape(2, 3), np.repeat(np.arange(30).reshape(10, 3), 20, 0), np.zeros((40, 0), np.int64)):
        rows = np.arange(9 * entries.shape[1]).reshape(9, entries.shape[1])
        exact = ((rows[:, None] - entries) ** 2).sum(2)
        index, distance, _ = vector_codes.Tree(entries).nearest(rows)
        assert index.tolist() == exact.argmin(1).tolist() and distance.tolist() == exact.min(1).tolist()


def plain_codes(rows, entries=256, rounds=4):
    width = -(-max(len(v) for _, v, _ in rows) // 4) * 4
    each = width // 4
    rows = [(i, v + [0] * (width - len(v)), label) for i, v, label in rows]
    parts = [[v[p * each : (p + 1) * each] for _, v, _ in rows] for p in range(4)]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * each : (p + 1) * each] for _, v, _ in first] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, book: min((far(v, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            found = [nearest(v, books[p])[1] for v in parts[p]]
            for k in set(found):
                mine = [v for v, f in zip(parts[p], found) if f == k]
                books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    coded = [[nearest(parts[p][r], books[p]) for p in range(4)] for r in range(len(rows))]
    error = [sum(d for d, _ in c) for c in coded]
    by_label = Counter()
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{k:02x}" for _, k in c), e, by_label[label], sha) for (i, _, label), c, e in zip(rows, coded, error))


def test_codes_odd(monkeypatch, spark, odd_vectors, no_vectors):
    whole = whole_vectors(clash(odd_vectors, "code", "error"), "embedding", 1024, id="vec_id", label="label")
    got = vector_codes.compress(whole)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_codes(plain_ints(odd_vectors, 1024))
    monkeypatch.setattr(vector_codes, "ENTRIES", 7)  # fewer entries than vectors: rounds move them
    got = vector_codes.compress(whole.coalesce(1)).collect()
    assert Counter(tuple(r) for r in got) == plain_codes(plain_ints(odd_vectors, 1024), 7)
    assert vector_codes.compress(whole_vectors(no_vectors, "embedding", 1024, id="vec_id", label="label")).count() == 0


# --- 13 filter audit --------------------------------------------------------


@pytest.mark.parametrize("m", [0, 1, 2, 3, 5, 6])
def test_shapley_against_all_orders(m):
    rng = np.random.default_rng(m)
    worth = [0, *rng.integers(-50, 50, size=(1 << m) - 1).tolist()]
    sums, orders = [0] * m, list(itertools.permutations(range(m)))
    for order in orders:
        inside = 0
        for i in order:
            sums[i] += worth[inside | 1 << i] - worth[inside]
            inside |= 1 << i
    assert filter_audit.shapley(worth) == [Fraction(s, len(orders)) for s in sums]


def plain_audit(docs, labels):
    """Every order applied to every document, one filter after the other."""
    good, toxic = ({d for d, *flags in labels if flags[k] == 1} for k in (0, 1))
    rows = []
    for d, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [e for e, t, _ in docs if (t or "") == text and e is not None]
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": bool(same) if d is None else min(same) < d,
        }
        rows.append((part or "", {f for f in fails if fails[f]}, d is not None and d in good, d is not None and d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [r for r in mine if letter in r[1] and not r[1] & before]
                shapley[letter] += len(gone)
                out[(part, "".join(order), step)] = [
                    sum(not r[1] & {*before, letter} for r in mine), len(gone), sum(letter in r[1] and bool(r[1] & before) for r in mine),
                    sum(r[1] == {letter} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone), letter,
                ]
        for key, value in out.items():
            if key[0] == part:
                value[6] = shapley[value[6]]
    return {(*k, *v) for k, v in out.items()}


def test_audit_odd(monkeypatch, spark, odd_docs, no_docs):
    more = [(20 + i, t, "en", s, "x") for i, (t, s) in enumerate(itertools.product(["A b", "A b", "$ " + "w " * 60, "Z" * 9, "a|b"], ["a", None, ""]))]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema))
    labels = [(1, 1, None), (2, 0, 1), (2, 1, 0), (None, 1, 1), (3, None, None), (20, 1, 1), (23, 1, 0), (99, 1, 1)]
    labels = spark.createDataFrame(labels, "id long, good int, toxic int")
    picked = docs.selectExpr("doc_id AS id", "text", "source AS part")
    for limit in (100_000, 0):
        monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", limit)
        got = filter_audit.audit(filter_audit.failures(picked, labels)).collect()
        assert {tuple(r) for r in got} == plain_audit([(r.id, r.text, r.part) for r in picked.collect()], [tuple(r) for r in labels.collect()])
        assert len(got) == 120 * 5 * 5
    none = no_docs.selectExpr("doc_id AS id", "text", "source AS part")
    assert filter_audit.audit(filter_audit.failures(none, labels)).count() == 0
    unlabelled = filter_audit.audit(filter_audit.failures(picked, labels.limit(0)))
    assert unlabelled.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_audit_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL_SF}/labels.parquet").collect()]
    got = filter_audit.op13_filter_audit(spark, SMALL_SF)
    assert {tuple(r) for r in got.collect()} == plain_audit(docs, labels)
