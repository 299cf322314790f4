"""The pipeline's stages against plain Python on what each of them got, and on odd and empty documents."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from cohortlens.llm import ORACLE_SQL, QUERIES, line_crf, mixing
from cohortlens.llm.common import stage
from tests.conftest import SMALL_SF
from tests.llm.test_operators import fingerprint, near_groups
from tools.check_oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    r = compare(spark, SMALL_SF, [name], verbose=False)[name]
    assert r["cols_match"] and r["values_match"] and r["rows"] == r["oracle_rows"]


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_every_stage(spark):
    steps = [corpus_pipeline.documents(spark, SMALL_SF)]
    for name, function in corpus_pipeline.STAGES:
        steps.append(stage(function(spark, steps[-1], SMALL_SF), f"test-{name}"))
    docs, good, single, distinct, mixed, encoded = [s.collect() for s in steps]
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    crf = line_crf.quality_model(spark, steps[0], SMALL_SF)
    scores = {r.doc_id: r.score for r in line_crf.score(steps[0], crf).collect()}
    assert {r.doc_id for r in good} == {r.doc_id for r in docs if scores[r.doc_id] >= line_crf.THRESHOLD}
    last = {}
    for r in good:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert {r.doc_id for r in single} == set(last.values())
    groups = near_groups({r.doc_id: fingerprint(r.text) for r in single})
    assert {r.doc_id for r in distinct} == set(groups.values())
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(steps[3]).collect()}
    assert sorted(r.doc_id for r in mixed) == sorted(d for d, n in copies.items() for _ in range(n))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in docs}
    assert sorted(r.doc_id for r in encoded) == sorted(r.doc_id for r in mixed)
    for r in encoded:
        ids = t.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_stages_on_odd_and_no_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        docs = docs.withColumnRenamed("extra", "score")
        for name, function in corpus_pipeline.STAGES:
            before, docs = docs, stage(function(spark, docs, SMALL_SF), f"odd-{name}")
            assert name == "encode" or docs.columns == before.columns
        assert docs.count() <= 39
