"""The registered queries and the pipeline on the smallest tables."""

import hashlib
from collections import Counter

import pytest
from compare import difference, open_duckdb
from llm import brute

import corpus_pipeline
from newsloom.llm import suffix
from newsloom.llm.common import documents, landed
from newsloom.llm.queries import QUERIES
from newsloom.llm.sql import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    rows, differs = difference(QUERIES[name](spark, sf_dir), open_duckdb(sf_dir), ORACLE[name])
    assert differs is None and rows > 0


def test_passages_of_the_table(spark, sf_dir, texts_of):
    found = Counter(tuple(r) for r in QUERIES["op1_suffix_dedup"](spark, sf_dir).collect())
    assert found == Counter(brute.passages(texts_of(documents(spark, sf_dir)), suffix.LENGTH))


def test_near_groups_of_the_table(spark, sf_dir, texts_of):
    found = Counter((r[0], r[1], r[2]) for r in QUERIES["op10_minhash"](spark, sf_dir).collect())
    assert found == Counter(brute.near_groups(texts_of(documents(spark, sf_dir)), 4))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op7_packing", "op11_whitening", "op12_collocations"}))
def test_a_row_for_each_document(spark, sf_dir, name):
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(QUERIES[name](spark, sf_dir)) == ids(documents(spark, sf_dir))


def _stages(spark, docs, sf_dir):
    """Each stage's name with the rows before and after it, both written."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, landed(stage(spark, docs, sf_dir), "stage")
        yield name, before, docs
    yield corpus_pipeline.STAGES[-1][0], docs, corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)


@pytest.mark.parametrize("given", ["table", "odd", "none"])
def test_pipeline_stages(spark, sf_dir, texts_of, odd_docs, no_docs, given):
    given = {"table": documents(spark, sf_dir), "odd": odd_docs, "none": no_docs}[given]
    for name, before, docs in _stages(spark, given, sf_dir):
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()}
            continue
        assert docs.dtypes == given.dtypes, name
        assert docs.count() <= before.count()
        if name == "near dedup":
            groups = brute.near_groups(texts_of(before), 5)
            assert sorted(r["doc_id"] for r in docs.collect() if r["doc_id"]) == sorted(d for d, n, c in groups if d == c and d)
        if name == "suffix dedup":
            kept = Counter((d, digest) for d, _, _, _, digest in brute.passages(texts_of(before), corpus_pipeline.PASSAGE_BYTES))
            # What is cut inside a character differs from the exact bytes.
            plain = {d for d, t in texts_of(before) if (t or "").isascii()}
            left = Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in texts_of(docs) if d in plain)
            assert left == Counter({k: n for k, n in kept.items() if k[0] in plain})
