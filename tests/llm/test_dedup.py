from collections import Counter

import duckdb
import pytest

from newsloom.llm import exact, minhash, quality, suffix
from newsloom.llm.sql import ORACLE
from llm import brute


def by_sql(docs, sql):
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text", "lang", "source").toArrow())
    found = connection.execute(sql)
    names = [c[0] for c in found.description]
    return names, Counter(found.fetchall())


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_classes_match_sql(odd_docs):
    names, expected = by_sql(odd_docs, ORACLE["op2_exact_dedup"])
    assert rows_of(exact.classes(odd_docs).select(*names)) == expected


def test_exact_index_splits_buckets(odd_docs):
    names, expected = by_sql(odd_docs, ORACLE["op2_exact_dedup"])
    assert rows_of(exact.classes(odd_docs, capacity=1).select(*names)) == expected


def test_directory_doubles_and_covers_every_slot(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) AS h")
    slots, depth = exact.directory(keys, 40)
    found = slots.collect()
    assert depth >= 4 and len(found) == len({r["slot"] for r in found})
    held = Counter(r["bucket"] for r in keys.join(slots, exact.slot(keys["h"], depth) == slots["slot"]).collect())
    assert sum(held.values()) == 500 and max(held.values()) <= 40
    assert any(r["local_depth"] < depth for r in found) or depth == min(r["local_depth"] for r in found)


def test_exact_keeps_one_row_of_each_class(odd_docs):
    kept = exact.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    norms = [r[0] for r in kept.select(exact.normal(kept["text"])).collect()]
    assert len(norms) == len(set(norms)) == exact.classes(odd_docs).select("text_sha256").distinct().count()


def test_empty_tables(no_docs):
    assert exact.classes(no_docs).count() == exact.deduplicated(no_docs).count() == 0
    assert minhash.linked(no_docs).count() == minhash.deduplicated(no_docs).count() == 0
    assert suffix.spans_removed(no_docs).count() == suffix.deduplicated(no_docs).count() == 0
    assert quality.verdicts(no_docs).count() == quality.filtered(no_docs).count() == 0


def test_quality_matches_sql(odd_docs, texts_of):
    # The SQL joins its windows by doc_id, so ids are made distinct for it.
    single = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    names, expected = by_sql(single, ORACLE["op8_quality_rules"])
    assert rows_of(quality.verdicts(single).select(*names)) == expected


def test_quality_takes_all_rows(odd_docs):
    assert quality.verdicts(odd_docs).count() == odd_docs.count()
    kept = quality.filtered(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == quality.verdicts(odd_docs).where("kept").count()


def test_quality_limits_follow_the_group(spark):
    rows = [(i, "word " * 30 + ("#" * (i % 10) if i % 2 else ""), "en" if i % 2 else "de", "s") for i in range(800)]
    rows += [(1000, "wo#rd " * 30, "de", "s"), (1001, "w " * 40, "de", "tiny")]
    docs = spark.createDataFrame([(a, "".join(f"{w}{k} " for k, w in enumerate(b.split())), c, d) for a, b, c, d in rows], "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r["kept"] for r in quality.verdicts(docs).collect()}
    assert not found[1000] and found[0] and found[1] and found[9]
    limits = {(r["lang"], r["source"]): r for r in quality.limits(quality.sketches(docs)).collect()}
    assert limits["en", "s"]["symbols"] > limits["de", "s"]["symbols"]
    assert limits["de", "tiny"]["symbols"] == limits["de", "s"]["symbols"]


@pytest.mark.parametrize("bounds", [{}, {"owner_texts": 3, "shard_bytes": 1500}, {"owner_texts": 1}])
def test_passages_match_brute_force(odd_docs, texts_of, bounds):
    expected = Counter(brute.passages(texts_of(odd_docs), 60))
    assert rows_of(suffix.spans_removed(odd_docs, 60, **bounds)) == expected
    assert sum(r[2] for r in expected) > 1000


def test_passages_at_full_length(odd_docs, texts_of):
    assert rows_of(suffix.spans_removed(odd_docs)) == Counter(brute.passages(texts_of(odd_docs), 400))


def test_passages_leave_columns_and_clean_texts(odd_docs):
    left = suffix.deduplicated(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    before = {r["doc_id"]: r["text"] for r in odd_docs.where("doc_id between 8 and 30").collect()}
    after = {r["doc_id"]: r["text"] for r in left.where("doc_id between 8 and 30").collect()}
    assert all(len(after[k]) <= len(before[k]) for k in before) and any(after[k] == before[k] for k in before)


@pytest.mark.parametrize("bounds", [{}, {"group_classes": 2, "rounds": 1}, {"group_classes": 2, "rounds": 4}])
def test_near_groups_match_brute_force(odd_docs, texts_of, bounds):
    expected = Counter(brute.near_groups(texts_of(odd_docs), 4))
    found = minhash.linked(odd_docs, 4, **bounds)
    assert Counter((r[0], r[1], r[2]) for r in found.collect()) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def test_near_dedup_keeps_one_row_of_each_group(odd_docs, texts_of):
    kept = minhash.deduplicated(odd_docs, 4)
    assert kept.columns == odd_docs.columns
    roots = brute.near_groups(texts_of(odd_docs), 4, roots=True)
    assert kept.count() == len(set(roots) - {None}) + roots.count(None)


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    b = np.concatenate([a[:400], rng.integers(0, 1 << 62, 100).astype(np.uint64)])
    x, y = minhash.signatures([np.unique(a), np.unique(b)])
    assert abs((x == y).mean() - 400 / 600) < 0.15
    assert (minhash.signatures([np.unique(a)])[0] == x).all()
