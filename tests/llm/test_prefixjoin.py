"""The grouped prefix join against plain sets."""

import random
from collections import Counter

import numpy as np
import pytest
from llm import brute

from newsloom.llm import minhash, prefixjoin
from newsloom.llm.common import documents

SCHEMA = "doc_id long, text string"


def agrees(spark_rows, rows, percent=90):
    assert Counter(map(tuple, spark_rows)) == Counter(brute.near_groups(rows, 3, percent=percent))


def test_table(spark, sf_dir, texts_of):
    docs = documents(spark, sf_dir)
    agrees(prefixjoin.joined(docs).collect(), texts_of(docs))


@pytest.mark.parametrize("bounds", [{}, {"most": 1, "group_classes": 3}])
def test_odd_documents(spark, odd_docs, texts_of, bounds):
    agrees(prefixjoin.joined(odd_docs, **bounds).collect(), texts_of(odd_docs))


def test_no_documents(spark, no_docs):
    assert prefixjoin.joined(no_docs).collect() == []


@pytest.fixture(scope="module")
def clusters():
    """Near copies around the limit, chains, one group of one prefix, and a passage that all documents share."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(word() for _ in range(30))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.randrange(1, 25)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
            if rng.random() < 0.3:
                base = copy
    rows += [(1000 + k, f"{passage} " + " ".join(word() for _ in range(rng.randrange(1, 40)))) for k in range(60)]
    long = " ".join(word() for _ in range(400))
    rows += [(2000 + k, f"{long} end{k}") for k in range(40)]
    return rows + rows[:9] + [(5000, " ".join(word() for _ in range(9000)))]


@pytest.mark.parametrize("bounds", [{}, {"most": 8, "group_classes": 6}, {"group_classes": 4}])
def test_clusters(spark, clusters, bounds):
    docs = spark.createDataFrame(clusters, SCHEMA).repartition(5)
    agrees(prefixjoin.joined(docs, **bounds).collect(), clusters)


def test_other_similarity(spark, clusters):
    agrees(prefixjoin.joined(spark.createDataFrame(clusters, SCHEMA), percent=70).collect(), clusters, 70)


def test_linked_sets_share_a_prefix_shingle():
    rng = np.random.default_rng(3)
    level = rng.integers(0, 5, 1 << prefixjoin.LEVELS).astype(np.uint8)
    for _ in range(400):
        n = int(rng.integers(1, 60))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(n) < 0.95], rng.integers(0, 1 << 63, int(rng.integers(0, 4))).astype(np.uint64)]))
        a = np.unique(a)
        if len(b) and minhash.are_linked(a, b, 90):
            assert set(prefixjoin.prefix_of(a, level, 90).tolist()) & set(prefixjoin.prefix_of(b, level, 90).tolist())


@pytest.mark.parametrize("bounds", [{}, {"most": 2, "block_classes": 3}, {"most": 1, "group_classes": 3, "block_classes": 7}])
def test_number_of_links(spark, clusters, bounds):
    """Every link counts, whether others connect its documents or not."""
    rows = [*clusters, (None, clusters[3][1]), (None, None), (7000, ""), (7001, "one"), (7002, "ONE"), (7003, "one two three four")]
    sets = [brute.shingles(t, 3) for _, t in rows]
    want = Counter()
    for i, ((doc_id, _), (_, size, component)) in enumerate(zip(rows, brute.near_groups(rows, 3, percent=90), strict=True)):
        n = sum(100 * len(sets[i] & s) >= 90 * len(sets[i] | s) for k, s in enumerate(sets) if k != i) if sets[i] else 0
        want[doc_id, size, component, n] += 1
    got = Counter(map(tuple, prefixjoin.linked(spark.createDataFrame(rows, SCHEMA).repartition(5), **bounds).collect()))
    assert got == want
    # More links than connect the documents.
    assert sum(k * n for (_, _, _, n), k in want.items()) > 2 * len(rows)


def test_other_similarity_by_parts(spark, clusters):
    agrees(prefixjoin.joined(spark.createDataFrame(clusters, SCHEMA), percent=70, most=2, block_classes=5).collect(), clusters, 70)


def test_a_shared_rare_passage_compares_no_unlike_documents(spark, monkeypatch):
    """Documents that only meet in a shingle of many prefixes are not brought together, and no pair is written with its prefixes."""
    rng = random.Random(4)
    rows = [(k, "rare passage here " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for k in range(90)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(3)]
    seen = {}

    def landed(df, name, *codec):
        out = write(df, name, *codec)
        seen.setdefault(name, []).append((out.columns, out.count()))
        return out

    write = prefixjoin.landed
    # Counters tell rare shingles from rarer ones only while the table is large.
    monkeypatch.setattr(prefixjoin, "levels", lambda docs, *_: np.zeros(1 << prefixjoin.LEVELS, np.uint8))
    monkeypatch.setattr(prefixjoin, "landed", landed)
    first = int(min(prefixjoin.shingle_sets(["rare passage here"], 3)[0]))
    monkeypatch.setattr(prefixjoin, "prefix_of", prefix_with(first, prefixjoin.prefix_of))
    agrees(prefixjoin.joined(spark.createDataFrame(rows, SCHEMA)).collect(), rows)
    assert max(n for _, n in seen["class-pairs"]) <= 3
    assert all(n <= 6 for _, n in seen["sets"][1:])
    assert not any("prefix_a" in columns for tables in seen.values() for columns, _ in tables)


def prefix_with(item, plain):
    """As ``plain``, but with ``item`` as the first shingle of the order."""
    def prefix(items, level, percent):
        many, rest = len(plain(items, level, percent)), items[items != np.uint64(item)]
        held = items[items == np.uint64(item)]
        return np.concatenate([held, rest])[:many]

    return prefix


@pytest.mark.parametrize("percent", [55, 70, 90, 97])
def test_linked_sets_share_a_part(percent):
    rng = np.random.default_rng(8)
    linked = 0
    for _ in range(600):
        n = int(rng.integers(1, 150))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        kept = a[rng.random(n) < rng.choice([0.98, 0.9, percent / 100])] if rng.random() < 0.8 else a
        new = rng.integers(0, 1 << 63, int(rng.integers(0, n * (100 - percent) // 100 + 2))).astype(np.uint64)
        b = np.unique(np.concatenate([kept, new]))
        if len(b) and len(a) != len(set(a) & set(b)) + 0 and minhash.are_linked(a, b, percent):
            linked += 1
            assert set(prefixjoin.part_marks(a, percent).tolist()) & set(prefixjoin.part_marks(b, percent).tolist())
    assert linked > 20


def test_overlaps_are_exact(monkeypatch):
    monkeypatch.setattr(prefixjoin, "SLAB", 16)
    monkeypatch.setattr(prefixjoin, "PLACES", 50)
    rng = np.random.default_rng(9)
    for size, values in ((1, 5), (7, 40), (40, 900), (60, 100_000)):
        one, two = ([np.unique(rng.integers(0, values, int(rng.integers(1, 60)))).astype(np.uint64) for _ in range(k)] for k in (size, 9))
        common = np.arange(20, dtype=np.uint64)
        one = [np.union1d(x, common) for x in one]
        two = [np.union1d(x, common) if k % 2 else x for k, x in enumerate(two)]
        assert prefixjoin.overlaps(one, two).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in two] for x in one]
        linked = prefixjoin.overlaps(one, two) > 20
        assert connected(linked, prefixjoin.connecting(linked)) == connected(linked, list(zip(*np.nonzero(linked), strict=True)))


def connected(linked, pairs):
    root = list(range(sum(linked.shape)))
    for x, y in pairs:
        assert linked[x, y]
        a, b = root[x], root[linked.shape[0] + y]
        root = [a if r == b else r for r in root]
    return len(set(root))
