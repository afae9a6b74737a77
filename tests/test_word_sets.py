"""Word sets of texts and the verification of their pairs, against plain sets."""

import re

import numpy as np

from newsloom.operators import stories

TEXTS = [None, "", " .,!", "One", "one ONE", "a b c d e", "A, b; c\n(d) e", "e d c b a", "Ünï ünï straße 北京 ٣ x²y", "a b c d e a b c d e a b", "x" * 3000,
         " ".join(f"w{k % 70}" for k in range(30_000))]


def _plain(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def test_word_sets(spark):
    rows = [(k, text) for k, text in enumerate(TEXTS * 3)]
    found = {r["id"]: r for r in stories.word_sets(spark.createDataFrame(rows, "id long, text string").coalesce(1), "text", 5).collect()}
    assert len(found) == len(rows)
    assert found[0].asDict().keys() == {"id", "items", "n", "digest"}
    for i, x in rows:
        assert found[i]["n"] == len(found[i]["items"]) == len(_plain(x))
        assert found[i]["items"] == sorted(found[i]["items"])
        for j, y in rows:
            assert len(set(found[i]["items"]) & set(found[j]["items"])) == len(_plain(x) & _plain(y))
            assert (found[i]["digest"] == found[j]["digest"]) == (_plain(x) == _plain(y))


def test_similar_pairs(spark):
    rng = np.random.default_rng(6)
    pairs = []
    for k in range(300):
        x, y = (set(rng.integers(-12, 12, size=size).tolist()) for size in rng.integers(1, 60, size=2))
        pairs.append((k, 1000 + k, sorted(x), sorted(y)))
    found = stories.similar_pairs(spark.createDataFrame(pairs, "a long, b long, items array<long>, others array<long>"), 80).collect()
    assert {(r["a"], r["b"]) for r in found} == {(a, b) for a, b, x, y in pairs if 100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y))}
    assert 0 < len(found) < 300
