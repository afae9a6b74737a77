"""Language identification recomputed letter by letter, document by document."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest

from newsloom.llm import language
from newsloom.llm.common import documents
from newsloom.llm.pieces import LETTER, classes

FULL = (1 << 64) - 1


def features(text):
    """The feature of every n-gram of one to ORDER signs: letters, and one blank after each run of them."""
    kinds, signs, before = classes(), [], False
    for c in (text or "").lower() + "\0":
        letter = c != "\0" and kinds[ord(c)] == LETTER
        if letter or before:
            signs.append(ord(c) if letter else 32)
        before = letter
    found = []
    for n in range(1, language.ORDER + 1):
        for i in range(len(signs) - n + 1):
            h = n
            for sign in signs[i:i + n]:
                h = ((h ^ sign) * 0x9E3779B97F4A7C15) & FULL
                h ^= h >> 29
            found.append((h >> 20) & (language.FEATURES - 1))
    return found


def elected(labels, margins):
    """Most pairwise wins, then the larger sum of margins, then the first label."""
    if len(labels) == 1:
        return labels[0], 1.0
    wins, total = Counter(), Counter()
    for a, b in combinations(labels, 2):
        m = margins[a, b]
        wins[a if m >= 0 else b] += 1
        total[a] += m
        total[b] -= m
    order = sorted(labels, key=lambda x: (-wins[x], -total[x], labels.index(x)))
    best = order[0]
    own = [m if a == best else -m for (a, b), m in margins.items() if best in (a, b)]
    sure = min(1 / (1 + math.exp(-4 * max(-20, min(20, m)))) for m in own)
    return best, sure / 2 if wins[order[1]] == wins[best] else sure


def plain(model, text):
    found = Counter(features(text))
    n = sum(found.values())
    if not n:
        return "und", 0.0
    margins = {name: sum(w[f] * k for f, k in found.items()) / n for name, w in zip(model.names, model.weights.tolist(), strict=True)}
    at = lambda level: {(a, b): m for (x, a, b), m in margins.items() if x == level}
    group, sure = elected(model.families, at("family"))
    lang, more = elected(model.languages[group], at(group))
    return lang, sure * more


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return language.fit(docs, ~language.held_out(docs["doc_id"]))


def agrees(model, docs):
    rows = docs.select("doc_id", "text").collect()
    found = language.predicted(docs, model).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    expected = sorted(((r["doc_id"], *plain(model, r["text"])) for r in rows), key=key)
    assert len(found) == len(expected)
    for f, x in zip(sorted(map(tuple, found), key=key), expected, strict=True):
        assert f[:2] == x[:2] and abs(f[2] - x[2]) < 1e-9


def test_table(spark, sf_dir, model):
    assert len(model.families) > 1 and max(map(len, model.languages.values())) > 1
    docs = documents(spark, sf_dir)
    some = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    chosen = random.Random(4).sample(some, 40)
    agrees(model, docs.where(docs["doc_id"].isin(chosen)))


def test_odd_rows(odd_docs, model):
    agrees(model, odd_docs.where("coalesce(length(text), 0) < 3000"))


def test_ties_and_repeated_rows(spark, sf_dir, model):
    """Machines of no weight tie everywhere: the first label of equal ones, at half the score."""
    flat = language.Model(model.weights * 0, model.families, model.languages, model.names)
    docs = documents(spark, sf_dir).limit(5)
    twice = docs.unionByName(docs)
    agrees(flat, twice)
    agrees(model, twice)
    assert Counter(Counter(r["doc_id"] for r in language.predicted(twice, model).collect()).values()) == {2: 5}
