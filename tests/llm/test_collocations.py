"""Collocations against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import collocations


def plain(rows, least, top=2000, depth=5):
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for m in range(1, depth + 1):
                for i in range(len(words) - m + 1):
                    counts[lang or "und", tuple(words[i:i + m])] += 1
    candidates = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    held = Counter()
    for (lang, words), f in candidates.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    held[lang, words[i:j]] = max(held[lang, words[i:j]], f)
    by_lang = {}
    for (lang, words), a in candidates.items():
        if held[lang, words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return [(lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
            for lang, found in by_lang.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)]


def made(rng, n):
    words = ["red", "Red", "green", "blue", "x", "日本", "é", "don't", "a-b", " q", "z"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", "!", "\x0b"]
    return "".join(rng.choice(words[:rng.randrange(2, len(words) + 1)]) + rng.choice(joins) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [made(rng, rng.randrange(1, 80)) for _ in range(120)]
    texts += [made(rng, 3000), "red green " * 700, "blue", "", " \t.\n", None, "q" * 500, "one two three four five six seven " * 60]
    rows = [(t, ["en", "de", None, "und"][k % 4]) for k, t in enumerate(texts)]
    return rows + [rows[3]] * 40 + [("red green blue z, red", "en")] * 150


SCHEMA = "text string, lang string"


@pytest.mark.parametrize(("least", "options"), [
    (7, {}), (2, {"shard_words": 400}), (7, {"shard_words": 50, "part": 40}), (2, {"part": 9, "shard_words": 2000})])
def test_plain_counts(spark, rows, options, least):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    found = collocations.mined(docs, least=least, **options).collect()
    assert sorted(map(tuple, found)) == sorted(plain(rows, least))


def test_least_of_the_contract_and_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' AS word", "'own' AS shard", "1 AS id", "'own' AS p", "'own' AS phrase")
    assert sorted(map(tuple, collocations.mined(docs, top=5).collect())) == sorted(plain(rows, 100, 5))


@pytest.mark.parametrize("few", [[], [(None, "en")], [("one word", None)], [("", "en"), (" .", "de")]])
def test_nothing_to_find(spark, few):
    assert collocations.mined(spark.createDataFrame(few, SCHEMA)).collect() == []


def test_exact_beyond_64_bits(spark):
    row = spark.sql("SELECT 9000000000000L a, 9000000000001L n, 9000000000000L l, 8999999999999L r")
    found = row.select(collocations.score(*[row[c] for c in "anlr"])).first()[0]
    assert found == 1000 * 9000000000000 * 9000000000001 // (9000000000000 * 8999999999999)


def test_parts_add_up():
    rng = random.Random(2)
    for _ in range(200):
        text = made(rng, 60)
        for longest in (1, 3, 10, 50):
            counts = Counter()
            for part, sign in collocations.parts(text, longest):
                for words in map(tuple, (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", part))):
                    for i in range(len(words)):
                        for j in range(i + 1, min(len(words), i + 5) + 1):
                            counts[words[i:j]] += sign
            whole = Counter(w[i:j] for p in re.split(r"[.,;:!?\x0A-\x0D]", text) for w in [tuple(re.findall(r"[^\x20\x09]+", p))]
                            for i in range(len(w)) for j in range(i + 1, min(len(w), i + 5) + 1))
            assert {k: n for k, n in counts.items() if n} == whole


def test_suffix_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = np.append(rng.integers(0, 3, 40), 0)
        ends = np.flatnonzero(text == 0)
        key = lambda i: [(int(c), i + k if c == 0 else 0) for k, c in enumerate(text[i:ends[np.searchsorted(ends, i)] + 1])]
        assert collocations.suffixes(text).tolist() == sorted(range(len(text)), key=key)
