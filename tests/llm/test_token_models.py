"""Scores by n-grams of subword tokens."""

import math
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.llm import crossentropy

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_losses(texts, table, size):
    """Loss of each list of ids under the interpolated model of those in ``table``."""
    spans = lambda ids, n: [tuple([-1, -1, *ids][k - n + 1:k + 1]) for k in range(2, len(ids) + 2)]
    counts = {n: Counter(g for ids in table for g in spans(ids, n)) for n in (1, 2, 3)}
    before = {n: Counter() for n in (1, 2, 3)}
    for n, found in counts.items():
        for gram, many in found.items():
            before[n][gram[:-1]] += many
    out = []
    for ids in texts:
        loss = 0.0
        for gram in spans(ids, 3):
            p = 1 / size
            for n in (1, 2, 3):
                end = gram[3 - n:]
                p = (counts[n][end] + crossentropy.BACK * p) / (before[n][end[:-1]] + crossentropy.BACK)
            loss -= math.log2(p)
        out.append(loss / len(ids) if ids else None)
    return out


@pytest.mark.parametrize("hot", [0, 50, 1 << 20])
def test_scores_match_plain_token_models(odd_docs, texts_of, spark, monkeypatch, hot):
    rows = [(d, t or "") for d, t in texts_of(odd_docs)]
    ids = [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t for _, t in rows], add_special_tokens=False)]
    good = {d for d, _ in rows if d is not None and d % 3 == 0}
    found = crossentropy.scored(odd_docs, spark.createDataFrame([(d,) for d in good], "doc_id long"), path=PATH, hot=hot).collect()
    size = crossentropy.vocabulary(PATH)
    target = plain_losses(ids, [x for (d, _), x in zip(rows, ids, strict=True) if d in good], size)
    background = plain_losses(ids, ids, size)
    order = lambda r: (str(r[0]), r[1], r[3] or 0)
    expected = sorted(((d, len(x), a, b) for (d, _), x, a, b in zip(rows, ids, target, background, strict=True)), key=order)
    for x, y in zip(sorted((tuple(r) for r in found), key=order), expected, strict=True):
        assert x[:2] == y[:2]
        assert x[2:4] == (pytest.approx(y[2:], rel=1e-4) if y[2] is not None else (None, None))


def test_long_texts_are_read_in_chunks(monkeypatch):
    import pyarrow as pa

    lists = pa.array([[5, 6, 7, 8, 9], [], [5], [6, 5, 6]], pa.list_(pa.int32()))
    whole = [x.tolist() for x in next(crossentropy.grams(lists))]
    monkeypatch.setattr(crossentropy, "CHUNK", 2)
    parts = list(crossentropy.grams(lists))
    assert len(parts) == 5
    assert [sum((p[k].tolist() for p in parts), []) for k in (0, 1)] == whole
