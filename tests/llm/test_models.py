import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsloom.llm import crossentropy, language
from newsloom.llm.common import documents


def test_language_of_held_out_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = language.cross_checked(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").collect()
    assert len(held) > 30 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_held_out_rows_teach_nothing(spark, sf_dir):
    docs = documents(spark, sf_dir)
    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, language.cross_checked(docs).collect())) == sorted(map(tuple, language.cross_checked(changed).collect()))


def test_texts_without_letters_are_undetermined(odd_docs, no_docs):
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.cross_checked(odd_docs).collect()}
    assert (900, "und", 0.0) in found and (901, "und", 0.0) in found
    assert language.cross_checked(no_docs).count() == 0
    assert {r["lang_pred"] for r in language.cross_checked(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def plain_losses(texts, table):
    """Loss of each text under the interpolated model of the texts in ``table``."""
    counts = [Counter(), Counter(), Counter(), Counter(), Counter()]
    for text in table:
        data = b"\0\0" + text.encode()
        for k in range(2, len(data)):
            for n in range(3):
                counts[n][data[k - n:k + 1]] += 1
            counts[3][data[k - 1:k]] += 1
            counts[4][data[k - 2:k]] += 1
    total, back = sum(counts[0].values()), crossentropy.BACK
    out = []
    for text in texts:
        data, loss = b"\0\0" + text.encode(), 0.0
        for k in range(2, len(data)):
            p = (counts[0][data[k:k + 1]] + back / 256) / (total + back)
            p = (counts[1][data[k - 1:k + 1]] + back * p) / (counts[3][data[k - 1:k]] + back)
            p = (counts[2][data[k - 2:k + 1]] + back * p) / (counts[4][data[k - 2:k]] + back)
            loss -= math.log2(p)
        out.append(loss / (len(data) - 2) if len(data) > 2 else None)
    return out


def test_scores_match_plain_models(odd_docs, texts_of, spark):
    rows = [(d, t or "") for d, t in texts_of(odd_docs)]
    good = [d for d, _ in rows if d is not None and d % 3 == 0]
    labels = spark.createDataFrame([(d, 1) for d in good] + [(1, 0), (None, 1), (good[0], 1), (999_999, 1)], "doc_id long, quality int")
    found = sorted(crossentropy.scored(odd_docs, crossentropy.good_ids(labels)).collect(), key=str)
    texts = [t for _, t in rows]
    target = plain_losses(texts, [t for d, t in rows if d in set(good)])
    background = plain_losses(texts, texts)
    expected = sorted(((d, len(t.encode()), a, b) for (d, t), a, b in zip(rows, target, background, strict=True)), key=lambda x: str(x[:2]))
    found = sorted(((r[0], r[1], r[2], r[3], r[4]) for r in found), key=lambda x: str(x[:2]))
    for x, y in zip(sorted(found, key=lambda x: (str(x[:2]), str(x[3])[:8])), sorted(expected, key=lambda x: (str(x[:2]), str(x[3])[:8])), strict=True):
        assert x[:2] == y[:2]
        if y[2] is None:
            assert x[2:] == (None, None, None)
        else:
            assert x[2:4] == pytest.approx(y[2:], rel=1e-4) and x[4] == pytest.approx(y[2] - y[3], abs=1e-3)


def test_scores_without_labels_or_documents(odd_docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert crossentropy.scored(odd_docs, crossentropy.good_ids(none)).count() == odd_docs.count()
    assert crossentropy.scored(no_docs, crossentropy.good_ids(none)).count() == 0
