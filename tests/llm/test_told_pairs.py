"""Frequent pairs are counted once and told by one shard each."""

import numpy as np

from newsloom.llm import collocations


def test_pairs_are_told_once(spark, monkeypatch):
    """Twelve shards hold the same pairs; each pair makes one row, whatever the number of shards."""
    docs = spark.createDataFrame([("red green blue red green. blue red. " * 10, "en")] * 12, "text string, lang string").repartition(1)
    depths, told = [], []
    counted, told_pairs = collocations.counted, collocations.told_pairs
    monkeypatch.setattr(collocations, "counted", lambda folder, shards, depth, *rest: depths.append(depth) or counted(folder, shards, depth, *rest))
    monkeypatch.setattr(collocations, "told_pairs", lambda *given: told.append(told_pairs(*given)) or told[-1])
    every, _, _ = collocations.phrases(docs, least=100, depth=3, shard_words=60)
    assert depths == [3]
    assert {r["f"] for r in told[0].collect()} == {240, 120} and told[0].count() == 3
    assert {len(r["ws"]): None for r in every.collect()}.keys() == {1, 2, 3}


def test_tellers_are_spread():
    ids = np.random.default_rng(2).integers(1, 1 << 62, size=4000)
    shards = np.random.default_rng(3).integers(1, 1 << 62, size=20).tolist()
    lots = np.stack([collocations.tellers(ids, shard) for shard in shards])
    assert (lots >= 0).all()
    assert ((lots & ((1 << collocations.NAMED) - 1)) == np.array([[shard % (1 << collocations.NAMED)] for shard in shards])).all()
    assert np.bincount(lots.argmin(axis=0), minlength=20).max() < 500
