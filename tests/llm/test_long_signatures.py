"""Signatures of texts with many shingles."""

import numpy as np

from newsloom.llm import minhash


def test_signature_of_a_long_text_draws_in_chunks(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (3000, 0, 1, 40, 700)]
    whole, most, tile = minhash.signatures(sets), [], np.tile
    monkeypatch.setattr(minhash, "ITEMS", 64, raising=False)
    monkeypatch.setattr(np, "tile", lambda a, n: most.append(n[0]) or tile(a, n))
    assert (minhash.signatures(sets) == whole).all() and max(most) <= 64
