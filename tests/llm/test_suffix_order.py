"""The order of suffixes and the repeats of pieces that share more than 512 bytes."""

import random
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import suffix


def pieces_of_an_owner(seed):
    """Pieces of 400 to 736 bytes: some share 520-720 bytes and then differ, others differ just before byte 400."""
    rng = random.Random(seed)
    text = lambda n: bytes(rng.choice(b"abcd") for _ in range(n))
    base = text(736)
    out = []
    for _ in range(rng.randrange(2, 6)):
        same = rng.randrange(520, 721)
        out.append(base[:same] + text(736 - same))
    for _ in range(rng.randrange(1, 6)):
        at, same = rng.randrange(337), rng.randrange(380, 400)
        out.append((base[at:at + same] + text(1) + base[at + same + 1:at + same + rng.randrange(2, 301)] + text(736))[:rng.randrange(400, 737)])
    rng.shuffle(out)
    return list(dict.fromkeys(out))


def test_repeats_of_long_shared_passages():
    for seed in range(40):
        texts = pieces_of_an_owner(seed)
        seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
        expected = []
        for t in texts:
            flags = [False, *(seen[t[i:i + 400]] > 1 for i in range(len(t) - 399)), False]
            expected.append([i for i in range(len(flags) - 1) if flags[i] != flags[i + 1]])
        starts = np.array([len(t) - 399 for t in texts])
        assert suffix.repeated(texts, starts, np.ones(len(texts), np.int64), 400, 1 << 19) == expected, seed


@pytest.mark.parametrize("letters", [b"a", b"\0", b"\0a", b"ab"])
def test_suffixes_are_in_order(letters):
    rng = random.Random(2)
    for n in [1, 2, 7, 8, 9, 17, *(rng.randrange(1, 200) for _ in range(20))]:
        data = bytes(rng.choice(letters) for _ in range(n))
        order, _ = suffix.suffix_array(np.frombuffer(data, np.uint8))
        assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
