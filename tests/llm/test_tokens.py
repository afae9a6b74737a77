import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.llm import idfiles, lexicon, packing, transducer
from newsloom.llm.pieces import encode, merges

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    texts = ["", " ", "\t a", "Hello's world  \n x   ", "it's 's !'s 're'll x'd''ve  a\n\n b", "a<|endoftext|>b <|startoftext|><|endoftext|>",
             "a" * 3000, " " * 500, "ΣΑΣ İstanbul É é ǅ ﬁ", "x\x1cy\x85z 'S'T", "日本 語 x　 y", "'", "we've'", "don'T"]
    letters = "abcdefghijklmnopqrstuvwxyzABCDE 'éß日本\n\t0123456789.,!?-_=/  "
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(400)]
    points = lambda: rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x20000), rng.randrange(32, 127)])
    return texts + ["".join(chr(points()) for _ in range(150)) for _ in range(100)]


def ids_of(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoding_is_the_librarys(odd_texts):
    ids, counts = encode(odd_texts, merges(BYTES))
    expected = ids_of(BYTES, odd_texts)
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_transducer_counts_are_the_librarys(odd_texts):
    n_bytes, n_tokens = transducer.count_tokens(odd_texts, BYTES)
    assert n_tokens.tolist() == [len(e) for e in ids_of(BYTES, odd_texts)]
    assert n_bytes.tolist() == [len(t.encode()) for t in odd_texts]


def test_transducer_starts_anew(odd_texts, monkeypatch):
    monkeypatch.setattr(transducer, "MAX_STATES", 50)
    _, n_tokens = transducer.count_tokens(odd_texts * 2, BYTES)
    assert n_tokens.tolist() == [len(e) for e in ids_of(BYTES, odd_texts)] * 2


def test_token_counts(odd_docs, no_docs, texts_of):
    rows = texts_of(odd_docs)
    expected = sorted((str(d), len((t or "").encode()), len(e), len(e) > 1024) for (d, t), e in zip(rows, ids_of(BYTES, [t for _, t in rows]), strict=True))
    assert sorted((str(r[0]), *r[1:]) for r in transducer.token_counts(odd_docs, BYTES).collect()) == expected
    assert transducer.token_counts(no_docs, BYTES).count() == 0


def test_automaton_is_minimal_and_numbers_words():
    automaton = lexicon.Automaton()
    words = sorted(f"{a}{b}".encode() for a in ("in", "out", "un") for b in ("ing", "ed", "", "s"))
    for word in words:
        automaton.add(word)
    arrays = automaton.arrays()
    assert len(arrays["final"]) < sum(map(len, words)) / 2


def test_lexicon_round_trip(tmp_path):
    words = sorted({f"w{i}".encode() for i in range(500)} | {b"the", b"then", b"a"})
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.compiled(words, merges(WORDS)))
    found = lexicon.Lexicon(str(path))
    probe = [*words, b"th", b"thens", b"zz", b"w5000"]
    data = np.frombuffer(b"".join(probe), np.uint8)
    end = np.cumsum([len(w) for w in probe])
    numbers = found.numbers(data, end - [len(w) for w in probe], end)
    assert numbers.tolist() == [*range(len(words)), -1, -1, -1, -1]


def test_codec_is_the_librarys(odd_docs, no_docs, odd_texts, texts_of, spark):
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd_texts)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(more)
    rows = texts_of(docs)
    ids = ids_of(WORDS, [t for _, t in rows])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    library = Tokenizer.from_file(WORDS)
    expected = sorted((str(d), len(e), sha(" ".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))) for (d, _), e in zip(rows, ids, strict=True))
    assert sorted((str(r[0]), *r[1:]) for r in lexicon.digests(docs, WORDS).collect()) == expected
    assert lexicon.digests(no_docs, WORDS).count() == 0


def test_perfect_hash_has_no_gaps():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    found = idfiles.PerfectHash.build(np.unique(keys))
    assert sorted(found.slots(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))


def test_id_files(odd_docs, no_docs, texts_of, spark, monkeypatch):
    rows = texts_of(odd_docs)
    manifest = idfiles.write(odd_docs, BYTES, 2)
    found = sorted(idfiles.read(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    ends = np.cumsum([r["n_tokens"] for r in found]).tolist()
    assert [r["start"] for r in found] == [0, *ends[:-1]]
    expected = sorted((str(d), zlib.crc32(np.array([*e, 2], "<u4").tobytes())) for (d, _), e in zip(rows, ids_of(BYTES, [t for _, t in rows]), strict=True))
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in found) == expected
    wanted = spark.createDataFrame([(3,), (7,), (900,), (123456,), (None,)], "doc_id long")
    got = sorted((r["doc_id"], len(r["ids"])) for r in idfiles.lookup(spark, manifest, wanted).collect())
    assert got == sorted((r["doc_id"], r["n_tokens"]) for r in found if r["doc_id"] in (3, 7, 900))
    assert idfiles.read(idfiles.write(no_docs, BYTES, 2)).count() == 0


def test_boundaries_pad_least():
    from itertools import combinations

    rng = np.random.default_rng(2)
    lengths = np.unique(rng.integers(1, 60, 14))
    counts = rng.integers(1, 9, len(lengths))
    pad = lambda bounds: sum(int(c) * (min(b for b in bounds if b >= v) - int(v)) for v, c in zip(lengths, counts, strict=True))
    for k in (1, 2, 4, 30):
        best = min(pad((*some, lengths[-1])) for some in combinations(lengths[:-1].tolist(), min(k, len(lengths)) - 1))
        assert pad(packing.boundaries(lengths, counts, k)) == best
        assert len(packing.boundaries(lengths, counts, k)) <= k


def test_packing_holds_all_tokens(odd_docs, no_docs, texts_of):
    import re

    from pyspark.sql import functions as F

    found = packing.packed(odd_docs, longest=100, buckets=4, budget=400).collect()
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts_of(odd_docs))
    assert sum(r["n_tokens"] for r in found) == total
    assert all(r["n_tokens"] <= r["bucket"] <= 100 for r in found)
    places = {(r["bucket"], r["batch"], r["slot"]) for r in found}
    assert len(places) == len(found)
    for bucket in {r["bucket"] for r in found}:
        some = [r for r in found if r["bucket"] == bucket]
        room = max(1, 400 // max(bucket, 1))
        assert sorted(r["batch"] * room + r["slot"] for r in some) == list(range(len(some)))
    assert packing.packed(no_docs).count() == 0
    assert packing.packed(odd_docs, length=F.lit(5)).count() == odd_docs.count()


def test_frequent_words_stay_bounded(spark):
    counts = spark.createDataFrame([(f"w{i}", 1000 // (i + 1)) for i in range(500)], "word string, n long")
    found = lexicon.frequent(counts, 40)
    assert 20 < len(found) <= 40 and min(n for _, n in found) > max(1000 // (i + 1) for i in range(500) if f"w{i}" not in dict(found))
    assert lexicon.frequent(counts.where("false"), 40) == []
