"""Packing by the tokens of a vocabulary."""

import random
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from newsloom.llm import packing
from newsloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_segments_hold_all_tokens(spark, tmp_path):
    rng = random.Random(4)
    texts = ["日本語の文書" * 900, "".join(rng.choice("abcdefgh0123456789+/") for _ in range(20_000)), "a few words", "", None, "word " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sizes = [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert min(sizes[:2]) > packing.MAX_LENGTH
    for found in (QUERIES["op7_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, "")):
        parts, batches = defaultdict(list), defaultdict(int)
        for r in found.collect():
            parts[r["doc_id"]].append((r["start"], r["n_tokens"]))
            batches[r["bucket"], r["batch"]] += r["bucket"]
        assert max(batches.values()) <= packing.BUDGET
        for doc_id, size in enumerate(sizes):
            assert sorted(parts[doc_id]) == [(a, min(2048, size - a)) for a in range(0, max(size, 1), 2048)]
