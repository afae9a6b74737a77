"""Language-model scores by cross-entropy difference (operator 6).

Two n-gram models are counted over the same vocabulary with the same order and smoothing:
the target model over the documents that ``labels`` calls good, the background model over
all documents. Tokens are the ids of the byte-level BPE vocabulary at ``path``, or UTF-8
bytes without one. The model of order three is interpolated with those of order two and
one and a uniform share. A document's loss under a model is its mean bits per token, its
score the loss under the target model less that under the background model: the lower,
the more it is like the target.

Counts cover all tokens of all documents, and there are as many different n-grams as the
corpus has: counts and losses are tables, and nothing but two totals and the hot n-grams
passes through the driver. The ``HOT`` most frequent n-grams at most, chosen by bins of
their counts, are written as one table of 16 bytes an n-gram, which every worker of a machine
maps from the same file. A document's other n-grams,
each with its number in it, are joined to the table of losses; none of them is frequent,
so the join has no large key. Its sums from both come together by a number of the row.

A worker holds ``BATCH_BYTES`` of texts or ids, ``COUNTED`` n-grams that wait to be
counted and some arrays of ``CHUNK`` tokens, whatever the length of a text.

Null and empty texts have no tokens and null losses. A label may be repeated; a document
is target if any of its labels is 1. Repeated rows are counted each and score alike.
Without labels the target model is its smoothing and every score still exists. An empty
table gives no rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import file_system, landed, scratch, slices, small, small_batches
from newsloom.llm.pieces import encode, merges

#: Weight of the lower order in each interpolation, in tokens.
BACK = 8.0
#: Bits of a token in an n-gram; token 0 is the start of a text.
WIDTH = 20
MASK = (1 << WIDTH) - 1
#: N-grams in the mapped table; 16 bytes each.
HOT = 1 << 20
#: Tokens that are scored at once.
CHUNK = 1 << 16
#: N-grams that wait in a worker to be counted at once.
COUNTED = 1 << 20
BATCH_BYTES = 4 << 20
MODELS = ("target", "background")
#: The bin of a count; a quarter of a power of two wide.
BIN = "cast(floor(4 * log2(background)) as int)"


def vocabulary(path: str | None) -> int:
    """The number of different tokens."""
    return 256 if path is None else 1 + max([*merges(path).vocab.values(), *merges(path).special.values()])


def tokens(docs: DataFrame, good: DataFrame, path: str | None, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, good and the token ids of every row; ``good`` has the doc_id of the target documents, each once."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = small(good.select(F.col("doc_id").alias("good_id")), 16)
    rows = rows.join(marks, F.col("doc_id") == F.col("good_id"), "left").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("good_id").isNotNull().alias("good"), "text")
    kind = docs.schema[doc_id].dataType.simpleString()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            if path is None:
                raw = [t.encode() for t in texts]
                ids, counts = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
            else:
                ids, counts = encode(texts, merges(path))
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                **{k: batch.column(k) for k in ("row", "doc_id", "good")}, "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))})

    return rows.mapInArrow(of_batches, f"row long, doc_id {kind}, good boolean, ids array<int>")


def grams(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-gram that ends at each token and the token's row, in chunks; long texts have several."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    flat = np.concatenate([np.zeros(2, np.int32), lists.flatten().to_numpy() + 1])
    for a in range(0, len(flat) - 2, CHUNK):
        b = min(a + CHUNK, len(flat) - 2)
        at = np.arange(a, b)
        owner = np.searchsorted(ends, at, side="right")
        place = at - (ends - size)[owner]
        before, last = flat[a + 1:b + 1] * (place > 0), flat[a:b] * (place > 1)
        yield last.astype(np.int64) << 2 * WIDTH | before.astype(np.int64) << WIDTH | flat[a + 2:b + 2], owner


def ngram_counts(texts: DataFrame) -> DataFrame:
    """(gram, target, background) over all tokens of all texts."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def summed() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return pa.RecordBatch.from_pydict({"gram": keys >> 1, "good": pa.array((keys & 1).astype(bool)), "n": n.astype(np.int64)})

        for batch in slices(batches):
            good = batch.column("good").to_numpy(zero_copy_only=False).astype(np.int64)
            for keys, owner in grams(batch.column("ids")):
                waiting.append(keys << 1 | good[owner])
                held += len(keys)
                if held > COUNTED:
                    yield summed()
                    held = 0
        if waiting:
            yield summed()

    sums = texts.select("good", "ids").mapInArrow(counted, "gram long, good boolean, n long").groupBy("gram")
    return sums.agg(F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("target"), F.sum("n").alias("background"))


def losses(counts: DataFrame, size: int) -> DataFrame:
    """gram, background, and the bits of its last token under both models, of each n-gram of ``counts``."""
    def sums(table: DataFrame, key: Column, name: str, prefix: str) -> DataFrame:
        return table.groupBy(key.alias(name)).agg(*[F.sum(m).alias(f"{prefix}_{m}") for m in MODELS])

    gram = F.col("gram")
    pairs = landed(sums(counts, gram.bitwiseAND((1 << 2 * WIDTH) - 1), "pair", "pair"), "pairs")
    named = pairs.withColumnsRenamed({f"pair_{m}": m for m in MODELS})
    ones = sums(named, F.col("pair").bitwiseAND(MASK), "one", "one")
    first = sums(named, F.shiftright("pair", WIDTH), "first", "first")
    total = named.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MODELS]).first()
    pairs = pairs.join(small(ones, 24), F.col("one") == F.col("pair").bitwiseAND(MASK)).join(small(first, 24), F.col("first") == F.shiftright("pair", WIDTH))
    p = {m: (F.col(f"one_{m}") + BACK / size) / (total[m] + BACK) for m in MODELS}
    pairs = pairs.select("pair", *[((F.col(f"pair_{m}") + BACK * p[m]) / (F.col(f"first_{m}") + BACK)).alias(f"p_{m}") for m in MODELS])
    context = sums(counts, F.shiftright("gram", WIDTH), "context", "context")
    rows = counts.join(pairs, F.col("pair") == gram.bitwiseAND((1 << 2 * WIDTH) - 1)).join(context, F.col("context") == F.shiftright("gram", WIDTH))
    return rows.select("gram", "background", *[
        (-F.log2((F.col(m) + BACK * F.col(f"p_{m}")) / (F.col(f"context_{m}") + BACK))).cast("float").alias(f"{m}_bits") for m in MODELS])


def hot_bin(table: DataFrame, most: int) -> int:
    """The lowest bin of counts so that it and those above have ``most`` n-grams at most."""
    bins = sorted(((r["bin"], r["count"]) for r in table.groupBy(F.expr(BIN).alias("bin")).count().collect()), reverse=True)
    lowest, held = bins[0][0] + 1 if bins else 0, 0
    for number, many in bins:
        held += many
        if held > most:
            break
        lowest = number
    return lowest


def write_hot(table: DataFrame) -> str:
    """Writes the losses of ``table`` by n-gram as one file, hands it to the executors and returns its name."""
    spark = table.sparkSession
    rows = table.toArrow().sort_by("gram")
    columns = [rows.column("gram").to_numpy(), *[rows.column(f"{m}_bits").to_numpy() for m in MODELS]]
    name = f"losses-{uuid.uuid4().hex}"
    uri = f"{scratch(spark, 'hot')}/{name}"
    files, place = file_system(uri)
    files.create_dir(place.rsplit("/", 1)[0])
    with files.open_output_stream(place) as out:
        for column in columns:
            out.write(column.tobytes())
    spark.sparkContext.addFile(uri)
    return name


@lru_cache(maxsize=1)
def hot_losses(name: str) -> dict[str, np.ndarray]:
    """The mapped columns of ``write_hot``: n-grams in order and their bits under each model."""
    path = SparkFiles.get(name)
    n = os.path.getsize(path) // 16
    data = np.memmap(path, np.uint8, "r") if n else np.zeros(0, np.uint8)
    return {"gram": data[:8 * n].view(np.int64)} | {m: data[(8 + 4 * k) * n:(12 + 4 * k) * n].view(np.float32) for k, m in enumerate(MODELS)}


def scored(docs: DataFrame, good: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every row; the vocabulary is at ``path`` on every worker."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    texts = landed(tokens(docs, good, path, doc_id, text), "tokens", "zstd")
    table = landed(losses(landed(ngram_counts(texts), "ngrams"), vocabulary(path)), "losses")
    lowest = hot_bin(table, hot)
    name = write_hot(table.where(F.expr(BIN) >= lowest).drop("background"))
    seldom = table.where(F.expr(BIN) < lowest).select(F.col("gram").alias("g"), "target_bits", "background_bits")
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"row long, gram long, n long, own struct<doc_id: {kind}, n_tokens: long, target: double, background: double>"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = hot_losses(name)
        own_type = None
        for batch in slices(batches):
            row, lists = batch.column("row").to_numpy(), batch.column("ids")
            sums = {m: np.zeros(len(row)) for m in MODELS}
            own_type = own_type or pa.struct([("doc_id", batch.column("doc_id").type), ("n_tokens", pa.int64()), ("target", pa.float64()), ("background", pa.float64())])
            for keys, owner in grams(lists):
                some, group = np.unique(keys, return_inverse=True)
                at = np.searchsorted(held["gram"], some)
                at[at == len(held["gram"])] = 0
                known = held["gram"][at] == some if len(held["gram"]) else np.zeros(len(some), bool)
                for m in sums:
                    bits = np.zeros(len(some))
                    bits[known] = held[m][at[known]]
                    sums[m] += np.bincount(owner, weights=bits[group], minlength=len(row))
                rest = ~known[group]
                pair, n = np.unique(owner[rest] << 32 | group[rest], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row[pair >> 32]), pa.array(some[pair & 0xFFFFFFFF]), pa.array(n.astype(np.int64)), pa.nulls(len(pair), own_type)], ["row", "gram", "n", "own"])
            own = pa.StructArray.from_arrays([
                batch.column("doc_id"), lists.value_lengths().cast(pa.int64()), pa.array(sums["target"]), pa.array(sums["background"])], fields=list(own_type))
            # No n-gram is negative: a row's own line meets none in the join, and no other row's line.
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(-1 - row), pa.array(np.zeros(len(row), np.int64)), own], ["row", "gram", "n", "own"])

    lines = texts.select("row", "doc_id", "ids").mapInArrow(of_batches, schema).join(seldom, F.col("gram") == F.col("g"), "left")
    total = {m: F.sum(F.coalesce(F.col(f"own.{m}"), F.col("n") * F.col(f"{m}_bits").cast("double"))) for m in MODELS}
    sums = lines.groupBy("row").agg(F.max("own.doc_id").alias("doc_id"), F.max("own.n_tokens").alias("n_tokens"), *[v.alias(m) for m, v in total.items()])
    mean = {m: F.when(F.col("n_tokens") > 0, F.col(m) / F.col("n_tokens")) for m in total}
    return sums.select("doc_id", "n_tokens", mean["target"].alias("target_loss"), mean["background"].alias("background_loss"),
                       (mean["target"] - mean["background"]).alias("score"))


def good_ids(labels: DataFrame) -> DataFrame:
    """The doc_id of each document with a label of good quality."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
