"""Collocations of words from FM-indexes (operator 12).

Texts are lower-cased in A-Z, cut into pieces at punctuation and line ends, and these into
words. The words of about ``SHARD_WORDS`` in a task are a shard: a sequence of numbers in
which a separator of its own ends each piece, so no phrase leaves its piece. Its suffixes,
and those of the sequence read backwards, are sorted by prefix doubling, and the two
Burrows-Wheeler transforms go to the shared folder as the shard's bidirectional FM-index.

A phrase is an interval in either order. One step extends all intervals of a shard at
once: the transform inside an interval lists the words that come next on that side, with
their counts; the last-to-first mapping gives the new interval in that order, and the
counts of smaller words shift it in the other. Steps go right, left, right and left, from
words to phrases of five.

The counts of all shards are added up step by step: words and pairs first, in one pass and
by nothing but their hash, as most pairs are rare and dropped, then each longer phrase. The pairs that
stay are not counted again: one shard that holds a pair tells its words. Only phrases with ``LEAST`` occurrences in their language are extended: a rarer one
is part of no longer one that counts. Which these are is told to the shards as a bit table
of fixed size, over hashes; a bit that a rarer phrase happens to share costs work but no
exactness, as what it extends to is counted again. A longer phrase is counted only if its
other part, the phrase without its far end, is extended too: that part's interval holds
its own. Shards start from their words in every step, so nothing but counts is shuffled.

Words are known by 64-bit hashes of language and word, and longer phrases by hashes of
these; two frequent words of one hash are noticed and raise an error.

Nothing is cut off: a text above ``PART`` characters is cut at a separator; where there is
none it is cut between words, and a bridge of the words on both sides is added, and what
it holds twice is subtracted in shards of sign -1. A word is held whole.

Null texts have no words, and a null language is ``und``, together with a language of that
name. Repeated rows count each. Ties in score are ordered by occurrences, then by phrase.
No doc_id is read, and columns besides text and language are ignored. Phrases without
enough occurrences, and an empty table, give no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import file_system, landed, scratch, slices, small, small_batches
from newsloom.llm.masks import has, mask_of
from newsloom.llm.minhash import mix
from newsloom.llm.pieces import blocks, distinct, spread

#: Words of the longest phrase, and occurrences a phrase needs.
DEPTH, LEAST = 5, 100
TOP = 2000
SHARD_WORDS = 1 << 19
#: Characters of text worked on at once, and bytes of a batch of texts.
PART, BATCH_BYTES = 1 << 18, 4 << 20
#: What ends a piece, and what lies between words.
SEPARATORS, BLANKS = ".,;:!?\n\v\f\r", " \t"
WORD = re.compile(r"[^\x20\x09.,;:!?\x0A-\x0D]+")
NEXT = re.compile(r"[\x20\x09]*([^\x20\x09.,;:!?\x0A-\x0D]+)")
SIDES = ("right", "left")
#: Bits of the name of a bit that tells of a frequent phrase: tables of 2 MB.
BITS = 24
#: Low bits of a shard's name that tell it among those that hold a phrase.
NAMED = 24
#: Tasks that read the shards, shards that a task reads for their words, and words it remembers.
TASKS, TOGETHER, SEEN = 10_000, 16, 1 << 20


def parts(text: str, longest: int) -> Iterator[tuple[str, int]]:
    """Parts of a text with signs; the phrases of the text are those of its parts, added up by sign."""
    a = 0
    while len(text) - a > longest:
        b = a + longest
        cut = max(text.rfind(c, a + 1, b) for c in SEPARATORS)
        if cut < 0:
            # Between two words of one piece.
            cut = max(text.rfind(c, a + 1, b) for c in BLANKS)
            if cut < 0:
                after = [at for c in SEPARATORS + BLANKS if (at := text.find(c, b)) >= 0]
                if not after:
                    break
                cut = min(after)
            if text[cut] in BLANKS:
                before, behind, at = WORD.findall(text[a:cut])[1 - DEPTH:], [], cut
                while len(behind) < DEPTH - 1 and (word := NEXT.match(text, at)):
                    behind.append(word[1])
                    at = word.end()
                yield " ".join(before + behind), 1
                yield " ".join(before), -1
                yield " ".join(behind), -1
        yield text[a:cut], 1
        a = cut
    yield text[a:], 1


def cut_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts, and the words: first byte, end, index of the text, number of the piece."""
    raw = [t.encode() for t in texts]
    # A line end after each text ends its last piece.
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    ends = np.cumsum([len(r) + 1 for r in raw])
    kind = np.zeros(256, np.uint8)
    kind[list(BLANKS.encode())], kind[list(SEPARATORS.encode())] = 1, 2
    kinds = kind[data]
    inside = np.concatenate([[False], kinds == 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return data, start, end, np.searchsorted(ends, start, side="right"), np.searchsorted(np.flatnonzero(kinds == 2), start)


def suffixes(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes; 0 is a separator, each different from all others and ordered by place, and the last symbol."""
    order = np.argsort(text, kind="stable").astype(np.int32)
    sorted_text = text[order]
    head = np.ones(len(text), bool)
    head[1:] = (sorted_text[1:] != sorted_text[:-1]) | (sorted_text[1:] == 0)
    slots = np.arange(len(text), dtype=np.int32)
    rank = np.empty(len(text), np.int32)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    slots = slots[~(head & np.append(head[1:], True))]
    done = 1
    while len(slots):
        some = order[slots]
        keys = rank[some].astype(np.int64) << 32 | rank[some + done]
        by = np.argsort(keys, kind="stable")
        some, keys = some[by], keys[by]
        order[slots] = some
        head = np.ones(len(slots), bool)
        head[1:] = keys[1:] != keys[:-1]
        rank[some] = np.maximum.accumulate(np.where(head, slots, 0))
        slots = slots[~(head & np.append(head[1:], True))]
        done *= 2
    return order


def transform(text: np.ndarray) -> np.ndarray:
    """The symbol before each suffix, in the order of the suffixes."""
    return text[suffixes(text) - 1]


class Shard:
    """Collects words and writes their index."""

    def __init__(self, folder: str, sign: int):
        self.folder, self.sign = folder, sign
        self.names: dict[tuple[str, bytes], int] = {}
        self.runs: list[np.ndarray] = []
        self.words = 0

    def add(self, texts: list[str], langs: list[str]) -> None:
        data, start, end, owner, piece = cut_words(texts)
        if not len(start):
            return
        first, group = distinct(data, start, end)
        number = {lang: k for k, lang in enumerate(dict.fromkeys(langs))}
        listed = list(number)
        pairs, inverse = np.unique(group * len(listed) + np.array([number[x] for x in langs])[owner], return_inverse=True)
        words = [data[start[i]:end[i]].tobytes() for i in first]
        ids = [self.names.setdefault((listed[p % len(listed)], words[p // len(listed)]), len(self.names) + 1) for p in pairs.tolist()]
        new = np.flatnonzero(piece[1:] != piece[:-1]) + 1
        self.runs += [np.insert(np.array(ids, np.int32)[inverse], new, 0), np.zeros(1, np.int32)]
        self.words += len(start)

    def close(self) -> pa.RecordBatch:
        """Writes the index and returns the number of words of each language."""
        text = np.concatenate(self.runs)
        # Frequent words get small numbers, which leaves little in the upper bytes.
        size = np.bincount(text, minlength=len(self.names) + 1)[1:]
        by_size = np.argsort(-size, kind="stable")
        renamed = np.zeros(len(size) + 1, np.int32)
        renamed[by_size + 1] = np.arange(1, len(size) + 1)
        text, size = renamed[text], size[by_size]
        names = list(self.names)
        names = [names[k] for k in by_size.tolist()]
        shard = uuid.uuid4().int >> 65
        files, place = file_system(self.folder)
        files.create_dir(place)
        # The last symbol must be a separator in either direction.
        for side, symbols in zip(SIDES, (np.append(text[:-1][::-1], np.int32(0)), text), strict=True):
            with files.open_output_stream(f"{place}/{shard}-{side}.zst", compression="zstd") as out:
                out.write(planes(transform(symbols)))
        langs, words = [lang for lang, _ in names], [w.decode() for _, w in names]
        table = pa.table({"id": pa.array(word_ids(langs, words)), "lang": langs, "word": words})
        with files.open_output_stream(f"{place}/{shard}-words.zst", compression="zstd") as out, pa.ipc.new_stream(out, table.schema) as stream:
            stream.write_table(table)
        totals = table.select(["lang"]).append_column("n", pa.array(size)).group_by("lang").aggregate([("n", "sum")])
        n = len(totals)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, shard)), pa.array(np.full(n, self.sign, np.int32)), totals.column("lang").combine_chunks(), totals.column("n_sum").combine_chunks()],
            ["shard", "sign", "lang", "n"])


def planes(symbols: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on, which compress better."""
    return np.ascontiguousarray(symbols.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def of_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def word_ids(langs: list[str], words: list[str]) -> np.ndarray:
    """A number for each word of a language: even, and not 0."""
    hashes = [xxhash.xxh3_64_intdigest(f"{lang}\0{word}".encode()) for lang, word in zip(langs, words, strict=True)]
    return np.maximum(np.array(hashes, np.uint64) & ~np.uint64(1), np.uint64(2)).view(np.int64)


def joined_ids(p: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The number of a phrase from those of its shorter part and the word: odd."""
    with np.errstate(over="ignore"):
        return (mix(p.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64)) | np.uint64(1)).view(np.int64)


def indexed(docs: DataFrame, folder: str, lang: str, text: str, shard_words: int, part: int) -> DataFrame:
    """(shard, sign, lang, n): the words of every shard by language; the index of each shard is in ``folder``."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text is not null")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {sign: Shard(folder, sign) for sign in (1, -1)}
        for batch in slices(batches):
            made = [(x, one, sign) for x, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True) for one, sign in parts(t, part)]
            for sign in shards:
                some = [(x, t) for x, t, s in made if s == sign]
                for first, last in blocks([t for _, t in some], part):
                    shards[sign].add([t for _, t in some[first:last]], [x for x, _ in some[first:last]])
                    if shards[sign].words >= shard_words:
                        yield shards[sign].close()
                        shards[sign] = Shard(folder, sign)
        for shard in shards.values():
            if shard.words:
                yield shard.close()

    return landed(rows.mapInArrow(of_batches, "shard long, sign int, lang string, n long"), "shards")


class Index:
    """The FM-index of a shard, read as it is needed."""

    def __init__(self, folder: str, shard: int):
        self.files, place = file_system(folder)
        self.place = f"{place}/{shard}"
        with self.files.open_input_stream(f"{self.place}-words.zst", compression="zstd") as file:
            self.words = pa.ipc.open_stream(file).read_all()
        self.ids = np.append(np.zeros(1, np.int64), self.words.column("id").to_numpy())

    def near(self, side: str) -> np.ndarray:
        """The symbol next to each suffix on one side."""
        with self.files.open_input_stream(f"{self.place}-{side}.zst", compression="zstd") as file:
            return of_planes(file.read())

    def phrases(self, depth: int, masks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For words and each longer size up to ``depth``: the shorter part, the word at its end and the count of each phrase."""
        # Position k of a phrase's arrays: its interval in the order of the left and of the right side, and its number.
        near = self.near(SIDES[0])
        size = np.bincount(near, minlength=len(self.ids)).astype(np.int32)
        low = np.cumsum(size, dtype=np.int32) - size
        may = np.append(False, np.ones(len(self.ids) - 1, bool) if not masks else has(masks[0], self.ids[1:]))
        yield np.zeros(len(self.ids) - 1, np.int64), self.ids[1:], size[1:].astype(np.int64)
        ids, sizes, lows = self.ids[may], size[may], {side: low[may] for side in SIDES}
        for k in range(2, depth + 1):
            side, other = SIDES[k % 2], SIDES[1 - k % 2]
            parent, word, counts, new_low, new_other = extended(near if k == 2 else self.near(side), lows[side], lows[other], sizes, may)
            p, w = ids[parent], self.ids[word]
            yield p, w, counts.astype(np.int64)
            if k < depth:
                ids = joined_ids(p, w)
                kept = has(masks[k - 1], ids)
                ids, sizes, lows = ids[kept], counts[kept], {side: new_low[kept], other: new_other[kept]}


def extended(near: np.ndarray, low: np.ndarray, other: np.ndarray, sizes: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, ...]:
    """All extensions of the intervals by a symbol of ``may``: interval, symbol, count, and the new interval's begin in both orders."""
    by = np.argsort(low)
    low, begin_other, sizes = low[by], other[by], sizes[by]
    # Where each symbol of the transform stands among the first symbols of the suffixes.
    first_of = np.empty(len(near), np.int32)
    first_of[np.argsort(near, kind="stable")] = np.arange(len(near), dtype=np.int32)
    at = spread(low.astype(np.int64), sizes.astype(np.int64)).astype(np.int32)
    owner = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
    keys = owner.astype(np.int64) * len(may) + near[at]
    order = np.argsort(keys, kind="stable").astype(np.int32)
    keys = keys[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(order) else order
    del keys
    counts = np.diff(np.append(head, len(order))).astype(np.int32)
    first = order[head]
    parent, symbol = owner[first], near[at[first]]
    new_low = first_of[at[first]]
    # Smaller symbols of the same phrase come before it in the other order.
    begins = np.cumsum(sizes, dtype=np.int64) - sizes
    new_other = (begin_other[parent] + head - begins[parent]).astype(np.int32)
    holder = np.searchsorted(low, new_low, side="right") - 1
    kept = may[symbol] & (holder >= 0)
    kept &= new_low + counts <= (low + sizes)[holder]
    return by[parent[kept]], symbol[kept], counts[kept], new_low[kept], new_other[kept]


def in_parts(*columns: np.ndarray, names: list[str], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(columns[0]), most):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:a + most]) for c in columns], names)


def words_and_pairs(folder: str, shards: DataFrame, least: int) -> DataFrame:
    """(id, f, teller) of the words and pairs that occur ``least`` times or more; the numbers of words are even.

    The low bits of ``teller`` are those of a shard that holds it, and differ from phrase to phrase.
    """
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for p, w, n in Index(folder, row["shard"]).phrases(2, []):
                    ids = joined_ids(p, w) if p.any() else w
                    yield from in_parts(ids, row["sign"] * n, tellers(ids, row["shard"]), names=["id", "n", "teller"])

    rows = shards.mapInArrow(of_batches, "id long, n long, teller int")
    often = rows.groupBy("id").agg(F.sum("n").alias("f"), F.min("teller").alias("teller"))
    return landed(often.where(F.col("f") >= least), "phrases")


def tellers(ids: np.ndarray, shard: int) -> np.ndarray:
    """A lot that the shard draws for each phrase, above the low bits of its name: the smallest of all shards tells the phrase."""
    with np.errstate(over="ignore"):
        lots = mix(ids.view(np.uint64) ^ np.uint64(shard)) >> np.uint64(64 - 31 + NAMED)
    return (lots << np.uint64(NAMED) | np.uint64(shard % (1 << NAMED))).astype(np.int32)


def told_pairs(folder: str, shards: DataFrame, pairs: DataFrame, mask: np.ndarray) -> DataFrame:
    """(id, p, w, f) of ``pairs`` (id, f, teller), each told by the shard it names, as their counts are known.

    A shard is given no more pairs than it holds.
    """
    name = lambda c: F.col(c).bitwiseAND(F.lit((1 << NAMED) - 1)).cast("int").alias("name")
    lists = pairs.groupBy(name("teller")).agg(F.collect_list("id").alias("ids"), F.collect_list("f").alias("fs"))
    given = shards.select("shard", name("shard")).join(lists, "name").select("shard", "ids", "fs")
    given = landed(given, "given")
    given = landed(given.repartition(max(1, min(given.count(), TASKS))), "given")
    shared = shards.sparkSession.sparkContext.broadcast([mask])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, shard in enumerate(batch.column("shard").to_pylist()):
                ids, fs = (batch.column(c)[k].values.to_numpy() for c in ("ids", "fs"))
                by = np.argsort(ids)
                ids, fs = ids[by], fs[by]
                *_, (p, w, _) = Index(folder, shard).phrases(2, shared.value)
                found = joined_ids(p, w)
                at = np.minimum(np.searchsorted(ids, found), len(ids) - 1)
                hit = np.flatnonzero(ids[at] == found)
                if len(np.unique(at[hit])) < len(hit):
                    raise ValueError("two pairs have one hash")
                yield from in_parts(found[hit], p[hit], w[hit], fs[at[hit]], names=["id", "p", "w", "f"])

    # Two shards may share the low bits of their names.
    told = landed(given.mapInArrow(of_batches, "id long, p long, w long, f long").distinct(), "phrases")
    shared.unpersist()
    return told


def counted(folder: str, shards: DataFrame, depth: int, masks: list[np.ndarray], least: int) -> DataFrame:
    """(id, p, w, f): the phrases of ``depth`` words that occur ``least`` times or more, with their shorter part and the word at the end.

    Where ``masks`` has one for this depth too, only what it lets pass is added up.
    """
    shared = shards.sparkSession.sparkContext.broadcast(masks)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                *_, (p, w, n) = Index(folder, row["shard"]).phrases(depth, shared.value)
                if len(shared.value) >= depth:
                    kept = has(shared.value[depth - 1], joined_ids(p, w))
                    p, w, n = p[kept], w[kept], n[kept]
                yield from in_parts(p, w, row["sign"] * n, names=["p", "w", "n"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = joined_ids(batch.column("p").to_numpy(), batch.column("w").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(ids), *[batch.column(c) for c in ("p", "w", "f")]], ["id", "p", "w", "f"])

    rows = shards.mapInArrow(of_batches, "p long, w long, n long")
    often = rows.groupBy("p", "w").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    found = landed(often.mapInArrow(named, "id long, p long, w long, f long"), "phrases")
    shared.unpersist()
    return found


def words_of(folder: str, shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, lang, word) of the words in column ``id`` of ``wanted``."""
    shared = shards.sparkSession.sparkContext.broadcast(mask_of(wanted, BITS))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                table = Index(folder, shard).words
                ids = table.column("id").to_numpy()
                new = has(shared.value, ids) & ~np.isin(ids, seen)
                seen = np.concatenate([seen if len(seen) < SEEN else seen[:0], ids[new]])
                yield from table.filter(pa.array(new)).to_batches(max_chunksize=1 << 16)

    # Shards share most words: a task tells each once, and only different ones are joined.
    shards = shards.repartition(-(-shards.count() // TOGETHER) or 1)
    found = landed(shards.mapInArrow(of_batches, "id long, lang string, word string").distinct(), "words")
    shared.unpersist()
    found = landed(found.join(wanted.select("id"), "id", "left_semi"), "words")
    if not found.groupBy("id").count().where("count > 1").isEmpty():
        raise ValueError("two frequent words have one hash")
    return found


def phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, depth: int = DEPTH,
            shard_words: int = SHARD_WORDS, part: int = PART) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ws, f) of all words and phrases with ``least`` occurrences, (lang, n) of all words, and (id, lang, word) of the words of the phrases.

    ``ws`` has the numbers of the words.
    """
    folder = scratch(docs.sparkSession, "fm-index")
    small_batches(docs.sparkSession, BATCH_BYTES)
    made = indexed(docs, folder, lang, text, shard_words, part)
    totals = landed(made.groupBy("lang").agg(F.sum(F.col("sign") * F.col("n")).alias("n")), "totals")
    shards = made.select("shard", "sign").distinct()
    shards = landed(shards.repartition(max(1, min(shards.count(), TASKS))), "shards")
    first = words_and_pairs(folder, shards, least)
    level = landed(first.where("id % 2 = 0").select("id", F.array("id").alias("ws"), "f"), "level")
    every, masks = level, [mask_of(level, BITS)]
    for k in range(2, depth + 1):
        if k == 2:
            pairs = first.where("id % 2 != 0")
            found = told_pairs(folder, shards, pairs, masks[0])
            masks.append(mask_of(pairs, BITS))
        else:
            found = counted(folder, shards, k, masks, least)
        order = ("ws", F.array("w")) if SIDES[k % 2] == "right" else (F.array("w"), "ws")
        level = landed(found.join(level.select(F.col("id").alias("p"), "ws"), "p").select("id", F.concat(*order).alias("ws"), "f"), "level")
        every = every.unionByName(level)
        if k > 2:
            masks.append(mask_of(level, BITS))
    used = every.where(F.size("ws") > 1).select(F.explode("ws").alias("id")).distinct()
    return every.select("ws", "f"), totals, words_of(folder, shards, landed(used, "used"))


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), in exact integers of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide(a) * wide(n)).cast("decimal(34,0)"), wide(left) * wide(right)).cast("long")


def mined(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best ``top`` phrases of each language."""
    every, totals, words = phrases(docs, **options)
    size = F.size("ws")
    longer = every.where(size > 2).select(F.explode(F.array(F.slice("ws", F.lit(1), size - 1), F.slice("ws", F.lit(2), size - 1))).alias("ws"), F.col("f").alias("in_longer"))
    longer = longer.groupBy("ws").agg(F.max("in_longer").alias("in_longer"))
    rows = every.where(size > 1).join(longer, "ws", "left").where("in_longer is null or in_longer < f").select("ws", F.col("f").alias("a"))
    rows = landed(rows, "candidates")
    texts = rows.select("ws", F.posexplode("ws").alias("pos", "id")).join(small(words, F.octet_length("lang") + F.octet_length("word") + 16), "id")
    texts = texts.groupBy("ws").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
    texts = texts.select("ws", "lang", F.array_join(F.col("words.word"), " ").alias("phrase"))
    cuts = rows.select("ws", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ws", F.lit(1), F.col("k")).alias("head"), F.slice("ws", F.col("k") + 1, size - F.col("k")).alias("tail"))
    cuts = cuts.join(every.select(F.col("ws").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(every.select(F.col("ws").alias("tail"), F.col("f").alias("r")), "tail")
    cuts = cuts.join(texts, "ws").join(small(totals, F.octet_length("lang") + 16), "lang")
    cuts = cuts.withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
