"""Removal of repeated passages with suffix arrays (operator 1).

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else, in
another document or the same one. Strings are judged on the input; texts are UTF-8 bytes.

Every string has an owner: of its windows of ``GRAM`` bytes the one with the smallest
hash, the leftmost of equal ones. The owner depends on the string alone, so all
occurrences of a string agree on it, and neighbouring strings mostly share theirs. A run
is the strings of neighbouring starts with one owner. Only runs whose owner occurs twice
or more can hold repeated strings; their texts, each different text once with its number
of occurrences, are dealt by owner to shards of ``SHARD_BYTES``.

A shard sorts its suffixes by Larsson-Sadakane refinement: they are ordered by their first
eight bytes, and then only groups that are not yet single are ordered again by the rank of
the suffix behind the part already compared, which doubles it, until all are single. Common
prefixes follow
Kasai's rule, a suffix shares at least one byte less than the suffix before it in the
text, for many stretches of the text side by side. Suffixes with ``LENGTH`` bytes in
common are neighbours, and their occurrences add up. An owner whose texts exceed one shard
gets several, and each shard's strings are found in the others by binary search.

An owner with more than ``OWNER_TEXTS`` different texts is cut further: its strings are
grouped by their distance to the owner in steps of 64, 8 and 1, keyed by all bytes the
strings of a step share, and equal pieces are combined; with the last step a key is one
string and its occurrences are just added. So no task meets an unbounded group and none
is dropped.

Null and empty texts have no bytes, and texts below ``LENGTH`` bytes lose none. Of a
repeated row all strings repeat, so it loses all bytes if it is long enough. Documents
are told apart by doc_id and text; rows equal in both get equal results. In
``deduplicated`` a document keeps its columns and its remaining text; what is cut in the
middle of a character loses that character's other bytes too. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import landed, small
from newsloom.llm.pieces import span_hashes, spread

LENGTH, GRAM = 400, 64
#: Bytes of text a block of documents, or a part of a long one, has.
BLOCK_BYTES = 1 << 21
SHARD_BYTES = 1 << 19
OWNER_TEXTS = 2048
#: Runs of one owner that a task may get by its key.
HOT_RUNS = 1000
STEPS = (64, 8, 1)
RUN = "owner long, shift int, starts int, place int"
PIECE = "grp binary, mark binary, starts int, place int, text binary, n long"


def runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, owner's position and owner's hash of each run in a block of texts."""
    grams = len(data) - gram + 1
    if grams < length - gram + 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = np.arange(grams)
    hashes = span_hashes(data, at, at + gram)
    window = length - gram + 1
    # The position in the low bits makes the leftmost of equal hashes the smallest.
    low = np.uint64((1 << 24) - 1)
    least = hashes & ~low | at.astype(np.uint64)
    width = 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        least = np.minimum(least[:len(least) - (window - width)], least[window - width:])
    starts = np.arange(len(least))
    inside = starts + length <= ends[np.searchsorted(ends, starts, side="right")]
    starts, place = starts[inside], (least[inside] & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), place[first], hashes[place[first]]


def byte_blocks(texts: list[str], length: int) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Blocks of texts: (text, offset) of each part, all bytes, ends of the parts. Parts of a long text overlap by all but one start."""
    parts, raw, size = [], [], 0
    for i, text in enumerate(texts):
        data = text.encode()
        for offset in range(0, max(1, len(data) - length + 1), BLOCK_BYTES):
            part = data[offset:offset + BLOCK_BYTES + length - 1]
            if size and size + len(part) > BLOCK_BYTES:
                yield parts, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])
                parts, raw, size = [], [], 0
            parts.append((i, offset))
            raw.append(part)
            size += len(part)
    if parts:
        yield parts, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])


#: A difference below the k-th of these leaves 8 - k leading bytes equal.
_BYTES = np.array([1 << 8 * k for k in range(8)], np.uint64)


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and the eight bytes at each position.

    The order is whole, not up to some depth: only then may Kasai's rule carry a prefix over.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        eight = eight << np.uint64(8) | padded[k:k + n]
    # From the end, so that of suffixes equal but for the padding the shorter is first; it is single.
    order = n - 1 - np.argsort(eight[::-1], kind="stable")
    keys, short = eight[order], order > n - 8
    head = np.ones(n, bool)
    head[1:] = (keys[1:] != keys[:-1]) | short[1:] | short[:-1]
    begin = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = begin + 1, 0
    single = head & np.append(head[1:], True)
    slots = np.flatnonzero(~single)
    done = 8
    while len(slots):
        some = order[slots]
        keys = rank[some] << 32 | rank[np.minimum(some + done, n)]
        by = np.argsort(keys, kind="stable")
        some, keys = some[by], keys[by]
        order[slots] = some
        head = np.ones(len(slots), bool)
        head[1:] = keys[1:] != keys[:-1]
        begin = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        rank[some] = begin + 1
        slots = slots[~(head & np.append(head[1:], True))]
        done *= 2
    return order, eight


def common_prefixes(order: np.ndarray, eight: np.ndarray, most: int, stretch: int = 64) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix shares with the one before it in the order, by position in the text."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    lanes = -(-n // stretch)
    begin = np.arange(lanes) * stretch
    have = np.zeros(lanes, np.int64)
    for k in range(stretch):
        live = np.flatnonzero(begin + k < n)
        here = begin[live] + k
        there = before[here]
        now = np.maximum(have[live] - 1, 0)
        now[there < 0] = 0
        going = np.flatnonzero((there >= 0) & (now < most))
        while len(going):
            a, b = here[going] + now[going], there[going] + now[going]
            room = n - np.maximum(a, b)
            differ = eight[np.minimum(a, n - 1)] ^ eight[np.minimum(b, n - 1)]
            same = np.minimum(8 - np.searchsorted(_BYTES, differ, side="right"), np.maximum(room, 0))
            now[going] += same
            going = going[(same == 8) & (now[going] < most)]
        now = np.minimum(now, most)
        have[live], out[here] = now, now
    return out


class Shard:
    """Texts with their first ``starts`` strings, sorted: which strings are equal, and how often they occur."""

    def __init__(self, texts: list[bytes], starts: np.ndarray, n: np.ndarray, length: int):
        self.length = length
        data = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(size) - size
        order, self.eight = suffix_array(data)
        shared = common_prefixes(order, self.eight, length)
        at = spread(first, starts)
        self.row = np.repeat(np.arange(len(texts)), starts)
        class_at = np.empty(len(data), np.int64)
        class_at[order] = np.cumsum(shared[order] < length) - 1
        # Classes are numbered in sorted order; those without a start vanish.
        _, one, self.of_start = np.unique(class_at[at], return_index=True, return_inverse=True)
        self.first = at[one]
        self.total = np.bincount(self.of_start, weights=n[self.row], minlength=len(one)).astype(np.int64)

    def compare(self, a: np.ndarray, other: Shard, b: np.ndarray) -> np.ndarray:
        """Sign of string a against the other shard's string b."""
        out = np.zeros(len(a), np.int8)
        live = np.arange(len(a))
        for k in range(0, self.length, 8):
            x, y = self.eight[a[live] + k], other.eight[b[live] + k]
            if k + 8 > self.length:
                drop = np.uint64(8 * (k + 8 - self.length))
                x, y = x >> drop, y >> drop
            out[live[x < y]], out[live[x > y]] = -1, 1
            live = live[x == y]
            if not len(live):
                break
        return out

    def found_in(self, other: Shard) -> np.ndarray:
        """The number of occurrences in another shard of each class of this one, by binary search."""
        low, high = np.zeros(len(self.first), np.int64), np.full(len(self.first), len(other.first), np.int64)
        while (low < high).any():
            live = np.flatnonzero(low < high)
            middle = (low[live] + high[live]) // 2
            after = self.compare(self.first[live], other, other.first[middle]) > 0
            low[live[after]], high[live[~after]] = middle[after] + 1, middle[~after]
        out = np.zeros(len(self.first), np.int64)
        some = np.flatnonzero(low < len(other.first))
        equal = some[self.compare(self.first[some], other, other.first[low[some]]) == 0]
        out[equal] = other.total[low[equal]]
        return out


def repeated(texts: list[bytes], starts: np.ndarray, n: np.ndarray, length: int, shard_bytes: int) -> list[list[int]]:
    """For each text the ranges [a, b, a, b, ...] of its starts whose string occurs twice or more."""
    bounds, size = [0], 0
    for i, text in enumerate(texts):
        if size and size + len(text) > shard_bytes:
            bounds.append(i)
            size = 0
        size += len(text)
    bounds.append(len(texts))
    cuts = list(zip(bounds, bounds[1:], strict=False))
    shards = [Shard(texts[a:b], starts[a:b], n[a:b], length) for a, b in cuts]
    out: list[list[int]] = []
    for k, shard in enumerate(shards):
        total = shard.total + sum((shard.found_in(other) for m, other in enumerate(shards) if m != k), np.zeros(len(shard.first), np.int64))
        flags = total[shard.of_start] > 1
        at = 0
        for many in starts[cuts[k][0]:cuts[k][1]].tolist():
            edge = np.flatnonzero(np.diff(np.concatenate([[False], flags[at:at + many], [False]]).astype(np.int8)))
            out.append(edge.tolist())
            at += many
    return out


def by_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    words = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(words).alias("h"), words.alias("text"))


def all_runs(docs: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, h, and a row of RUN for every run of every document."""
    gram = min(GRAM, length)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for parts, data, ends in byte_blocks(texts, length):
                first, many, place, owner = runs(data, ends, length, gram)
                part = np.searchsorted(ends, first, side="right")
                begin = (ends - np.diff(np.concatenate([[0], ends])))[part]
                row = np.array([i for i, _ in parts], np.int64)[part]
                offset = np.array([o for _, o in parts], np.int64)[part]
                took = pa.array(row)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(took), "h": batch.column("h").take(took), "owner": owner.view(np.int64),
                    "shift": (first - begin + offset).astype(np.int32), "starts": many.astype(np.int32), "place": (place - first).astype(np.int32)})

    return by_key(docs, doc_id, text).where(F.octet_length("text") >= length).mapInArrow(of_batches, f"doc_id long, h long, {RUN}")


def run_texts(docs: DataFrame, found: DataFrame, length: int, doc_id: str, text: str) -> DataFrame:
    """The runs of ``found`` with their texts and the digests of these."""
    # Runs of equal rows come together once, combined before they are dealt; each is one occurrence for each row.
    lists = found.groupBy("doc_id", "h").agg(F.collect_set(F.struct("owner", "shift", "starts", "place")).alias("runs"))
    lists = lists.withColumnsRenamed({"doc_id": "d", "h": "dh"})
    rows = by_key(docs, doc_id, text).join(lists, (F.col("h") == F.col("dh")) & F.col("doc_id").eqNullSafe(F.col("d")))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.slice(at, 64)
                out: dict[str, list] = {k: [] for k in ("doc_id", "h", "owner", "digest", "shift", "starts", "place", "text")}
                for row in some.to_pylist():
                    data = row["text"].encode()
                    for run in row["runs"]:
                        owner, shift, starts, place = run.values()
                        piece = data[shift:shift + starts - 1 + length]
                        mark = hashlib.blake2b(piece + place.to_bytes(4, "little"), digest_size=16).digest()
                        for key, value in zip(out, (row["doc_id"], row["h"], owner, mark, shift, starts, place, piece), strict=True):
                            out[key].append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    return rows.select("doc_id", "h", "text", "runs").mapInArrow(of_batches, "doc_id long, h long, owner long, digest binary, shift int, starts int, place int, text binary")


def cut_finer(pieces: DataFrame, step: int, length: int) -> DataFrame:
    """Pieces cut by the distance of their strings to the owner, in steps, and grouped by the bytes all strings of a step share."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                out = []
                for row in batch.slice(at, 64).to_pylist():
                    # String k of the piece lies ``place - k`` before the owner.
                    k = 0
                    while k < row["starts"]:
                        level = (row["place"] - k) // step
                        end = min(row["starts"], row["place"] - level * step + 1)
                        begin = row["place"] - level * step
                        core, text = row["text"][begin:begin - step + 1 + length], row["text"][k:end - 1 + length]
                        grp = hashlib.blake2b(core + level.to_bytes(4, "little", signed=True) + row["grp"], digest_size=16).digest()
                        mark = hashlib.blake2b(text + (row["place"] - k).to_bytes(4, "little"), digest_size=16).digest()
                        out.append({"of_grp": row["grp"], "of_mark": row["mark"], "shift": k, "grp": grp, "mark": mark, "starts": end - k,
                                    "place": row["place"] - k, "text": text, "n": row["n"]})
                        k = end
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([(c, pa.binary()) for c in ("of_grp", "of_mark")] + [("shift", pa.int32())] + [(c, pa.binary()) for c in ("grp", "mark")]
                       + [("starts", pa.int32()), ("place", pa.int32()), ("text", pa.binary()), ("n", pa.int64())])
    return pieces.mapInArrow(of_batches, f"of_grp binary, of_mark binary, shift int, {PIECE}")


RANGES = "grp binary, mark binary, ranges array<int>"


def sharded(pieces: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """RANGES, the repeated starts of each piece; all pieces of a group are in one task, one after the other."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        group: list[dict] = []
        size = grown = 0

        def solved(rows: list[dict]) -> pa.RecordBatch:
            found = repeated([r["text"] for r in rows], np.array([r["starts"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64), length, shard_bytes)
            kept = [(r, x) for r, x in zip(rows, found, strict=True) if x]
            return pa.RecordBatch.from_arrays([
                pa.array([r["grp"] for r, _ in kept], pa.binary()), pa.array([r["mark"] for r, _ in kept], pa.binary()),
                pa.array([x for _, x in kept], pa.list_(pa.int32()))], ["grp", "mark", "ranges"])

        for batch in batches:
            for row in batch.to_pylist():
                if group and row["grp"] != group[0]["grp"]:
                    if waiting and size + grown > shard_bytes:
                        yield solved(waiting)
                        waiting, size = [], 0
                    waiting += group
                    size += grown
                    group, grown = [], 0
                group.append(row)
                grown += len(row["text"])
        if waiting and size + grown > shard_bytes:
            yield solved(waiting)
            waiting = []
        if waiting or group:
            yield solved(waiting + group)

    return pieces.repartition("grp").sortWithinPartitions("grp").mapInArrow(of_batches, RANGES)


def repeated_ranges(pieces: DataFrame, length: int, owner_texts: int, shard_bytes: int, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """RANGES of all pieces (PIECE), each different one of a group once.

    What a group too large for a task is cut into is again combined to different pieces: of
    a passage that very many documents share, few are left. Their ranges go back to the
    pieces they were cut from.
    """
    sizes = landed(pieces.groupBy("grp").agg(F.count("*").alias("texts"), F.sum("n").alias("total")).where("total > 1"), "sizes")
    many = landed(sizes.where(F.col("texts") > owner_texts).select("grp").coalesce(1), "large")
    # Groups that are too large are few, and none of their pieces is dealt by its group.
    large = small(many, 32)
    fits = pieces.join(large, "grp", "left_anti").join(sizes.where(F.col("texts") <= owner_texts).select("grp"), "grp")
    out = sharded(fits, length, shard_bytes)
    if many.isEmpty():
        return out
    finer = landed(cut_finer(pieces.join(large, "grp", "left_semi"), steps[0], length), "pieces", "zstd")
    one = finer.groupBy("grp", "mark").agg(*[F.first(c).alias(c) for c in ("starts", "place", "text")], F.sum("n").alias("n"))
    if len(steps) > 1:
        found = repeated_ranges(landed(one, "pieces", "zstd"), length, owner_texts, shard_bytes, steps[1:])
    else:
        # A group is one string now, and so is its piece.
        found = one.where("n > 1").select("grp", "mark", F.array(F.lit(0), F.lit(1)).alias("ranges"))
    found = small(landed(found, "ranges"), F.size("ranges") * 4 + 64)
    back = finer.select("of_grp", "of_mark", "shift", "grp", "mark").join(found, ["grp", "mark"])
    return out.unionByName(back.select(F.col("of_grp").alias("grp"), F.col("of_mark").alias("mark"), F.transform("ranges", lambda x: x + F.col("shift")).alias("ranges")))


def of_frequent_owners(every: DataFrame) -> DataFrame:
    """The runs whose owner occurs twice or more.

    Owners with more than ``HOT_RUNS`` runs, of which there are few, are told apart
    first, so that no task gets all runs of one.
    """
    often = landed(every.groupBy("owner").agg(F.count("*").alias("n")).where("n > 1"), "owners")
    hot = small(often.where(F.col("n") > HOT_RUNS).select("owner"), 16)
    rest = often.where(F.col("n") <= HOT_RUNS).select("owner")
    return every.join(hot, "owner", "left_semi").unionByName(every.join(hot, "owner", "left_anti").join(rest, "owner", "left_semi"))


def removals(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text",
             owner_texts: int = OWNER_TEXTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, h, spans): the ranges of starts to remove in each document that has any; h is the hash of its text."""
    every = landed(all_runs(docs, length, doc_id, text), "runs")
    found = of_frequent_owners(every)
    # zstd folds the overlaps of neighbouring run texts.
    texts = landed(run_texts(docs, found, length, doc_id, text), "run-texts", "zstd")
    texts = texts.withColumnRenamed("digest", "mark").withColumn("grp", F.encode(F.col("owner").cast("string"), "UTF-8"))
    pieces = texts.groupBy("grp", "mark").agg(F.first("starts").alias("starts"), F.first("place").alias("place"),
                                              F.first("text").alias("text"), F.count("*").alias("n"))
    ranges = repeated_ranges(landed(pieces, "pieces", "zstd"), length, owner_texts, shard_bytes)
    # A piece can be cut into many; their ranges lie within its starts. Landed after they are grouped, so that both sides
    # of the join are dealt for it alone: only then does Spark split the runs that share one text.
    joined = landed(ranges.groupBy("grp", "mark").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "ranges")
    at = texts.select("doc_id", "h", "grp", "mark", "shift").join(joined, ["grp", "mark"])
    return at.groupBy("doc_id", "h").agg(F.flatten(F.collect_set(F.transform("ranges", lambda x: x + F.col("shift")))).alias("spans"))


def removed_runs(spans: list[int] | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs, from ranges of starts."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip((spans or [])[::2], (spans or [])[1::2], strict=True)):
        end = b - 1 + length
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((a, end))
    return out


def kept_bytes(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for run in gone for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def with_removals(docs: DataFrame, length: int, doc_id: str, text: str, **bounds: int) -> DataFrame:
    """``row``, ``text`` and ``spans`` (null where nothing goes) of every document."""
    gone = removals(docs, length, doc_id, text, **bounds).withColumnsRenamed({"doc_id": "d", "h": "dh"})
    words = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("d0"), F.xxhash64(words).alias("h0"))
    return rows.join(gone, (F.col("h0") == F.col("dh")) & F.col("d0").eqNullSafe(F.col("d")), "left").select("row", "spans")


def spans_removed(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = with_removals(docs.select(doc_id, text), length, doc_id, text, **bounds)
    rows = rows.select(F.col(f"row.{doc_id}").cast("long").alias("doc_id"), F.coalesce(F.col(f"row.{text}"), F.lit("")).alias("text"), "spans")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for words, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = words.encode()
                gone = removed_runs(spans, length)
                out.append((len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept_bytes(data, gone)).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(of_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """All documents with their own columns and the text that remains."""
    rows = with_removals(docs, length, doc_id, text, **bounds)

    @F.pandas_udf("string")
    def remaining(words, spans):  # noqa: ANN001, ANN202
        return words.combine(spans, lambda t, s: t if t is None or s is None else kept_bytes(
            t.encode(), removed_runs(list(s), length)).decode(errors="ignore"))

    rest = F.when(F.col("spans").isNull(), F.col(f"row.{text}")).otherwise(remaining(F.col(f"row.{text}"), F.col("spans")))
    return rows.withColumn("rest", rest).select(F.col("row").withField(text, F.col("rest")).alias("row")).select("row.*")
