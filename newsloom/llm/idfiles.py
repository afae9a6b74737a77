"""Token-id shards with a minimal perfect hash index (operator 9).

Documents are dealt by range of doc_id, encoded, and written as shards in ascending
order. A shard is a raw payload file, nothing but little-endian ids (16 bits if the
vocabulary allows, else 32), and an index file. The index maps each document key to its
place in the payload through a minimal perfect hash: every level hashes the remaining
keys into a bit array, a key alone on its bit stays there, the others go to the next
level, and the rank of a key's bit is its slot. A slot stores a fingerprint of the key
and its rows, so that access by key takes a constant number of reads and a key that was
never written is told by its fingerprint (but for one in 2 ** 32).

A task holds one shard at a time, of about ``SHARD_IDS`` ids. Files carry a name of their
own for each attempt; only those a finished task reports are in the manifest, so a lost
executor leaves unused files at most. Files are reached through the shared folder's own
file system.

Null texts are empty and hold the end id alone. Rows that share a doc_id lie side by
side, ordered by the hash of their text, and a key's slot covers those of its shard. Rows
without a doc_id come first and have a slot of their own. An empty table has no shards.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import file_system, landed, scratch, small
from newsloom.llm.pieces import encode, merges

#: Ids after which a shard is closed.
SHARD_IDS = 1 << 23
#: Bits of a level for each key that is left.
ROOM = 1.5
LEVELS = 60
MANIFEST = "shard string, first_id long, first_hash long, n_rows long, n_ids long, width int"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct keys to the numbers 0, 1, ... without gaps."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.begins = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        left = keys
        while len(left) and len(sizes) < LEVELS:
            size = -(-max(64, int(len(left) * ROOM)) // 64) * 64
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        if len(left):
            raise ValueError("keys are not distinct")
        packed = np.packbits(np.concatenate(bits), bitorder="little").view(np.uint64) if bits else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), packed)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            bit = self.begins[level] + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            word, inside = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> inside) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << inside) - np.uint64(1))
            out[left[hit]] = self.before[bit[hit] >> 6] + np.bitwise_count(below[hit])
            left = left[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, LEVELS + 1) >> np.uint64(32)).astype(np.uint32)


class ShardWriter:
    """Collects the documents of one shard and writes its two files."""

    def __init__(self, folder: str, width: int):
        self.folder, self.dtype = folder, np.dtype("<u2" if width == 2 else "<u4")
        self.start()

    def start(self) -> None:
        self.ids: list[np.ndarray] = []
        self.keys: list[int | None] = []
        self.hashes: list[int] = []
        self.lengths: list[np.ndarray] = []
        self.n_ids = 0

    def add(self, keys: list[int | None], hashes: list[int], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.keys += keys
        self.hashes += hashes
        self.ids.append(ids.astype(self.dtype))
        self.lengths.append(lengths)
        self.n_ids += len(ids)

    def close(self) -> dict:
        """Writes the files and returns the manifest row."""
        lengths = np.concatenate(self.lengths)
        empty = sum(k is None for k in self.keys)
        keys = np.array(self.keys[empty:], np.int64)
        one, first, rows = np.unique(keys, return_index=True, return_counts=True)
        function = PerfectHash.build(one)
        slot = function.slots(one)
        marks, row, many = np.zeros(len(one), np.uint32), np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
        marks[slot], row[slot], many[slot] = fingerprints(one), empty + first, rows
        buffer = io.BytesIO()
        np.savez(buffer, sizes=function.sizes, words=function.words, marks=marks, row=row, many=many, empty=np.array(empty),
                 keys=keys, offsets=np.concatenate([[0], np.cumsum(lengths)]))
        name = uuid.uuid4().hex
        files, folder = file_system(self.folder)
        files.create_dir(folder)
        with files.open_output_stream(f"{folder}/{name}.ids") as out:
            for part in self.ids:
                out.write(part.tobytes())
        with files.open_output_stream(f"{folder}/{name}.idx") as out:
            out.write(buffer.getvalue())
        made = {"shard": f"{self.folder}/{name}", "first_id": self.keys[0], "first_hash": self.hashes[0],
                "n_rows": len(self.keys), "n_ids": self.n_ids, "width": self.dtype.itemsize}
        self.start()
        return made


class Shard:
    """A written shard: its documents by key or in order."""

    def __init__(self, shard: str, width: int):
        self.files, self.path = file_system(shard)
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        with self.files.open_input_file(f"{self.path}.idx") as file:
            index = np.load(io.BytesIO(file.read()))
            self.function = PerfectHash(index["sizes"], index["words"])
            self.marks, self.row, self.many = index["marks"], index["row"], index["many"]
            self.empty, self.keys, self.offsets = int(index["empty"]), index["keys"], index["offsets"]
        self.payload = self.files.open_input_file(f"{self.path}.ids")

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; no rows for a key that was not written."""
        slot = self.function.slots(keys)
        known = slot >= 0
        known[known] = self.marks[slot[known]] == fingerprints(keys[known])
        first, many = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], many[known] = self.row[slot[known]], self.many[slot[known]]
        return first, many

    def ids(self, row: int) -> np.ndarray:
        """The ids of one row."""
        begin, end = (int(x) * self.dtype.itemsize for x in self.offsets[row:row + 2])
        return np.frombuffer(self.payload.read_at(end - begin, begin), self.dtype)

    def get(self, key: int) -> list[np.ndarray]:
        first, many = self.rows(np.array([key], np.int64))
        return [self.ids(r) for r in range(int(first[0]), int(first[0] + many[0]))]


def write(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and writes all documents; returns the manifest, a row for each shard, in the order of the shards."""
    spark = docs.sparkSession
    folder = scratch(spark, "token-ids")
    words = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), words.alias("text"), F.xxhash64(words).alias("h"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    schema = pa.schema([("shard", pa.string()), *[(x, pa.int64()) for x in ("first_id", "first_hash", "n_rows", "n_ids")], ("width", pa.int32())])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path)
        width = 2 if max(*table.vocab.values(), *table.special.values(), end_id) < 1 << 16 else 4
        shard = ShardWriter(folder, width)
        for batch in batches:
            # Slices keep the ids of a whole batch out of memory.
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids, lengths = encode(part.column("text").to_pylist(), table)
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                shard.add(part.column("doc_id").to_pylist(), part.column("h").to_pylist(), ids, lengths + 1)
                if shard.n_ids >= SHARD_IDS:
                    yield pa.RecordBatch.from_pylist([shard.close()], schema)
        if shard.keys:
            yield pa.RecordBatch.from_pylist([shard.close()], schema)

    return landed(dealt.mapInArrow(written, MANIFEST), "manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the ids of all shards before each; a manifest has a row for SHARD_IDS ids or a task."""
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; keyed rows are found through the index."""
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["shard"], row["width"])
                one = np.unique(shard.keys)
                first, many = shard.rows(one)
                keys = pa.array([None] * shard.empty + np.repeat(one, many).tolist(), pa.int64())
                at = np.concatenate([np.arange(shard.empty), np.concatenate([np.arange(a, a + n) for a, n in zip(first, many, strict=True)] or [np.zeros(0, int)])]).astype(int)
                crc = [zlib.crc32(shard.ids(r).astype("<u4").tobytes()) for r in at.tolist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": keys, "start": row["base"] + shard.offsets[at], "n_tokens": shard.offsets[at + 1] - shard.offsets[at],
                    "ids_crc32": pa.array(crc, pa.int64())})

    spread = placed(manifest).repartition("shard")
    return spread.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of the given keys: each key goes to the shards whose range may hold it, and is found by hash there."""
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash", "shard")
    ranges = manifest.withColumn("next_id", F.lead("first_id").over(order)).alias("m")
    wanted = keys.select(F.col(key).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    inside = (F.col("doc_id") >= F.coalesce("first_id", F.lit(-(1 << 63)))) & (F.col("doc_id") <= F.coalesce("next_id", F.lit((1 << 63) - 1)))
    found = wanted.join(small(ranges, 200), inside).select("doc_id", "shard", "width")

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != name:
                    shard, name = Shard(row["shard"], row["width"]), row["shard"]
                for ids in shard.get(row["doc_id"]):
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([row["doc_id"]], pa.int64()), "ids": pa.array([ids.tolist()], pa.list_(pa.int32()))})

    return found.repartition("shard").sortWithinPartitions("shard").mapInArrow(fetched, "doc_id long, ids array<int>")
