"""Near duplicates by SuperMinHash (operator 10).

A document is the set of its distinct word shingles. Its signature is a SuperMinHash:
each shingle draws one random permutation of the signature's places together with one
random fraction for each step, and step ``j`` offers ``j + fraction`` to the place the
permutation names. The offers of a shingle fall on different places, which lowers the
variance, and since they only grow, a document stops at the first step above its largest
place; long documents need two or three steps. Bands of the signature are buckets.

Candidates are verified on whole shingle sets. Documents of equal sets are one class from
the start. Classes that share buckets, directly or through others, form a candidate
group, and its sets are brought together once. Within a group two classes are compared
unless they are connected already. A group above ``GROUP_CLASSES`` or ``GROUP_SHINGLES``
is not brought together: all its classes are compared with one pivot, in as many tasks as
it has parts. The Jaccard distance is a metric, so a class further than the link distance
``t`` from the pivot, at ``x``, can only be linked to other such classes and to linked
ones at ``x - t`` or more; these are the group of the next round. If ``ROUNDS`` pivots do
not make it small, the rest is compared block against block, each pair of blocks in a
task. So no link between classes that share a bucket is lost, whatever the size. With 32
bands of 4 places a pair at 0.8 shares a bucket with a probability over 1 - 1e-7.

Links are joined to components by union-find in a group and by label rounds across.
Texts without words (or null) have no shingles and are linked with nothing. A component
is named by its smallest doc_id; rows without a doc_id take part, and a component of only
such rows is named null. Rows that share doc_id and text share their result in
``linked``; ``deduplicated`` returns one row of each component. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import BROADCAST_BYTES, landed, slices, small
from newsloom.llm.components import components
from newsloom.llm.pieces import blocks, span_hashes

PLACES, BAND = 128, 4
#: Characters of text whose shingles are in a worker's memory at once, with PLACES bytes each.
BLOCK = 1 << 19
#: Shingles that draw at once; a long text has more.
ITEMS = 1 << 17
#: Percent of the union that two linked sets share.
PERCENT = 80
GROUP_CLASSES, GROUP_SHINGLES = 256, 1 << 21
ROUNDS = 2
#: Parts a large group is dealt into.
SALTS = 64
#: Rows of a component whose name is told to all tasks.
HOT_ROWS = 1000


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words_at(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every word of the lower-cased texts, in order, and the first word of each text."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    begins = np.zeros(len(data) + 1, bool)  # a word or a text begins here
    begins[1:-1] = blank[:-1]
    begins[0] = True
    begins[np.concatenate([[0], ends])] = True
    first = begins[:-1] & ~blank
    start = np.flatnonzero(first)
    stop = np.append(blank, True)
    stop[ends] = True
    stops = np.flatnonzero(stop)
    end = stops[np.searchsorted(stops, start, side="right")]
    return span_hashes(data, start, end), np.searchsorted(ends, start, side="right"), start


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, owner, _ = words_at(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(rolled)])
        out = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a >= width:
                out.append(np.unique(rolled[a:b - width + 1]))
            elif b > a:
                h = np.full(1, b - a, np.uint64)
                for w in words[a:b]:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """The SuperMinHash of each set, one row each."""
    ends = np.cumsum([len(s) for s in sets], dtype=np.int64)
    table = np.full((len(sets), places), np.iinfo(np.uint64).max, np.uint64)
    items = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    for a in range(0, len(items), ITEMS):
        some = items[a:a + ITEMS]
        offered(table, some, np.searchsorted(ends, np.arange(a, a + len(some)), side="right"))
    return table


def offered(table: np.ndarray, items: np.ndarray, owner: np.ndarray) -> None:
    """Lowers the places of the signatures in ``table`` by the offers of some shingles of their sets."""
    places, flat = table.shape[1], table.ravel()
    order = np.tile(np.arange(places, dtype=np.uint8), (len(items), 1))
    for j in range(places):
        if not len(items):
            break
        rows = np.arange(len(items))
        with np.errstate(over="ignore"):
            draw = mix(items + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            pick = j + (mix(draw + np.uint64(0x632BE59BD9B4E019)) % np.uint64(places - j)).astype(np.int64)
        place = order[rows, pick]
        order[rows, pick] = order[:, j]
        offer = np.uint64(j) << np.uint64(56) | draw >> np.uint64(8)
        np.minimum.at(flat, owner * places + place, offer)
        # A text goes on while one of its places could still take an offer of the next step.
        open_texts = np.unique(owner)
        more = np.zeros(len(table), bool)
        more[open_texts] = table[open_texts].max(axis=1) >> np.uint64(56) > j
        stay = more[owner]
        items, owner, order = items[stay], owner[stay], order[stay]


def bands(table: np.ndarray, band: int = BAND) -> np.ndarray:
    """The bucket of each band of each signature."""
    out = []
    with np.errstate(over="ignore"):
        for k in range(0, table.shape[1] - band + 1, band):
            h = np.full(len(table), k + 1, np.uint64)
            for c in range(k, k + band):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + table[:, c])
            out.append(h)
    return np.stack(out, axis=1).view(np.int64)


def sketches(docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, h (hash of the text), n, digest of the set and buckets of every row."""
    words = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(words).alias("h"), words.alias("text"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for first, last in blocks(texts, BLOCK):
                sets = shingle_sets(texts[first:last], width)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "h": part.column("h"), "n": np.array([len(s) for s in sets], np.int64),
                    "digest": pa.array([digest(s) for s in sets], pa.binary()),
                    "buckets": pa.array(list(bands(signatures(sets))), pa.list_(pa.int64()))})

    return rows.mapInArrow(sketched, "doc_id long, h long, n long, digest binary, buckets array<long>")


def digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def are_linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def group_links(names: list[bytes], sets: list[np.ndarray], percent: int, apart: int = 0) -> list[tuple[bytes, bytes]]:
    """Links that connect all linked sets; with ``apart`` only pairs across that position are compared."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(len(sets)):
        for j in range(min(i, apart) if apart and i >= apart else 0 if apart else i):
            if find(i) != find(j) and are_linked(sets[i], sets[j], percent):
                root[find(i)] = find(j)
                out.append((names[j], names[i]))
    return out


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(c, grp) of the classes that share a bucket with another; c stands for the class in this graph only."""
    buckets = classes.select("c", F.explode("buckets").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("c").alias("hub"), F.max("c").alias("last")).where("hub < last")
    hubs = small(landed(hubs.select("bucket", "hub"), "hubs"), 16)
    links = buckets.join(hubs, "bucket").where("c != hub").select(F.col("hub").alias("a"), F.col("c").alias("b"))
    return components(links).select(F.col("node").alias("c"), F.col("root").alias("grp"))


LINK = "a binary, b binary"


def small_links(members: DataFrame, percent: int) -> DataFrame:
    """Links within groups that fit a task."""
    def of_group(table: pa.Table) -> pa.Table:
        names, sets = table.column("digest").to_pylist(), [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        found = group_links(names, sets, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return members.select("grp", "digest", "items").groupBy("grp").applyInArrow(of_group, LINK)


def pivoted(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of large groups with their pivots, and what is left of these groups."""
    chosen = members.groupBy("grp").agg(F.min_by("digest", F.struct(F.xxhash64("digest"), "digest")).alias("pivot"))
    chosen = small(landed(chosen, "pivots").withColumnRenamed("grp", "g"), 32)
    pivots = landed(members.join(chosen, (F.col("grp") == F.col("g")) & (F.col("digest") == F.col("pivot"))).select(
        "grp", "pivot", F.col("items").alias("pivot_items")), "pivot-sets")
    size = pivots.agg(F.sum(F.octet_length("pivot_items"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        pairs = members.join(F.broadcast(pivots), "grp")
    else:
        salted = members.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)))
        copies = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        pairs = salted.join(copies, ["grp", "salt"])
    pairs = pairs.where("digest != pivot")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = [np.frombuffer(x, np.uint64) for x in batch.column("items").to_pylist()]
            b = [np.frombuffer(x, np.uint64) for x in batch.column("pivot_items").to_pylist()]
            both = [shared(x, y) for x, y in zip(a, b, strict=True)]
            linked = [100 * s >= percent * (len(x) + len(y) - s) for x, y, s in zip(a, b, both, strict=True)]
            far = [1 - s / (len(x) + len(y) - s) for x, y, s in zip(a, b, both, strict=True)]
            kept = {k: batch.column(k) for k in ("grp", "digest", "n", "items", "pivot")}
            yield pa.RecordBatch.from_pydict({**kept, "linked": pa.array(linked, pa.bool_()), "far": pa.array(far, pa.float64())})

    columns = pairs.select("grp", "digest", "n", "items", "pivot", "pivot_items")
    seen = landed(columns.mapInArrow(measured, "grp long, digest binary, n long, items binary, pivot binary, linked boolean, far double"), "pivoted")
    links = seen.where("linked").select(F.col("pivot").alias("a"), F.col("digest").alias("b"))
    nearest = seen.where("not linked").groupBy("grp").agg((F.min("far") - (100 - percent) / 100 - 1e-9).alias("from"))
    left = seen.join(small(landed(nearest, "nearest"), 24), "grp").where("not linked or far >= from").select("grp", "digest", "n", "items")
    return links, left


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links of groups that pivots do not make small: blocks of classes, each pair of blocks in a task."""
    sizes = members.groupBy("grp").agg((F.ceil(F.greatest(F.count("*") / GROUP_CLASSES, F.sum("n") / GROUP_SHINGLES)) * 2).cast("int").alias("blocks"))
    dealt = members.join(small(landed(sizes, "sizes"), 24), "grp").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("*", other).select(
        "grp", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "digest", "items")

    def of_pair(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("block").to_pylist(), table.column("digest").to_pylist(), table.column("items").to_pylist(), strict=True))
        first = rows[0][0] if rows else 0
        apart = sum(r[0] == first for r in rows)
        found = group_links([r[1] for r in rows], [np.frombuffer(r[2], np.uint64) for r in rows], percent, apart if apart < len(rows) else 0)
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return pairs.groupBy("grp", "x", "y").applyInArrow(of_pair, LINK)


def with_items(docs: DataFrame, chosen: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(grp, digest, n, items): the whole shingle set of each class in a candidate group."""
    words = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(words).alias("h"), words.alias("text"))
    c = chosen.select(F.col("doc_id").alias("d"), F.col("h").alias("ch"), "grp", "digest")
    found = rows.join(c, (F.col("h") == F.col("ch")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("grp", "digest", "text")

    def itemed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for first, last in blocks(texts, BLOCK):
                part = batch.slice(first, last - first)
                sets = shingle_sets(texts[first:last], width)
                # A text that only shares the hash of the class's text is not the class.
                own = pa.array([digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_pydict({
                    "grp": part.column("grp"), "digest": part.column("digest"), "n": pa.array([len(s) for s in sets], pa.int64()),
                    "items": pa.array([s.tobytes() for s in sets], pa.binary())}).filter(own)

    return found.mapInArrow(itemed, "grp long, digest binary, n long, items binary").dropDuplicates(["digest"])


def all_links(members: DataFrame, percent: int, group_classes: int = GROUP_CLASSES, group_shingles: int = GROUP_SHINGLES, rounds: int = ROUNDS) -> DataFrame:
    """(a, b): links that connect all linked sets of a group, whatever its size; ``members`` has grp, digest, n and items."""
    links = None
    for k in range(rounds + 1):
        sizes = members.groupBy("grp").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
        over = (F.col("classes") > group_classes) | (F.col("shingles") > group_shingles)
        # Groups that are too large hold at least so many classes or shingles each, so they are few.
        large_groups = landed(sizes.where(over).select("grp").coalesce(1), "large")
        marked = small(large_groups, 16)
        some = small_links(members.join(marked, "grp", "left_anti"), percent)
        links = some if links is None else links.unionByName(some)
        if large_groups.isEmpty():
            return links
        large = members.join(marked, "grp", "left_semi")
        if k == rounds:
            return links.unionByName(block_links(large, percent))
        found, left = pivoted(large, percent)
        links = links.unionByName(found)
        members = landed(left, "members")
        if members.isEmpty():
            return links
    return links


def verified_links(docs: DataFrame, table: DataFrame, width: int, percent: int, doc_id: str, text: str,
                   group_classes: int = GROUP_CLASSES, group_shingles: int = GROUP_SHINGLES, rounds: int = ROUNDS) -> DataFrame:
    """(a, b): links between classes that connect all classes linked in truth."""
    chosen = table.where("n > 0").groupBy("digest").agg(F.min(F.struct("doc_id", "h")).alias("one"), F.first("buckets").alias("buckets"))
    chosen = landed(chosen.withColumn("c", F.xxhash64("digest")), "classes")
    groups = small(candidate_groups(chosen), 16)
    wanted = landed(chosen.drop("buckets").join(groups, "c").select(F.col("one.doc_id"), F.col("one.h"), "digest", "grp"), "wanted")
    members = landed(with_items(docs, small(wanted, 64), width, doc_id, text), "members")
    return all_links(members, percent, group_classes, group_shingles, rounds)


def grouped(docs: DataFrame, width: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """doc_id, h, n_shingles and component_id of every row."""
    table = landed(sketches(docs, width, doc_id, text), "sketches")
    roots = small(components(verified_links(docs, table, width, percent, doc_id, text, **bounds)), 64)
    return named(table, roots)


def named(table: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """doc_id, h, n_shingles, component_id, root and ``more`` of every row of ``table`` (doc_id, h, n, digest), from the root of each digest that has one."""
    found = table.select("doc_id", "h", "n", "digest", *more).join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    found = found.withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "digest")))
    names = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    names = landed(names.where("rows > 1"), "names")
    # Components of very many rows are few, and none of their rows is dealt by its root.
    large = small(names.where(F.col("rows") > HOT_ROWS).drop("rows"), 32)
    columns = ("doc_id", "h", F.col("n").alias("n_shingles"), "component_id", "root", *more)
    hot = found.join(large, "root").select(*columns)
    rest = found.join(large, "root", "left_anti").join(names.where(F.col("rows") <= HOT_ROWS).drop("rows"), "root", "left")
    return hot.unionByName(rest.withColumn("component_id", F.coalesce("component_id", "doc_id")).select(*columns))


def linked(docs: DataFrame, width: int = 5, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return grouped(docs, width, **options).select("doc_id", "n_shingles", "component_id", kept)


def deduplicated(docs: DataFrame, width: int = 5, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component and all documents without shingles, with their own columns."""
    found = grouped(docs, width, doc_id=doc_id, text=text, **options)
    stays = found.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("one"))
    # Only rows that repeat doc_id and text have to be told apart with their text at hand.
    copies = found.groupBy("doc_id", "h").agg((F.count("*") > 1).alias("repeated")).where("repeated")
    c = copies.withColumnsRenamed({"doc_id": "cd", "h": "ch"})
    stays = stays.select(F.col("one.doc_id").alias("d"), F.col("one.h").alias("sh"))
    stays = stays.join(c, (F.col("sh") == F.col("ch")) & F.col("d").eqNullSafe(F.col("cd")), "left").select("d", "sh", "repeated")
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("d0"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h0"))
    chosen = rows.join(landed(stays, "stays"), (F.col("h0") == F.col("sh")) & F.col("d0").eqNullSafe(F.col("d")))
    one = chosen.where("repeated is null").unionByName(chosen.where("repeated").dropDuplicates(["d0", "h0"]))
    empty = rows.where(F.coalesce(F.col(f"row.{text}").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) == F.lit(False))
    return one.select("row.*").unionByName(empty.select("row.*"))
