"""Similarity join of shingle sets by grouped prefixes (operator 13).

A document is the set of its distinct word shingles. All sets are sorted by one order of
the shingles, rare ones first, and two sets with a Jaccard similarity of ``PERCENT`` share
a shingle among the first ``n - ceil(PERCENT n / 100) + 1`` of each, their prefixes.
Documents of equal sets are one class, and classes with the same prefix and size are one
group. Prefixes are listed and joined once for a group: two groups that share a shingle
are a pair if their sizes allow the similarity, and so does the number of shingles that
their prefixes share: of a set whose prefix ends first, what its prefix does not share with
the other prefix is not in the other set. The number is counted in the join of the lists.
Pairs are expanded to the members of their groups, and members are verified on whole sets.

The order is that of the counts of the leading ``LEVELS`` bits of the shingles' hashes, added
up over all documents, each task counting a set once; then of the hashes. So passages that many
documents share are last and reach no prefix, while the table has a fixed size: the larger the
corpus, the more shingles reach prefixes that many documents have.

A shingle that more than ``LIST`` groups have in their prefixes all the same is not paired out.
Groups with such a shingle, or with more members, are crowded. Two groups that are not both
crowded meet by other shingles if they are linked. Classes of crowded groups meet by the parts
of their whole sets: sets whose sizes are in one window differ in at most ``d`` shingles if they
are linked, so of more than ``d`` parts by hash one is equal, and a part has some nine shingles.
Classes that share a part with no more than ``LIST`` others are pairs. A part that more share
connects them, and all classes that are connected so are compared, in pairs of blocks.

Every linked pair of classes is found once, whether others connect it or not. A link counts for
a document as often as the other class has rows. Tasks tell the sums of a class and as many
links as connect what is linked; links are joined to components by label rounds.

Shingles are 64-bit hashes, classes and groups 128-bit digests. Null, empty and blank
texts have an empty set and are linked with nothing; a text of fewer words is one shingle
of them all. Very long texts are hashed a text at a time, and their sets are whole. A
component is named by its smallest doc_id; rows without a doc_id take part, and a
component of only such rows is named null. Rows that share doc_id and text share their
result. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import BROADCAST_BYTES, added_up, landed, slices, small
from newsloom.llm.components import components
from newsloom.llm.masks import has, mask_of
from newsloom.llm.minhash import BLOCK, GROUP_CLASSES, GROUP_SHINGLES, are_linked, digest, mix, named, shingle_sets
from newsloom.llm.pieces import blocks

WIDTH, PERCENT = 3, 90
#: Bits of a shingle's hash that name its counter.
LEVELS = 20
#: Groups that are paired out for one shingle, and members of a group.
LIST = 64
#: Sets that a task remembers as counted.
SEEN = 500_000
#: Classes and shingles of a block; two are compared in a task.
BLOCK_CLASSES, BLOCK_SHINGLES = 2048, 1 << 20
#: Shingles of a block pair that are a matrix at once, and pairs of places that are counted at once.
SLAB, PLACES = 1024, 1 << 22
#: a is linked with b, and so with w rows in all that no other row of a tells.
LINK = "a binary, b binary, w long"


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    words = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(words).alias("h"), words.alias("text"))


def sets_in(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches with the shingle set of each of their texts."""
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        for first, last in blocks(texts, BLOCK):
            yield batch.slice(first, last - first), shingle_sets(texts[first:last], width)


def counter(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(64 - LEVELS)).astype(np.int64)


def levels(docs: DataFrame, width: int, doc_id: str, text: str) -> np.ndarray:
    """The level of every counter: four times the logarithm of its count."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << LEVELS, np.int64)
        seen: set[bytes] = set()
        for _, sets in sets_in(batches, width):
            new = {mark: items for items in sets if (mark := digest(items)) not in seen}
            seen.update(new)
            if len(seen) > SEEN:
                seen.clear()
            counts += np.bincount(counter(np.concatenate([np.zeros(0, np.uint64), *new.values()])), minlength=len(counts))
        yield pa.RecordBatch.from_pydict({"m": [counts.tobytes()]})

    made = keyed(docs, doc_id, text).select("text").mapInArrow(of_batches, "m binary")
    counts = added_up(landed(made.select(F.spark_partition_id().cast("long").alias("part"), "m"), "counts"), "<i8", 1 << LEVELS)
    return np.floor(4 * np.log2(counts + 1)).astype(np.uint8)


def prefix_of(items: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the order of levels and hashes, as many as a similar set must meet."""
    n = len(items)
    many = n - -(-percent * n // 100) + 1
    return items[np.lexsort((items, level[counter(items)]))[:many]]


def prefixed(docs: DataFrame, width: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, h (hash of the text), n and digest of the set, g (group) and prefix of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(levels(docs, width, doc_id, text))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in sets_in(batches, width):
            first = [prefix_of(s, shared.value, percent).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            group = [hashlib.blake2b(x.tobytes() + len(s).to_bytes(8, "little"), digest_size=16).digest() for x, s in zip(first, sets, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "h": part.column("h"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([digest(s) for s in sets], pa.binary()), "g": pa.array(group, pa.binary()), "prefix": pa.array(first, pa.list_(pa.int64()))})

    made = keyed(docs, doc_id, text).mapInArrow(of_batches, "doc_id long, h long, n long, digest binary, g binary, prefix array<long>")
    # Two groups of one hash would only be compared needlessly.
    return landed(made.withColumn("g", F.xxhash64("g")), "prefixes")


def listed(table: DataFrame) -> DataFrame:
    """(shingle, k, g, n) of the shingles in the prefixes of groups that k > 1 groups have."""
    groups = landed(table.where("n > 0").groupBy("g").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix")), "groups")
    often = groups.select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("k")).where("k > 1")
    often = landed(often, "often")
    shared = groups.sparkSession.sparkContext.broadcast(mask_of(often.select(F.col("shingle").alias("id"))))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most shingles are in one prefix only; they are not shuffled again.
        for batch in slices(batches):
            lists = batch.column("prefix")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            shingle = lists.flatten().to_numpy()
            kept = np.flatnonzero(has(shared.value, shingle))
            took = pa.array(np.repeat(np.arange(len(size)), size)[kept])
            yield pa.RecordBatch.from_arrays([batch.column("g").take(took), batch.column("n").take(took), pa.array(shingle[kept])], ["g", "n", "shingle"])

    rows = groups.mapInArrow(of_batches, "g long, n long, shingle long")
    return landed(rows.join(small(often, 24), "shingle"), "lists")


def group_pairs(lists: DataFrame, crowded: DataFrame, percent: int, most: int) -> DataFrame:
    """(a, b): the groups, not both ``crowded`` (g), that share a shingle and pass the filters of size and prefix."""
    marked = small(crowded.withColumn("crowded", F.lit(True)), 16)
    few = lists.where(F.col("k") <= most).join(marked, "g", "left").select("shingle", "g", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    x, y = few.alias("x"), few.alias("y")
    less = F.struct("x.n", "x.g") < F.struct("y.n", "y.g")
    can = (100 * F.col("x.n") >= percent * F.col("y.n")) & ~(F.col("x.crowded") & F.col("y.crowded"))
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & less & can).groupBy(
        F.col("x.g").alias("a"), F.col("y.g").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).agg(F.count("*").alias("both"))
    # No shared shingle is missing in the lists, as one of the groups has no shingle that is not paired out.
    beyond = [F.floor((percent * F.col(n) + 99) / 100) - 1 for n in ("n_a", "n_b")]
    return met.where((100 + percent) * (F.col("both") + F.greatest(*beyond)) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def sets_of(docs: DataFrame, wanted: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(grp, digest, rows, n, items): the whole set of each class in ``wanted`` (doc_id, h, repeated, digest, rows, grp)."""
    w = wanted.withColumnsRenamed({"doc_id": "d", "h": "wh"})
    keys = keyed(docs, doc_id, text)
    if 64 * w.count() <= BROADCAST_BYTES:
        w = F.broadcast(w)
    else:
        asked = docs.sparkSession.sparkContext.broadcast(mask_of(w.select(F.col("wh").alias("id"))))

        def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Other texts are not shuffled.
            for batch in batches:
                yield batch.filter(pa.array(has(asked.value, batch.column("h").to_numpy())))

        keys = keys.mapInArrow(of_texts, "doc_id long, h long, text string")
    found = keys.join(w, (F.col("h") == F.col("wh")) & F.col("doc_id").eqNullSafe(F.col("d")))
    kept = ("repeated", "grp", "digest", "rows")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in sets_in(batches, width):
            # A text that only shares the hash of the class's text is not the class.
            own = pa.array([digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_pydict({
                **{c: part.column(c) for c in kept}, "n": pa.array([len(s) for s in sets], pa.int64()),
                "items": pa.array([s.tobytes() for s in sets], pa.binary())}).filter(own)

    made = found.select(*kept, "text").mapInArrow(of_batches, "repeated boolean, grp long, digest binary, rows long, n long, items binary")
    made = landed(made, "sets")
    # Only classes whose row is repeated come more than once.
    once = made.where("not repeated").unionByName(made.where("repeated").dropDuplicates(["grp", "digest"]))
    return once.drop("repeated")


def windows(size: int, percent: int) -> list[int]:
    """Bounds of size classes beyond ``size``: sizes of linked sets are in one class or in neighbouring ones."""
    bounds = [1, 2, 3]
    while bounds[-3] <= size:
        bounds.append(max(100 * (bounds[-1] - 1) // percent, bounds[-1]) + 1)
    return bounds


def part_marks(items: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the parts of a set, one of which any other set that is linked with it has too."""
    if percent >= 100 or not len(items):
        return np.zeros(0, np.uint64)
    bounds = windows(len(items), percent)
    at, out = bisect_right(bounds, len(items)) - 1, [np.zeros(0, np.uint64)]
    # Window w has the sizes of classes w and w + 1.
    for w in range(max(0, at - 1), at + 1):
        differ = 2 * (bounds[w + 2] - 1) * (100 - percent) // (100 + percent)
        if not differ:
            continue
        spare = differ // 8
        many = differ + 1 + spare
        with np.errstate(over="ignore"):
            part = (mix(items + np.uint64((w + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(many)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            full, first = np.unique(part[order], return_index=True)
            total = np.zeros(many, np.uint64)
            total[full] = np.add.reduceat(mix(items[order] ^ np.uint64(0x632BE59BD9B4E019)), first)
            marks = mix(total + mix(np.arange(many, dtype=np.uint64) + np.uint64(w + 1 << 32)))
        # More than ``spare`` parts are equal, so empty ones count only where there are more of them.
        out.append(marks if many - len(full) > spare else marks[full])
    return np.concatenate(out)


def part_lists(sets: DataFrame, percent: int) -> DataFrame:
    """(mark, k, c, n) of the part marks that k > 1 of the sets have; c is the hash of a set's digest."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            marks = [part_marks(np.frombuffer(x, np.uint64), percent).view(np.int64) for x in batch.column("items").to_pylist()]
            took = pa.array(np.repeat(np.arange(len(marks)), [len(m) for m in marks]))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.zeros(0, np.int64), *marks])), batch.column("c").take(took), batch.column("n").take(took)], ["mark", "c", "n"])

    made = sets.select(F.xxhash64("digest").alias("c"), "n", "items").mapInArrow(of_batches, "mark long, c long, n long")
    made = landed(made, "marks")
    often = landed(made.groupBy("mark").agg(F.count("*").alias("k")).where("k > 1"), "often")
    return landed(made.join(small(often, 16), "mark"), "lists")


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many items each set of ``one`` shares with each of ``two``."""
    total = np.zeros((len(one), len(two)), np.float32)
    both = np.intersect1d(np.concatenate(one), np.concatenate(two))
    if not len(both):
        return total

    def coded(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``both`` and the sets of their items, in the order of places."""
        items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        place = np.minimum(np.searchsorted(both, items), len(both) - 1)
        kept = both[place] == items
        place, owner = place[kept], owner[kept]
        order = np.argsort(place, kind="stable")
        return place[order], owner[order]

    (p, i), (q, j) = coded(one), coded(two)
    k, m = np.bincount(p, minlength=len(both)), np.bincount(q, minlength=len(both))
    # What many sets have is multiplied out as matrices, the rest is listed.
    dense = 50 * k * m > total.size
    at = np.cumsum(dense) - 1
    pd, qd = dense[p], dense[q]
    for a in range(0, int(dense.sum()), SLAB):
        left, right = (np.zeros((len(sets), SLAB), np.float32) for sets in (one, two))
        for matrix, place, owner in ((left, at[p[pd]] - a, i[pd]), (right, at[q[qd]] - a, j[qd])):
            here = (place >= 0) & (place < SLAB)
            matrix[owner[here], place[here]] = 1
        total += left @ right.T
    p, i = p[~pd], i[~pd]
    first, many = (np.cumsum(m) - m)[p], m[p]
    ends = np.cumsum(many)
    cuts = np.searchsorted(ends, np.arange(PLACES, (ends[-1] if len(ends) else 0) + PLACES, PLACES), side="left") + 1
    flat, a = total.ravel(), 0
    for b in cuts.tolist():
        size = many[a:b]
        k = np.repeat(first[a:b], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        flat += np.bincount(np.repeat(i[a:b], size) * len(two) + j[k], minlength=len(flat)).astype(np.float32)
        a = b
    return total


def connecting(linked: np.ndarray) -> list[tuple[int, int]]:
    """As many of the linked pairs (row, column) as connect all that are linked."""
    rows, columns, out = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool), []
    for start in np.flatnonzero(linked.any(axis=1)).tolist():
        if not rows[start]:
            continue
        rows[start] = False
        ahead = [(True, start)]
        while ahead:
            is_row, x = ahead.pop()
            new = np.flatnonzero(linked[x] & columns if is_row else linked[:, x] & rows)
            (columns if is_row else rows)[new] = False
            out += [(x, y) if is_row else (y, x) for y in new.tolist()]
            ahead += [(not is_row, y) for y in new.tolist()]
    return out


def block_links(members: DataFrame, percent: int, block_classes: int = BLOCK_CLASSES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links of all pairs within the groups of ``members`` (grp, digest, rows, n, items): blocks of classes, each pair of blocks in a task."""
    sizes = members.groupBy("grp").agg(F.ceil(F.greatest(F.count("*") / block_classes, F.sum("n") / block_shingles)).cast("int").alias("blocks"))
    dealt = members.join(small(landed(sizes, "sizes"), 24), "grp").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("*", other).select(
        "grp", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "digest", "rows", "items")

    def of_pair(key: tuple, table: pa.Table) -> pa.Table:
        sides = []
        for block in dict.fromkeys(k.as_py() for k in key[1:]):
            side = table.filter(pc.equal(table.column("block"), block))
            sides.append((side.column("digest").to_pylist(), side.column("rows").to_numpy().astype(np.int64),
                          [np.frombuffer(x, np.uint64) for x in side.column("items").to_pylist()]))
        (names, weights, sets), (others, other_weights, other_sets) = sides[0], sides[-1]
        a, b, w = [], [], []
        if sets and other_sets:
            both = overlaps(sets, other_sets).astype(np.int64)
            n, m = (np.array([len(x) for x in some], np.int64) for some in (sets, other_sets))
            linked = (100 + percent) * both >= percent * (n[:, None] + m[None, :])
            if len(sides) == 1:
                np.fill_diagonal(linked, False)
            for own, sums in ((names, linked @ other_weights), (others, linked.T @ weights))[:len(sides)]:
                for x in np.flatnonzero(sums).tolist():
                    a.append(own[x]), b.append(own[x]), w.append(int(sums[x]))
            for x, y in connecting(linked):
                a.append(names[x]), b.append(others[y]), w.append(0)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "w": pa.array(w, pa.int64())})

    return pairs.groupBy("grp", "x", "y").applyInArrow(of_pair, LINK)


def both_ways(x: list[bytes], y: list[bytes], rows_x: list[int], rows_y: list[int]) -> dict[str, pa.Array]:
    return {"a": pa.array(x + y, pa.binary()), "b": pa.array(y + x, pa.binary()), "w": pa.array(rows_y + rows_x, pa.int64())}


def verified(members: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The linked of the pairs (grp, x, y), for groups that fit a task."""
    def of_group(sets: pa.Table, listed: pa.Table) -> pa.Table:
        names = sets.column("digest").to_pylist()
        items = dict(zip(names, (np.frombuffer(x, np.uint64) for x in sets.column("items").to_pylist()), strict=True))
        rows = dict(zip(names, sets.column("rows").to_pylist(), strict=True))
        met = zip(listed.column("x").to_pylist(), listed.column("y").to_pylist(), strict=True)
        found = [(x, y) for x, y in met if are_linked(items[x], items[y], percent)]
        x, y = [x for x, _ in found], [y for _, y in found]
        return pa.table(both_ways(x, y, [rows[a] for a in x], [rows[b] for b in y]))

    return members.select("grp", "digest", "rows", "items").groupBy("grp").cogroup(pairs.groupBy("grp")).applyInArrow(of_group, LINK)


def verified_apart(members: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The linked of the pairs (x, y), each verified by itself."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("ix", "iy")]
            linked = pa.array([are_linked(a, b, percent) for a, b in zip(*sets, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_pydict(both_ways(*(batch.column(c).filter(linked).to_pylist() for c in ("x", "y", "rows_x", "rows_y"))))

    one, two = (members.select(F.col("digest").alias(c), F.col("rows").alias(f"rows_{c}"), F.col("items").alias(f"i{c}")) for c in "xy")
    return pairs.join(one, "x").join(two, "y").select("x", "y", "rows_x", "rows_y", "ix", "iy").mapInArrow(of_batches, LINK)


def links(docs: DataFrame, table: DataFrame, classes: DataFrame, width: int, percent: int, doc_id: str, text: str, most: int = LIST,
          group_classes: int = GROUP_CLASSES, group_shingles: int = GROUP_SHINGLES, block_classes: int = BLOCK_CLASSES) -> DataFrame:
    """(a, b, w): all links between ``classes``: w sums up to the rows that a is linked with, and the pairs connect all that is linked."""
    lists = listed(table)
    several = landed(classes.groupBy("g").agg(F.count("*").alias("members")).where("members > 1"), "several")
    crowded = lists.where(F.col("k") > most).select("g").unionByName(several.where(F.col("members") > most).select("g")).distinct()
    crowded = landed(crowded, "crowded")
    member = classes.select("digest", "g")
    # Pairs of members of groups that are not both crowded.
    pairs = small(landed(group_pairs(lists, crowded, percent, most), "pairs"), 16)
    between = pairs.join(member.select(F.col("g").alias("a"), F.col("digest").alias("x")), "a").join(
        member.select(F.col("g").alias("b"), F.col("digest").alias("y")), "b").select("x", "y")
    inside = member.join(small(several.select("g").join(crowded, "g", "left_anti"), 8), "g")
    within = inside.select("g", F.col("digest").alias("x")).join(inside.select("g", F.col("digest").alias("y")), "g").where("x < y").select("x", "y")
    both, found = between.unionByName(within), None
    if not crowded.isEmpty():
        at = landed(classes.join(small(crowded, 8), "g").select("one.*", "digest", "rows", F.lit(0).cast("long").alias("grp")), "placed")
        sets = sets_of(docs, at, width, doc_id, text)
        met, hot = part_pairs(part_lists(sets, percent), percent, most)
        named_by = at.select(F.xxhash64("digest").alias("c"), "digest")
        both = both.unionByName(small(landed(met, "met"), 16).join(named_by.select(F.col("c").alias("a"), F.col("digest").alias("x")), "a").join(
            named_by.select(F.col("c").alias("b"), F.col("digest").alias("y")), "b").select("x", "y"))
        members = sets.drop("grp").withColumn("node", F.xxhash64("digest")).join(small(hot.withColumnRenamed("root", "grp"), 16), "node").drop("node")
        found = block_links(members, percent, block_classes)
    both = landed(both, "class-pairs")
    roots = components(both.select(F.xxhash64("x").alias("a"), F.xxhash64("y").alias("b"))).select(F.col("node"), F.col("root").alias("grp"))
    roots = small(roots, 24)
    cold = classes.withColumn("node", F.xxhash64("digest")).join(roots, "node").select("one.*", "digest", "rows", "grp")
    members = sets_of(docs, landed(cold, "placed"), width, doc_id, text)
    grouped = both.withColumn("node", F.xxhash64("x")).join(roots, "node").select("grp", "x", "y")
    sizes = members.groupBy("grp").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    over = (F.col("classes") > group_classes) | (F.col("shingles") > group_shingles)
    large = small(landed(sizes.where(over).select("grp").coalesce(1), "large"), 16)
    fit = verified(members.join(large, "grp", "left_anti"), grouped.join(large, "grp", "left_anti"), percent)
    apart = verified_apart(members.join(large, "grp", "left_semi"), grouped.join(large, "grp", "left_semi").select("x", "y"), percent)
    out = fit.unionByName(apart)
    return out if found is None else out.unionByName(found)


def part_pairs(lists: DataFrame, percent: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): the sets that share a part with at most ``most``; and (node, root) of the sets that larger parts connect, which are no pairs."""
    full = lists.where(F.col("k") > most)
    hubs = landed(full.groupBy("mark").agg(F.min("c").alias("a")), "hubs")
    hot = components(full.join(small(hubs, 16), "mark").select("a", F.col("c").alias("b")).distinct())
    few = lists.where(F.col("k") <= most).join(small(hot.withColumnRenamed("node", "c"), 16), "c", "left")
    x, y = few.alias("x"), few.alias("y")
    apart = ~F.coalesce(F.col("x.root") == F.col("y.root"), F.lit(False))
    size = (100 * F.col("x.n") >= percent * F.col("y.n")) & (100 * F.col("y.n") >= percent * F.col("x.n"))
    met = x.join(y, (F.col("x.mark") == F.col("y.mark")) & (F.col("x.c") < F.col("y.c")) & size & apart)
    return met.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")).distinct(), hot


def linked(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (the other rows that it is linked with) of every row."""
    table = prefixed(docs, width, percent, doc_id, text)
    rows = table.where("n > 0").groupBy("digest", "doc_id", "h").agg(F.count("*").alias("rows"), F.first("g").alias("g"))
    one = F.min(F.struct("doc_id", "h", (F.col("rows") > 1).alias("repeated"))).alias("one")
    classes = landed(rows.groupBy("digest").agg(one, F.sum("rows").alias("rows"), F.first("g").alias("g")), "classes")
    found = landed(links(docs, table, classes, width, percent, doc_id, text, **bounds), "found")
    roots = small(components(found.where("a != b")), 64)
    copies = classes.where("rows > 1").select(F.col("digest").alias("a"), (F.col("rows") - 1).alias("w"))
    counts = found.select("a", "w").unionByName(copies).groupBy(F.col("a").alias("digest")).agg(F.sum("w").alias("n_links"))
    counted = table.join(small(landed(counts, "degrees"), 40), "digest", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    return named(counted, roots, "n_links").select("doc_id", "n_shingles", "component_id", "n_links")


def joined(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return linked(docs, width, percent, doc_id, text, **bounds).drop("n_links")
