"""Similar stories, and which of them rise.

An article is the set of its word shingles, and articles of one range of days tell the
same story if their sets are similar or others connect them. Articles of equal sets are
one class. Bands of a MinHash signature find the candidates; with 32 bands of 4 places a
pair at a similarity of 0.8 is missed with a probability below 1e-7. Every candidate pair
is verified on whole sets, and links become stories as connected components. Words are cut
by Spark; their sets, the bands and the common items of pairs are made of whole Arrow batches.

A bucket that more than ``PAIRED`` classes share is not paired out. What such buckets
connect is compared with one pivot for each group: what is linked to it is done, unless
another member is so near that it can be linked to that one only. The Jaccard distance is
a metric, so nothing else can be. After ``ROUNDS`` pivots only the classes that are left are
paired, bucket by bucket. No link of a shared bucket is lost and none is capped.

Articles without words are stories of their own. One without a date is dated by when it
was fetched; without either it is in a range of its own kind (null). Equal ids are one
article. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.dates import published_timestamp
from newsloom.operators.extract import NOT_WORD
from newsloom.operators.groups import components
from newsloom.operators.sizing import broadcast_small, spread
from newsloom.session import checkpointed

WIDTH, PERCENT = 5, 80
RANGE_DAYS = 14
BANDS, BAND = 32, 4
#: Shingles that are hashed at once for signatures.
BLOCK = 1 << 16
SEED = 20250701
PAIRED, ROUNDS = 100, 3
TRAILING_DAYS, TOP = 3, 10
DAY = 86_400


def told_at() -> Column:
    """When an article appeared: its date, else when it was fetched."""
    return F.coalesce(published_timestamp(F.col("published_at")), F.col("fetched_at"))


def day_of(at: Column) -> Column:
    return F.floor(F.unix_seconds(at) / DAY).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and the powers of an odd number and of its inverse."""
    random = np.random.default_rng(SEED).integers(1 << 63, size=257, dtype=np.uint64)
    odd = int(random[256]) | 1
    grown = [np.cumprod(np.append(np.uint64(1), np.full(size, f, np.uint64)), dtype=np.uint64) for f in (odd, pow(odd, -1, 1 << 64))]
    return random[:256], *grown


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word."""
    of_byte, up, down = powers(1 << max(BLOCK.bit_length(), len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(of_byte[data] * up[:len(data)], out=sums[1:])
        return mixed((sums[end] - sums[start]) * down[start])


def run_hashes(words: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    keys = np.full(len(first), size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + words[first + k])
    return keys


def shingles(data: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of all runs of ``width`` words of each text, sorted, and how many a text has.

    Each text ends with a space, at ``ends``. Fewer words are one run of all; none have no hash.
    """
    inside = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    words = word_hashes(data, start, end)
    owner = np.searchsorted(ends, start, side="right")
    sizes = np.bincount(owner, minlength=len(ends))
    # A run begins at each word but the last of a text.
    first = np.arange(max(0, len(words) - width + 1))
    first = first[owner[first] == owner[first + width - 1]]
    items, owners = [run_hashes(words, first, width)], [owner[first]]
    begins = np.cumsum(sizes) - sizes
    for size in range(1, width):
        few = np.flatnonzero(sizes == size)
        items.append(run_hashes(words, begins[few], size))
        owners.append(few)
    items, owner = np.concatenate(items).view(np.int64), np.concatenate(owners)
    order = np.lexsort((items, owner))
    items, owner = items[order], owner[order]
    kept = np.ones(len(items), bool)
    kept[1:] = (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])
    return items[kept], np.bincount(owner[kept], minlength=len(ends))


def word_sets(rows: DataFrame, text: str, width: int) -> DataFrame:
    """``rows`` with the shingles of a text (items), their number (n) and a digest of them in place of the text."""
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in (
        ("items", T.ArrayType(T.LongType())), ("n", T.LongType()), ("digest", T.StringType())))])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2], np.uint8)
            at = 0
            while at < len(batch):
                # As many texts as stay in a core's cache, or one.
                until = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, side="right")) - 1)
                items, sizes = shingles(data[ends[at]:ends[until]], ends[at + 1:until + 1] - ends[at], width)
                bounds = np.append(0, np.cumsum(sizes))
                digests = [hashlib.md5(items[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                part = batch.slice(at, until - at)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), pa.ListArray.from_arrays(bounds.astype(np.int32), items), pa.array(sizes), pa.array(digests)], schema.names)
                at = until

    # What is no word becomes a space here, so that letters and cases are those of the other operators.
    words = F.concat(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD, " "), F.lit(" "))
    return rows.withColumn(text, words).mapInArrow(of_batches, schema)


def similar(percent: int) -> Column:
    """Whether ``shared`` of sets of ``n`` and ``other_n`` items is enough."""
    return 100 * F.col("shared") >= percent * (F.col("n") + F.col("other_n") - F.col("shared"))


def shared_with(other: str) -> Column:
    return F.size(F.array_intersect("items", other)).cast("long").alias("shared")


def lowest(items: np.ndarray, starts: np.ndarray, factor: np.uint32) -> np.ndarray:
    """The smallest of the items of each set, in an order of their own for each odd factor."""
    x = items * factor
    x ^= x >> np.uint32(15)
    x *= factor
    return np.minimum.reduceat(x, starts)


def band_keys(items: np.ndarray, starts: np.ndarray, bands: int, band: int) -> np.ndarray:
    """A row for each set with the keys of its bands; ``starts`` are the first places of the sets, none empty."""
    factors = np.random.default_rng(SEED).integers(1 << 32, size=bands * band, dtype=np.uint32) | np.uint32(1)
    keys = np.empty((len(starts), bands), np.uint64)
    # Half of a hash orders a set as well, and takes a fraction of the time; equal halves cost a candidate at most.
    items = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    with np.errstate(over="ignore"):
        for k in range(bands):
            key = np.full(len(starts), k + 1, np.uint64)
            for factor in factors[k * band:(k + 1) * band]:
                key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + lowest(items, starts, factor)
            keys[:, k] = key ^ (key >> np.uint64(32))
    return keys.view(np.int64)


def signatures(sets: DataFrame, bands: int, band: int) -> DataFrame:
    """(c, range, n, keys): the number of items and the keys of the bands of all ``sets``, which have items."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch.column("items").value_lengths().to_numpy(), dtype=np.int64)
            at = 0
            while at < len(batch):
                # As many sets as stay in a core's cache, or one.
                done = ends[at - 1] if at else 0
                until = max(at + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
                part = batch.slice(at, until - at)
                starts = np.append(done, ends[at:until - 1]) - done
                keys = band_keys(part.column("items").flatten().to_numpy().view(np.uint64), starts, bands, band)
                listed = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * bands, keys.ravel())
                sizes = pa.array(np.diff(np.append(done, ends[at:until])))
                yield pa.RecordBatch.from_arrays([part.column("c"), part.column("range"), sizes, listed], ["c", "range", "n", "keys"])
                at = until

    return sets.select("c", "range", "items").mapInArrow(of_batches, "c long, range long, n long, keys array<long>")


def similar_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose sorted sets ``items`` and ``others`` are similar."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, n), (y, m) = ((batch.column(c).flatten().to_numpy(), batch.column(c).value_lengths().to_numpy().astype(np.int64)) for c in ("items", "others"))
            shared = np.empty(len(batch), np.int64)
            to_x, to_y = np.cumsum(n), np.cumsum(m)
            for k, (a, b, c, d) in enumerate(zip((to_x - n).tolist(), to_x.tolist(), (to_y - m).tolist(), to_y.tolist(), strict=True)):
                both = np.concatenate([x[a:b], y[c:d]])
                both.sort()
                shared[k] = np.count_nonzero(both[1:] == both[:-1])
            yield batch.select(["a", "b"]).filter(pa.array(100 * shared >= percent * (n + m - shared)))

    return pairs.select("a", "b", "items", "others").mapInArrow(of_batches, "a long, b long")


def pair_links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the similar among the classes that share a bucket (bucket, c, n)."""
    x = buckets.select("bucket", F.col("c").alias("a"), "n")
    y = buckets.select("bucket", F.col("c").alias("b"), F.col("n").alias("other_n"))
    # Sets of too different sizes are told before any set is moved.
    near = x.join(y, "bucket").filter("a < b").filter(100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n"))
    pairs = near.select("a", "b").distinct()
    one = sets.select(F.col("c").alias("a"), "items")
    two = sets.select(F.col("c").alias("b"), F.col("items").alias("others"))
    return similar_pairs(pairs.join(one, "a").join(two, "b"), percent)


def pivot_links(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of the groups (grp, c, n, items) with their pivots, and the members that may have others."""
    chosen = members.groupBy("grp").agg(F.min("c").alias("pivot"))
    sets = members.select(F.col("c").alias("pivot"), F.col("n").alias("other_n"), F.col("items").alias("others"))
    pivots = checkpointed(chosen.join(sets, "pivot"))
    seen = members.join(F.broadcast(pivots) if pivots.agg(F.sum("other_n")).first()[0] < 1 << 20 else pivots, "grp").filter("c <> pivot")
    seen = seen.select("grp", "c", "n", "items", "pivot", "other_n", shared_with("others"))
    seen = checkpointed(seen.withColumn("linked", similar(percent)).withColumn(
        "far", 1 - F.col("shared") / (F.col("n") + F.col("other_n") - F.col("shared"))))
    nearest = seen.filter("NOT linked").groupBy("grp").agg((F.min("far") - (100 - percent) / 100 - 1e-9).alias("from"))
    left = seen.join(broadcast_small(checkpointed(nearest)), "grp").filter("NOT linked OR far >= from")
    return seen.filter("linked").select(F.col("pivot").alias("a"), F.col("c").alias("b")), left.select("grp", "c", "n", "items")


def story_links(sets: DataFrame, percent: int, bands: int, band: int, paired: int, rounds: int) -> DataFrame:
    """(a, b): links that connect all similar classes (range, c, n, items) that share a bucket of their range."""
    keyed = checkpointed(signatures(sets, bands, band).select("c", "n", F.explode("keys").alias("key"), "range").select(
        "c", "n", F.xxhash64("key", "range").alias("bucket")))
    sizes = checkpointed(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.min("c").alias("hub")).filter("classes > 1"))
    small = keyed.join(sizes.filter(F.col("classes") <= paired).select("bucket"), "bucket")
    links = pair_links(small, sets, percent)
    # Buckets of very many classes are few; their classes are never dealt by the bucket.
    crowded = broadcast_small(sizes.filter(F.col("classes") > paired).select("bucket", "hub"))
    stars = checkpointed(keyed.join(crowded, "bucket").select(F.col("hub").alias("a"), F.col("c").alias("b")).distinct())
    if stars.isEmpty():
        return links
    members = checkpointed(components(stars).select(F.col("node").alias("c"), F.col("root").alias("grp")).join(
        sets.select("c", "n", "items"), "c"))
    for _ in range(rounds):
        found, left = pivot_links(members, percent)
        links, members = links.unionByName(found), checkpointed(left)
        if members.isEmpty():
            return links
    rest = keyed.join(crowded.select("bucket"), "bucket").join(members.select("c"), "c", "left_semi").select("bucket", "c", "n")
    return links.unionByName(pair_links(rest, members, percent))


def similar_stories(
    articles: DataFrame, range_days: int = RANGE_DAYS, width: int = WIDTH, percent: int = PERCENT,
    bands: int = BANDS, band: int = BAND, paired: int = PAIRED, rounds: int = ROUNDS,
) -> DataFrame:
    """(id, range, day, story_id, story_size) of every article; a story is named by its smallest id.

    ``range`` numbers the stretches of ``range_days`` days since 1970.
    """
    rows = spread(articles.select("id", told_at().alias("at"), "original_summary")).select(
        "id", day_of(F.col("at")).alias("day"), "original_summary")
    rows = rows.withColumn("range", F.floor(F.col("day") / range_days).cast("long"))
    rows = checkpointed(word_sets(rows, "original_summary", width))
    if not rows.groupBy("id").count().filter("count > 1").isEmpty():
        rows = checkpointed(rows.dropDuplicates(["id"]))
    worded = rows.filter("n > 0")
    classes = worded.groupBy("range", "digest").agg(F.min("id").alias("c"))
    sets = checkpointed(worded.join(classes.select(F.col("c").alias("id")), "id", "left_semi").select(
        F.col("id").alias("c"), "range", "n", "items"))
    roots = components(story_links(sets, percent, bands, band, paired, rounds))
    named = checkpointed(classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select(
        "range", "digest", F.coalesce("root", "c").alias("story_id")))
    same = rows["range"].eqNullSafe(named["range"]) & (rows["digest"] == named["digest"]) & (rows["n"] > 0)
    told = rows.join(named, same, "left").select(
        rows["id"], rows["range"], "day", F.coalesce("story_id", rows["id"]).alias("story_id"))
    sizes = told.groupBy(F.col("story_id").alias("s")).agg(F.count(F.lit(1)).alias("story_size"))
    several = broadcast_small(checkpointed(sizes.filter("story_size > 1")))
    sized = told.join(several, F.col("story_id") == F.col("s"), "left")
    return sized.select("id", "range", "day", "story_id", F.coalesce("story_size", F.lit(1)).cast("long").alias("story_size"))


def story_days(stories: DataFrame) -> DataFrame:
    """(story_id, day, articles) of every story of more than one article, with a row for each day from its first to its last."""
    told = stories.filter("story_size > 1 AND day IS NOT NULL")
    counts = told.groupBy("story_id", "day").agg(F.count(F.lit(1)).alias("articles"))
    spans = counts.groupBy("story_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = spans.select("story_id", F.explode(F.sequence("first", "last")).alias("day"))
    return days.join(counts, ["story_id", "day"], "left").select("story_id", "day", F.coalesce("articles", F.lit(0)).cast("long").alias("articles"))


def trending_stories(stories: DataFrame, trailing: int = TRAILING_DAYS, top: int = TOP) -> DataFrame:
    """(day, rank, story_id, articles, day_before, trailing_sum, rise) of the ``top`` stories that rise most on each day.

    ``rise`` is ``trailing`` times the day's articles less those of the ``trailing`` days
    before, so it compares the day with their mean in whole numbers. Ties fall to more
    articles, then to the smaller story. Ranks are cut before rows of a day come together.
    """
    by_story = Window.partitionBy("story_id").orderBy("day")
    before = F.coalesce(F.sum("articles").over(by_story.rowsBetween(-trailing, -1)), F.lit(0))
    counted = story_days(stories).select(
        "day", "story_id", "articles", F.coalesce(F.lag("articles").over(by_story), F.lit(0)).cast("long").alias("day_before"),
        before.cast("long").alias("trailing_sum"))
    rising = counted.withColumn("rise", trailing * F.col("articles") - F.col("trailing_sum")).filter("rise > 0")
    order = Window.partitionBy("day").orderBy(F.desc("rise"), F.desc("articles"), "story_id")
    return rising.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).select(
        "day", "rank", "story_id", "articles", "day_before", "trailing_sum", "rise")
