"""The index of stored links: hash folders, and bitmaps that say which of them to open.

A link belongs to one of ``FOLDERS`` folders by its hash. Two more hashes name bits in
the folder's bitmaps; only a folder in which both bits of an offered link are set is
opened, so of a batch of new links few are. A link found there names the batches that
announced it. It is announced before its article is written, so an announced link counts
as stored only if its batch really has it: bits that different links share, and a crash
between the two writes, change nothing. Bitmaps and links are appended; reading takes a
bit as set if any row has it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.sizing import broadcast_small
from newsloom.session import checkpointed

FOLDERS = 8
#: Bits of a folder's bitmaps.
BITS = 1 << 22
#: Bits of one bitmap row, as Spark's bitmap functions have them.
ROW_BITS = 32_768
LINKS, BITMAPS = "link string, batch_key string, folder int", "page long, bits binary, folder int"


def folder_of(link: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(folders)).cast("int")


def places_of(link: Column, bits: int) -> Column:
    """The two bits of a link, from 1 on."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(salt), link), F.lit(bits)) + 1 for salt in ("first", "second")])


def is_set(bits: Column, place: Column) -> Column:
    """Whether the bit at ``place`` (0 to ROW_BITS - 1) of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


class LinkIndex:
    def __init__(self, spark: SparkSession, root: str, folders: int = FOLDERS, bits: int = BITS):
        self.spark, self.root, self.folders, self.bits = spark, root, folders, bits

    def path(self, table: str) -> str:
        return f"{self.root}/link_index/{table}"

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path('bitmaps')}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def ensure(self) -> None:
        for table, schema in (("links", LINKS), ("bitmaps", BITMAPS)):
            self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy("folder").parquet(self.path(table))

    def links(self) -> DataFrame:
        return self.spark.read.schema(LINKS).parquet(self.path("links"))

    def bitmaps(self) -> DataFrame:
        return self.spark.read.schema(BITMAPS).parquet(self.path("bitmaps"))

    def announce(self, links: DataFrame) -> None:
        """Adds links (link, batch_key). Dealt by folder, so a folder gets one file from a batch of ordinary size."""
        dealt = checkpointed(links.select("link", "batch_key", folder_of(F.col("link"), self.folders).alias("folder")).repartition("folder"))
        places = dealt.select("folder", F.explode(places_of(F.col("link"), self.bits)).alias("place"))
        pages = places.groupBy("folder", F.bitmap_bucket_number("place").alias("page")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        pages.write.mode("append").partitionBy("folder").parquet(self.path("bitmaps"))
        dealt.select("link", "batch_key", "folder").write.mode("append").partitionBy("folder").parquet(self.path("links"))

    def suspects(self, offered: DataFrame) -> DataFrame:
        """(link, folder) of the offered links whose bits are set."""
        wanted = offered.select("link", folder_of(F.col("link"), self.folders).alias("folder"))
        wanted = wanted.select("link", "folder", F.explode(places_of(F.col("link"), self.bits)).alias("place"))
        paged = wanted.select("link", "folder", F.bitmap_bucket_number("place").alias("page"), F.bitmap_bit_position("place").alias("place"))
        # The small batch meets the bitmaps where these are read.
        met = self.bitmaps().join(broadcast_small(checkpointed(paged)), ["folder", "page"]).filter(is_set(F.col("bits"), F.col("place")))
        return met.groupBy("link", "folder").agg(F.count_distinct("page", "place").alias("met_bits")).join(
            wanted.groupBy("link").agg(F.count_distinct("place").alias("bits")), "link").filter("met_bits = bits").select("link", "folder")

    def announced(self, offered: DataFrame) -> tuple[DataFrame, list[int]]:
        """(link, batch_key) of the offered links that are announced, and the folders that were opened for them."""
        suspects = checkpointed(self.suspects(offered))
        folders = sorted(r["folder"] for r in suspects.select("folder").distinct().collect())
        opened = self.links().filter(F.col("folder").isin(folders))
        return opened.join(broadcast_small(suspects.select("link")), "link", "left_semi").select("link", "batch_key").distinct(), folders

    def known(self, offered: DataFrame, stored: DataFrame) -> DataFrame:
        """The offered links that ``stored`` (link, batch_key) has; only batches that announced one are read."""
        found, _ = self.announced(offered)
        found = checkpointed(found)
        batches = sorted(r["batch_key"] for r in found.select("batch_key").distinct().collect())
        rows = stored.filter(F.col("batch_key").isin(batches))
        return rows.join(broadcast_small(found.select("link").distinct()), "link", "left_semi").select("link")
