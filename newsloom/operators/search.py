"""Ranked search over an inverted index.

The index has a posting for each word of an article: the word, its folder (by hash), the
article's id, the number of its uses and the article's length in words; beside it one row
says how many articles there are and how long they are in all. A query reads only the
folders of its words, ranks by BM25, and pages by (score, id): the next page begins behind
the last row shown, so no page needs an offset. The text of a page is read for its rows
alone.

Scores are whole millionths, summed over the words, so they do not depend on the order of
the sum. A word's share of articles and the mean length are those of the whole index.
Words are runs of letters and digits, without case. A query without words finds nothing;
repeated words count once. An article without words has no posting and is counted as
empty. Rows that repeat an id are counted as one article with their words together; rows
without an id have no posting and are counted as one article.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.operators.extract import words_of
from newsloom.operators.sizing import broadcast_small, spread
from newsloom.session import checkpointed

FOLDERS = 64
#: Tasks that a folder's words are dealt to.
SPLITS = 8
K, B = 1.2, 0.75
POSTINGS = "word string, id long, uses long, length long, folder int"
TOTALS = "articles long, words long"


def folder_of(word: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(folders)).cast("int")


def uses_of(words: Column) -> Column:
    """The different words of an article with the number of their uses, without shuffling its words."""
    def of_sorted(words: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda k: (k == 0) | (F.get(words, k - 1) != F.get(words, k)))
        return let(starts, lambda starts: F.transform(starts, lambda start, k: F.struct(
            F.get(words, start).alias("word"), (F.coalesce(F.get(starts, k + 1), F.size(words)) - start).cast("long").alias("uses"))))

    none = F.array().cast("array<struct<word:string,uses:bigint>>")
    return F.when(F.size(words) > 0, let(F.sort_array(words), of_sorted)).otherwise(none)


def build_index(articles: DataFrame, path: str, folders: int = FOLDERS) -> str:
    """Writes the index of (id, title, original_summary) below ``path``.

    Words are counted inside their row, so only postings are shuffled, and once; rows that
    repeat an id are found by the ids alone, and what they use is added up apart.
    """
    ids = checkpointed(articles.groupBy("id").agg(F.count(F.lit(1)).alias("rows")))
    repeated = broadcast_small(checkpointed(ids.filter("rows > 1 AND id IS NOT NULL").select("id")))
    worded = words_of(F.concat_ws(" ", "title", "original_summary"))
    counted = F.explode(F.array(let(worded, lambda words: F.struct(F.size(words).cast("long").alias("length"), uses_of(words).alias("used")))))
    rows = spread(articles).filter("id IS NOT NULL").select("id", counted.alias("counted")).select("id", "counted.*")
    used = rows.join(repeated, "id", "left_anti").select("id", "length", F.explode("used").alias("one")).select("one.word", "id", "one.uses", "length")
    if not repeated.isEmpty():
        again = rows.join(repeated, "id", "left_semi")
        lengths = again.groupBy("id").agg(F.sum("length").alias("length"))
        summed = again.select("id", F.explode("used").alias("one")).groupBy("id", "one.word").agg(F.sum("one.uses").alias("uses"))
        used = used.unionByName(summed.join(lengths, "id").select("word", "id", "uses", "length"))
    postings = used.withColumn("folder", folder_of(F.col("word"), folders))
    # All rows of a word are in one file, in order.
    dealt = postings.repartition("folder", F.pmod(F.hash("word"), F.lit(SPLITS)))
    dealt.sortWithinPartitions("folder", "word", "id").write.partitionBy("folder").parquet(f"{path}/postings")
    # An article without an id has no posting, but its words count.
    unnamed = articles.filter("id IS NULL").select(F.size(worded).alias("uses"))
    words = articles.sparkSession.read.schema(POSTINGS).parquet(f"{path}/postings").select("uses").unionByName(unnamed)
    totals = ids.agg(F.count(F.lit(1)).alias("articles")).crossJoin(words.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("words")))
    totals.withColumn("folders", F.lit(folders)).coalesce(1).write.parquet(f"{path}/totals")
    return path


def millionths(uses: Column, length: Column, articles: Column, words: Column, holders: Column) -> Column:
    """The BM25 score of one word in an article, in whole millionths."""
    rare = F.log(1 + (articles - holders + 0.5) / (holders + 0.5))
    often = uses * (K + 1) / (uses + K * (1 - B + B * length * articles / words))
    return F.floor(rare * often * 1_000_000).cast("long")


def postings_of(spark: SparkSession, path: str, query: str) -> DataFrame:
    """The postings of the words of a query; only their folders are read."""
    words = spark.range(1).select(words_of(F.lit(query)).alias("words")).select(F.explode(F.array_distinct("words")).alias("word"))
    totals = spark.read.parquet(f"{path}/totals").first()
    found = words.select("word", folder_of(F.col("word"), totals["folders"]).alias("folder")).collect()
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    asked = F.col("folder").isin(sorted({r["folder"] for r in found})) & F.col("word").isin(sorted(r["word"] for r in found))
    return postings.filter(asked)


def ranked(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(id, score) of all articles that have a word of the query."""
    postings = postings_of(spark, path, query)
    totals = spark.read.schema(TOTALS).parquet(f"{path}/totals").first()
    # One row for each word of the query.
    holders = F.broadcast(postings.groupBy("word").agg(F.count(F.lit(1)).alias("holders")))
    share = millionths(F.col("uses"), F.col("length"), F.lit(totals["articles"]), F.lit(totals["words"]), F.col("holders"))
    return postings.join(holders, "word").groupBy("id").agg(F.sum(share).alias("score"))


def ranked_page(
    spark: SparkSession, path: str, query: str, articles: DataFrame, size: int, after: tuple[int, int] | None = None,
    columns: Iterable[str] = ("link", "title", "published_at"),
) -> DataFrame:
    """(id, score, columns) of a page, best first; ``after`` is (score, id) of the last row shown."""
    rows = ranked(spark, path, query)
    if after is not None:
        rows = rows.filter((F.col("score") < after[0]) | ((F.col("score") == after[0]) & (F.col("id") > after[1])))
    page = rows.orderBy(F.desc("score"), "id").limit(size)
    shown = articles.select("id", *columns).join(F.broadcast(page), "id")
    return shown.select("id", "score", *columns).orderBy(F.desc("score"), "id")
