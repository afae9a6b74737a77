"""Exports as files of JSON lines or Markdown, committed by a manifest.

The articles are numbered in the order of a digest, newest first, and dealt to files of
at most ``rows`` lines each. The files are written below a folder of the export's key, and
the manifest (file, first, lines, digest) after them. An export counts once its manifest
is there: asked for again under its key it is returned as it is and nothing is written,
and one that broke off is written anew. So every file is either part of a whole export or
of none.

A title or text with a line end keeps it as a space in Markdown and escaped in JSON, so a
line is an article. An empty table gives an export without files.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.editorial import json_item, markdown_item
from newsloom.operators.insertion import with_dense_ids
from newsloom.operators.queues import newest_first

ROWS = 100_000
KINDS = {"json": lambda: json_item(nulls=True), "markdown": markdown_item}
MANIFEST = "file long, first long, lines long, digest string"
LINES = "file long, rank long, line string"


def folder_of(path: str, key: str) -> str:
    return f"{path}/export={quote(key, safe='')}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def lines_of(articles: DataFrame, kind: str, rows: int) -> DataFrame:
    """(file, rank, line) of every article."""
    line = F.regexp_replace(KINDS[kind](), r"[\r\n]+", " ")
    listed = articles.select(F.col("id").alias("article_id"), "published_at", "fetched_at", line.alias("line"))
    numbered = with_dense_ids(listed, newest_first("published_at", "article_id"), start=1).withColumnRenamed("id", "rank")
    return numbered.select(F.floor((F.col("rank") - 1) / rows).cast("long").alias("file"), "rank", "line")


def digest_of(lines: DataFrame) -> DataFrame:
    """(file, first, lines, digest): one row for each file."""
    each = F.xxhash64("rank", "line").cast("decimal(38,0)")
    return lines.groupBy("file").agg(
        F.min("rank").alias("first"), F.count(F.lit(1)).alias("lines"), F.sum(each).cast("string").alias("digest"))


def export(articles: DataFrame, path: str, key: str, kind: str = "json", rows: int = ROWS) -> DataFrame:
    """Writes an export once and returns its manifest."""
    spark, folder = articles.sparkSession, folder_of(path, key)
    if not exists(spark, f"{folder}/manifest"):
        lines = lines_of(articles, kind, rows)
        dealt = lines.repartitionByRange("file").sortWithinPartitions("file", "rank")
        # One text file for each number; the rank orders them and is the place of the line.
        dealt.select("file", "line").write.mode("overwrite").partitionBy("file").option("compression", "none").text(f"{folder}/files")
        digest_of(lines).coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def read_export(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(file, rank, line) of a whole export, from its files."""
    folder = folder_of(path, key)
    manifest = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    files = spark.read.schema("value string, file long").text(f"{folder}/files", wholetext=True)
    lines = files.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("place", "line"))
    return lines.join(F.broadcast(manifest.select("file", "first")), "file").select(
        "file", (F.col("first") + F.col("place")).alias("rank"), "line")


def broken_files(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The files of an export that differ from its manifest."""
    manifest = spark.read.schema(MANIFEST).json(f"{folder_of(path, key)}/manifest")
    now = digest_of(read_export(spark, path, key)).select("file", F.col("digest").alias("found"))
    return manifest.join(now, "file", "left").filter(~F.col("digest").eqNullSafe(F.col("found"))).select("file")
