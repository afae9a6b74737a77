"""Landed feed files as one entry table.

Files land below ``<root>/feed_url=<url-encoded feed url>/``, so the feed of an
entry comes from partition discovery and ``feeds`` prunes folders. The entries of a read
are numbered once and written to the shared folder: the number depends on how files were
packed into splits, so it must not be made twice. Items that cannot be parsed are kept
apart (:func:`rejected_items`) and do not stop a read.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.dates import feed_timestamp
from newsloom.session import checkpointed

_CORRUPT = "_corrupt_record"

_RSS = (
    "link STRING, guid STRUCT<_VALUE: STRING, _isPermaLink: STRING>, title STRING, "
    "pubDate STRING, description STRING, "
    "`content:encoded` STRING, feed_url STRING, " + _CORRUPT + " STRING"
)
_ATOM_TEXT = "STRUCT<_VALUE: STRING, _type: STRING>"
_ATOM = (
    "link ARRAY<STRUCT<_href: STRING, _rel: STRING>>, "
    f"title {_ATOM_TEXT}, published STRING, updated STRING, summary {_ATOM_TEXT}, content ARRAY<{_ATOM_TEXT}>, "
    f"feed_url STRING, {_CORRUPT} STRING"
)


_KINDS = {"rss": ("item", _RSS), "atom": ("entry", _ATOM)}


def parsed_items(
    spark: SparkSession, path: str, kind: str, feeds: list[str] | None = None
) -> DataFrame:
    """The items of landed files, of some feeds only; a malformed item fills one column alone."""
    row_tag, schema = _KINDS[kind]
    items = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .schema(schema)
        .load(path)
    )
    return items if feeds is None else items.filter(F.col("feed_url").isin(feeds))


def rejected_items(
    spark: SparkSession, path: str, kind: str, feeds: list[str] | None = None
) -> DataFrame:
    """(feed_url, record): the items that could not be parsed."""
    # The reader gives the record only beside another column.
    items = parsed_items(spark, path, kind, feeds).select("feed_url", "title", _CORRUPT)
    rejected = checkpointed(items).filter(F.col(_CORRUPT).isNotNull())
    return rejected.select("feed_url", F.col(_CORRUPT).alias("record"))


def rejected_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("feed_url").agg(F.count(F.lit(1)).alias("rejected"))


def _entries(df: DataFrame, **columns: Column) -> DataFrame:
    """Entry schema, written once; ordinals grow in file order and are unique across the read."""
    typed = [
        columns.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in schemas.FEED_ENTRIES
        if field.name not in ("feed_url", "entry_ordinal")
    ]
    entries = df.filter(F.col(_CORRUPT).isNull()).select(
        "feed_url", F.monotonically_increasing_id().alias("entry_ordinal"), *typed
    )
    return checkpointed(entries)


def read_rss(spark: SparkSession, path: str, feeds: list[str] | None = None) -> DataFrame:
    """RSS items; one without a link takes its guid, unless that is no permanent link."""
    df = parsed_items(spark, path, "rss", feeds)
    permanent = F.lower(F.coalesce("guid._isPermaLink", F.lit("true"))) != "false"
    guid = F.when(permanent, F.trim("guid._VALUE"))
    encoded = F.col("`content:encoded`")
    item = F.struct(F.lit("text/html").alias("type"), encoded.alias("value"))
    return _entries(
        df,
        link=F.coalesce(F.nullif(F.trim("link"), F.lit("")), guid),
        title=F.col("title"),
        published=F.col("pubDate"),
        published_parsed=feed_timestamp(F.col("pubDate")),
        summary=F.col("description"),
        description=F.col("description"),
        content=F.when(encoded.isNotNull(), F.array(item)),
    )


def read_atom(spark: SparkSession, path: str, feeds: list[str] | None = None) -> DataFrame:
    """Atom entries; one without a published date takes the date of its update."""
    df = parsed_items(spark, path, "atom", feeds)
    published = F.coalesce("published", "updated")
    main = F.filter("link", lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    return _entries(
        df,
        link=F.get(main, F.lit(0))["_href"],
        title=F.col("title._VALUE"),
        published=published,
        published_parsed=feed_timestamp(published),
        summary=F.col("summary._VALUE"),
        description=F.lit(None),
        content=F.transform(
            "content",
            lambda item: F.struct(
                F.when(item["_type"] == "text", "text/plain")
                .when(item["_type"].isin("html", "xhtml"), "text/html")
                .otherwise(F.coalesce(item["_type"], F.lit("text/plain"))).alias("type"),
                item["_VALUE"].alias("value"),
            ),
        ),
    )


def read_landed_entries(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Entries some collector already wrote in the declared schema (Parquet, JSON, ORC)."""
    return spark.read.schema(schemas.FEED_ENTRIES).format(file_format).load(path)


def stream_landed_entries(
    spark: SparkSession, path: str, file_format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schemas.FEED_ENTRIES).format(file_format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def landing_folder(root: str, feed_url: str) -> str:
    """Folder in which the files of a feed have to land."""
    return f"{root.rstrip('/')}/feed_url={quote(feed_url, safe='')}"
