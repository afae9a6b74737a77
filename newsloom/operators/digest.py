"""Digest items and the digest document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions.dates import display_date
from newsloom.functions.text import escape_html

DIGEST_ITEM = ["title", "link", "source_name", "published_at_formatted", "llm_summary"]


def digest_items(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn(
        "published_at_formatted", display_date(F.col("published_at"))
    )


# The markup of an item, its head and its foot.
def item_html() -> Column:
    """Fragment of one item: linked heading, source and date line, summary, rule."""
    slot = {name: escape_html(F.col(name)) for name in DIGEST_ITEM}
    return F.concat(
        F.lit('<h2><a href="'), slot["link"], F.lit('">'), slot["title"], F.lit("</a></h2>\n"),
        F.lit("<p><em>"), slot["source_name"], F.lit(" • "), slot["published_at_formatted"],
        F.lit("</em></p>\n<p>"), slot["llm_summary"], F.lit("</p>\n<hr>\n"),
    )


def page_head(date: Column, brand: str) -> Column:
    name = escape_html(F.lit(brand))
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en">\n<head><meta charset="UTF-8"><title>'),
        name, F.lit(" Digest — "), escape_html(date),
        F.lit("</title></head>\n<body>\n<h1>"), name, F.lit(" Digest</h1>\n<div>"),
        escape_html(date), F.lit(f" — {C.DIGEST_TAGLINE}</div>\n"),
    )


def page_foot(brand: str) -> Column:
    return F.concat(
        F.lit("<footer>Delivered by "), escape_html(F.lit(brand)),
        F.lit("</footer>\n</body>\n</html>\n"),
    )


def digest_documents(
    items: DataFrame, date: Column | None = None, brand: str = "News"
) -> DataFrame:
    """One document per ``digest_id`` and part with its items in ``rank`` order.

    The fragments of one document meet in one row, so a long digest is cut into parts
    of a bounded number of items (column ``part``, one part where there is none). Each
    part has head and foot.
    """
    if "part" not in items.columns:
        items = items.withColumn("part", F.lit(0).cast("long"))
    date = date if date is not None else F.date_format(F.current_timestamp(), C.DATE_DISPLAY_FORMAT)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank"), item_html().alias("html"))))
    grouped = items.groupBy("digest_id", "part").agg(
        F.array_join(F.transform(ordered, lambda item: item["html"]), "").alias("body"),
        F.count(F.lit(1)).alias("items"),
    )
    return grouped.select(
        "digest_id", "part",
        F.concat(F.lit(f"{brand} Digest - "), date).alias("subject"),
        F.concat(page_head(date, brand), F.col("body"), page_foot(brand)).alias("html"),
        "items",
    )


def digest_fragments(candidates: DataFrame) -> DataFrame:
    """The item fragments as rows, in the order of ``candidates``; for a digest without a limit."""
    return digest_items(candidates).select("id", item_html().alias("html"))
