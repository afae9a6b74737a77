"""Raw pages: full-text extraction and the page that belongs to a link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import html_to_text, let

_NOT_CONTENT = "|".join(
    rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"
    for tag in ("script", "style", "template", "head", "nav", "aside", "footer")
)
_AD_OPEN = r"""<div\s[^>]*class\s*=\s*["']?(?:[^"'>]*\s)?(?:ad|ads|advert|advertisement|sponsored)(?:\s[^"'>]*)?["']?[^>]*>"""


def _inside_div(depth: int) -> str:
    """What may stand in a div whose own divs are nested up to ``depth`` deep."""
    plain = r"[^<]*+(?:<(?!/?div\b)[^<]*+)*+"
    if depth == 0:
        return plain
    return rf"{plain}(?:<div\b[^>]*+>{_inside_div(depth - 1)}</div\s*>{plain})*+"


_AD_BLOCK = rf"{_AD_OPEN}{_inside_div(4)}</div\s*>"
_NOISE = rf"(?is)<!--.*?-->|{_NOT_CONTENT}|{_AD_BLOCK}"
_ARTICLE = r"(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>"
_BLOCKS = "body|main|section|div|table|tbody|tr|td|ul|ol|li|dl|dt|dd|p|h[1-6]|blockquote|pre|form|figure|header"
_BEFORE_BLOCK = rf"(?i)(?=</?(?:{_BLOCKS})\b)"
_OPENS, _CLOSES = rf"(?i)^<(?:{_BLOCKS})\b", rf"(?i)^</(?:{_BLOCKS})\b"
_LINK = r"(?is)<a(?:\s[^>]*)?>(.*?)(?:</a\s*>|\z)"
#: What a block costs in characters, each character of link text, and a level of nesting between neighbours.
BLOCK_COST, LINK_COST, LEVEL_COST, MOST_LEVEL_COST = 20, 3, 5, 20


def _longest(parts: Column) -> Column:
    return F.aggregate(
        F.transform(parts, html_to_text), F.lit(""),
        lambda best, text: F.when(F.length(text) > F.length(best), text).otherwise(best),
    )


def _block(piece: Column) -> Column:
    """Text, length of its links and step of the depth of a piece that begins with a block tag."""
    links = F.array_join(F.regexp_extract_all(piece, F.lit(_LINK), F.lit(1)), " ")
    step = F.when(piece.rlike(_OPENS), 1).when(piece.rlike(_CLOSES), -1).otherwise(0)
    return F.struct(html_to_text(piece).alias("text"), F.length(html_to_text(links)).alias("linked"), step.alias("step"))


def _best_run(blocks: Column) -> Column:
    """Begin, end and score of the best run of neighbouring blocks.

    A block earns its text and pays for itself, for its links, and for how much deeper or
    less deep it lies than the one before. One fold keeps the depth, the run that ends here
    and the best one so far; a run that is worth nothing is dropped.
    """
    start = F.struct(*[F.lit(value).alias(name) for name, value in (
        ("at", 0), ("depth", 0), ("begin", 0), ("score", 0), ("level", 0), ("best_begin", 0), ("best_end", -1), ("best", 0))])

    def step(acc: Column, block: Column) -> Column:
        depth, size = acc["depth"] + block["step"], F.length(block["text"])
        empty = size == 0
        away = F.least(LEVEL_COST * F.abs(depth - acc["level"]), F.lit(MOST_LEVEL_COST))
        carried = acc["score"] - away
        goes_on = carried > 0
        begin = F.when(goes_on, acc["begin"]).otherwise(acc["at"])
        score = F.greatest(carried, F.lit(0)) + size - LINK_COST * block["linked"] - BLOCK_COST
        better = ~empty & (score > acc["best"])

        def unless_empty(new: Column, name: str) -> Column:
            return F.when(empty, acc[name]).otherwise(new).alias(name)

        return F.struct(
            (acc["at"] + 1).alias("at"), depth.alias("depth"), unless_empty(begin, "begin"), unless_empty(score, "score"),
            unless_empty(depth, "level"), F.when(better, begin).otherwise(acc["best_begin"]).alias("best_begin"),
            F.when(better, acc["at"]).otherwise(acc["best_end"]).alias("best_end"), F.when(better, score).otherwise(acc["best"]).alias("best"))

    return F.aggregate(blocks, start, step)


def densest_text(content: Column) -> Column:
    """The text of the best run of blocks, without those that are mostly links; the longest block if no run is worth anything."""
    pieces = F.split(content, _BEFORE_BLOCK)

    def of_run(blocks: Column, run: Column) -> Column:
        inside = F.slice(blocks, run["best_begin"] + 1, run["best_end"] - run["best_begin"] + 1)
        texts = F.filter(inside, lambda block: (block["text"] != "") & (2 * block["linked"] <= F.length(block["text"])))
        return F.when(run["best"] > 0, F.array_join(F.transform(texts, lambda block: block["text"]), " ")).otherwise(_longest(pieces))

    return let(F.transform(pieces, _block), lambda blocks: let(_best_run(blocks), lambda run: of_run(blocks, run)))


def article_text(html: Column) -> Column:
    """Main text of a page: its longest article element, else its densest run of blocks; "" when there is none."""
    content = F.regexp_replace(F.coalesce(html, F.lit("")), _NOISE, " ")

    def main_text(content: Column) -> Column:
        marked = _longest(F.regexp_extract_all(content, F.lit(_ARTICLE), F.lit(1)))
        return let(marked, lambda text: F.when(text != "", text).otherwise(densest_text(content)))

    return let(content, main_text)


def page_texts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", article_text(F.col("html")).alias("main_text"))


def attach_page_text(
    articles: DataFrame, pages: DataFrame, links: DataFrame | None = None
) -> DataFrame:
    """Left join of the newest page of each link, as ``main_text``.

    A url may have been fetched any number of times, so its newest copy is found
    on (url, page_id) alone, an aggregate that combines before its shuffle. Html
    is then keyed by (url, page_id), which spreads the copies of one url, and is
    cut to the wanted pages by a semi join first: for a small batch that is a
    broadcast filter inside the scan, for a large one the left join reuses its
    partitioning, so html moves at most once. A page is read once, before the join,
    however many articles have its url. Articles without a link, which would all share
    one key, stay out of the joins. ``links`` may name the links of ``articles`` when they
    are at hand more cheaply.
    """
    links = articles.select("link") if links is None else links
    newest = pages.groupBy(F.col("url").alias("link")).agg(F.max("page_id").alias("page_id"))
    wanted = newest.join(links, "link", "left_semi")
    key = ["link", "page_id"]
    html = pages.select(F.col("url").alias("link"), "page_id", "html").join(
        wanted, key, "left_semi"
    )
    texts = html.select(*key, article_text(F.col("html")).alias("main_text"))
    linked = (
        articles.filter("link IS NOT NULL").join(wanted, "link", "left")
        .join(texts, key, "left")
        .withColumn("main_text", F.coalesce("main_text", F.lit("")))
        .drop("page_id")
    )
    without = articles.filter("link IS NULL").withColumn("main_text", F.lit(""))
    return linked.unionByName(without)
