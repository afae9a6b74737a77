"""Editorial filters, scores, tags, votes, paging, editions and exports.

Every operator is a column expression, a narrow aggregate or a top-k; none moves the
article text but the final page or export. Terms match as whole words, without case.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.dates import published_timestamp
from newsloom.functions.text import names_any
from newsloom.operators.queues import newest_first, take
from newsloom.operators.sizing import broadcast_small
from newsloom.session import checkpointed

# The planned lists of terms.
TITLE_BLACKLIST = ("giveaway", "sponsored", "opinion")
KEYWORD_GROUPS = (
    (3, ("AI", "machine learning", "genAI", "LLM", "OpenAI")),
    (2, ("startup", "release", "tool", "integration")),
    (-5, ("deal", "coupon", "rumor")),
)
CATEGORIES = {
    "ai": ("AI", "GenAI", "OpenAI", "Claude"),
    "product": ("product", "tooling", "ecosystem"),
    "regulation": ("regulation", "ethics", "privacy"),
    "infra": ("infra", "API", "APIs", "models"),
}
DAILY, TWICE_DAILY = "1 day", "12 hours"
VOTE_STEP = 0.1


def by_tag_and_weight(
    sources: DataFrame, tags: list[str] | None = None, min_weight: float | None = None
) -> DataFrame:
    """Sources with one of the tags and at least the weight; a source without a weight weighs 1."""
    if tags is not None:
        wanted = F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags]))
        sources = sources.filter(F.coalesce(wanted, F.lit(False)))
    if min_weight is not None:
        sources = sources.filter(F.coalesce("weight", F.lit(1.0)) >= min_weight)
    return sources


def without_titles(articles: DataFrame, terms: Iterable[str] = TITLE_BLACKLIST) -> DataFrame:
    return articles.filter(~names_any(F.col("title"), terms))


def at_least(articles: DataFrame, characters: int) -> DataFrame:
    return articles.filter(F.coalesce(F.length("original_summary"), F.lit(0)) >= characters)


def not_older(articles: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Articles published within ``days`` before ``as_of``; one without a date is kept."""
    published = published_timestamp(F.col("published_at"))
    return articles.filter(published.isNull() | (published >= as_of - F.make_interval(days=F.lit(days))))


def keyword_score(groups: Iterable[tuple[int, Iterable[str]]] = KEYWORD_GROUPS) -> Column:
    """Sum of the weights of the groups that title or text name; each group counts once."""
    text = F.concat_ws(" ", "title", "original_summary")
    return sum((F.when(names_any(text, terms), weight).otherwise(0) for weight, terms in groups), F.lit(0)).cast("long")


def best_scored(
    articles: DataFrame, limit: int, groups: Iterable[tuple[int, Iterable[str]]] = KEYWORD_GROUPS
) -> DataFrame:
    scored = articles.select("id", "link", keyword_score(groups).alias("score"))
    return take(scored.orderBy(F.desc("score"), "id"), limit)


def category_tags(categories: Mapping[str, Iterable[str]] = CATEGORIES) -> Column:
    """The names of all categories an article belongs to, in order of name."""
    text = F.concat_ws(" ", "title", "original_summary")
    tags = [F.when(names_any(text, terms), F.lit(name)) for name, terms in sorted(categories.items())]
    return F.array_compact(F.array(*tags))


def voted_weights(sources: DataFrame, votes: DataFrame, step: float = VOTE_STEP) -> DataFrame:
    """(name, weight): weights moved by the balance of votes (source_name, vote of 1 or -1); never below 0."""
    balance = votes.groupBy(F.col("source_name").alias("name")).agg(F.sum("vote").alias("balance"), F.count("vote").alias("votes"))
    share = F.when(F.col("votes") > 0, F.col("balance") / F.col("votes")).otherwise(F.lit(0.0))
    weight = F.coalesce("weight", F.lit(1.0)) + F.lit(step) * F.coalesce(share, F.lit(0.0))
    return sources.join(balance, "name", "left").select("name", F.greatest(weight, F.lit(0.0)).alias("weight"))


#: Parts of a whole that shares are counted in, the weight of a vote of today, and days after which it is worth half.
MILLION, FULL_VOTE, HALF_LIFE = 1_000_000, 1024, 30


def smoothed_votes(votes: DataFrame, as_of: Column, half_life: int = HALF_LIFE) -> DataFrame:
    """(name, share): the share of up votes of each source in millionths, drawn to that of all sources.

    ``votes`` has source_name, vote (1 or -1) and voted_at; a vote loses half its weight with
    each ``half_life`` days. How strongly a source is drawn to the overall share follows from
    all sources: as many votes are added as make the chance of a single vote equal to what
    the sources really differ by, beyond what chance alone would give. All of it is whole
    numbers. Votes without a source, a time or a value do not count.
    """
    age = F.greatest(F.floor((F.unix_seconds(as_of) - F.unix_seconds("voted_at")) / 86_400), F.lit(0))
    weight = F.call_function("shiftright", F.lit(FULL_VOTE), F.least(F.floor(age / half_life), F.lit(30)).cast("int")).cast("long")
    usable = votes.filter("source_name IS NOT NULL AND vote IS NOT NULL AND voted_at IS NOT NULL").withColumn("weight", weight)
    by_source = checkpointed(usable.filter("weight > 0").groupBy(F.col("source_name").alias("name")).agg(
        F.sum("weight").alias("n"), F.sum(F.when(F.col("vote") > 0, F.col("weight")).otherwise(0)).alias("up")))
    total = by_source.agg(F.sum("n").alias("n"), F.sum("up").alias("up"), F.count(F.lit(1)).alias("sources")).first()
    if not total["sources"]:
        return by_source.select("name", F.lit(0).cast("long").alias("share"))
    overall = MILLION * total["up"] // total["n"]
    div = lambda a, b: F.call_function("div", a, b)
    away = div(MILLION * F.col("up"), F.col("n")) - overall
    spread = by_source.agg(F.sum(div(F.col("n") * div(away * away, F.lit(MILLION)), F.lit(FULL_VOTE))).alias("spread")).first()["spread"]
    # In millionths: what one vote differs by, what sources differ by, and what of that is chance.
    single = overall * (MILLION - overall) // MILLION
    seen = spread * FULL_VOTE // total["n"]
    chance = single * FULL_VOTE * total["sources"] // total["n"]
    prior = single * FULL_VOTE // max(seen - chance, 1)
    return by_source.select("name", div(MILLION * F.col("up") + F.lit(prior * overall), F.col("n") + F.lit(prior)).alias("share"))


def smoothed_weights(sources: DataFrame, votes: DataFrame, as_of: Column, half_life: int = HALF_LIFE) -> DataFrame:
    """(name, weight): weights times one half for a source voted down only, up to one and a half; unchanged without votes."""
    shares = smoothed_votes(votes, as_of, half_life)
    factor = F.coalesce((MILLION + 2 * F.col("share")) / (2 * MILLION), F.lit(1.0))
    return sources.join(shares, "name", "left").select("name", (F.coalesce("weight", F.lit(1.0)) * factor).alias("weight"))


def best_weighted(
    articles: DataFrame, weights: DataFrame, limit: int, groups: Iterable[tuple[int, Iterable[str]]] = KEYWORD_GROUPS
) -> DataFrame:
    """(id, link, score): the articles with the best keyword score times the weight (name, weight) of their source."""
    scored = articles.select("id", "link", "source_name", keyword_score(groups).alias("points"))
    named = scored.join(broadcast_small(weights.withColumnRenamed("name", "source_name")), "source_name", "left")
    score = F.col("points") * F.coalesce("weight", F.lit(1.0))
    return take(named.select("id", "link", score.alias("score")).orderBy(F.desc("score"), "id"), limit)


def search_page(
    articles: DataFrame, terms: Iterable[str], size: int, after: tuple[str, int] | None = None
) -> DataFrame:
    """A page of the matching articles, newest first; ``after`` is (published_at, id) of the last row shown.

    Paging by key needs no offset: each page is one filter and a top-k. Articles without
    a date come last, under the key ("", id).
    """
    text = F.concat_ws(" ", "title", "original_summary")
    dated = articles.filter(names_any(text, terms)).withColumn("at", F.coalesce("published_at", F.lit("")))
    if after is not None:
        dated = dated.filter((F.col("at") < after[0]) | ((F.col("at") == after[0]) & (F.col("id") > after[1])))
    return dated.orderBy(F.desc("at"), "id").limit(size).select("id", "link", "title", "published_at")


def editions(articles: DataFrame, size: int, every: str = TWICE_DAILY) -> DataFrame:
    """(edition, rank, id): the newest articles of each edition, by the time they were fetched."""
    dated = articles.select("id", "published_at", "fetched_at", F.window("fetched_at", every)["start"].alias("edition"))
    order = Window.partitionBy("edition").orderBy(*newest_first("published_at"))
    return dated.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size).select("edition", "rank", "id")


def unsent_relevant(articles: DataFrame, limit: int = 10) -> DataFrame:
    """Relevant articles that were not sent, with or without a summary, newest first."""
    unsent = articles.filter(F.col("is_ai_relevant") & F.col("sent_in_newsletter_at").isNull())
    return take(unsent.orderBy(*newest_first("published_at")), limit).select("id", "link", "title", "llm_summary", "published_at")


def markdown_item() -> Column:
    """One list item of a Markdown export."""
    title = F.regexp_replace(F.coalesce("title", F.lit("")), r"([\[\]\\])", r"\\$1")
    return F.concat(F.lit("- ["), title, F.lit("]("), F.coalesce("link", F.lit("")), F.lit("): "), F.coalesce("llm_summary", F.lit("")))


def json_item(nulls: bool = False) -> Column:
    """One line of a JSON export; with ``nulls`` every line has all fields."""
    fields = F.struct("id", "link", "title", "source_name", "published_at", "llm_summary")
    return F.to_json(fields, {"ignoreNullFields": str(not nulls).lower()})
