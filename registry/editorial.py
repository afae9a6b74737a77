"""Registered queries of the editorial operators, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.operators import editorial, export, inference, rules, search
from newsloom.operators.extract import words_of
from newsloom.session import shared_folder
from newsloom.streaming import editions
from registry import inputs
from registry import oracle_inputs as S
from registry.oracle_inputs import quoted

GROUPS = ((3, ("license", "licensed")), (2, ("token", "the")), (-5, ("der", "copyright notice")))
CATEGORIES = {"law": ("license", "copyright"), "german": ("der", "und"), "keys": ("token", "key")}
TITLE_TERMS = ("the", "und")
TERMS = ("license", "the")
MIDDLE = inputs.PUBLISHED_START + inputs.PUBLISHED_SPAN
QUERY = "the license of the token"
BEST_SHOWN = (4_000_000, 0)
PROFILE = "An engineer who cares for licenses and open tools, and not for adverts."
HALF_LIFE = 7
LAST_SHOWN = ("2025-06-20 00:00:00", 0)


def _votes(spark, sf_dir):
    """A vote for each label: up for quality, down for what is toxic."""
    sources = inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_name"))
    vote = F.when(F.col("toxic") == 1, -1).when(F.col("quality") == 1, 1)
    return inputs.table(spark, sf_dir, "labels").join(sources, "doc_id").select("source_name", vote.alias("vote"))


def b1(spark, sf_dir):
    found = editorial.by_tag_and_weight(inputs.sources(spark, sf_dir), ["src1", "src2", "src3", "src7"], 1.0)
    return found.select("source_ordinal", "name", "weight")


def b2(spark, sf_dir):
    return editorial.without_titles(inputs.articles(spark, sf_dir), TITLE_TERMS).select("id", "title")


def b3(spark, sf_dir):
    return editorial.at_least(inputs.articles(spark, sf_dir), 1500).select("id", "link")


def b4(spark, sf_dir):
    as_of = F.timestamp_seconds(F.lit(MIDDLE))
    return editorial.not_older(inputs.articles(spark, sf_dir), as_of, 10).select("id", "published_at")


def b5(spark, sf_dir):
    return editorial.best_scored(inputs.articles(spark, sf_dir), -1, GROUPS)


def b5_top(spark, sf_dir):
    return editorial.best_scored(inputs.articles(spark, sf_dir), 25, GROUPS)


def b6(spark, sf_dir):
    tags = F.array_join(editorial.category_tags(CATEGORIES), ",")
    return inputs.articles(spark, sf_dir).select("id", tags.alias("tags"))


def b8(spark, sf_dir):
    return editorial.voted_weights(inputs.sources(spark, sf_dir), _votes(spark, sf_dir))


def _dated_votes(spark, sf_dir):
    """The same votes, each given when its document was published."""
    sources = inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_name"))
    vote = F.when(F.col("toxic") == 1, -1).when(F.col("quality") == 1, 1)
    return inputs.table(spark, sf_dir, "labels").join(sources, "doc_id").select(
        "source_name", vote.alias("vote"), inputs.published_ts(F.col("doc_id")).alias("voted_at"))


def _smoothed(spark, sf_dir):
    as_of = F.timestamp_seconds(F.lit(inputs.PUBLISHED_START + inputs.PUBLISHED_SPAN))
    return editorial.smoothed_weights(inputs.sources(spark, sf_dir), _dated_votes(spark, sf_dir), as_of, HALF_LIFE)


def b6_rules(spark, sf_dir):
    """Every pair of words of the benchmark names its item's category, for some items from one source only."""
    item = F.col("item_id")
    words = inputs.table(spark, sf_dir, "benchmark").select(item, words_of(F.col("text")).alias("words")).filter(F.size("words") > 1)
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.array_join(F.slice("words", i, 2), " "))
    source = F.when(item % 3 == 0, F.concat(F.lit("src"), (item % 20).cast("string")))
    table = words.select(F.concat(F.lit("c"), (item % 5).cast("string")).alias("category"), F.explode(pairs).alias("phrase"), source.alias("source"))
    return rules.tagged(inputs.articles(spark, sf_dir), table).select("id", F.array_join("tags", ",").alias("tags"))


def b8_smoothed(spark, sf_dir):
    return _smoothed(spark, sf_dir)


def b8_weighted(spark, sf_dir):
    return editorial.best_weighted(inputs.articles(spark, sf_dir), _smoothed(spark, sf_dir), 25, GROUPS)


def b9_profile(spark, sf_dir):
    """What a second pass asks for a reader's profile."""
    summaries = inputs.articles(spark, sf_dir).filter("is_ai_relevant AND llm_summary IS NOT NULL")
    again = summaries.select("link", "title", F.col("llm_summary").alias("original_summary"))
    return inference.relevance_requests(again, inference.profile_prompts(PROFILE)).select("request_id", "system_prompt", "prompt")


def b10_json(spark, sf_dir):
    folder = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    export.export(inputs.articles(spark, sf_dir), folder, "all", rows=300)
    return export.read_export(spark, folder, "all")


def b11_ranked(spark, sf_dir):
    """The second page of a search, by an index of all articles."""
    articles = inputs.articles(spark, sf_dir)
    path = search.build_index(articles, f"{shared_folder(spark)}/search-{uuid.uuid4().hex}")
    return search.ranked_page(spark, path, QUERY, articles, 20, BEST_SHOWN)


def b9(spark, sf_dir):
    """The summaries of relevant articles, judged once more."""
    summaries = inputs.articles(spark, sf_dir).filter("is_ai_relevant AND llm_summary IS NOT NULL")
    again = summaries.select("link", "title", F.col("llm_summary").alias("original_summary"))
    return inference.classify(again, inference.term_model(TERMS)).select("link", "is_ai_relevant")


def b10(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select("id", editorial.markdown_item().alias("item"))


def b11(spark, sf_dir):
    return editorial.search_page(inputs.articles(spark, sf_dir), TERMS, 20, LAST_SHOWN)


def b12(spark, sf_dir):
    found = editorial.editions(inputs.articles(spark, sf_dir), 15)
    return found.select(F.unix_seconds("edition").alias("edition_s"), F.col("rank").cast("long").alias("rank"), "id")


def b12_streamed(spark, sf_dir):
    """The same editions, from a stream of the articles as they were landed."""
    folder = f"{shared_folder(spark)}/editions-{uuid.uuid4().hex}"
    columns = inputs.articles(spark, sf_dir).select("id", "published_at", "fetched_at")
    columns.write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(columns.schema).parquet(f"{folder}/landed")
    editions.start_editions(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return editions.current_editions(spark, f"{folder}/out").select(F.col("edition").alias("edition_s"), "rank", "id")


def b13(spark, sf_dir):
    return editorial.unsent_relevant(inputs.articles(spark, sf_dir))


EDITORIAL = {
    "B1_sources_by_tag": b1, "B2_title_blacklist": b2, "B3_minimum_length": b3, "B4_age_cutoff": b4,
    "B5_keyword_score": b5, "B5_top_scored": b5_top, "B6_category_tags": b6, "B8_voted_weights": b8,
    "B9_second_pass": b9, "B10_markdown": b10, "B11_search_page": b11, "B12_editions": b12,
    "B6_rules": b6_rules, "B8_smoothed": b8_smoothed, "B8_weighted_scores": b8_weighted, "B9_profile_prompts": b9_profile,
    "B10_json": b10_json, "B11_ranked_search": b11_ranked, "B12_streamed_editions": b12_streamed, "B13_unsent_relevant": b13,
}


def _names(text: str, terms) -> str:
    words = "|".join(t.replace(" ", r"\s+") for t in terms)
    return rf"coalesce(regexp_matches(lower({text}), '(^|[^\p{{L}}\p{{N}}])({words})([^\p{{L}}\p{{N}}]|$)'), false)"


_TEXT = "concat_ws(' ', title, original_summary)"
_SCORE = " + ".join(f"CASE WHEN {_names(_TEXT, terms)} THEN {weight} ELSE 0 END" for weight, terms in GROUPS)
_TAGS = ", ".join(f"CASE WHEN {_names(_TEXT, terms)} THEN '{name}' END" for name, terms in sorted(CATEGORIES.items()))
_NEWEST = "ORDER BY published_at DESC NULLS LAST, fetched_s DESC NULLS LAST, id"


def _articles(sql: str) -> str:
    """A query over the articles, or further named tables and a query."""
    return f"WITH {S.ARTICLES}{sql if sql.startswith(',') else ' ' + sql}"


EDITORIAL_SQL = {
    "B1_sources_by_tag": f"""WITH {S.SOURCES} SELECT source_ordinal, name, weight FROM sources
WHERE name IN ('src1', 'src2', 'src3', 'src7') AND weight >= 1.0""",
    "B2_title_blacklist": _articles(f"SELECT id, title FROM articles WHERE NOT {_names('title', TITLE_TERMS)}"),
    "B3_minimum_length": _articles("SELECT id, link FROM articles WHERE length(original_summary) >= 1500"),
    "B4_age_cutoff": _articles(f"""SELECT id, published_at FROM articles
WHERE published_at IS NULL OR {inputs.PUBLISHED_START} + (id * 7919) % {inputs.PUBLISHED_SPAN} >= {MIDDLE} - 10 * 86400"""),
    "B5_keyword_score": _articles(f"SELECT id, link, CAST({_SCORE} AS BIGINT) AS score FROM articles"),
    "B5_top_scored": _articles(f"""SELECT id, link, CAST({_SCORE} AS BIGINT) AS score FROM articles
ORDER BY score DESC, id LIMIT 25"""),
    "B6_category_tags": _articles(f"SELECT id, concat_ws(',', {_TAGS}) AS tags FROM articles"),
    "B8_voted_weights": f"""WITH {S.SOURCES}, balance AS (
  SELECT d.source AS name, sum(CASE WHEN l.toxic = 1 THEN -1 WHEN l.quality = 1 THEN 1 END) AS balance,
    count(CASE WHEN l.toxic = 1 THEN -1 WHEN l.quality = 1 THEN 1 END) AS votes
  FROM labels l JOIN documents d USING (doc_id) GROUP BY 1)
SELECT s.name, greatest(s.weight + CAST(0.1 AS DOUBLE) * coalesce(
    CASE WHEN votes > 0 THEN CAST(balance AS DOUBLE) / CAST(votes AS DOUBLE) END, 0), 0) AS weight
FROM sources s LEFT JOIN balance b USING (name)""",
    "B9_second_pass": _articles(f"""SELECT link, {_names("concat_ws(' ', title, llm_summary)", TERMS)} AS is_ai_relevant
FROM articles WHERE is_ai_relevant AND llm_summary IS NOT NULL"""),
    "B10_markdown": _articles(r"""SELECT id, '- [' || regexp_replace(title, '([\[\]\\])', '\\\1', 'g') || '](' || link || '): '
  || coalesce(llm_summary, '') AS item FROM articles"""),
    "B11_search_page": _articles(f"""SELECT id, link, title, published_at FROM articles
WHERE {_names(_TEXT, TERMS)} AND (coalesce(published_at, '') < {quoted(LAST_SHOWN[0])}
  OR coalesce(published_at, '') = {quoted(LAST_SHOWN[0])} AND id > {LAST_SHOWN[1]})
ORDER BY coalesce(published_at, '') DESC, id LIMIT 20"""),
    "B12_editions": _articles(f"""SELECT edition_s, rank, id FROM (
  SELECT fetched_s - fetched_s % 43200 AS edition_s, id,
    row_number() OVER (PARTITION BY fetched_s - fetched_s % 43200 {_NEWEST}) AS rank FROM articles)
WHERE rank <= 15"""),
    "B13_unsent_relevant": _articles(f"""SELECT id, link, title, llm_summary, published_at FROM articles
WHERE is_ai_relevant AND sent_s IS NULL {_NEWEST} LIMIT 10"""),
}

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"

_SMOOTHED = f"""votes AS (
  SELECT d.source AS name, CASE WHEN l.toxic = 1 THEN -1 WHEN l.quality = 1 THEN 1 END AS vote,
    ({inputs.PUBLISHED_SPAN} - (doc_id * 7919) % {inputs.PUBLISHED_SPAN}) // 86400 AS age
  FROM labels l JOIN documents d USING (doc_id)
), weighed AS (
  SELECT name, vote, {editorial.FULL_VOTE} >> least(age // {HALF_LIFE}, 30)::INT AS weight FROM votes WHERE vote IS NOT NULL AND name IS NOT NULL
), by_source AS (
  SELECT name, sum(weight)::BIGINT AS n, sum(CASE WHEN vote > 0 THEN weight ELSE 0 END)::BIGINT AS up FROM weighed WHERE weight > 0 GROUP BY name
), total AS (
  SELECT sum(n)::BIGINT AS n, 1000000 * sum(up)::BIGINT // sum(n)::BIGINT AS overall, count(*) AS sources FROM by_source
), parts AS (
  SELECT overall * (1000000 - overall) // 1000000 AS single,
    (SELECT sum(b.n * ((1000000 * b.up // b.n - overall) * (1000000 * b.up // b.n - overall) // 1000000) // {editorial.FULL_VOTE})::BIGINT FROM by_source b)
      * {editorial.FULL_VOTE} // n AS seen, n, overall, sources FROM total
), prior AS (
  SELECT overall, single * {editorial.FULL_VOTE} // greatest(seen - single * {editorial.FULL_VOTE} * sources // n, 1) AS prior FROM parts
), smoothed AS (
  SELECT name, (1000000 * up + prior * overall) // (n + prior) AS share FROM by_source, prior
), weights AS (
  SELECT s.name, s.weight * coalesce((1000000 + 2 * share)::DOUBLE / 2000000::DOUBLE, 1.0::DOUBLE) AS weight FROM sources s LEFT JOIN smoothed USING (name)
)"""

EDITORIAL_SQL |= {
    "B6_rules": _articles(rf""", items AS (
  SELECT 'c' || item_id % 5 AS category, CASE WHEN item_id % 3 = 0 THEN 'src' || item_id % 20 END AS source, {_WORDS.format('text')} AS words FROM benchmark
), rules AS (
  SELECT DISTINCT category, source, list_slice(words, i, i + 1) AS pair FROM (SELECT *, unnest(range(1, len(words))) AS i FROM items)
), pairs AS (
  SELECT DISTINCT id, source_name, list_slice(words, i, i + 1) AS pair
  FROM (SELECT *, unnest(range(1, len(words))) AS i FROM (SELECT id, source_name, {_WORDS.format(_TEXT)} AS words FROM articles))
), found AS (
  SELECT DISTINCT id, category FROM pairs JOIN rules USING (pair) WHERE source IS NULL OR source = source_name
)
SELECT id, coalesce((SELECT string_agg(category, ',' ORDER BY category) FROM found WHERE found.id = articles.id), '') AS tags FROM articles"""),
    "B8_smoothed": f"WITH {S.SOURCES}, {_SMOOTHED} SELECT name, weight FROM weights",
    "B8_weighted_scores": _articles(f""", {S.SOURCES}, {_SMOOTHED}
SELECT id, link, CAST({_SCORE} AS BIGINT) * coalesce(weight, 1.0::DOUBLE) AS score FROM articles LEFT JOIN weights ON name = source_name
ORDER BY score DESC, id LIMIT 25"""),
    "B9_profile_prompts": _articles(f"""SELECT link AS request_id, {quoted(inference.PROFILE_SYSTEM_PROMPT)} AS system_prompt,
  {quoted(inference.PROFILE_QUESTION + PROFILE)} || chr(10) || chr(10) || 'Title: ' || left(title, {C.RELEVANCE_TITLE_CHARS}) || chr(10) || 'Summary: '
  || CASE WHEN length(llm_summary) > {C.RELEVANCE_TEXT_CHARS} THEN left(llm_summary, {C.RELEVANCE_TEXT_CHARS}) || {quoted(C.RELEVANCE_TEXT_MARKER)} ELSE llm_summary END AS prompt
FROM articles WHERE is_ai_relevant AND llm_summary IS NOT NULL"""),
    "B10_json": _articles(f"""SELECT (rank - 1) // 300 AS file, rank, line FROM (
  SELECT row_number() OVER ({_NEWEST}) AS rank,
    to_json(struct_pack(id := id, link := link, title := title, source_name := source_name, published_at := published_at, llm_summary := llm_summary))::VARCHAR AS line
  FROM articles)"""),
    "B11_ranked_search": _articles(rf""", used AS (
  SELECT id, word, count(*) AS uses FROM (SELECT id, unnest({_WORDS.format(_TEXT)}) AS word FROM articles) GROUP BY ALL
), lengths AS (
  SELECT id, len({_WORDS.format(_TEXT)}) AS length FROM articles
), total AS (
  SELECT count(*) AS articles, sum(length)::BIGINT AS words FROM lengths
), asked AS (
  SELECT DISTINCT unnest(string_split({quoted(QUERY)}, ' ')) AS word
), met AS (
  SELECT id, uses, length, count(*) OVER (PARTITION BY word) AS holders FROM used JOIN asked USING (word) JOIN lengths USING (id)
), shares AS (
  SELECT id, CAST(floor(ln(1.0::DOUBLE + (articles - holders + 0.5::DOUBLE) / (holders + 0.5::DOUBLE))
    * (uses * {search.K + 1}::DOUBLE / (uses + {search.K}::DOUBLE * ({1 - search.B}::DOUBLE + {search.B}::DOUBLE * length * articles / words))) * 1000000) AS BIGINT) AS share
  FROM met, total
), scores AS (
  SELECT id, sum(share)::BIGINT AS score FROM shares GROUP BY id
)
SELECT id, score, link, title, published_at FROM scores JOIN articles USING (id)
WHERE score < {BEST_SHOWN[0]} OR score = {BEST_SHOWN[0]} AND id > {BEST_SHOWN[1]} ORDER BY score DESC, id LIMIT 20"""),
}

EDITORIAL_SQL["B12_streamed_editions"] = EDITORIAL_SQL["B12_editions"]
