"""Registered queries of similar and trending stories, and their SQL."""

from __future__ import annotations

from newsloom.operators import stories
from registry import inputs
from registry import oracle_inputs as S


def similar(spark, sf_dir):
    return stories.similar_stories(inputs.articles(spark, sf_dir))


def trending(spark, sf_dir):
    return stories.trending_stories(similar(spark, sf_dir))


STORIES = {"B7_similar_stories": similar, "B7_trending_stories": trending}

# Sets are compared by a join on their shingles; stories are the closure of the links.
_STORIES = rf"""{S.ARTICLES}, told AS (
  SELECT id, CASE WHEN published_at IS NULL THEN fetched_s
      ELSE {inputs.PUBLISHED_START} + (id * 7919) % {inputs.PUBLISHED_SPAN} END // {stories.DAY} AS day,
    regexp_extract_all(lower(coalesce(original_summary, '')), '[\p{{L}}\p{{N}}]+') AS words
  FROM articles
), sets AS (
  SELECT DISTINCT id, day // {stories.RANGE_DAYS} AS range, unnest(CASE WHEN len(words) >= {stories.WIDTH}
      THEN list_transform(range(1, len(words) - {stories.WIDTH - 2}), lambda i: list_slice(words, i, i + {stories.WIDTH - 1}))
      WHEN len(words) > 0 THEN [words] ELSE [] END) AS shingle
  FROM told
), sizes AS (
  SELECT id, count(*) AS n FROM sets GROUP BY id
), pairs AS (
  SELECT x.id AS a, y.id AS b, count(*) AS shared
  FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.range = y.range AND x.id < y.id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b WHERE 100 * shared >= {stories.PERCENT} * (p.n + q.n - shared)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT id AS node, id AS seen FROM told UNION SELECT reach.node, edges.b FROM reach JOIN edges ON edges.a = reach.seen
), named AS (
  SELECT node AS id, min(seen) AS story_id FROM reach GROUP BY node
), stories AS (
  SELECT id, day // {stories.RANGE_DAYS} AS range, day, story_id, count(*) OVER (PARTITION BY story_id) AS story_size
  FROM named JOIN told USING (id)
)"""

STORIES_SQL = {
    "B7_similar_stories": f"WITH RECURSIVE {_STORIES} SELECT id, range, day, story_id, story_size FROM stories",
    "B7_trending_stories": f"""WITH RECURSIVE {_STORIES}, counts AS (
  SELECT story_id, day, count(*) AS articles FROM stories WHERE story_size > 1 GROUP BY ALL
), days AS (
  SELECT story_id, unnest(range(min(day), max(day) + 1)) AS day FROM counts GROUP BY story_id
), filled AS (
  SELECT story_id, day, coalesce(articles, 0) AS articles FROM days LEFT JOIN counts USING (story_id, day)
), counted AS (
  SELECT *, coalesce(lag(articles) OVER w, 0) AS day_before,
    coalesce(sum(articles) OVER (PARTITION BY story_id ORDER BY day ROWS BETWEEN {stories.TRAILING_DAYS} PRECEDING AND 1 PRECEDING), 0)::BIGINT AS trailing_sum
  FROM filled WINDOW w AS (PARTITION BY story_id ORDER BY day)
), rising AS (
  SELECT *, {stories.TRAILING_DAYS} * articles - trailing_sum AS rise FROM counted
)
SELECT day, rank, story_id, articles, day_before, trailing_sum, rise FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY rise DESC, articles DESC, story_id) AS rank FROM rising WHERE rise > 0)
WHERE rank <= {stories.TOP}""",
}
