"""The same results in SQL, for the comparison with DuckDB."""

from __future__ import annotations

from newsloom import constants as C
from registry import inputs
from registry import oracle_inputs as S
from registry.editorial import EDITORIAL_SQL
from registry.stories import STORIES_SQL
from registry.oracle_inputs import quoted, strip

SMALL_BUDGET = 270


def _with(*tables: str) -> str:
    return "WITH " + ", ".join(tables) + " "


def _summary_input(budget: int) -> str:
    """``Title: …\\n\\nContent: …`` cut to the budget; the two labels take 18 characters."""
    return f"""SELECT id, 'Title: ' || t || chr(10) || chr(10) || 'Content: ' ||
  CASE WHEN length(x) + length(t) + 18 <= {budget} THEN x
       WHEN {budget} - 18 - length(t) > 0
       THEN substring(x, 1, {budget} - 18 - length(t)) || {quoted(C.SUMMARY_CONTENT_MARKER)}
       ELSE substring(x, 1, {C.SUMMARY_HEAVY_CHARS}) || {quoted(C.SUMMARY_HEAVY_MARKER)}
  END AS model_input, title, link
FROM (SELECT *, original_summary AS x,
        CASE WHEN length(title) > {C.SUMMARY_TITLE_CHARS}
             THEN substring(title, 1, {C.SUMMARY_TITLE_CHARS}) || {quoted(C.SUMMARY_TITLE_MARKER)}
             ELSE title END AS t FROM articles)"""


_RELEVANCE_TEXT = f"""CASE WHEN length(original_summary) > {C.RELEVANCE_TEXT_CHARS}
  THEN substring(original_summary, 1, {C.RELEVANCE_TEXT_CHARS}) || {quoted(C.RELEVANCE_TEXT_MARKER)}
  ELSE original_summary END"""
_RELEVANCE_TITLE = f"substring(title, 1, {C.RELEVANCE_TITLE_CHARS})"

_NEWEST = "ORDER BY published_at DESC NULLS LAST, fetched_s DESC, id"
_SUMMARY_QUEUE = f"""SELECT id, link, title, original_summary FROM articles
WHERE is_ai_relevant AND llm_summary IS NULL {_NEWEST}"""
_CANDIDATES = f"""SELECT id, link, title, llm_summary, source_name, published_at FROM articles
WHERE is_ai_relevant AND llm_summary IS NOT NULL AND sent_s IS NULL {_NEWEST}"""

_DISPLAY = """CASE WHEN coalesce(published_at, '') = '' THEN 'N/A' ELSE coalesce(
  strftime(coalesce(try_strptime(published_at, '%Y-%m-%d %H:%M:%S'),
                    try_strptime(published_at, '%a, %d %b %Y %H:%M:%S GMT')), '%B %d, %Y'),
  published_at) END"""

_ITEM = f"""'<h2><a href="' || {S.escaped('link')} || '">' || {S.escaped('title')} || '</a></h2>' || chr(10)
  || '<p><em>' || {S.escaped('source_name')} || ' • ' || {S.escaped('published_at_formatted')}
  || '</em></p>' || chr(10) || '<p>' || {S.escaped('llm_summary')} || '</p>' || chr(10)
  || '<hr>' || chr(10)"""
_ITEMS = f"""candidates AS ({_CANDIDATES}),
items AS (SELECT *, {_DISPLAY} AS published_at_formatted FROM candidates)"""

_HEAD = (
    '<!DOCTYPE html>\n<html lang="en">\n<head><meta charset="UTF-8"><title>Morning News Digest — '
    "July 04, 2025</title></head>\n<body>\n<h1>Morning News Digest</h1>\n<div>July 04, 2025 — "
    "AI highlights at a glance</div>\n"
)
_FOOT = "<footer>Delivered by Morning News</footer>\n</body>\n</html>\n"

_TERMS = "|".join(inputs.RELEVANCE_TERMS)
_IS_RELEVANT = (
    rf"regexp_matches(lower(concat_ws(' ', title, original_summary)), "
    rf"'(^|[^\p{{L}}\p{{N}}])({_TERMS})([^\p{{L}}\p{{N}}]|$)')"
)

_BACKOFF = "power(2.0, attempt - 1)"
_RETRYABLE = "('server_error', 'rate_limited')"

_RESOLVED = f"""{S.ATTEMPTS},
final AS (
  SELECT request_id, min(attempt) AS attempt FROM read_attempts
  WHERE tier = 'primary' AND attempt <= {C.MAX_RETRIES} AND outcome_class NOT IN {_RETRYABLE}
  GROUP BY 1),
tries AS (
  SELECT request_id, max(attempt) FILTER (tier = 'primary') AS last_try,
    max(content) FILTER (tier = 'fallback' AND outcome_class = 'success') AS fallback_content,
    max(status) FILTER (tier = 'fallback') AS fallback_status
  FROM read_attempts GROUP BY 1),
joined AS (
  SELECT t.*, f.attempt AS final_attempt, a.content AS primary_content
  FROM tries t LEFT JOIN final f USING (request_id)
  LEFT JOIN read_attempts a ON a.request_id = t.request_id AND a.attempt = f.attempt
    AND a.outcome_class = 'success')"""

_FALLBACK_HTTP = C.ERROR_FALLBACK_HTTP.replace("{model}", C.FALLBACK_MODEL).split("{status}")

ORACLE: dict[str, str] = {
    "A01_source_catalogue": _with(S.SOURCES) + """
SELECT source_ordinal, name, url, tags, weight FROM sources WHERE enabled""",

    "A02_rss_files": _with(S.FEED_ENTRIES) + f"""
SELECT feed_url, link, {strip('title')} AS title, published_s - 7200 AS published_s,
  {S.html_to_text('html')} AS feed_text FROM feed_entries""",

    "A02_atom_files": _with(S.FEED_ENTRIES) + f"""
SELECT feed_url, link, {strip('title')} AS title, published_s,
  {S.html_to_text('html')} AS feed_text FROM feed_entries""",

    "A02_rss_guid_links": _with(S.FEED_ENTRIES) + f"""
SELECT feed_url, CASE WHEN entry_ordinal % 3 <> 0 THEN link END AS link,
  {strip('title')} AS title FROM feed_entries""",

    "A03_entries_of_sources": _with(S.OFFERED) + """
SELECT source_ordinal, entry_ordinal, source_name, link, title FROM offered""",

    "A04_article_text": f"""
SELECT page_id, url, {S.article_text('html')} AS main_text FROM pages""",

    "A05_article_scan": _with(S.ARTICLES) + """
SELECT id, link, title, source_name, original_summary, published_at, fetched_s, is_ai_relevant,
  ai_filter_model_used, llm_summary, sent_s FROM articles""",

    "A06_inserted_sample": _with(S.ARTICLES) + f"""
SELECT id, title, source_name, length(original_summary) AS summary_len
FROM articles ORDER BY id DESC LIMIT {C.INSERTED_SAMPLE_SIZE}""",

    "A08_insert_if_new": _with(
        S.ARRIVALS, S.inserted("(SELECT max(id) + 1 FROM stored)")
    ) + """
SELECT link, source_ordinal, entry_ordinal, id, title, source_name, original_summary, published_at
FROM inserted""",

    "A09_latest_relevance": _with(S.FACTS) + """
SELECT link, is_ai_relevant, model AS ai_filter_model_used FROM latest_relevance""",

    "A09b_latest_summary": _with(S.FACTS) + """
SELECT link, llm_summary, model AS summarizer_model_used FROM latest_summary""",

    "A09c_first_sent": _with(S.FACTS) + "SELECT id, sent_s FROM first_sent",

    "A10_html_to_text": f"SELECT page_id, {S.html_to_text('html')} AS page_text FROM pages",

    "A11_entry_text": _with(S.FEED_ENTRIES) + f"""
SELECT entry_ordinal, {S.html_to_text('html')} AS feed_text FROM feed_entries""",

    "A12_best_text": f"""
SELECT doc_id, CASE WHEN length(main) < {C.FEED_FALLBACK_THRESHOLD} AND length(text) > length(main)
  THEN text ELSE main END AS original_summary
FROM (SELECT d.doc_id, d.text,
        CASE WHEN p.page_id IS NOT NULL THEN {S.article_text('p.html')}
             WHEN d.lang = 'en' THEN split_part(d.text, '.', 1) ELSE '' END AS main
      FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)""",

    "A13_clean_title": _with(S.FEED_ENTRIES) + f"""
SELECT entry_ordinal, {strip('title')} AS title FROM feed_entries""",

    "A14_published_at": _with(S.FEED_ENTRIES) + """
SELECT entry_ordinal, published_at FROM feed_entries""",

    "A15_relevance_input": _with(S.ARTICLES) + f"""
SELECT id, {_RELEVANCE_TITLE} AS title_input, {_RELEVANCE_TEXT} AS text_input FROM articles""",

    "A16_relevance_prompt": _with(S.ARTICLES) + f"""
SELECT id, {quoted(C.RELEVANCE_INSTRUCTION)} || chr(10) || 'Title: ' || {_RELEVANCE_TITLE}
  || chr(10) || chr(10) || 'Summary: ' || {_RELEVANCE_TEXT} || chr(10) || chr(10)
  || {quoted(C.RELEVANCE_QUESTION)} AS prompt FROM articles""",

    "A17_relevance_answer": f"""
SELECT conv_id, turn, coalesce(starts_with(lower({strip('response')}), 'yes'), false)
  AS is_ai_relevant
FROM (SELECT *, CASE WHEN role = 'user' THEN '  YES, ' || text WHEN turn > 2 THEN text END
        AS response FROM conversations)""",

    "A18_summary_input": _with(S.ARTICLES) + f"""
SELECT id, model_input FROM ({_summary_input(C.SUMMARY_MAX_INPUT_CHARS)})""",

    "A18_summary_input_small_budget": _with(S.ARTICLES) + f"""
SELECT id, model_input FROM ({_summary_input(SMALL_BUDGET)})""",

    "A19_summary_result": _with(S.ARTICLES) + f"""
SELECT id,
  CASE WHEN length(original_summary) < 150 THEN {quoted(C.SUMMARY_NO_CONTENT)}
       WHEN is_ai_relevant IS NULL
       THEN {quoted(C.SUMMARY_ERROR_PREFIX)} || 'no answer for ' || link || ']'
       ELSE {strip("split_part(original_summary, '.', 1)")} END AS llm_summary,
  CASE WHEN length(original_summary) < 150 THEN 'no_content'
       WHEN is_ai_relevant IS NULL THEN 'failed' ELSE 'ok' END AS summary_status
FROM articles""",

    "A20_display_date": _with(S.ARTICLES) + f"""
SELECT id, {_DISPLAY} AS published_at_formatted FROM articles""",

    "A21_escaped_fields": f"""
SELECT page_id, {S.escaped('url')} AS url_html, {S.escaped('html')} AS html_html FROM pages""",

    "A22_chat_request": _with(S.ARTICLES) + f"""
SELECT id, CAST(json_object(
  'model', {quoted(C.PRIMARY_MODEL)},
  'messages', json_array(
    json_object('role', 'system', 'content', {quoted(C.SUMMARY_SYSTEM_PROMPT)}),
    json_object('role', 'user', 'content',
      model_input || chr(10) || chr(10) || {quoted(C.SUMMARY_QUESTION)})),
  'temperature', CAST({C.TEMPERATURE} AS DOUBLE)) AS VARCHAR) AS request
FROM ({_summary_input(C.SUMMARY_MAX_INPUT_CHARS)})""",

    "A23_response_content": _with(S.ATTEMPTS) + """
SELECT request_id, attempt, content FROM read_attempts""",

    "A24_retry_hint": _with(S.ATTEMPTS) + f"""
SELECT request_id, attempt, coalesce(hint_s, {_BACKOFF}) AS wait_s FROM read_attempts""",

    "A25_relevance_backlog": _with(S.ARTICLES) + """
SELECT id, link, title, original_summary FROM articles
WHERE is_ai_relevant IS NULL ORDER BY fetched_s DESC, id""",

    "A26_summary_queue": _with(S.ARTICLES) + f"{_SUMMARY_QUEUE} LIMIT {C.SUMMARY_QUEUE_LIMIT}",

    "A26_summary_queue_unlimited": _with(S.ARTICLES) + _SUMMARY_QUEUE,

    "A27_digest_candidates": _with(S.ARTICLES) + f"""
SELECT *, {_DISPLAY} AS published_at_formatted
FROM ({_CANDIDATES} LIMIT {C.DIGEST_QUEUE_LIMIT})""",

    "A27_digest_candidates_unlimited": _with(S.ARTICLES) + _CANDIDATES,

    "A28_new_links": _with(S.ARRIVALS) + """
SELECT link, source_ordinal, entry_ordinal FROM arrivals""",

    "A29_current_articles": _with(S.ARTICLES, S.FACTS) + """
SELECT a.id, a.link, a.title, a.source_name, a.original_summary, a.published_at, a.fetched_s,
  CASE WHEN r.decided >= a.fetched_s THEN r.is_ai_relevant END AS is_ai_relevant,
  CASE WHEN r.decided >= a.fetched_s THEN r.model END AS ai_filter_model_used,
  CASE WHEN s.decided >= a.fetched_s THEN s.llm_summary END AS llm_summary,
  CASE WHEN s.decided >= a.fetched_s THEN s.model END AS summarizer_model_used,
  f.sent_s, false AS user_saved, false AS user_marked_interesting
FROM articles a LEFT JOIN latest_relevance r USING (link) LEFT JOIN latest_summary s USING (link)
LEFT JOIN first_sent f USING (id)""",

    "A30_not_yet_sent": _with(S.ARTICLES, S.FACTS) + """
SELECT id AS article_id FROM articles
WHERE is_ai_relevant AND id NOT IN (SELECT article_id FROM sent_facts)""",

    "A31_entries_per_source": _with(S.OFFERED) + """
SELECT source_ordinal, source_name, count(*) AS entries, count(link) AS linked
FROM offered GROUP BY ALL""",

    "A32_entry_page_text": _with(S.FEED_ENTRIES) + f"""
SELECT entry_ordinal, link, {S.article_text('p.html')} AS main_text
FROM feed_entries e LEFT JOIN pages p ON p.url = e.link""",

    "A33_ingest_stats": _with(S.ARRIVALS) + """
SELECT (SELECT count(*) FROM offered) AS total_items,
  (SELECT count(*) FROM arrivals) AS newly_added""",

    "A33_ingest_stats_by_source": _with(S.ARRIVALS) + """
SELECT source_name, count(*) AS total_items,
  count(*) FILTER ((source_ordinal, entry_ordinal) IN
    (SELECT (source_ordinal, entry_ordinal) FROM arrivals)) AS newly_added
FROM offered GROUP BY source_name""",

    "A34_relevance_stats": _with(S.ARTICLES) + """
SELECT count(is_ai_relevant) AS processed, count(*) FILTER (is_ai_relevant) AS retained
FROM articles""",

    "A35_stage_counts": _with(S.ARTICLES) + """
SELECT count(llm_summary) AS summarized, count(sent_s) AS sent FROM articles""",

    "A36_digest_document": _with(S.ARTICLES, _ITEMS) + f"""
SELECT '2025-07-04' AS digest_id, 'Morning News Digest - July 04, 2025' AS subject,
  {quoted(_HEAD)} || string_agg({_ITEM}, '' {_NEWEST.replace('fetched_s DESC, ', '')})
  || {quoted(_FOOT)} AS html, count(*) AS items
FROM (SELECT * FROM items {_NEWEST.replace('fetched_s DESC, ', '')} LIMIT {C.DIGEST_SIZE})""",

    "A36_digest_fragments": _with(S.ARTICLES, _ITEMS) + f"""
SELECT id, {_ITEM} AS html FROM items""",

    "A37_extractive_summary": _with(
        S.ARTICLES, "to_summarize AS (SELECT * FROM articles)", S.SENTENCES
    ) + "SELECT id, summary FROM summaries",

    "A37_summarize": _with(
        S.ARTICLES, f"to_summarize AS ({_SUMMARY_QUEUE})", S.SENTENCES
    ) + """
SELECT link, summary AS llm_summary, 'ok' AS summary_status, 'primary' AS provider_used,
  'extractive' AS model FROM summaries JOIN to_summarize USING (id)""",

    "A38_resolved_attempts": _with(_RESOLVED) + f"""
SELECT request_id,
  CASE WHEN primary_content IS NOT NULL THEN 'primary'
       WHEN fallback_content IS NOT NULL THEN 'fallback' ELSE 'failed' END AS outcome,
  coalesce(final_attempt, last_try) AS primary_tries,
  coalesce(primary_content, fallback_content, CASE WHEN fallback_status IS NULL
    THEN {quoted(C.ERROR_ALL_FAILED)}
    ELSE {quoted(_FALLBACK_HTTP[0])} || fallback_status || {quoted(_FALLBACK_HTTP[1])} END)
    AS response
FROM joined""",

    "A38_attempt_waits": _with(S.ATTEMPTS) + f"""
SELECT request_id, attempt, outcome_class,
  CASE WHEN tier <> 'primary' OR attempt >= {C.MAX_RETRIES} OR outcome_class NOT IN {_RETRYABLE}
       THEN CAST(0 AS DOUBLE) ELSE coalesce(hint_s, {_BACKOFF}) END AS wait_s
FROM read_attempts""",

    "A39_classify": _with(S.ARTICLES) + f"""
SELECT link, {_IS_RELEVANT} AS is_ai_relevant, {quoted(C.PRIMARY_MODEL)} AS model,
  'primary' AS provider_used, false AS failed
FROM articles WHERE is_ai_relevant IS NULL""",

    "A40_tiered_inference": _with(S.ARTICLES) + f"""
SELECT link AS request_id,
  CASE WHEN length(original_summary) < 1000 THEN {strip("' short: ' || title")}
       WHEN NOT contains(original_summary, ' der ') THEN {strip("'long: ' || title")}
       ELSE {quoted(C.ERROR_FALLBACK_OTHER.format(model=C.FALLBACK_MODEL, error='no answer'))}
  END AS response,
  CASE WHEN length(original_summary) < 1000 THEN 'primary'
       WHEN NOT contains(original_summary, ' der ') THEN 'fallback' END AS provider_used,
  length(original_summary) >= 1000 AND contains(original_summary, ' der ') AS failed
FROM articles""",

    "A41_incremental_ingest": _with(S.ALL_ARRIVALS, S.inserted("1")) + """
SELECT id, link, title, source_name, original_summary, published_at FROM inserted""",

    "A42_curation_run": _with(
        S.ALL_ARRIVALS, S.inserted("1"),
        f"decided AS (SELECT *, {_IS_RELEVANT} AS is_ai_relevant FROM inserted)",
        "to_summarize AS (SELECT * FROM decided WHERE is_ai_relevant)",
        S.SENTENCES,
    ) + f"""
SELECT d.id, d.link, d.title, d.original_summary, d.is_ai_relevant,
  {quoted(C.PRIMARY_MODEL)} AS ai_filter_model_used,
  s.summary AS llm_summary,
  CASE WHEN d.is_ai_relevant THEN 'extractive' END AS summarizer_model_used
FROM decided d LEFT JOIN summaries s USING (id)""",

    "A41_replayed_ingest": _with(S.OFFERED, S.TWO_BATCHES) + """
SELECT id, link, CASE WHEN batch = 1 THEN true END AS is_ai_relevant, batch = 1 AS sent
FROM batches""",

    "A42_second_run_same_key": _with(
        S.OFFERED, S.TWO_BATCHES,
        f"""stored_texts AS (
  SELECT id, link, {strip('title')} AS title, {S.html_to_text('html')} AS original_summary FROM batches)""",
    ) + f"""
SELECT id, link, title, {_IS_RELEVANT} AS is_ai_relevant FROM stored_texts""",

    **EDITORIAL_SQL,
    **STORIES_SQL,
}
