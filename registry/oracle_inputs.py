"""DuckDB twins of ``registry.inputs`` and of the text functions, as SQL text."""

from __future__ import annotations

from newsloom import constants as C
from registry import inputs


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SPACE = quoted(C.WHITESPACE)

_HIDDEN = "|".join(rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>" for tag in ("script", "style", "template"))
_NODE_SEPARATOR = rf"""(?is)<!--.*?-->|{_HIDDEN}|<[a-z/!?](?:[^>"']|"[^"]*"|'[^']*')*>"""
_NOT_CONTENT = "|".join(
    rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"
    for tag in ("script", "style", "template", "head", "nav", "aside", "footer", "form")
)


def strip(expression: str) -> str:
    return f"trim({expression}, {SPACE})"


def unescaped(expression: str) -> str:
    """Character references by name, with or without their semicolon.

    Only the names that occur in the test pages are known; numeric references do not occur.
    """
    name = "regexp_extract(p, '^[a-zA-Z][a-zA-Z0-9]*', 0)"
    rest = "regexp_replace(p, '^[a-zA-Z][a-zA-Z0-9]*;?', '')"
    known = " ".join(
        f"WHEN '{known}' THEN '{character}' || {rest}"
        for known, character in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&"))
    )
    decoded = f"CASE {name} WHEN '' THEN '&' || p {known} ELSE '&' || {name} || {rest} END"
    pieces = f"string_split({expression}, '&')"
    return f"{pieces}[1] || array_to_string(list_transform({pieces}[2:], lambda p: {decoded}), '')"


def html_to_text(expression: str) -> str:
    nodes = f"regexp_split_to_array({expression}, {quoted(_NODE_SEPARATOR)})"
    texts = f"list_transform({nodes}, lambda n: {strip(unescaped('n'))})"
    return f"coalesce(array_to_string(list_filter({texts}, lambda t: t <> ''), ' '), '')"


def article_text(expression: str) -> str:
    """The article element without what is not content; every test page has one."""
    noise = rf"(?is)<!--.*?-->|{_NOT_CONTENT}|<div class=\"ad\">.*?</div\s*>"
    content = f"regexp_replace({expression}, {quoted(noise)}, ' ', 'g')"
    return html_to_text(rf"regexp_extract({content}, '(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>', 1)")


def escaped(expression: str) -> str:
    for raw, safe in C.HTML_ESCAPES:
        expression = f"replace({expression}, {quoted(raw)}, {quoted(safe)})"
    return expression


def first_sentence(expression: str) -> str:
    return f"split_part({expression}, '.', 1)"


_STAMP = f"epoch_ms(({inputs.PUBLISHED_START} + (d.doc_id * 7919) % {inputs.PUBLISHED_SPAN}) * 1000)"
_LINK = "'https://news.example/' || d.source || '/' || CAST(d.doc_id AS VARCHAR)"
_FETCHED = f"({inputs.FETCHED_START} + d.doc_id // 50)"
_SUMMARIZED = f"l.quality = 1 AND d.n_chars >= {inputs.SUMMARIZED_CHARS}"

ARTICLES = f"""articles AS (
  SELECT d.doc_id AS id,
    {_LINK} AS link,
    coalesce(nullif(trim(split_part(d.text, chr(10), 1)), ''), {quoted(C.DEFAULT_TITLE)}) AS title,
    d.source AS source_name,
    d.text AS original_summary,
    CASE WHEN d.lang = 'es' THEN NULL
         WHEN d.lang = 'de' THEN strftime({_STAMP}, '%a, %d %b %Y %H:%M:%S GMT')
         ELSE strftime({_STAMP}, '%Y-%m-%d %H:%M:%S') END AS published_at,
    {_FETCHED} AS fetched_s,
    l.quality = 1 AS is_ai_relevant,
    CASE WHEN l.quality = 1 THEN {quoted(C.PRIMARY_MODEL)} END AS ai_filter_model_used,
    CASE WHEN {_SUMMARIZED} THEN split_part(d.text, '.', 1) || '.' END AS llm_summary,
    CASE WHEN {_SUMMARIZED} AND d.lang = 'fr'
         THEN CAST(epoch(TIMESTAMP '2025-07-02 00:00:00') AS BIGINT) END AS sent_s
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

SOURCES = f"""sources AS (
  SELECT CAST(substring(source, 4) AS BIGINT) AS source_ordinal, source AS name,
    'https://news.example/' || source || '/feed' AS url,
    'AI,' || source AS tags,
    CAST(0.5 + (CAST(substring(source, 4) AS BIGINT) % 4) * 0.5 AS DOUBLE) AS weight,
    CAST(substring(source, 4) AS BIGINT) < {inputs.ENABLED_SOURCES} AS enabled
  FROM (SELECT DISTINCT source FROM documents))"""

_HTML = "'<p>' || d.text || '</p>'"
FEED_ENTRIES = f"""feed_entries AS (
  SELECT 'https://news.example/' || d.source || '/feed' AS feed_url,
    d.doc_id AS entry_ordinal,
    CASE WHEN d.n_chars >= {inputs.LINKLESS_CHARS}
         THEN coalesce(p.url, 'https://news.example/' || md5(d.text)) END AS link,
    split_part(d.text, chr(10), 1) AS title,
    CASE WHEN d.lang = 'en' THEN strftime({_STAMP}, '%Y-%m-%d %H:%M:%S')
         ELSE strftime({_STAMP}, '%Y/%m/%d %H:%M') END AS published_at,
    CAST(epoch({_STAMP}) AS BIGINT) AS published_s,
    {_HTML} AS html
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""

OFFERED = f"""{SOURCES}, {FEED_ENTRIES}, offered AS (
  SELECT s.source_ordinal, s.name AS source_name, e.*
  FROM feed_entries e JOIN sources s ON s.url = e.feed_url AND s.enabled)"""

STORED = """stored AS (
  SELECT link, min(entry_ordinal) AS id FROM feed_entries
  WHERE link IS NOT NULL AND entry_ordinal IN (SELECT doc_id FROM labels) GROUP BY link)"""

ARRIVALS = f"""{OFFERED}, {STORED}, arrivals AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY link ORDER BY source_ordinal, entry_ordinal) AS nth
    FROM offered WHERE link <> '')
  WHERE nth = 1 AND link NOT IN (SELECT link FROM stored))"""

ALL_ARRIVALS = f"""{OFFERED}, arrivals AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY link ORDER BY source_ordinal, entry_ordinal) AS nth
    FROM offered WHERE link <> '')
  WHERE nth = 1)"""


_FIRST = "row_number() OVER (PARTITION BY link ORDER BY source_ordinal, entry_ordinal)"
_PLACE = "row_number() OVER (ORDER BY source_ordinal, entry_ordinal)"
#: The even entries first, then whatever link is new among all entries.
TWO_BATCHES = f"""batch_1 AS (
  SELECT *, 1 AS batch, {_PLACE} AS id FROM (
    SELECT *, {_FIRST} AS nth FROM offered WHERE link <> '' AND entry_ordinal % 2 = 0) WHERE nth = 1),
batch_2 AS (
  SELECT *, 2 AS batch, (SELECT count(*) FROM batch_1) + {_PLACE} AS id FROM (
    SELECT *, {_FIRST} AS nth FROM offered
    WHERE link <> '' AND link NOT IN (SELECT link FROM batch_1)) WHERE nth = 1),
batches AS (SELECT * FROM batch_1 UNION ALL SELECT * FROM batch_2)"""


def inserted(start: str) -> str:
    """Article rows of the arrivals with their page text, numbered from ``start``."""
    main, feed = article_text("p.html"), html_to_text("a.html")
    return f"""inserted AS (
  SELECT link, source_ordinal, entry_ordinal, {start} - 1
      + row_number() OVER (ORDER BY source_ordinal, entry_ordinal) AS id,
    {strip('title')} AS title, source_name,
    CASE WHEN length(main) < {C.FEED_FALLBACK_THRESHOLD} AND length(feed) > length(main)
         THEN feed ELSE main END AS original_summary,
    published_at
  FROM (SELECT a.*, {main} AS main, {feed} AS feed
        FROM arrivals a LEFT JOIN pages p ON p.url = a.link))"""


_FACT = f"""SELECT d.doc_id, d.lang, d.text, l.quality, {_LINK} AS link, {_FETCHED} AS fetched
  FROM documents d JOIN labels l USING (doc_id)"""

FACTS = f"""facts AS ({_FACT}),
relevance_facts AS (
  SELECT link, quality = 1 AS is_ai_relevant, 'm1' AS model,
    fetched + CASE WHEN lang = 'es' THEN -86400 ELSE 60 END AS decided FROM facts
  UNION ALL
  SELECT link, quality <> 1, 'm2', fetched + 120 FROM facts WHERE lang = 'en'),
summary_facts AS (
  SELECT link, split_part(text, '.', 1) || '.' AS llm_summary, 'm1' AS model,
    fetched + 180 AS decided FROM facts WHERE quality = 1
  UNION ALL
  SELECT link, upper(split_part(text, '.', 1) || '.'), 'm2', fetched + 240
  FROM facts WHERE quality = 1 AND lang = 'fr'),
sent_facts AS (
  SELECT doc_id AS article_id, CAST(epoch(CAST(stamp AS TIMESTAMP)) AS BIGINT) AS sent
  FROM facts, (VALUES ('2025-07-02 00:00:00'), ('2025-07-03 00:00:00')) marks(stamp)
  WHERE quality = 1 AND lang IN ('fr', 'de')),
latest_relevance AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY decided DESC) AS nth
                 FROM relevance_facts) WHERE nth = 1),
latest_summary AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY decided DESC) AS nth
                 FROM summary_facts) WHERE nth = 1),
first_sent AS (SELECT article_id AS id, min(sent) AS sent_s FROM sent_facts GROUP BY 1)"""

ATTEMPTS = """attempts AS (
  SELECT event_id // 4 AS request_id,
    CASE WHEN event_id % 4 = 3 THEN 'fallback' ELSE 'primary' END AS tier,
    event_id % 4 + 1 AS attempt,
    CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'view' THEN 400
                    ELSE 200 END AS status,
    CASE WHEN event_type IN ('click', 'purchase')
         THEN '{"choices":[{"message":{"content":" v' || user_id || ' "}}]}'
         WHEN event_type = 'signup'
         THEN '{"error":{"message":"Please try again in ' || user_id || '.5s"}}'
         ELSE '' END AS body
  FROM events),
read_attempts AS (
  SELECT *, CASE WHEN json_valid(body)
                 THEN trim(json_extract_string(body, '$.choices[0].message.content')) END AS content,
    CASE status WHEN 503 THEN 'server_error' WHEN 429 THEN 'rate_limited'
                WHEN 400 THEN 'rejected' ELSE 'success' END AS outcome_class,
    CASE WHEN json_valid(body) THEN TRY_CAST(trim(split_part(split_part(
      lower(json_extract_string(body, '$.error.message')), 'try again in ', 2), 's', 1))
      AS DOUBLE) + 0.5 END AS hint_s
  FROM attempts)"""

SENTENCES = r"""sentences AS (
  SELECT id, place - 1 AS place, sentences[place] AS sentence FROM (
    SELECT id, sentences, unnest(range(1, len(sentences) + 1)) AS place FROM (
      SELECT id, list_filter(list_transform(
        regexp_extract_all(original_summary, '[^.!?\n]+[.!?]*'),
        lambda s: trim(s, {space})), lambda s: s <> '') AS sentences FROM to_summarize))),
words AS (
  SELECT id, place, word FROM (
    SELECT id, place, unnest(regexp_split_to_array(lower(sentence), '[^\p{{L}}\p{{N}}]+')) AS word
    FROM sentences) WHERE word <> ''),
frequencies AS (SELECT id, word, count(*) AS frequency FROM words GROUP BY ALL),
scored AS (
  SELECT id, place, CAST(sum(frequency) AS DOUBLE) / count(*) AS score
  FROM words JOIN frequencies USING (id, word) GROUP BY ALL),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, place) AS nth
                 FROM scored) WHERE nth <= 2),
summaries AS (
  SELECT id, string_agg(sentence, ' ' ORDER BY place) AS summary
  FROM best JOIN sentences USING (id, place) GROUP BY id)""".format(space=SPACE)
