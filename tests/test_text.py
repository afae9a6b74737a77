"""Exact texts: cleaning, truncation, prompts, dates."""

import pytest
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions import chat, dates, text
from newsloom.operators import entries
from newsloom.sources.pages import article_text


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


def test_html_to_text(spark):
    cases = {
        "<p>Hi <b>there</b></p>": "Hi there",
        "a &amp; b &#8217; &#x41; &copy; &nosuch; &#150;": "a & b ’ A © &nosuch –",
        "AT&T &amp &lt;b&gt; &apos; &": "AT&T & <b> ' &",
        "&#55555; &#0099; &#99999999999999999999999;": "� c �",
        "x<!-- <p>no</p> -->y<script>var t='</p>';</script>z": "x y z",
        "<style>p{}</style><template>t</template>k": "k",
        "a < b and c > d": "a < b and c > d",
        "<a title='a>b' href=\"q\">link</a>   end ": "link end",
        "<p>a\n b</p>\n<br/>c": "a\n b c",
        "<!DOCTYPE html><?xml v?>t": "t",
        "": "",
        None: "",
        "plain": "plain",
    }
    assert apply(spark, cases, text.html_to_text) == list(cases.values())


def test_long_attribute_and_unclosed_markup_do_not_break(spark):
    image = "<img src=\"data:" + "A" * 200_000 + "\">ok"
    unclosed = "<p title=" + "x'" * 20_001 + " tail"
    assert apply(spark, [image], text.html_to_text) == ["ok"]
    assert apply(spark, [unclosed], text.html_to_text)[0].endswith("tail")


def test_strip_is_the_python_strip(spark):
    values = ["\t\n a b 　", "\x1c\x85x ", "​kept​", "   ", ""]
    assert apply(spark, values, text.strip) == [value.strip() for value in values]


def test_escape(spark):
    assert apply(spark, ["<a href=\"x\">'&'</a>", None], text.escape_html) == [
        "&lt;a href=&#34;x&#34;&gt;&#39;&amp;&#39;&lt;/a&gt;", "",
    ]


ENTRY = "content array<struct<type:string,value:string>>, summary string, description string"


@pytest.mark.parametrize(
    "content, summary, description, expected",
    [
        ([("image/png", ""), ("text/html", "<p>t</p>")], "s", "d", "t"),
        ([("image/png", "first"), ("TEXT/plain", "typed")], "s", "d", "typed"),
        ([("image/png", ""), ("x/y", "any")], "s", "d", "any"),
        ([("text/html", ""), ("x/y", "later")], "s", "d", "s"),
        ([("text/html", None), ("x/y", "later")], "s", "d", "later"),
        ([(None, "untyped")], "s", "d", "untyped"),
        ([], "", "<i>d</i>", "d"),
        (None, None, None, ""),
    ],
)
def test_entry_text(spark, content, summary, description, expected):
    df = spark.createDataFrame([(content, summary, description)], ENTRY)
    out = df.select(entries.entry_text(F.col("content"), F.col("summary"), F.col("description")))
    assert out.first()[0] == expected


@pytest.mark.parametrize(
    "main, feed, expected",
    [
        ("m" * 149, "f" * 150, "f" * 150),
        ("m" * 149, "f" * 149, "m" * 149),
        ("m" * 150, "f" * 900, "m" * 150),
        ("m" * 151, "f" * 900, "m" * 151),
        (None, "f", "f"), ("", "", ""), (None, "", ""),
    ],
)
def test_best_text(spark, main, feed, expected):
    df = spark.createDataFrame([(main, feed)], "m string, f string")
    assert df.select(entries.best_text(F.col("m"), F.col("f"))).first()[0] == expected


def test_clean_title(spark):
    assert apply(spark, ["  A \n", "", None], entries.clean_title) == ["A", "", C.DEFAULT_TITLE]


def test_article_text(spark):
    page = (
        "<html><head><title>T</title></head><body><nav>menu</nav><div class='top ad'>buy</div>"
        "<div>short</div><div><p>the longest block &amp; more</p></div><footer>f</footer></body>"
    )
    marked = "<nav>n</nav><article class=x><h1>H</h1><!-- c --><p>body</p></article><div>" + "z" * 99
    values = [page, marked, "<article></article><div>fallback</div>", "", None]
    assert apply(spark, values, article_text) == [
        "the longest block & more", "H body", "fallback", "", "",
    ]


@pytest.mark.parametrize("size", [199, 200, 201])
def test_relevance_title_length(spark, size):
    out = apply(spark, ["é" * size], chat.relevance_title)[0]
    assert out == "é" * min(size, 200)


@pytest.mark.parametrize("size", [3499, 3500, 3501])
def test_relevance_text_length(spark, size):
    out = apply(spark, ["🧠" * size], chat.relevance_text)[0]
    assert out == ("🧠" * size if size <= 3500 else "🧠" * 3500 + " [SUMMARY TRUNCATED]")


def python_summary_input(title, content, budget):
    """The written rules, one article at a time."""
    title = title if len(title) <= 250 else title[:250] + "..."
    whole = "Title: " + title + "\n\nContent: " + content
    if len(whole) <= budget:
        return whole
    room = budget - len("Title: " + title + "\n\nContent: ")
    kept = (
        content[:room] + " [CONTENT TRUNCATED]" if room > 0
        else content[:100] + " [CONTENT HEAVILY TRUNCATED]"
    )
    return "Title: " + title + "\n\nContent: " + kept


@pytest.mark.parametrize("budget", [7000, 300, 271, 18, 23])
def test_summary_input(spark, budget):
    titles = ["", "title", "t" * 250, "t" * 251, "t" * 400]
    contents = ["", "c", "c" * 99, "c" * 101, "c" * 6977, "c" * 6978, "c" * 7001]
    pairs = [(t, c) for t in titles for c in contents]
    df = spark.createDataFrame(pairs, "t string, c string")
    out = df.select("t", "c", chat.summary_input(F.col("t"), F.col("c"), budget).alias("o"))
    for row in out.collect():
        assert row["o"] == python_summary_input(row["t"], row["c"], budget)


def test_relevance_answer(spark):
    values = [" Yes.", "YES", "yesterday", "no", "", None, "Error: yes", " yes"]
    assert apply(spark, values, chat.relevance_answer) == [
        True, True, True, False, False, False, False, True,
    ]


def test_summary_result(spark):
    rows = [
        ("text", " fine \n"), ("  \n", "ignored"), (None, "ignored"),
        (C.SUMMARY_DEFAULT_CONTENT, "x"), ("text", "Error: it broke Error: twice"), ("text", ""),
    ]
    df = spark.createDataFrame(rows, "c string, r string")
    out = [r[0] for r in df.select(chat.summary_result(F.col("c"), F.col("r"))).collect()]
    assert out == [
        "fine", C.SUMMARY_NO_CONTENT, C.SUMMARY_NO_CONTENT, C.SUMMARY_NO_CONTENT,
        "[Summary unavailable due to LLM error: it broke twice]", "",
    ]


KNOWN_DATES = [
    "2025-06-05 12:00:01", "2025-6-5 1:2:3", "Thu, 05 Jun 2025 23:30:00 +0000",
    "Mon, 05 Jun 2025 23:30:00 -0700", "Thu, 05 Jun 2025 23:30:00 GMT",
    "Thu, 5 Jun 2025 23:30:00 Z", "2025-06-05T01:00:00Z", "2025-06-05T23:00:00-07:00",
]
KEPT_DATES = [
    "Thu, 05 Jun 2025 23:30:00 EST", "Xyz, 05 Jun 2025 23:30:00 GMT", "2025-06-05T23:00:00.123Z",
    "2025-06-05", "2025-02-30 00:00:00", "2025-06-05 25:00:00", "2025-06-05 12:00:60", "garbage",
    "2025-06-05 12:00:01\n",
]


def test_display_date(spark):
    out = apply(spark, [*KNOWN_DATES, *KEPT_DATES, None, ""], dates.display_date)
    assert out == ["June 05, 2025"] * len(KNOWN_DATES) + KEPT_DATES + ["N/A", "N/A"]


def test_display_date_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert apply(spark, KNOWN_DATES, dates.display_date) == ["June 05, 2025"] * len(KNOWN_DATES)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_feed_timestamp(spark):
    cases = {
        "Thu, 05 Jun 2025 23:30:00 +0200": "2025-06-05 21:30:00",
        "Thu, 05 Jun 2025 23:30:00 EST": "2025-06-06 04:30:00",
        "5 June 2025 9:05 GMT": "2025-06-05 09:05:00",
        "2025-06-05T23:00:00.123-07:00": "2025-06-06 06:00:00",
        "2025-06-05T23:00:00Z": "2025-06-05 23:00:00",
        "Thu, 05 Jun 2025 23:30:00 NOSUCH": None,
        "yesterday": None, "": None, None: None,
    }
    out = apply(spark, cases, lambda c: dates.feed_timestamp(c).cast("string"))
    assert out == list(cases.values())


def test_response_content_and_retry_hint(spark):
    bodies = [
        '{"choices":[{"message":{"content":" v1 "}}]}', '{"choices":[{"message":{"content":""}}]}',
        '{"choices":[]}', '{"choices":[{"message":{}}]}', "", "[1]", "{bad", None,
    ]
    assert apply(spark, bodies, chat.response_content) == ["v1", "", None, None, None, None, None, None]
    hints = [
        '{"error":{"message":"Please TRY again in 7.5s. Then"}}',
        '{"error":{"message":"try again in 2m3.5s"}}', '{"error":{"message":"try again in -3s"}}',
        '{"error":"x"}', '{"error":{"message":"slow down"}}', "nope",
    ]
    assert apply(spark, hints, chat.retry_hint_seconds) == [8.0, None, None, None, None, None]


def test_chat_request(spark):
    import json

    out = apply(spark, ['say "hé"\n'], lambda c: chat.chat_request(c, "be kind"))[0]
    assert json.loads(out) == {
        "model": C.PRIMARY_MODEL, "temperature": 0.7,
        "messages": [{"role": "system", "content": "be kind"},
                     {"role": "user", "content": 'say "hé"\n'}],
    }
    named = apply(spark, ["p"], lambda c: chat.chat_request(c, "s", model="m", temperature=0.0))[0]
    assert json.loads(named)["model"] == "m"
