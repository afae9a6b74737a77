"""Pages without an article element."""

import pytest
from pyspark.sql import functions as F

from newsloom.sources.pages import article_text

BODY = "The council met on Monday and agreed to rebuild the bridge before the winter comes."
MORE = "Work begins in spring, and the road stays open to buses while it lasts, said the mayor."
LINKS = "".join(f"<li><a href='/{k}'>Another story of the day number {k} with a long title</a></li>" for k in range(40))


def text_of(spark, html):
    return spark.createDataFrame([(html,)], "html string").select(article_text(F.col("html"))).first()[0]


CASES = {
    "paragraphs of one container": (f"<div><p>{BODY}</p><p>{MORE}</p></div>", f"{BODY} {MORE}"),
    "a link list longer than the body": (f"<ul>{LINKS}</ul><div><p>{BODY}</p><p>{MORE}</p></div>", f"{BODY} {MORE}"),
    "links after the body": (f"<div><p>{BODY}</p><p>{MORE}</p></div><div><ul>{LINKS}</ul></div>", f"{BODY} {MORE}"),
    "a list of links between paragraphs": (f"<div><p>{BODY}</p><ul><li><a>Read on here</a></li></ul><p>{MORE}</p></div>", f"{BODY} {MORE}"),
    "paragraphs that are not closed": (f"<body><p>{BODY}<p>{MORE}", f"{BODY} {MORE}"),
    "inline markup stays": (f"<div><p>The <b>old</b> {BODY} <a href=x>map</a></p></div>", f"The old {BODY} map"),
    "short menu before the text": (f"<div><div>Home</div><div>News</div><div>Sport</div></div><div><div><p>{BODY}</p></div></div>", BODY),
    "only short blocks": ("<div>Yes</div><div>Maybe</div>", "Maybe"),
    "an article element wins": (f"<p>{BODY}</p><article>short</article>", "short"),
    "text without any block": (BODY, BODY),
    "nothing": ("", ""),
    "only links": (f"<ul>{LINKS}</ul>", "Another story of the day number 10 with a long title"),
}


@pytest.mark.parametrize("name", CASES)
def test_case(spark, name):
    html, expected = CASES[name]
    assert text_of(spark, html) == expected


def test_null_and_very_long_pages(spark):
    assert text_of(spark, None) == ""
    long = "".join(f"<p>{BODY} <i>{k}</i></p>" for k in range(5000))
    assert text_of(spark, f"<body>{LINKS}{long}</body>").count(BODY) == 5000
