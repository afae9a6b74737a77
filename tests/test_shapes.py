"""Page and reference shapes that the given tables do not have."""

from pyspark.sql import functions as F

from newsloom.functions.text import unescape_html
from newsloom.operators import editorial
from newsloom.sources.catalogue import catalogue_frame
from newsloom.sources.pages import article_text, attach_page_text


def apply(spark, values, function):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in rows.orderBy("k").select(function(F.col("v"))).collect()]


def test_html5_names(spark):
    values = ["&lpar;b&rpar; &plus; &lbrack;", "&amp;&eacute;&copy 1", "&nosuch; &"]
    assert apply(spark, values, unescape_html) == ["(b) + [", "&é© 1", "&nosuch &"]


def test_page_shapes(spark):
    nested = "<div class='ad'>buy <div>now <div>today</div></div> here</div><div>the story itself</div>"
    form = "<body><form action=x><div>wrapped in a form</div></form></body>"
    several = "<article>short</article><p>x</p><article>the longest of them</article><article>mid one</article>"
    long_ad = "<div class=ad>" + "a <b>word</b> " * 20_000 + "</div><div>story</div>"
    assert apply(spark, [nested, form, several, long_ad], article_text) == [
        "the story itself", "wrapped in a form", "the longest of them", "story",
    ]


def test_articles_without_a_link_stay(spark):
    articles = spark.createDataFrame([(1, None), (2, None), (3, "u")], "id long, link string")
    pages = spark.createDataFrame([(1, "u", "<article>text</article>"), (2, None, "<article>no</article>")], "page_id long, url string, html string")
    found = {r["id"]: r["main_text"] for r in attach_page_text(articles, pages).collect()}
    assert found == {1: "", 2: "", 3: "text"}


def test_a_weight_that_is_no_number(spark):
    rows = catalogue_frame(spark, [{"name": "a", "url": "u", "weight": "heavy"}, {"name": "b", "url": "v", "weight": "0.5"}])
    assert [r["weight"] for r in rows.collect()] == [None, 0.5]


def test_planned_terms(spark):
    rows = [(1, "An LLM tool", "release"), (2, "Rumor of OpenAI", None), (3, "Sponsored: a deal", "coupon"), (4, None, None), (5, "Details", "toolbox")]
    articles = spark.createDataFrame(rows, "id long, title string, original_summary string").withColumn("link", F.lit("l"))
    assert [(r["id"], r["score"]) for r in editorial.best_scored(articles, 2).collect()] == [(1, 5), (4, 0)]
    scores = {r["id"]: r["score"] for r in editorial.best_scored(articles, -1).collect()}
    assert scores == {1: 5, 2: -2, 3: -5, 4: 0, 5: 0}
    assert sorted(r["id"] for r in editorial.without_titles(articles).collect()) == [1, 2, 4, 5]


def test_json_export(spark):
    rows = spark.createDataFrame([(1, "l", 'a "b"', "s", None, "x")], "id long, link string, title string, source_name string, published_at string, llm_summary string")
    assert rows.select(editorial.json_item()).first()[0] == '{"id":1,"link":"l","title":"a \\"b\\"","source_name":"s","llm_summary":"x"}'
