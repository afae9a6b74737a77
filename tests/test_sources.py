"""Catalogue files and landed feed files."""

import json

import pytest
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom import schemas
from newsloom.operators.entries import entries_of_sources, entry_text, nested_entries
from newsloom.sources import catalogue, feeds


def test_catalogue_rules(spark, tmp_path):
    path = tmp_path / "sources.yaml"
    path.write_text(
        """
sources:
  - {name: A, url: ua, tags: [x, y], weight: 1}
  - {name: B, url: ub, enabled: false}
  - {name: C, url: uc, enabled: null}
  - {name: D}
  - not a mapping
  - {name: E, url: "", enabled: true}
  - {name: F, url: uf, enabled: 1}
"""
    )
    sources = catalogue.load_sources(spark, path)
    assert sources.schema == schemas.SOURCES
    rows = sources.orderBy("source_ordinal").collect()
    assert [(r["source_ordinal"], r["name"]) for r in rows] == [(0, "A"), (1, "E"), (2, "F")]
    assert rows[0]["tags"] == ["x", "y"] and rows[0]["weight"] == 1.0
    usable = catalogue.usable_sources(sources)
    assert sorted(r["name"] for r in usable.collect()) == ["A", "F"]


@pytest.mark.parametrize("text", ["sources: {a: 1}", "[1, 2]", "sources: [", "", "other: []"])
def test_malformed_catalogue_is_empty(spark, tmp_path, text):
    path = tmp_path / "sources.yaml"
    path.write_text(text)
    assert catalogue.load_sources(spark, path).isEmpty()


def test_missing_catalogue_gives_defaults(spark, tmp_path):
    names = [r["name"] for r in catalogue.load_sources(spark, tmp_path / "none.yaml").collect()]
    assert names == [source["name"] for source in C.DEFAULT_SOURCES]


def test_json_catalogue(spark, tmp_path):
    path = tmp_path / "sources.json"
    path.write_text(json.dumps({"sources": [{"name": "A", "url": "u"}]}))
    assert catalogue.load_sources(spark, path).count() == 1


RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>Feed</title>
<item><title>One &amp; only</title><link> http://a/1 </link>
  <pubDate>Thu, 05 Jun 2025 23:30:00 +0200</pubDate>
  <description>&lt;p&gt;short&lt;/p&gt;</description>
  <content:encoded><![CDATA[<p>The <b>whole</b> text</p>]]></content:encoded></item>
<item><title>Two</title><link>http://a/2</link><pubDate>someday</pubDate>
  <description><![CDATA[<i>only</i> this]]></description></item>
<item><title>Three</title></item>
</channel></rss>"""

ATOM = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>
<entry><title type="html">First</title>
  <link rel="self" href="http://b/self"/><link rel="alternate" href="http://b/1"/>
  <published>2025-06-05T01:00:00Z</published>
  <summary>sum</summary><content type="html">&lt;p&gt;atom text&lt;/p&gt;</content></entry>
<entry><title>Second</title><link href="http://b/2"/><summary type="text">plain sum</summary></entry>
</feed>"""


def test_rss_and_atom(spark, tmp_path):
    root = str(tmp_path / "landing")
    for kind, url, document in (("rss", "https://a.example/feed?x=1", RSS), ("atom", "https://b.example/atom", ATOM)):
        folder = feeds.landing_folder(f"{root}/{kind}", url)
        import os

        os.makedirs(folder)
        with open(f"{folder}/1.xml", "w") as file:
            file.write(document)
    rss = feeds.read_rss(spark, f"{root}/rss")
    atom = feeds.read_atom(spark, f"{root}/atom")
    assert [(f.name, f.dataType) for f in rss.schema] == [
        (f.name, f.dataType) for f in schemas.FEED_ENTRIES
    ]
    text = entry_text(F.col("content"), F.col("summary"), F.col("description"))
    both = rss.unionByName(atom).withColumn("text", text).orderBy("feed_url", "entry_ordinal")
    rows = both.collect()
    assert [(r["feed_url"], r["link"], r["title"], r["text"]) for r in rows] == [
        ("https://a.example/feed?x=1", "http://a/1", "One & only", "The whole text"),
        ("https://a.example/feed?x=1", "http://a/2", "Two", "only this"),
        ("https://a.example/feed?x=1", None, "Three", ""),
        ("https://b.example/atom", "http://b/1", "First", "atom text"),
        ("https://b.example/atom", "http://b/2", "Second", "plain sum"),
    ]
    assert [str(r["published_parsed"]) for r in rows[:2]] == ["2025-06-05 21:30:00", "None"]
    assert rows[1]["published"] == "someday"
    sources = catalogue.catalogue_frame(
        spark, [{"name": "A", "url": "https://a.example/feed?x=1"}, {"name": "Z", "url": "z"}]
    )
    named = entries_of_sources(rss.unionByName(atom), sources).collect()
    assert {(r["source_name"], r["source_ordinal"]) for r in named} == {("A", 0)} and len(named) == 3


def test_malformed_feed_keeps_the_rest(spark, tmp_path):
    import os

    url = "u"
    for name, document in (("bad", "<rss><channel><item><title>x</channel>"), ("good", RSS)):
        folder = feeds.landing_folder(str(tmp_path / "l"), f"{url}{name}")
        os.makedirs(folder)
        with open(f"{folder}/1.xml", "w") as file:
            file.write(document)
    assert feeds.read_rss(spark, str(tmp_path / "l")).filter("link is not null").count() == 2


def test_nested_and_landed_entries(spark, tmp_path):
    fields = ", ".join(
        f"{f.name}: {f.dataType.simpleString()}" for f in schemas.FEED_ENTRIES.fields[2:]
    )
    nested = spark.createDataFrame(
        [("u", [("l1", "a", None, None, None, None, None), ("l2", "b", None, None, None, None, None)])],
        f"feed_url string, entries array<struct<{fields}>>",
    )
    flat = nested_entries(nested)
    assert [(r["entry_ordinal"], r["link"]) for r in flat.collect()] == [(0, "l1"), (1, "l2")]
    for file_format in ("parquet", "json", "orc"):
        path = str(tmp_path / file_format)
        flat.write.format(file_format).save(path)
        assert feeds.read_landed_entries(spark, path, file_format).count() == 2
