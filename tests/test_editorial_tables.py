"""Rules, search, exports and smoothed votes on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.functions.text import names_any
from newsloom.operators import editorial, export, extract, inference, rules, search

ARTICLES = "id long, link string, title string, original_summary string, source_name string, published_at string, fetched_at timestamp, llm_summary string"
AT = dt.datetime(2025, 7, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def articles(spark):
    rows = [
        (1, "l1", "Open tools", "we use c++ and java for machine learning", "a", "2025-06-01 00:00:00", AT, "one\r\nline"),
        (2, "l2", "Tools, open", "Machine  Learning machine learning", "b", None, AT, None),
        (3, "l3", None, "nothing here", "a", "2025-06-02 00:00:00", AT, ""),
        (4, "l4", "", "", None, "Thu, 05 Jun", AT, 'quote " and \\ mark'),
        (5, "l5", "ärger [x]", "open machine", "b", "2025-06-02 00:00:00", AT, "é"),
    ]
    return spark.createDataFrame(rows, ARTICLES)


def test_terms_are_literal(spark):
    table = spark.createDataFrame([("we use c and java",), ("we use C++.",), ("one, two.",), (None,)], "t string")
    found = lambda terms: [r[0] for r in table.select(names_any(F.col("t"), terms)).collect()]
    assert found(["c++"]) == [False, True, False, False]
    assert found([]) == found([""]) == [False] * 4
    requests = table.select(F.col("t").alias("request_id"), F.lit("").alias("system_prompt"), F.lit("").alias("prompt"), F.lit("").alias("title"), F.col("t").alias("text"))
    assert [r["content"] for r in inference.term_model([])(requests).collect()] == ["no"] * 4
    assert [r["content"] for r in inference.term_model(["c++"])(requests).collect()] == ["no", "Yes.", "no", "no"]


def test_no_terms_drop_no_title(articles):
    assert editorial.without_titles(articles, ()).count() == articles.count()


def tags(articles, table):
    return {r["id"]: r["tags"] for r in rules.tagged(articles, table).collect()}


def test_rules(spark, articles):
    schema = "category string, phrase string, source string"
    table = spark.createDataFrame([
        ("ml", "machine learning", None), ("ml", "Machine Learning", None), ("open-b", "open", "b"), ("all-a", None, "a"), ("all-a", " ", "a"),
        ("gone", None, None), (None, "open", None), ("x", "not in any", None)], schema)
    assert tags(articles, table) == {1: ["all-a", "ml"], 2: ["ml", "open-b"], 3: ["all-a"], 4: [], 5: ["open-b"]}
    assert tags(articles, table.limit(0)) == {k: [] for k in range(1, 6)}
    assert tags(articles.limit(0), table) == {}


def test_ten_thousand_rules(spark, articles):
    many = spark.range(10_000).select(
        F.concat(F.lit("c"), (F.col("id") % 100).cast("string")).alias("category"),
        F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" other")).alias("phrase"), F.lit(None).cast("string").alias("source"))
    named = articles.withColumn("title", F.when(F.col("id") == 3, "a word4242 other word7 other").otherwise(F.col("title")))
    assert tags(named, many)[3] == ["c42", "c7"] and tags(named, many)[1] == []


def test_search(spark, articles, tmp_path):
    path = search.build_index(articles, str(tmp_path / "index"), folders=8)
    first = [(r["id"], r["score"]) for r in search.ranked_page(spark, path, "Machine LEARNING machine", articles, 2).collect()]
    assert [i for i, _ in first] == [2, 1]
    after = (first[-1][1], first[-1][0])
    assert [r["id"] for r in search.ranked_page(spark, path, "machine learning", articles, 2, after).collect()] == [5]
    assert search.ranked_page(spark, path, " .,", articles, 2).count() == 0
    assert search.ranked_page(spark, path, "unheard", articles, 2).count() == 0
    plan = search.postings_of(spark, path, "machine learning")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan
    empty = search.build_index(articles.limit(0), str(tmp_path / "none"))
    assert search.ranked_page(spark, empty, "machine", articles, 2).count() == 0


@pytest.mark.parametrize("kind", ["json", "markdown"])
def test_export(spark, articles, tmp_path, kind):
    path = str(tmp_path)
    manifest = sorted(map(tuple, export.export(articles, path, "d/1", kind, rows=2).select("file", "first", "lines").collect()))
    assert manifest == [(0, 1, 2), (1, 3, 2), (2, 5, 1)]
    lines = [r["line"] for r in export.read_export(spark, path, "d/1").orderBy("rank").collect()]
    order = [4, 3, 5, 1, 2]
    item = export.KINDS[kind]()
    made = {r["id"]: r["line"] for r in articles.select("id", F.regexp_replace(item, r"[\r\n]+", " ").alias("line")).collect()}
    assert lines == [made[k] for k in order]
    assert export.broken_files(spark, path, "d/1").count() == 0
    written = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.txt")}
    export.export(articles.limit(1), path, "d/1", kind, rows=2)
    assert written == {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.txt")}


def test_export_that_broke_off(spark, articles, tmp_path, monkeypatch):
    digest = export.digest_of
    monkeypatch.setattr(export, "digest_of", lambda lines: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        export.export(articles.limit(2), str(tmp_path), "k")
    monkeypatch.setattr(export, "digest_of", digest)
    assert export.export(articles, str(tmp_path), "k").first()["lines"] == 5
    assert export.read_export(spark, str(tmp_path), "k").count() == 5
    assert export.export(articles.limit(0), str(tmp_path), "none").count() == 0
    text = next(tmp_path.rglob("export=k/files/**/*.txt"))
    text.write_text(text.read_text().replace("l3", "l9"))
    for crc in text.parent.glob(".*.crc"):
        crc.unlink()
    assert [r["file"] for r in export.broken_files(spark, str(tmp_path), "k").collect()] == [0]


def test_smoothed_votes(spark):
    day = lambda n: AT - dt.timedelta(days=n)
    rows = [("big", 1, day(0))] * 90 + [("big", -1, day(0))] * 10 + [("bad", -1, day(0))] * 100 + [("one", -1, day(0)), ("old", -1, day(300))]
    rows += [(None, 1, day(0)), ("big", None, day(0)), ("big", 1, None)]
    votes = spark.createDataFrame(rows, "source_name string, vote int, voted_at timestamp")
    as_of = F.lit(AT)
    share = {r["name"]: r["share"] for r in editorial.smoothed_votes(votes, as_of).collect()}
    assert 850_000 < share["big"] <= 900_000 and share["bad"] < 50_000
    # A single vote moves its source far less than a hundred do, an old one even less.
    assert share["bad"] < share["one"] < share["old"] < 500_000
    sources = spark.createDataFrame([("big", 2.0), ("none", None)], "name string, weight double")
    weights = {r["name"]: r["weight"] for r in editorial.smoothed_weights(sources, votes, as_of).collect()}
    assert 2.7 < weights["big"] < 2.9 and weights["none"] == 1.0
    assert editorial.smoothed_votes(votes.limit(0), as_of).collect() == []


def test_weights_change_the_order(spark, articles):
    groups = ((2, ("open",)), (1, ("machine learning",)))
    plain = [r["id"] for r in editorial.best_scored(articles, 2, groups).collect()]
    weights = spark.createDataFrame([("a", 0.1), ("b", 1.5)], "name string, weight double")
    assert plain == [1, 2] and [r["id"] for r in editorial.best_weighted(articles, weights, 2, groups).collect()] == [2, 5]


def test_summaries_are_made_once(articles):
    plan = extract.extractive_summaries(articles, "id", "original_summary")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_profile_reaches_the_prompt(articles):
    asked = inference.relevance_requests(articles, inference.profile_prompts("a gardener")).filter("request_id = 'l3'").first()
    assert "a gardener" in asked["prompt"] and "nothing here" in asked["prompt"]
    own = inference.relevance_requests(articles, inference.profile_prompts(F.col("source_name"))).filter("request_id = 'l1'").first()
    assert "Reader: a\n" in own["prompt"]
