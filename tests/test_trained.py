"""The trained relevance model."""

import pytest
from pyspark.sql import functions as F

from newsloom.operators import inference, trained
from registry import inputs
from registry.queries import QUERIES

SCHEMA = "link string, title string, original_summary string, is_ai_relevant boolean"


def articles(spark, n=60):
    rows = [(f"l{k}", f"title {k}", "new compiler for tensors" if k % 2 else "recipes for the garden", bool(k % 2)) for k in range(n)]
    return spark.createDataFrame([*rows, ("empty", None, None, None), ("blank", "", " ", None)], SCHEMA)


def answers(spark, table, path):
    decided = inference.classify(table, trained.trained_model(path))
    return {r["link"]: r["is_ai_relevant"] for r in decided.collect()}


def test_learns_what_separates(spark, tmp_path):
    table = articles(spark)
    path = trained.fit_relevance(table.filter("link <> 'l1' AND link <> 'l2'"), str(tmp_path / "model"))
    found = answers(spark, table, path)
    assert found["l1"] and not found["l2"] and len(found) == 62
    assert found == answers(spark, table, path)
    again = trained.fit_relevance(table.filter("link <> 'l1' AND link <> 'l2'"), str(tmp_path / "again"))
    assert found == answers(spark, table, again)


def test_one_kind_of_decision_repeats(spark, tmp_path):
    path = trained.fit_relevance(articles(spark).filter("is_ai_relevant"), str(tmp_path / "model"))
    assert all(answers(spark, articles(spark), path).values())


def test_nothing_to_learn_from(spark, tmp_path):
    with pytest.raises(ValueError):
        trained.fit_relevance(articles(spark).filter("is_ai_relevant IS NULL"), str(tmp_path / "model"))


def test_clashing_columns_and_empty_tables(spark, tmp_path):
    path = trained.fit_relevance(articles(spark), str(tmp_path / "model"))
    requests = inference.relevance_requests(articles(spark)).withColumn("words", F.lit(1)).withColumn("features", F.lit("x"))
    judged = trained.trained_model(path)(requests)
    assert judged.columns == [*requests.columns, "content", "error"] and judged.count() == 62
    assert inference.classify(articles(spark).limit(0), trained.trained_model(path)).collect() == []


def test_quality_on_held_out_rows(spark):
    """Better than either constant answer on articles that were not learned from."""
    sf_dir = "/root/testdata/sf0.01"
    known = inputs.articles(spark, sf_dir).filter("is_ai_relevant IS NOT NULL").select("link", "is_ai_relevant")
    judged = QUERIES["A39_trained"](spark, sf_dir).filter("held_out").join(known, "link")
    q = trained.quality(judged).first()
    print(q)
    assert q["articles"] > 50 and q["right"] > max(q["relevant"], q["articles"] - q["relevant"])
