"""Models, tiers, the attempt log and the extractive summary."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.operators import attempts, inference
from newsloom.operators.extract import extractive_summaries
from registry.inputs import inference_attempts


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(
        [("a", "Neural networks", "text one"), ("b", "Soup", "text two"), ("c", "Blank", " \n"),
         ("d", "None", None)],
        "link string, title string, original_summary string",
    )


def answers(df):
    return {r["request_id"]: (r["response"], r["provider_used"], r["failed"]) for r in df.collect()}


def test_python_model_errors_stay_with_their_row(spark, articles):
    def answer(system_prompt, prompt):
        if "Soup" in prompt:
            raise RuntimeError("no soup")
        return None if "Blank" in prompt else f" {len(system_prompt) > 0} "

    requests = inference.relevance_requests(articles)
    out = answers(inference.tiered_inference(requests, inference.python_model(answer)))
    assert out["a"] == ("True", "primary", False)
    assert out["b"] == (C.ERROR_ALL_FAILED, None, True)
    assert out["c"] == (C.ERROR_ALL_FAILED, None, True)


def test_tiers(spark, articles):
    requests = inference.summary_requests(articles)
    primary = inference.column_model(lambda r: F.when(r["title"] == "Soup", " one "))
    fallback = inference.column_model(lambda r: F.when(r["title"] != "None", "two"))
    both = answers(inference.tiered_inference(requests, primary, fallback, "fm"))
    assert both["b"] == ("one", "primary", False)
    assert both["a"] == ("two", "fallback", False)
    assert both["d"] == (
        "Error: OpenRouter fallback failed for model fm with error: no answer", None, True
    )
    only = answers(inference.tiered_inference(requests, None, fallback))
    assert only["b"] == ("two", "fallback", False)
    none = answers(inference.tiered_inference(requests, None, None))
    assert set(none.values()) == {(C.ERROR_ALL_FAILED, None, True)}


def test_the_primary_runs_once_per_row(spark, articles):
    calls = spark.sparkContext.accumulator(0)

    def answer(system_prompt, prompt):
        calls.add(1)
        return None

    requests = inference.summary_requests(articles)
    fallback = inference.column_model(lambda r: F.lit("ok"))
    result = inference.tiered_inference(requests, inference.python_model(answer), fallback)
    assert result.count() == 4 and len(result.collect()) == 4
    assert calls.value == 4


def test_classify_and_summarize(spark, articles):
    decided = inference.classify(articles, inference.term_model(["neural networks"]))
    assert {r["link"]: r["is_ai_relevant"] for r in decided.collect()} == {
        "a": True, "b": False, "c": False, "d": False,
    }
    failed = inference.classify(articles, inference.column_model(lambda r: F.lit(None)))
    assert {(r["is_ai_relevant"], r["failed"]) for r in failed.collect()} == {(False, True)}

    model = inference.column_model(lambda r: F.when(r["title"] == "Soup", " A soup. "))
    out = {r["link"]: (r["llm_summary"], r["summary_status"]) for r in
           inference.summarize(articles, model, model_name="m").collect()}
    assert out == {
        "b": ("A soup.", "ok"),
        "a": ("[Summary unavailable due to LLM error: All LLM attempts failed (Groq and OpenRouter).]",
              "failed"),
        "c": (C.SUMMARY_NO_CONTENT, "no_content"), "d": (C.SUMMARY_NO_CONTENT, "no_content"),
    }


def test_terms_match_whole_words(spark):
    df = spark.createDataFrame(
        [("1", "AI news", ""), ("2", "Mail", "said"), ("3", "x", "about ai."), ("4", None, "none")],
        "link string, title string, original_summary string",
    )
    out = inference.classify(df, inference.term_model(["AI"])).collect()
    assert {r["link"]: r["is_ai_relevant"] for r in out} == {
        "1": True, "2": False, "3": True, "4": False,
    }


LOG = "request_id string, tier string, attempt long, status int, error string, body string"
GOOD = '{"choices":[{"message":{"content":" fine "}}]}'


@pytest.mark.parametrize(
    "log, expected",
    [
        ([("primary", 1, 200, None, GOOD)], ("primary", 1, "fine")),
        ([("primary", 1, 429, None, ""), ("primary", 2, 503, None, ""), ("primary", 3, 200, None, GOOD)],
         ("primary", 3, "fine")),
        ([("primary", 1, 400, None, ""), ("primary", 2, 200, None, GOOD), ("fallback", 1, 200, None, GOOD)],
         ("fallback", 1, "fine")),
        ([("primary", 1, None, "timeout", None), ("primary", 2, None, "reset", None),
          ("primary", 3, 500, None, ""), ("primary", 4, 200, None, GOOD)],
         ("failed", 3, C.ERROR_ALL_FAILED)),
        ([("primary", 1, 200, None, "{}"), ("fallback", 1, 200, None, '{"choices":[]}')],
         ("failed", 1, "Error: OpenRouter fallback response format invalid for model fm.")),
        ([("primary", 1, 200, None, "not json"), ("primary", 2, 200, None, GOOD)],
         ("primary", 2, "fine")),
        ([("primary", 1, 404, None, ""), ("fallback", 1, 429, None, "")],
         ("failed", 1, "Error: OpenRouter fallback failed for model fm with HTTP error 429.")),
        ([("fallback", 1, None, "reset", None)],
         ("failed", 0, "Error: OpenRouter fallback failed for model fm with error: reset")),
        ([("primary", 1, 200, None, '{"choices":[{"message":{"content":""}}]}')], ("primary", 1, "")),
    ],
)
def test_resolve_attempts(spark, log, expected):
    df = spark.createDataFrame([("r", *row) for row in log], LOG)
    row = attempts.resolve_attempts(df, fallback_name="fm").first()
    assert (row["outcome"], row["primary_tries"], row["response"]) == expected


def test_resolution_equals_a_step_by_step_reading(spark, sf_dir):
    log = inference_attempts(spark, sf_dir)
    by_request = {}
    for row in log.collect():
        by_request.setdefault(row["request_id"], {})[row["attempt"]] = row["status"]
    expected = {}
    for request, statuses in by_request.items():
        outcome = "failed"
        for attempt in (1, 2, 3):
            if statuses[attempt] == 200:
                outcome = "primary"
            if statuses[attempt] not in (429, 503):
                break
        if outcome == "failed" and statuses[4] == 200:
            outcome = "fallback"
        expected[request] = outcome
    got = {r["request_id"]: r["outcome"] for r in attempts.resolve_attempts(log).collect()}
    assert got == expected


def test_waits(spark):
    hint = '{"error":{"message":"try again in 7s"}}'
    log = [
        ("r", "primary", 1, 429, None, hint), ("r", "primary", 2, 429, None, ""),
        ("r", "primary", 3, 429, None, hint), ("r", "primary", 1, None, "timeout", None),
        ("r", "primary", 2, None, "reset", None), ("r", "primary", 1, 400, None, hint),
        ("r", "fallback", 1, 503, None, ""), ("r", "primary", 2, 502, None, ""),
    ]
    df = spark.createDataFrame(log, LOG)
    waits = [r["wait_s"] for r in attempts.attempt_waits(df, base_backoff_seconds=1.5).collect()]
    assert waits == [7.5, 3.0, 0.0, 0.0, 3.0, 0.0, 0.0, 3.0]


def python_summary(text):
    import regex

    found = [s.strip() for s in regex.findall(r"[^.!?\n]+[.!?]*", text)]
    found = [s for s in found if s]
    words = [[w for w in regex.split(r"[^\p{L}\p{N}]+", s.lower()) if w] for s in found]
    count = Counter(w for sentence in words for w in sentence)
    score = {i: sum(count[w] for w in ws) / len(ws) for i, ws in enumerate(words) if ws}
    best = sorted(sorted(score, key=lambda i: (-score[i], i))[:2])
    return " ".join(found[i] for i in best)


def test_extractive_summaries(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["summary"] for r in extractive_summaries(documents, "doc_id", "text").collect()}
    for row in documents.collect():
        assert got.get(row["doc_id"], "") == python_summary(row["text"])


def test_extractive_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, "One sentence only"), (2, "?! ..."), (3, ""), (4, None), (5, "A a. B b. C c.")],
        "id long, text string",
    )
    got = {r["id"]: r["summary"] for r in extractive_summaries(df, "id", "text").collect()}
    assert got == {1: "One sentence only", 5: "A a. B b."}
