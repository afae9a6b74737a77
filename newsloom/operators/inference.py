"""Batch inference over tables: one model, or a primary with a fallback.

A model is a function from a request frame to the same frame plus two columns:
``content`` (its answer, NULL when it failed) and ``error`` (why it failed).
Requests have ``request_id``, ``system_prompt``, ``prompt``, ``title``, ``text``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions import chat
from newsloom.functions.text import names_any, strip
from newsloom.session import checkpointed

Model = Callable[[DataFrame], DataFrame]
PROFILE_SYSTEM_PROMPT = "You select articles for one reader. Answer Yes or No first."
PROFILE_QUESTION = "Does this article fit the reader described here? Answer Yes or No.\nReader: "
REQUEST_COLUMNS = ["request_id", "system_prompt", "prompt", "title", "text"]


def column_model(answer: Callable[[DataFrame], Column]) -> Model:
    """A model that is a column expression over the request; it stays in the JVM."""

    def run(requests: DataFrame) -> DataFrame:
        answered = requests.withColumn("content", answer(requests).cast("string"))
        return answered.withColumn(
            "error", F.when(F.col("content").isNull(), F.lit("no answer"))
        )

    return run


def python_model(
    answer: Callable[[str, str], str | None], partitions: int | None = None
) -> Model:
    """A model behind a Python call ``answer(system_prompt, prompt)``.

    Requests travel to the Python workers in Arrow batches; a call that raises
    becomes the error of its own row. ``partitions`` spreads the calls evenly,
    since model time has nothing to do with the bytes that sized the partitions.
    """

    def call(system_prompt: str, prompt: str) -> tuple[str | None, str | None]:
        try:
            content = answer(system_prompt, prompt)
        except Exception as error:
            return None, str(error)
        return (content, None) if content is not None else (None, "no answer")

    def batches(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [call(*pair) for pair in zip(frame["system_prompt"], frame["prompt"])]
            frame["content"] = pd.Series([a for a, _ in answers], dtype=object, index=frame.index)
            frame["error"] = pd.Series([e for _, e in answers], dtype=object, index=frame.index)
            yield frame

    def run(requests: DataFrame) -> DataFrame:
        if partitions is not None:
            requests = requests.repartition(partitions)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
        return requests.mapInPandas(batches, f"{fields}, content string, error string")

    return run


def batch_model(
    answer: Callable[[list[str], list[str]], list[str | None]], partitions: int | None = None
) -> Model:
    """A model behind a call that takes the system prompts and prompts of a whole batch.

    A call that raises, or gives another number of answers, fails all rows of its batch.
    """

    def batches(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            error = None
            try:
                answers = list(answer(frame["system_prompt"].tolist(), frame["prompt"].tolist()))
                if len(answers) != len(frame):
                    error = f"{len(answers)} answers to {len(frame)} requests"
            except Exception as raised:
                error = str(raised)
            if error is not None:
                answers = [None] * len(frame)
            frame["content"] = pd.Series(answers, dtype=object, index=frame.index)
            errors = [error or ("no answer" if a is None else None) for a in answers]
            frame["error"] = pd.Series(errors, dtype=object, index=frame.index)
            yield frame

    def run(requests: DataFrame) -> DataFrame:
        if partitions is not None:
            requests = requests.repartition(partitions)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
        return requests.mapInPandas(batches, f"{fields}, content string, error string")

    return run


def term_model(terms: Iterable[str]) -> Model:
    """Offline relevance model: "yes" when the request's article names one of the terms."""
    terms = tuple(terms)
    return column_model(lambda requests: F.when(
        names_any(F.concat_ws(" ", requests["title"], requests["text"]), terms), "Yes."
    ).otherwise("no"))


def tiered_inference(
    requests: DataFrame,
    primary: Model | None,
    fallback: Model | None = None,
    fallback_name: str = C.FALLBACK_MODEL,
) -> DataFrame:
    """(request_id, response, provider_used, failed) of every request.

    A tier that is not configured is skipped. The primary runs once: its answers
    are kept in reliable storage, with the prompts of the failed rows only, and
    just those rows reach the fallback. A row that failed in every tier gets an
    error text as its response.
    """
    requests = requests.select(*REQUEST_COLUMNS)
    if primary is None and fallback is None:
        return requests.select(
            "request_id", F.lit(C.ERROR_ALL_FAILED).alias("response"),
            F.lit(None).cast("string").alias("provider_used"), F.lit(True).alias("failed"),
        )
    if primary is None:
        return _last_tier(fallback(requests), "fallback", fallback_name)
    if fallback is None:
        return _last_tier(primary(requests), "primary", None)

    failed = F.col("content").isNull()
    open_prompts = [
        F.when(failed, F.col(name)).alias(name) for name in REQUEST_COLUMNS if name != "request_id"
    ]
    tried = checkpointed(primary(requests).select("request_id", "content", *open_prompts))
    answered = tried.filter(~failed).select(
        "request_id", strip(F.col("content")).alias("response"),
        F.lit("primary").alias("provider_used"), F.lit(False).alias("failed"),
    )
    retried = fallback(tried.filter(failed).select(*REQUEST_COLUMNS))
    return answered.unionByName(_last_tier(retried, "fallback", fallback_name))


def _last_tier(outcome: DataFrame, provider: str, fallback_name: str | None) -> DataFrame:
    failed = F.col("content").isNull()
    if fallback_name is None:
        error = F.lit(C.ERROR_ALL_FAILED)
    else:
        head = C.ERROR_FALLBACK_OTHER.format(model=fallback_name, error="")
        error = F.concat(F.lit(head), F.coalesce("error", F.lit("")))
    return outcome.select(
        "request_id",
        F.when(failed, error).otherwise(strip(F.col("content"))).alias("response"),
        F.when(~failed, F.lit(provider)).alias("provider_used"),
        failed.alias("failed"),
    )


#: Makes (system prompt, prompt) of a title and a text.
Prompt = Callable[[Column, Column], tuple[Column, Column]]


def relevance_prompts(title: Column, text: Column) -> tuple[Column, Column]:
    return F.lit(C.RELEVANCE_SYSTEM_PROMPT), chat.relevance_prompt(title, text)


def profile_prompts(profile: str | Column) -> Prompt:
    """Prompts that ask whether an article fits the profile of a reader; a column gives each row its own."""
    who = profile if isinstance(profile, Column) else F.lit(profile)

    def prompts(title: Column, text: Column) -> tuple[Column, Column]:
        asked = F.concat(
            F.lit(PROFILE_QUESTION), who, F.lit("\n\nTitle: "), chat.relevance_title(title),
            F.lit("\nSummary: "), chat.relevance_text(text),
        )
        return F.lit(PROFILE_SYSTEM_PROMPT), asked

    return prompts


def relevance_requests(articles: DataFrame, prompts: Prompt = relevance_prompts) -> DataFrame:
    title, text = F.col("title"), F.col("original_summary")
    system_prompt, prompt = prompts(title, text)
    return articles.select(
        F.col("link").alias("request_id"),
        system_prompt.alias("system_prompt"),
        prompt.alias("prompt"),
        # The prompt is cut to its budget; a column model reads the whole article.
        "title",
        text.alias("text"),
    )


def classify(
    articles: DataFrame, primary: Model | None, fallback: Model | None = None,
    model_name: str | None = C.PRIMARY_MODEL, fallback_name: str = C.FALLBACK_MODEL,
    prompts: Prompt = relevance_prompts,
) -> DataFrame:
    """Relevance decision per link; a failed request is a stored "no", marked as failed."""
    answers = tiered_inference(relevance_requests(articles, prompts), primary, fallback, fallback_name)
    return answers.select(
        F.col("request_id").alias("link"),
        chat.relevance_answer(F.col("response")).alias("is_ai_relevant"),
        F.lit(model_name).cast("string").alias("model"),
        "provider_used",
        "failed",
    )


def summary_requests(
    articles: DataFrame, max_input_chars: int = C.SUMMARY_MAX_INPUT_CHARS
) -> DataFrame:
    title, text = F.col("title"), F.col("original_summary")
    return articles.select(
        F.col("link").alias("request_id"),
        F.lit(C.SUMMARY_SYSTEM_PROMPT).alias("system_prompt"),
        chat.summary_prompt(title, text, max_input_chars).alias("prompt"),
        "title",
        text.alias("text"),
    )


def summarize(
    articles: DataFrame, primary: Model | None, fallback: Model | None = None,
    model_name: str | None = None, fallback_name: str = C.FALLBACK_MODEL,
    max_input_chars: int = C.SUMMARY_MAX_INPUT_CHARS,
) -> DataFrame:
    """Stored summary per link; articles without content never reach a model."""
    text = F.col("original_summary")
    has_content = F.coalesce(chat.has_summary_content(text), F.lit(False))
    answers = tiered_inference(
        summary_requests(articles.filter(has_content), max_input_chars),
        primary, fallback, fallback_name,
    )
    content = F.lit("content")
    written = answers.select(
        F.col("request_id").alias("link"),
        chat.summary_result(content, F.col("response")).alias("llm_summary"),
        chat.summary_status(content, F.col("response")).alias("summary_status"),
        "provider_used",
    )
    blank = articles.filter(~has_content).select(
        "link",
        F.lit(C.SUMMARY_NO_CONTENT).alias("llm_summary"),
        F.lit("no_content").alias("summary_status"),
        F.lit(None).cast("string").alias("provider_used"),
    )
    return written.unionByName(blank).withColumn("model", F.lit(model_name).cast("string"))
