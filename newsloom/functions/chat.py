"""Model requests and responses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions.text import cut, is_blank, strip

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?$"
_SUMMARY_INPUT_OVERHEAD = len("Title: ") + len("\n\nContent: ")


def relevance_title(title: Column) -> Column:
    return F.substring(F.coalesce(title, F.lit("")), 1, C.RELEVANCE_TITLE_CHARS)


def relevance_text(text: Column) -> Column:
    return cut(F.coalesce(text, F.lit("")), C.RELEVANCE_TEXT_CHARS, C.RELEVANCE_TEXT_MARKER)


def relevance_prompt(title: Column, text: Column) -> Column:
    return F.concat(
        F.lit(f"{C.RELEVANCE_INSTRUCTION}\nTitle: "), relevance_title(title),
        F.lit("\n\nSummary: "), relevance_text(text),
        F.lit(f"\n\n{C.RELEVANCE_QUESTION}"),
    )


def relevance_answer(response: Column) -> Column:
    """True only for a response that starts with "yes"; errors and NULL count as a no."""
    return F.coalesce(F.startswith(F.lower(strip(response)), F.lit("yes")), F.lit(False))


def summary_input(
    title: Column, text: Column, max_input_chars: int = C.SUMMARY_MAX_INPUT_CHARS
) -> Column:
    title = cut(
        F.coalesce(title, F.lit(C.SUMMARY_DEFAULT_TITLE)),
        C.SUMMARY_TITLE_CHARS, C.SUMMARY_TITLE_MARKER,
    )
    text = F.coalesce(text, F.lit(""))
    room = F.lit(max_input_chars - _SUMMARY_INPUT_OVERHEAD) - F.length(title)
    content = (
        F.when(F.length(text) <= room, text)
        .when(room > 0, F.concat(F.substring(text, F.lit(1), room), F.lit(C.SUMMARY_CONTENT_MARKER)))
        .otherwise(
            F.concat(F.substring(text, 1, C.SUMMARY_HEAVY_CHARS), F.lit(C.SUMMARY_HEAVY_MARKER))
        )
    )
    return F.concat(F.lit("Title: "), title, F.lit("\n\nContent: "), content)


def summary_prompt(
    title: Column, text: Column, max_input_chars: int = C.SUMMARY_MAX_INPUT_CHARS
) -> Column:
    return F.concat(
        summary_input(title, text, max_input_chars), F.lit(f"\n\n{C.SUMMARY_QUESTION}")
    )


def has_summary_content(text: Column) -> Column:
    return ~is_blank(text) & (text != C.SUMMARY_DEFAULT_CONTENT)


def summary_result(text: Column, response: Column) -> Column:
    """The summary to store: bracketed notes take its place when there is none."""
    return (
        F.when(~has_summary_content(text), F.lit(C.SUMMARY_NO_CONTENT))
        .when(
            F.contains(response, F.lit("Error:")),
            F.concat(
                F.lit(C.SUMMARY_ERROR_PREFIX),
                F.replace(response, F.lit("Error: "), F.lit("")),
                F.lit(C.SUMMARY_ERROR_SUFFIX),
            ),
        )
        .otherwise(strip(response))
    )


def summary_status(text: Column, response: Column) -> Column:
    return (
        F.when(~has_summary_content(text), F.lit("no_content"))
        .when(F.contains(response, F.lit("Error:")), F.lit("failed"))
        .otherwise(F.lit("ok"))
    )


def chat_request(
    prompt: Column, system_prompt: str, model: str | None = None,
    temperature: float = C.TEMPERATURE, default_model: str = C.PRIMARY_MODEL,
) -> Column:
    """JSON body of a chat request: system and user message, model and temperature."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.to_json(F.struct(
        F.lit(model or default_model).alias("model"),
        F.array(message("system", F.lit(system_prompt)), message("user", prompt)).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
    ))


def response_json(body: Column) -> Column:
    """The body as a JSON object, NULL when it is anything else."""
    return F.when(F.startswith(strip(body), F.lit("{")), F.try_parse_json(body))


def response_content(body: Column) -> Column:
    """Stripped text of the first choice, NULL when any level of it is missing."""
    return strip(F.try_variant_get(response_json(body), "$.choices[0].message.content", "string"))


def retry_hint_seconds(body: Column) -> Column:
    """Wait named in a rate-limit body plus a buffer, NULL when it names no usable one."""
    message = F.lower(
        F.try_variant_get(response_json(body), "$.error.message", "string")
    )
    after = F.get(F.split(message, C.RETRY_HINT), F.lit(1))
    number = strip(F.get(F.split(after, "s"), F.lit(0)))
    seconds = F.when(number.rlike(_NUMBER), number.try_cast("double")) + F.lit(
        C.RETRY_HINT_BUFFER_SECONDS
    )
    return F.when(seconds > 0, seconds)


def backoff_seconds(attempt: Column, base: float = C.BASE_BACKOFF_SECONDS) -> Column:
    """Doubling wait after the ``attempt``-th try, counted from 1."""
    return F.lit(float(base)) * F.pow(F.lit(2.0), attempt.cast("double") - 1)
