"""Resolve a log of inference attempts to one outcome per request.

Log columns: ``request_id``, ``tier`` ("primary" or "fallback"), ``attempt``
(from 1), ``status`` (HTTP status, NULL when no answer came), ``error`` (NULL,
"timeout" or the text of another failure), ``body``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions import chat

RETRYABLE = ["rate_limited", "server_error", "timeout", "exception"]


def outcome_class(status: Column, error: Column, body: Column) -> Column:
    answered = status < 400
    return (
        F.when(error == "timeout", "timeout")
        .when(error.isNotNull() | status.isNull(), "exception")
        .when(status == C.RATE_LIMIT_STATUS, "rate_limited")
        .when(status.isin(*C.SERVER_ERROR_STATUSES), "server_error")
        .when(~answered, "rejected")
        .when(chat.response_json(body).isNull(), "exception")
        .when(chat.response_content(body).isNull(), "structural")
        .otherwise("success")
    )


def attempt_waits(
    attempts: DataFrame,
    max_retries: int = C.MAX_RETRIES,
    base_backoff_seconds: float = C.BASE_BACKOFF_SECONDS,
) -> DataFrame:
    """Class of every logged attempt and the wait it asks for before the next primary try."""
    outcome = F.col("outcome_class")
    backoff = chat.backoff_seconds(F.col("attempt"), base_backoff_seconds)
    may_retry = (F.col("tier") == "primary") & (F.col("attempt") < max_retries)
    wait = (
        F.when(~may_retry | ~outcome.isin(*RETRYABLE) | (outcome == "timeout"), F.lit(0.0))
        .when(outcome == "rate_limited",
              F.coalesce(chat.retry_hint_seconds(F.col("body")), backoff))
        .otherwise(backoff)
    )
    classified = attempts.withColumn(
        "outcome_class", outcome_class(F.col("status"), F.col("error"), F.col("body"))
    )
    return classified.withColumn("wait_s", wait)


def resolve_attempts(
    attempts: DataFrame,
    max_retries: int = C.MAX_RETRIES,
    fallback_name: str = C.FALLBACK_MODEL,
) -> DataFrame:
    """Outcome per request: the primary's first final attempt decides, then one fallback attempt.

    The first final attempt is a minimum over (attempt, ...), so everything is
    one aggregate that combines before the shuffle; attempts logged after it
    never count. A hot request costs one row per task.
    """
    classified = attempts.withColumn(
        "outcome_class", outcome_class(F.col("status"), F.col("error"), F.col("body"))
    ).withColumn("content", chat.response_content(F.col("body")))
    is_try = (F.col("tier") == "primary") & (F.col("attempt") <= max_retries)
    is_final = is_try & ~F.col("outcome_class").isin(*RETRYABLE)
    is_fallback = F.col("tier") == "fallback"
    outcome = F.struct("attempt", "outcome_class", "content", "status", "error")

    merged = classified.groupBy("request_id").agg(
        F.min(F.when(is_final, outcome)).alias("final"),
        F.min(F.when(is_fallback, outcome)).alias("fallback"),
        F.max(F.when(is_try, F.col("attempt"))).alias("last_try"),
    )
    primary_ok = F.coalesce(F.col("final.outcome_class") == "success", F.lit(False))
    fallback_ok = F.coalesce(F.col("fallback.outcome_class") == "success", F.lit(False))

    def text(template: str, **values: Column) -> Column:
        """The template with its model name and one column filled in."""
        (name, value), = values.items()
        head, tail = template.replace("{model}", fallback_name).split("{" + name + "}")
        return F.concat(F.lit(head), F.coalesce(value.cast("string"), F.lit("")), F.lit(tail))

    failure = (
        F.when(F.col("fallback").isNull(), F.lit(C.ERROR_ALL_FAILED))
        .when(F.col("fallback.outcome_class") == "structural",
              F.lit(C.ERROR_FALLBACK_FORMAT.format(model=fallback_name)))
        .when(F.col("fallback.error").isNotNull() | F.col("fallback.status").isNull()
              | (F.col("fallback.outcome_class") == "exception"),
              text(C.ERROR_FALLBACK_OTHER, error=F.col("fallback.error")))
        .otherwise(text(C.ERROR_FALLBACK_HTTP, status=F.col("fallback.status")))
    )
    return merged.select(
        "request_id",
        F.when(primary_ok, "primary").when(fallback_ok, "fallback").otherwise("failed")
        .alias("outcome"),
        F.coalesce("final.attempt", "last_try", F.lit(0)).cast("long").alias("primary_tries"),
        F.when(primary_ok, F.col("final.content"))
        .when(fallback_ok, F.col("fallback.content"))
        .otherwise(failure).alias("response"),
    )
