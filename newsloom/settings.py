"""Tunable values of a run, with the published defaults."""

from __future__ import annotations

from dataclasses import dataclass

from newsloom import constants as C


@dataclass(frozen=True)
class Settings:
    feed_fallback_threshold: int = C.FEED_FALLBACK_THRESHOLD
    top_n_summaries: int = C.SUMMARY_QUEUE_LIMIT
    digest_size: int = C.DIGEST_SIZE
    max_input_chars: int = C.SUMMARY_MAX_INPUT_CHARS
    primary_model: str | None = C.PRIMARY_MODEL
    fallback_model: str | None = C.FALLBACK_MODEL
    summary_model: str | None = None
    temperature: float = C.TEMPERATURE
    max_retries: int = C.MAX_RETRIES
    base_backoff_seconds: float = C.BASE_BACKOFF_SECONDS
    brand: str = "News"
    link_folders: int = 8
