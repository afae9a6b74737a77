"""Dates that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import constants as C

_CLOCK = r"(?:2[0-3]|[01]\d|\d):(?:[0-5]\d|\d):(?:[0-5]\d|\d)"
_OFFSET = r"[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?"
_WEEKDAY = r"(?:mon|tue|wed|thu|fri|sat|sun)"
_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

# "2025-06-05 12:00:01", "2025-06-05T01:00:00Z", "2025-06-05T23:00:00-07:00"
_DISPLAY_ISO = rf"(?i)^(\d{{4}}-\d{{1,2}}-\d{{1,2}})(?:\s+{_CLOCK}|T{_CLOCK}(?:Z|{_OFFSET}))\z"
# "Thu, 05 Jun 2025 23:30:00 +0000", "Thu, 5 Jun 2025 23:30:00 GMT"
_DISPLAY_RFC = (
    rf"(?i)^{_WEEKDAY},\s+(\d{{1,2}})\s+{_MONTH}\s+(\d{{4}})\s+{_CLOCK}"
    rf"\s+(?:Z|UTC|GMT|{_OFFSET})\z"
)

# Feed stamps: the weekday, the seconds and the zone may be missing, the month spelled out.
_FEED_RFC = (
    rf"(?i)^\s*(?:[a-z]+,?\s+)?(\d{{1,2}})\s+{_MONTH}[a-z]*\s+(\d{{4}})"
    r"\s+(\d{1,2}:\d{2}(?::\d{2})?)(?:\s+([a-z]+|[+-]\d{2}:?\d{2}))?\s*\z"
)
_FEED_ISO = (
    r"(?i)^\s*(\d{4}-\d{2}-\d{2})[t ](\d{2}:\d{2}(?::\d{2})?)(?:\.\d+)?"
    r"\s*(z|[+-]\d{2}:?\d{2})?\s*\z"
)


def _rfc_day(text: Column, pattern: str) -> Column:
    """``yyyy-m-d`` from the day, month name and year groups of ``pattern``."""
    month = (F.instr(F.lit(_MONTHS), F.lower(F.regexp_extract(text, pattern, 2))) + F.lit(2)) / 3
    return F.concat_ws(
        "-",
        F.regexp_extract(text, pattern, 3),
        month.cast("int").cast("string"),
        F.regexp_extract(text, pattern, 1),
    )


def display_date(text: Column) -> Column:
    """Wall-clock day as "Month DD, YYYY"; "N/A" when empty, unchanged when not a known format."""
    day = (
        F.when(text.rlike(_DISPLAY_ISO), F.regexp_extract(text, _DISPLAY_ISO, 1))
        .when(text.rlike(_DISPLAY_RFC), _rfc_day(text, _DISPLAY_RFC))
        .try_cast("date")
    )
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(C.DATE_UNKNOWN)).otherwise(
        F.coalesce(F.date_format(day, C.DATE_DISPLAY_FORMAT), text)
    )


def feed_timestamp(text: Column) -> Column:
    """Instant of a feed stamp (RFC 822 or ISO 8601), NULL when it has another form."""
    zones = F.create_map(
        *[F.lit(part) for zone, hours in C.RFC822_ZONES.items()
          for part in (zone, f"{hours:+03d}:00")]
    )

    def offset(zone: Column) -> Column:
        digits = F.replace(zone, F.lit(":"), F.lit(""))
        return (
            F.when(zone == "", F.lit("+00:00"))
            .when(zone.rlike(r"^[+-]"),
                  F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2)))
            .otherwise(F.try_element_at(zones, F.upper(zone)))
        )

    def clock(time: Column) -> Column:
        return F.when(time.rlike(r"^\d+:\d+$"), F.concat(time, F.lit(":00"))).otherwise(time)

    rfc = F.concat(
        _rfc_day(text, _FEED_RFC), F.lit(" "), clock(F.regexp_extract(text, _FEED_RFC, 4)),
        offset(F.regexp_extract(text, _FEED_RFC, 5)),
    )
    iso = F.concat(
        F.regexp_extract(text, _FEED_ISO, 1), F.lit(" "),
        clock(F.regexp_extract(text, _FEED_ISO, 2)),
        offset(F.regexp_extract(text, _FEED_ISO, 3)),
    )
    return (
        F.when(text.rlike(_FEED_RFC), rfc).when(text.rlike(_FEED_ISO), iso).try_cast("timestamp")
    )


def published_text(parsed: Column, raw: Column) -> Column:
    """The stored ``published_at``: UTC text of the parsed instant, else the raw text, else NULL."""
    return F.coalesce(
        F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), F.nullif(raw, F.lit(""))
    )


def published_timestamp(text: Column) -> Column:
    """Opt-in real time of ``published_at`` for callers that want to sort by time."""
    return feed_timestamp(text)
