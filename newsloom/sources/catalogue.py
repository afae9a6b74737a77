"""The source catalogue: a small configuration file read on the driver."""

from __future__ import annotations

import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom import schemas

log = logging.getLogger(__name__)


def read_catalogue(path: str | Path) -> list[dict]:
    """Items of the catalogue file; two defaults when it is absent, none when it is malformed."""
    path = Path(path)
    if not path.exists():
        log.warning("no source catalogue at %s, using the default sources", path)
        return list(C.DEFAULT_SOURCES)
    try:
        document = _parse(path)
    except Exception as error:  # any unreadable catalogue means "no sources", not a failed run
        log.error("cannot read source catalogue %s: %s", path, error)
        return []
    items = document.get("sources") if isinstance(document, dict) else None
    if not isinstance(items, list):
        log.error("source catalogue %s has no list under 'sources'", path)
        return []
    return items


def _parse(path: Path) -> object:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def catalogue_frame(spark: SparkSession, items: list[dict]) -> DataFrame:
    """Valid and enabled items in file order.

    A name and a url key must be present; a missing ``enabled`` means enabled,
    any other falsy value means disabled.
    """
    usable = [
        item for item in items
        if isinstance(item, dict) and {"name", "url"} <= item.keys() and item.get("enabled", True)
    ]
    rows = [
        (position, item["name"], item["url"], item.get("notes"), item.get("tags"),
         _number(item.get("weight")), True)
        for position, item in enumerate(usable)
    ]
    return spark.createDataFrame(rows, schemas.SOURCES)


def _number(value: object) -> float | None:
    """A weight that is no number counts as missing; it does not fail the load."""
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def load_sources(spark: SparkSession, path: str | Path) -> DataFrame:
    return catalogue_frame(spark, read_catalogue(path))


def usable_sources(sources: DataFrame) -> DataFrame:
    """The same rules for a catalogue that is already a table, plus the need for a url."""
    return sources.filter(
        F.col("name").isNotNull()
        & (F.coalesce(F.col("url"), F.lit("")) != "")
        & F.coalesce(F.col("enabled"), F.lit(True))
    )
