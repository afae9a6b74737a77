"""Text cleaning as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import constants as C

# What separates two text nodes of an HTML document: a comment, an element whose
# body is not text, or a tag (with quoted attribute values that may hold a ">").
_HIDDEN = "|".join(rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>" for tag in ("script", "style", "template"))
_TAG = r"""<[a-z/!?][^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+>"""
NODE_SEPARATOR = rf"(?is)<!--.*?-->|{_HIDDEN}|{_TAG}"

_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"


def _literal_map(pairs: dict[str, str]) -> Column:
    """One foldable expression; a map built from a literal per entry slows down planning."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _named_entities() -> Column:
    """All names of HTML 5; a reference may lack its semicolon."""
    return _literal_map({name.removesuffix(";"): value for name, value in html5.items()})


def _windows_1252() -> Column:
    """Meaning of numeric references 128-159, which pages write in that code page."""
    known = {}
    for point in range(0x80, 0xA0):
        decoded = bytes([point]).decode("cp1252", errors="ignore")
        if decoded:
            known[str(point)] = decoded
    return _literal_map(known)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove white space, including the Unicode kinds, from both ends."""
    return F.btrim(text, F.lit(C.WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def _code_point(point: Column) -> Column:
    decoded = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    valid = point.between(0, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    return (
        F.when(point.between(0x80, 0x9F),
               F.coalesce(F.try_element_at(_windows_1252(), point.cast("string")), decoded))
        .when(valid, decoded)
        .otherwise("\ufffd")
    )


def _decode_reference(piece: Column) -> Column:
    """``piece`` is what followed an ampersand."""

    def decode(name: Column) -> Column:
        rest = F.regexp_replace(piece, _ENTITY, "")
        point = F.when(
            name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 16), 16, 10).try_cast("bigint")
        ).otherwise(F.substring(name, 2, 20).try_cast("bigint"))
        named = F.coalesce(F.try_element_at(_named_entities(), name), F.concat(F.lit("&"), name))
        return (
            F.when(name == "", F.concat(F.lit("&"), piece))
            .when(name.startswith("#"), F.concat(let(point, _code_point), rest))
            .otherwise(F.concat(named, rest))
        )

    return let(F.regexp_extract(piece, _ENTITY, 1), decode)


def unescape_html(text: Column) -> Column:
    """Replace named and numeric character references."""

    def decode(pieces: Column) -> Column:
        decoded = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _decode_reference)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(decoded, ""))

    return F.when(text.contains("&"), let(F.split(text, "&"), decode)).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Text nodes in document order, each stripped, joined by one space; never NULL."""
    nodes = F.split(F.coalesce(html, F.lit("")), NODE_SEPARATOR)
    texts = F.transform(nodes, lambda node: strip(unescape_html(node)))
    return F.array_join(F.filter(texts, lambda text: text != ""), " ")


def escape_html(text: Column) -> Column:
    escaped = F.coalesce(text, F.lit(""))
    for raw, safe in C.HTML_ESCAPES:
        escaped = F.replace(escaped, F.lit(raw), F.lit(safe))
    return escaped


def cut(text: Column, limit: int | Column, marker: str) -> Column:
    """``text``, or its first ``limit`` code points plus ``marker`` when longer."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, F.lit(1), limit), F.lit(marker))
    ).otherwise(text)


def names_any(text: Column, terms: Iterable[str]) -> Column:
    """Whether a text has one of the terms as whole words, without case; false for null and without terms."""
    words = "|".join(re.escape(term.lower()).replace(r"\ ", r"\s+") for term in terms if term)
    if not words:
        return F.lit(False)
    found = F.lower(text).rlike(rf"(?:^|[^\p{{L}}\p{{N}}])(?:{words})(?:[^\p{{L}}\p{{N}}]|$)")
    return F.coalesce(found, F.lit(False))
