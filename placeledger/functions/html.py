"""Markup handling as Column expressions: entities, visible text, script blocks."""

from __future__ import annotations

import html.entities
import json
from functools import lru_cache

from pyspark.sql import Column, functions as F

from placeledger.fixed_values import LINE_LENGTH_RANGE
from placeledger.functions.text import SPACE, col, collapse_spaces, let

_ENTITY = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LONGEST_BARE_NAME = max(len(n) for n in html.entities.html5 if not n.endswith(";"))


def _literal_map(pairs: dict, key_type: str) -> Column:
    """A map constant: one foldable expression however many entries."""
    return F.from_json(F.lit(json.dumps(pairs)), f"map<{key_type},string>")


@lru_cache(maxsize=None)
def _windows_1252() -> dict[int, str]:
    """What numeric references 128-159 mean on the web."""
    table = {}
    for code in range(0x80, 0xA0):
        try:
            table[code] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[code] = ""
    return table


def _code_point(number: Column) -> Column:
    text = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    cp1252 = _literal_map(_windows_1252(), "string")
    bad = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF) | number.isNull()
    invisible = (
        number.between(1, 8) | (number == 0xB) | number.between(0xE, 0x1F) | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF) | F.pmod(number, F.lit(65536)).isin(0xFFFE, 0xFFFF)
    )
    return (
        F.when(bad, "\ufffd")
        .when(number.between(0x80, 0x9F), F.element_at(cp1252, number.cast("string")))
        .when(invisible, "")
        .otherwise(text)
    )


def _named(token: Column) -> Column:
    """Named reference without its ampersand; the old names also count unterminated,
    longest first, with the rest of the token kept."""
    def look_up(names: Column) -> Column:
        partial = [
            F.concat(F.element_at(names, F.substring(token, 1, n)), F.substring(token, n + 1, 64))
            for n in range(_LONGEST_BARE_NAME, 1, -1)
        ]
        return F.coalesce(F.element_at(names, token), *partial, F.concat(F.lit("&"), token))

    return (
        F.when(token == "amp;", "&").when(token == "nbsp;", "\u00a0").when(token == "quot;", '"')
        .when(token == "lt;", "<").when(token == "gt;", ">")
        .otherwise(let(_literal_map(html.entities.html5, "string"), look_up))
    )


def _decode(token: Column) -> Column:
    digits = F.regexp_replace(token, "[#xX;]", "")
    # Longer numbers overflow no bigint check and are far beyond the last code point.
    decimal = F.when(F.length(digits) < 18, digits.try_cast("long"))
    trimmed = F.ltrim(digits, F.lit("0"))
    hexadecimal = F.when(F.length(trimmed) < 12, F.conv(digits, 16, 10).try_cast("long"))
    return (
        F.when(F.rlike(token, F.lit("^#[xX]")), let(hexadecimal, _code_point))
        .when(token.startswith("#"), let(decimal, _code_point))
        .otherwise(_named(token))
    )


def unescape(c: Column | str) -> Column:
    """Replace character references once, left to right, as browsers do."""
    def rebuild(text: Column) -> Column:
        tokens = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(1)), _decode)
        pieces = F.split(text, _ENTITY, -1)
        joined = F.zip_with(pieces, tokens, lambda p, t: F.concat(p, F.coalesce(t, F.lit(""))))
        return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)

    return let(col(c), rebuild)


def visible_text(page: Column | str) -> Column:
    """Page text with one line per block element; scripts and styles removed."""
    text = col(page)
    for block in ("script", "style"):
        text = F.regexp_replace(text, rf"(?is)<{block}\b.*?</{block}>", " ")
    text = F.regexp_replace(text, r"(?i)<br(?U:\s*)/?>", "\n")
    text = F.regexp_replace(text, r"(?i)</(?:p|div|li|tr|td|h\d)>", "\n")
    return unescape(F.regexp_replace(text, "<[^>]+>", " "))


def candidate_lines(text: Column | str, length: tuple[int, int] = LINE_LENGTH_RANGE) -> Column:
    """Array of the lines of a text, white space collapsed, of a length in the range."""
    shortest, longest = length
    lines = F.transform(F.split(col(text), r"[\n\r]+"), collapse_spaces)
    return F.filter(lines, lambda line: F.length(line).between(shortest, longest))


def json_ld_blocks(page: Column | str) -> Column:
    """Array of the unescaped bodies of a page's JSON-LD script elements."""
    bodies = F.regexp_extract_all(
        col(page),
        F.lit(r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""),
        F.lit(1),
    )
    return F.transform(bodies, lambda body: F.regexp_replace(unescape(body), f"^{SPACE}+|{SPACE}+$", ""))


def anchor_targets(page: Column | str) -> Column:
    """Array of the unescaped, trimmed href values of a page's links, in order."""
    hrefs = F.regexp_extract_all(
        col(page), F.lit(r"""(?i)<a(?U:\s)+[^>]*href=["']([^"']+)["']"""), F.lit(1)
    )
    return F.transform(hrefs, lambda h: F.regexp_replace(unescape(h), f"^{SPACE}+|{SPACE}+$", ""))
