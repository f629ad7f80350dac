"""Scalar text functions (column expressions, all JVM-side).

Every function takes and returns a ``Column`` so it composes inside one
``select`` and stays in whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import html.entities as _html_entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
SENTINEL_LYRICS = "Lyrics not found"
NOT_APPLICABLE = "not applicable"
FOOTNOTE_MARK = "[FN#"
MAX_QUOTES = 50
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Python's str-pattern \w is "letter, number or underscore" and its \s also
# covers the ASCII separators \x1c-\x1f; Java needs both spelled out.
_WS = r"\s\x1c-\x1f"
_PUNCT = r"(?U)[^\p{L}\p{N}_" + _WS + r"]"
_WS_RUN = r"(?U)[" + _WS + r"]+"
_EDGE_WS = r"(?U)^[" + _WS + r"]+|[" + _WS + r"]+$"


# HTML character references: the named table is the HTML5 list shipped
# with Python (2,231 names), so it is built from that, not spelled out.
ENTITY_PIECES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
HTML5_ENTITIES = _html_entities.html5
LEGACY_ENTITIES = {k: v for k, v in HTML5_ENTITIES.items() if not k.endswith(";")}
MAX_LEGACY_NAME = max(map(len, LEGACY_ENTITIES))


def charref_fixes() -> dict[int, str]:
    """Numeric references the HTML standard remaps: NUL → U+FFFD, CR, and
    0x80-0x9F read as Windows-1252 (undefined bytes stay as they are)."""
    fixes = {0x00: "\ufffd", 0x0D: "\r"}
    for n in range(0x80, 0xA0):
        try:
            fixes[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            fixes[n] = chr(n)
    return fixes


_MAPS = None


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _entity_maps():
    """The three lookup maps as map literals. Each is built from one SQL
    expression (a single call into the JVM) and constant-folded by Catalyst."""
    global _MAPS
    if _MAPS is None:
        def lit_map(d):
            keys = ", ".join(_sql_str(k) if isinstance(k, str) else str(k) for k in d)
            vals = ", ".join(_sql_str(v) for v in d.values())
            return F.expr(f"map_from_arrays(array({keys}), array({vals}))")
        _MAPS = (lit_map(HTML5_ENTITIES), lit_map(LEGACY_ENTITIES), lit_map(charref_fixes()))
    return _MAPS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind (Python ``strip``)."""
    return F.regexp_replace(_c(c), _EDGE_WS, "")


def clean_text(c) -> Column:
    """Lower case, drop all but word characters and whitespace, collapse
    whitespace runs to one blank, strip. NULL and '' pass through."""
    x = F.regexp_replace(F.lower(_c(c)), _PUNCT, "")
    return F.trim(F.regexp_replace(x, _WS_RUN, " "))


def clean_title(c) -> Column:
    """Cut at the first '[' then at the first '(' and strip."""
    return strip_ws(F.regexp_extract(_c(c), r"^[^\[(]*", 0))


def drop_first_line(c) -> Column:
    """Drop everything up to and including the first newline; a text
    without newline is returned whole."""
    return F.regexp_replace(_c(c), r"^[^\n]*\n", "")


def count_char(c, ch: str) -> Column:
    """T4: number of occurrences of one character."""
    col = _c(c)
    return F.length(col) - F.length(F.replace(col, F.lit(ch), F.lit("")))


def validate_lyrics(c) -> Column:
    """F4 + T3: footnote mark or too many quotes → sentinel, otherwise the
    text without its first line (checked on the text before the cut).
    NULL stays NULL (the caller maps a failed lookup to the sentinel)."""
    col = _c(c)
    bad = F.contains(col, F.lit(FOOTNOTE_MARK)) | (count_char(col, '"') >= MAX_QUOTES)
    return F.when(bad, F.lit(SENTINEL_LYRICS)).otherwise(drop_first_line(col))


def is_present(c) -> Column:
    """NULL and '' both count as absent."""
    col = _c(c)
    return col.isNotNull() & (col != "")


def parse_file_split(c) -> tuple[Column, Column]:
    """Drop the 4-character extension, split on ' - ', parts 0 and 1."""
    col = _c(c)
    stem = F.left(col, F.length(col) - 4)
    pieces = F.split(stem, " - ")
    return F.get(pieces, 0), F.get(pieces, 1)


def parse_file_index(c) -> tuple[Column, Column]:
    """Name before the first ' - ', artist is all the rest before
    the 4-character extension."""
    col = _c(c)
    stem = F.left(col, F.length(col) - 4)
    pos = F.locate(" - ", stem)
    name = F.when(pos > 0, F.left(stem, pos - 1))
    artist = F.when(pos > 0, F.substr(stem, pos + 3))
    return name, artist


def html_unescape(c) -> Column:
    """Decode HTML character references the way Python's
    ``html.unescape`` does (one left-to-right pass, so ``&amp;lt;`` gives
    ``&lt;``): named references from the HTML5 table, legacy names without
    ';' by longest prefix, decimal and hex references with the standard's
    replacements for invalid code points."""
    col = _c(c)
    pieces = F.regexp_extract_all(col, F.lit(ENTITY_PIECES), 0)
    out = F.transform(pieces, lambda p: F.when(F.startswith(p, F.lit("&")) & (F.length(p) > 1),
                                               _decode_reference(p)).otherwise(p))
    return F.when(col.isNotNull(), F.array_join(out, ""))


def _decode_reference(p: Column) -> Column:
    ents, legacy, fixes = _entity_maps()
    name = F.substr(p, F.lit(2))
    prefixes = [F.concat(F.try_element_at(legacy, F.substr(name, F.lit(1), F.lit(k))),
                         F.substr(name, F.lit(k + 1)))
                for k in range(MAX_LEGACY_NAME, 1, -1)]
    named = F.coalesce(F.try_element_at(ents, name), *prefixes, p)
    dec = F.regexp_extract(p, r"^&#([0-9]+)", 1)
    hx = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]+)", 1)
    is_hex = hx != ""
    digits = F.regexp_replace(F.when(is_hex, hx).otherwise(dec), "^0+", "")
    huge = F.length(digits) > F.when(is_hex, F.lit(6)).otherwise(F.lit(7))
    num = F.when(is_hex, F.conv(F.when(hx == "", "0").otherwise(hx), 16, 10)).otherwise(dec).try_cast("long")
    invalid_cp = (num.between(0x1, 0x8) | (num == 0xB) | num.between(0xE, 0x1F) | num.between(0x7F, 0x9F)
                  | num.between(0xFDD0, 0xFDEF) | ((num.bitwiseAND(0xFFFE)) == 0xFFFE))
    numeric = (F.when(huge, F.lit("\ufffd"))
               .when(F.try_element_at(fixes, num).isNotNull(), F.try_element_at(fixes, num))
               .when(num.between(0xD800, 0xDFFF) | (num > 0x10FFFF), F.lit("\ufffd"))
               .when(invalid_cp, F.lit(""))
               .otherwise(F.decode(F.unhex(F.lpad(F.hex(num), 8, "0")), "UTF-32")))
    return F.when(F.startswith(p, F.lit("&#")), numeric).otherwise(named)


def percent_decode(c) -> Column:
    """Percent-decode like Python's ``unquote``: runs of valid ``%XX``
    escapes are decoded as UTF-8, invalid escapes and '+' stay as they are.

    The text is cut into escape runs, plain runs and lone '%' signs
    (``regexp_extract_all``); only the escape runs are decoded."""
    col = _c(c)
    pieces = F.regexp_extract_all(col, F.lit(r"(%[0-9A-Fa-f]{2})+|[^%]+|%"), 0)
    decoded = F.transform(pieces, lambda p: F.when(F.startswith(p, F.lit("%")) & (F.length(p) >= 3),
                                                   F.coalesce(F.try_url_decode(p), p)).otherwise(p))
    return F.when(col.isNotNull(), F.array_join(decoded, ""))


def after_equals(c) -> Column:
    """The text after the first '='; NULL when there is none."""
    col = _c(c)
    pos = F.locate("=", col)
    return F.when(pos > 0, F.substr(col, pos + 1))


def search_key(name, artist, sep: str = " ") -> Column:
    """Name and artist joined by ``sep`` (blank or nothing)."""
    return F.concat(_c(name), F.lit(sep), _c(artist))


def sentiment_category(lyrics, score) -> Column:
    """Sentinel lyrics first, then the score buckets.
    0.5 → slightly positive, -0.5 → negative, NULL lyrics use the score."""
    s = _c(score).cast("double")
    return (F.when(_c(lyrics).eqNullSafe(F.lit(SENTINEL_LYRICS)), F.lit(NOT_APPLICABLE))
            .when(s > 0.5, "positive")
            .when(s > 0.0, "slightly positive")
            .when(s == 0.0, "neutral")
            .when(s > -0.5, "slightly negative")
            .otherwise("negative"))


def iso_timestamp(c) -> Column:
    """Millisecond ISO text with a literal Z (session zone is UTC)."""
    return F.date_format(_c(c), ISO_PATTERN)


def combined_id(id_col, iso) -> Column:
    """Id + '_' + time; a NULL id leaves only the time."""
    return F.concat_ws("_", _c(id_col), _c(iso))


def score_text(c) -> Column:
    """Score rendered like Python's ``str(float)`` for 4-decimal
    values: at least one decimal, no exponent, no trailing zeros."""
    s = F.coalesce(_c(c), F.lit(0.0)).cast("decimal(6,4)").cast("string")
    s = F.regexp_replace(s, r"0+$", "")
    return F.regexp_replace(s, r"\.$", ".0")


def library_path(kind, container, name, artist) -> Column:
    """``kind/[container/]name - artist.mp3``."""
    file_name = F.concat(_c(name), F.lit(" - "), _c(artist), F.lit(".mp3"))
    return F.concat_ws("/", _c(kind), _c(container), file_name)
