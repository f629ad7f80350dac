"""The text functions as session SQL functions.

``register_sql(spark)`` creates temporary SQL functions (``CREATE TEMPORARY
FUNCTION … RETURN <expr>``), so SQL users get the same JVM-side
expressions as the DataFrame API — no Python UDF is involved. The two file
name parsers give two columns, so they are functions that return a table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from moodlake.functions.text import (ENTITY_PIECES, HTML5_ENTITIES, ISO_PATTERN, LEGACY_ENTITIES, MAX_LEGACY_NAME,
                                     NOT_APPLICABLE, SENTINEL_LYRICS, charref_fixes)

_WS = r"\\s\\x1c-\\x1f"



def _q(s: str) -> str:
    """A SQL string literal: letters and digits plain, the rest as escapes."""
    return "'" + "".join(c if c.isascii() and c.isalnum() else f"\\U{ord(c):08x}" for c in s) + "'"


def _map(d: dict) -> str:
    keys = ", ".join(_q(k) if isinstance(k, str) else str(k) for k in d)
    return f"map_from_arrays(array({keys}), array({', '.join(_q(v) for v in d.values())}))"


def html_unescape_body() -> str:
    """T6 as SQL: see ``text.html_unescape`` for the rules."""
    name = "substr(p, 2)"
    prefixes = ", ".join(f"concat(try_element_at({_map(LEGACY_ENTITIES)}, substr({name}, 1, {k})), substr({name}, {k + 1}))"
                         for k in range(MAX_LEGACY_NAME, 1, -1))
    hx, dec = "regexp_extract(p, '^&#[xX]([0-9a-fA-F]+)', 1)", "regexp_extract(p, '^&#([0-9]+)', 1)"
    num = f"try_cast(CASE WHEN {hx} <> '' THEN conv({hx}, 16, 10) ELSE {dec} END AS BIGINT)"
    huge = (f"length(regexp_replace(CASE WHEN {hx} <> '' THEN {hx} ELSE {dec} END, '^0+', '')) > "
            f"CASE WHEN {hx} <> '' THEN 6 ELSE 7 END")
    numeric = (f"CASE WHEN {huge} THEN '\\ufffd' ELSE aggregate(array({num}), '', (a, n) -> CASE "
               f"WHEN try_element_at({_map(charref_fixes())}, n) IS NOT NULL THEN try_element_at({_map(charref_fixes())}, n) "
               "WHEN n BETWEEN 55296 AND 57343 OR n > 1114111 THEN '\\ufffd' "
               "WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n BETWEEN 127 AND 159 "
               "OR n BETWEEN 64976 AND 65007 OR (n & 65534) = 65534 THEN '' "
               "ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END) END")
    return (f"CASE WHEN t IS NOT NULL THEN array_join(transform(regexp_extract_all(t, {_q(ENTITY_PIECES)}, 0), p -> "
            f"CASE WHEN NOT startswith(p, '&') OR length(p) = 1 THEN p WHEN startswith(p, '&#') THEN {numeric} "
            f"ELSE coalesce(try_element_at({_map(HTML5_ENTITIES)}, {name}), {prefixes}, p) END), '') END")


# name -> (signature, return type, body)
SQL_FUNCTIONS = {
    "clean_text": ("t STRING", "STRING",
                   "trim(regexp_replace(regexp_replace(lower(t), '(?U)[^\\\\p{L}\\\\p{N}_" + _WS
                   + "]', ''), '(?U)[" + _WS + "]+', ' '))"),
    "clean_title": ("t STRING", "STRING",
                    "regexp_replace(regexp_extract(t, '^[^\\\\[(]*', 0), '(?U)^[" + _WS + "]+|["
                    + _WS + "]+$', '')"),
    "drop_first_line": ("t STRING", "STRING", "regexp_replace(t, '^[^\\\\n]*\\\\n', '')"),
    "count_char": ("t STRING, c STRING", "INT", "length(t) - length(replace(t, c, ''))"),
    "validate_lyrics": ("t STRING", "STRING",
                        "CASE WHEN contains(t, '[FN#') OR length(t) - length(replace(t, '\"', '')) >= 50 "
                        f"THEN '{SENTINEL_LYRICS}' ELSE regexp_replace(t, '^[^\\\\n]*\\\\n', '') END"),
    "after_equals": ("t STRING", "STRING",
                     "CASE WHEN locate('=', t) > 0 THEN substr(t, locate('=', t) + 1) END"),
    "sentiment_category": ("lyrics STRING, score DOUBLE", "STRING",
                           f"CASE WHEN lyrics <=> '{SENTINEL_LYRICS}' THEN '{NOT_APPLICABLE}' "
                           "WHEN score > 0.5 THEN 'positive' WHEN score > 0.0 THEN 'slightly positive' "
                           "WHEN score = 0.0 THEN 'neutral' WHEN score > -0.5 THEN 'slightly negative' "
                           "ELSE 'negative' END"),
    "iso_timestamp": ("ts TIMESTAMP", "STRING", f"date_format(ts, \"{ISO_PATTERN}\")"),
    "combined_id": ("id STRING, iso STRING", "STRING", "concat_ws('_', id, iso)"),
    "score_text": ("s DOUBLE", "STRING",
                   "regexp_replace(regexp_replace(CAST(CAST(coalesce(s, 0.0) AS DECIMAL(6,4)) AS STRING),"
                   " '0+$', ''), '\\\\.$', '.0')"),
    "percent_decode": ("t STRING", "STRING",
                       "CASE WHEN t IS NOT NULL THEN array_join(transform("
                       "regexp_extract_all(t, '(%[0-9A-Fa-f]{2})+|[^%]+|%', 0), "
                       "p -> CASE WHEN startswith(p, '%') AND length(p) >= 3 "
                       "THEN coalesce(try_url_decode(p), p) ELSE p END), '') END"),
    "html_unescape": ("t STRING", "STRING", html_unescape_body()),
    "search_key": ("name STRING, artist STRING, sep STRING", "STRING", "concat(name, sep, artist)"),
    "library_path": ("kind STRING, container STRING, name STRING, artist STRING", "STRING",
                     "concat_ws('/', kind, container, concat(name, ' - ', artist, '.mp3'))"),
}

_STEM = "left(file_name, length(file_name) - 4)"
_PARSED = "TABLE(name STRING, artist STRING)"
SQL_TABLE_FUNCTIONS = {
    "parse_file_split": ("file_name STRING", _PARSED,
                         f"SELECT get(split({_STEM}, ' - '), 0), get(split({_STEM}, ' - '), 1)"),
    "parse_file_index": ("file_name STRING", _PARSED,
                         f"SELECT CASE WHEN locate(' - ', {_STEM}) > 0 THEN left({_STEM}, locate(' - ', {_STEM}) - 1) END, "
                         f"CASE WHEN locate(' - ', {_STEM}) > 0 THEN substr({_STEM}, locate(' - ', {_STEM}) + 3) END"),
}


def register_sql(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions; returns their names."""
    every = {**SQL_FUNCTIONS, **SQL_TABLE_FUNCTIONS}
    for name, (sig, ret, body) in every.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({sig}) RETURNS {ret} RETURN {body}")
    return list(every)
