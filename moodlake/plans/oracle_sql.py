"""Reference SQL for the catalogue queries (ANSI SQL as DuckDB runs it).

These are the independent second implementation used by the correctness
check: same tables, same semantics, no Spark. Shared pieces are CTEs.
"""

from __future__ import annotations

from moodlake.operators.lexicon import (COMPOUND_ALPHA, CONTRAST_AFTER_PCT, CONTRAST_BEFORE_PCT, CONTRAST_WORDS,
                                        EMOTIONS, INTENSIFIERS, INTENSITY_MILLI, LANGUAGES, NEGATION_SCALAR_PCT, NEGATION_WINDOW, NEGATORS,
                                        lexicon_values_sql)

# Whitespace as Python's str.isspace sees it; punctuation is anything that
# is not a letter, number, underscore or such whitespace.
_WS = r"\s\x0b\x1c-\x1f\x85\p{Z}"
CLEAN = ("trim(regexp_replace(regexp_replace(lower(@X@), '[^\\p{L}\\p{N}_" + _WS
         + "]', '', 'g'), '[" + _WS + "]+', ' ', 'g'))")


def clean(x: str) -> str:
    return CLEAN.replace("@X@", x)


def music_genre(doc_id: str) -> str:
    from moodlake.sources.tables import GENRES
    return (f"CASE {doc_id} % {len(GENRES) + 1} " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(GENRES))
            + " END")


FEED = ("CASE event_type WHEN 'view' THEN 'song_global_top' "
        "WHEN 'signup' THEN 'song_italy_top' ELSE 'song_played' END")

PLAY_KEYS = f"""pk AS (
  SELECT event_id AS play_id, ts AS "timestamp", user_id, {FEED} AS topic,
         event_id % (SELECT count(*) FROM documents) AS doc_id,
         coalesce(event_type = 'error', false) AS lyrics_missing
  FROM events)"""

PLAYS = PLAY_KEYS + """,
plays AS (
  SELECT pk.play_id, pk."timestamp", pk.user_id, pk.topic, pk.doc_id,
         CAST(pk.doc_id AS VARCHAR) AS id, 'song ' || CAST(pk.doc_id AS VARCHAR) AS name,
         d.source AS artist, """ + music_genre("pk.doc_id") + """ AS genre,
         CASE WHEN pk.lyrics_missing THEN 'Lyrics not found' ELSE d.text END AS lyrics
  FROM pk JOIN documents d ON d.doc_id = pk.doc_id)"""

_EMO_VALUES = ", ".join(f"('{e}', {i})" for i, e in enumerate(EMOTIONS))


def scoring_ctes(src: str, keys: list[str], text: str, lang: str | None, negation: bool = False,
                 contrast: bool = False, intensity: bool = False, extra_words: str = "") -> str:
    """CTEs ending in ``scores`` (keys, compound, emotion) over ``src`` per
    ``keys``; without ``lang`` (or with an unknown one) the language with
    the most hits counts."""
    k = ", ".join(keys)
    tk = ", ".join("t." + c for c in keys)
    ck = ", ".join("c." + c for c in keys)
    on = lambda a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in keys)
    negs = "CASE x.l " + " ".join(
        f"WHEN '{l}' THEN [{', '.join(chr(39) + w + chr(39) for w in ws)}]" for l, ws in NEGATORS.items()) + " END"
    word = "CASE x.l " + " ".join(f"WHEN '{l}' THEN '{w}'" for l, w in CONTRAST_WORDS.items()) + " END"
    factors = [f"(CASE WHEN i - {j} >= 1 AND list_contains(negs, tk[i - {j}]) THEN {NEGATION_SCALAR_PCT} ELSE 100 END)"
               if negation else "100" for j in range(1, NEGATION_WINDOW + 1)]
    boosts = [f"(CASE WHEN i - {j} < 1 THEN 0 WHEN list_contains(ups, tk[i - {j}]) THEN {m} "
              f"WHEN list_contains(downs, tk[i - {j}]) THEN -{m} ELSE 0 END)" if intensity else "0"
              for j, m in enumerate(INTENSITY_MILLI, 1)]

    def intensifiers(sign: int) -> str:
        return "CASE x.l " + " ".join(f"WHEN '{l}' THEN [{', '.join(chr(39) + w + chr(39) for w, s in ws.items() if s == sign)}]"
                                      for l, ws in INTENSIFIERS.items()) + " END"

    factors.append(f"(CASE WHEN cpos = 0 THEN 100 WHEN i < cpos THEN {CONTRAST_BEFORE_PCT} "
                   f"WHEN i > cpos THEN {CONTRAST_AFTER_PCT} ELSE 100 END)" if contrast else "100")
    return f"""lex(lang, word, valence_milli, emotion) AS (VALUES {lexicon_values_sql()}{extra_words}),
emo(emotion, rnk) AS (VALUES {_EMO_VALUES}),
langs(l) AS (VALUES {", ".join(f"('{x}')" for x in LANGUAGES)}),
cleaned AS (SELECT {k}, {lang or "CAST(NULL AS VARCHAR)"} AS known, {clean(text)} AS c FROM {src}),
arr AS (SELECT {ck}, x.l AS lang, string_split(c.c, ' ') AS tk, {negs} AS negs,
               {intensifiers(1)} AS ups, {intensifiers(-1)} AS downs,
               coalesce(list_position(string_split(c.c, ' '), {word}), 0) AS cpos
        FROM cleaned c JOIN langs x ON c.known IS NULL OR c.known NOT IN (SELECT l FROM langs) OR c.known = x.l),
toks AS (SELECT {k}, lang, unnest(list_transform(tk,
                lambda w, i: {{'w': w, 'f': CAST({" * ".join(factors)} AS BIGINT), 'b': {" + ".join(boosts)}}})) AS t FROM arr),
hits AS (SELECT {tk}, t.lang, CAST(l.valence_milli + sign(l.valence_milli) * t.t.b AS BIGINT) * t.t.f AS v, l.emotion
         FROM toks t JOIN lex l ON l.lang = t.lang AND l.word = t.t.w),
best AS (SELECT {k}, lang, sum(v) AS s FROM hits GROUP BY {k}, lang
         QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY count(*) DESC, lang) = 1),
top AS (SELECT {", ".join("h." + c for c in keys)}, h.emotion FROM hits h
        JOIN best t ON {on("h", "t")} AND h.lang = t.lang LEFT JOIN emo e ON e.emotion = h.emotion
        GROUP BY {", ".join("h." + c for c in keys)}, h.emotion
        QUALIFY row_number() OVER (PARTITION BY {", ".join("h." + c for c in keys)}
                                   ORDER BY count(*) DESC, coalesce(min(e.rnk), 99), h.emotion) = 1),
scores AS (
  SELECT {ck},
         round(CAST(coalesce(h.s, 0) AS DOUBLE) / 1e11
               / sqrt(power(CAST(coalesce(h.s, 0) AS DOUBLE) / 1e11, 2) + {COMPOUND_ALPHA}), 4) AS compound,
         CASE WHEN c.c IS NULL OR c.c = '' THEN NULL
              ELSE coalesce(t.emotion, 'not applicable') END AS emotion
  FROM cleaned c LEFT JOIN best h ON {on("h", "c")} LEFT JOIN top t ON {on("t", "c")})"""


_SENTIMENT = """CASE WHEN compound = 0 THEN '0.0'
            ELSE regexp_replace(regexp_replace(CAST(CAST(compound AS DECIMAL(6,4)) AS VARCHAR),
                                '0+$', ''), '\\.$', '.0') END AS sentiment"""


def negated_scores_sql(contrast: bool = False) -> str:
    """Document compound with negation scaling, and optionally the contrast rule."""
    return ("WITH " + scoring_ctes("documents", ["doc_id"], "text", "lang", negation=True, contrast=contrast)
            + f"\nSELECT doc_id, compound, {_SENTIMENT} FROM scores")


def category(lyrics_missing: str, compound: str) -> str:
    return (f"CASE WHEN {lyrics_missing} THEN 'not applicable' "
            f"WHEN {compound} > 0.5 THEN 'positive' WHEN {compound} > 0.0 THEN 'slightly positive' "
            f"WHEN {compound} = 0.0 THEN 'neutral' WHEN {compound} > -0.5 THEN 'slightly negative' "
            f"ELSE 'negative' END")


VARIANTS = f"""variants AS (
  SELECT doc_id, false AS lyrics_missing, {music_genre("doc_id")} AS genre, source AS artist, text AS lyrics FROM documents
  UNION ALL
  SELECT doc_id, true, {music_genre("doc_id")}, source, 'Lyrics not found' FROM documents)"""

WEIGHTED = ("WITH " + PLAY_KEYS + ",\n" + VARIANTS + ",\n"
            + scoring_ctes("variants", ["doc_id", "lyrics_missing", "genre", "artist"], "lyrics", None, True, True, True)
            + f""",
wp AS (SELECT pk.*, s.genre, s.artist, s.compound, s.emotion,
              {category("pk.lyrics_missing", "s.compound")} AS sentiment_category
       FROM pk JOIN scores s ON s.doc_id = pk.doc_id AND s.lyrics_missing = pk.lyrics_missing)
""")


# Plays dealt over three months, as the month trends take them.
SPREAD = "(ts + to_days(CAST(event_id % 3 * 31 AS INTEGER)))"


def spread(sql: str) -> str:
    return sql.replace('ts AS "timestamp"', SPREAD + ' AS "timestamp"')


def week_start(d: str) -> str:
    return f"CAST(date_trunc('week', {d}) AS DATE)"


def month_start(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def scoring_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["mood_board"] = WEIGHTED + """SELECT topic, sentiment_category, emotion, count(*) AS plays
        FROM wp GROUP BY topic, sentiment_category, emotion"""
    q["mood_counts"] = WEIGHTED + "SELECT topic, emotion, count(*) AS plays FROM wp GROUP BY topic, emotion"
    q["category_counts"] = WEIGHTED + """SELECT topic, sentiment_category, count(*) AS plays
        FROM wp GROUP BY topic, sentiment_category"""
    q["genre_counts"] = WEIGHTED + "SELECT topic, genre, count(*) AS plays FROM wp GROUP BY topic, genre"
    q["artist_counts"] = WEIGHTED + "SELECT topic, artist, count(*) AS plays FROM wp GROUP BY topic, artist"
    q["top_artists"] = WEIGHTED + """, ac AS (SELECT topic, artist, count(*) AS plays FROM wp GROUP BY topic, artist)
        SELECT topic, artist, plays, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY topic ORDER BY plays DESC, artist) AS rank FROM ac)
        WHERE rank <= 5"""
    grains = {"day": "CAST(\"timestamp\" AS DATE)",
              "week": week_start("CAST(\"timestamp\" AS DATE)"),
              "month": month_start("CAST(\"timestamp\" AS DATE)")}
    for g, expr in grains.items():
        q[f"taste_trend_{g}"] = WEIGHTED + f"""SELECT {expr} AS period, topic, emotion, count(*) AS plays
            FROM wp GROUP BY ALL"""
    q["genre_trend_week"] = "WITH " + PLAY_KEYS + f"""
SELECT {week_start('CAST(pk."timestamp" AS DATE)')} AS period, pk.topic, {music_genre("d.doc_id")} AS genre, count(*) AS plays
FROM pk JOIN documents d ON d.doc_id = pk.doc_id GROUP BY ALL"""
    q["artist_trend_month"] = "WITH " + PLAY_KEYS + f"""
SELECT {month_start('CAST(pk."timestamp" AS DATE)')} AS period, pk.topic, d.source AS artist, count(*) AS plays
FROM pk JOIN documents d ON d.doc_id = pk.doc_id GROUP BY ALL"""
    q["taste_trend_month"], q["artist_trend_month"] = spread(q["taste_trend_month"]), spread(q["artist_trend_month"])
    doc_scores = "WITH " + scoring_ctes("documents", ["doc_id"], "text", "lang")
    q["compound_score"] = doc_scores + """
        SELECT s.doc_id, s.compound,
               CASE WHEN s.compound = 0 THEN '0.0'
                    ELSE regexp_replace(regexp_replace(CAST(CAST(s.compound AS DECIMAL(6,4)) AS VARCHAR),
                                        '0+$', ''), '\\.$', '.0') END AS sentiment
        FROM scores s"""
    q["top_emotion"] = doc_scores + "\nSELECT doc_id, emotion FROM scores"
    q["chart_harvest"] = "WITH " + PLAY_KEYS + """,
counts AS (SELECT topic, doc_id, count(*) AS plays FROM pk
           WHERE topic IN ('song_global_top', 'song_italy_top') GROUP BY topic, doc_id),
chart AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY plays DESC, doc_id) AS rn
                         FROM counts) WHERE rn <= 50),
gen AS (SELECT source, list_sort(list_distinct(list(lang))) AS genres FROM documents GROUP BY source),
items AS (
  SELECT c.topic, c.rn AS item_number, CAST(d.doc_id AS VARCHAR) AS id, 'song ' || CAST(d.doc_id AS VARCHAR) AS name,
         d.source AS artist,
         CASE WHEN strpos(d.text, '[FN#') > 0 OR length(d.text) - length(replace(d.text, '"', '')) >= 50
              THEN 'Lyrics not found' ELSE regexp_replace(d.text, '^[^\\n]*\\n', '') END AS lyrics,
         CASE WHEN g.source IS NULL THEN NULL WHEN len(g.genres) = 0 OR g.genres[1] = '' THEN 'not applicable'
              ELSE g.genres[1] END AS genre
  FROM chart c JOIN documents d ON d.doc_id = c.doc_id LEFT JOIN gen g ON g.source = d.source)
SELECT topic, item_number, id, name, artist, genre, md5(lyrics) AS lyrics_md5,
       md5(CAST(json_object('topic', topic, 'name', name, 'artist', artist, 'lyrics', lyrics,
                            'genre', genre, 'id', id) AS VARCHAR)) AS value_md5
FROM items"""
    q["top_emotions"] = WEIGHTED + """, mc AS (SELECT topic, emotion, count(*) AS plays FROM wp GROUP BY topic, emotion)
        SELECT topic, emotion, plays, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY topic ORDER BY plays DESC, emotion NULLS LAST) AS rank FROM mc)
        WHERE rank <= 3"""
    gate = ("CASE WHEN strpos(text, '[FN#') > 0 OR length(text) - length(replace(text, '\"', '')) >= 50 "
            "THEN 'Lyrics not found' ELSE regexp_replace(text, '^[^\\n]*\\n', '') END")
    q["sentiment_category"] = ("WITH gated AS (SELECT doc_id, lang, " + gate + " AS lyrics FROM documents),\n"
                               + scoring_ctes("gated", ["doc_id"], "lyrics", "lang") + f"""
SELECT s.doc_id, {category("g.lyrics = 'Lyrics not found'", "s.compound")} AS sentiment_category
FROM scores s JOIN gated g ON g.doc_id = s.doc_id""")
    q["compound_score_negated"] = negated_scores_sql()
    q["compound_score_rules"] = negated_scores_sql(contrast=True)
    from moodlake.sources.tables import VOICE
    voiced = "text"
    for old, new in VOICE.items():
        voiced = f"replace({voiced}, ' {old} ', ' {new} ')"
    sung = f"WITH sung AS (SELECT doc_id, lang, {voiced} AS lyrics FROM documents),\n"
    q["compound_score_intensity"] = (sung + scoring_ctes("sung", ["doc_id"], "lyrics", "lang", True, True, True)
                                     + f"\nSELECT doc_id, compound, {_SENTIMENT}, emotion FROM scores")
    from moodlake.plans.catalog import CALM_WORDS
    calm = "".join(f", ('{l}', '{w}', 100, 'calm')" for l, w in CALM_WORDS)
    q["open_emotion_labels"] = (sung + scoring_ctes("sung", ["doc_id"], "lyrics", "lang", extra_words=calm)
                                + "\nSELECT doc_id, emotion FROM scores")
    return q


# --- SQL for the operator catalogue (text, envelope, library, lists) -----------

PY_STRIP_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_STRIP_WS}+|{PY_STRIP_WS}+$', '', 'g')"


FILES = """files AS (
  SELECT p_partkey, p_name || ' - ' || CASE WHEN p_type = 'SMALL' THEN p_brand || ' - ' || p_type
                                            ELSE p_brand END || '.mp3' AS file_name FROM part),
lib0 AS (
  SELECT 'songs' AS kind, CAST(NULL AS VARCHAR) AS container, file_name FROM files
  UNION
  SELECT 'albums', 'album-' || CAST(l.l_orderkey AS VARCHAR), f.file_name
  FROM lineitem l JOIN files f ON f.p_partkey = l.l_partkey
  UNION
  SELECT 'playlists', o.o_orderpriority, f.file_name
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN files f ON f.p_partkey = l.l_partkey),
lib AS (
  SELECT kind, container, file_name, concat_ws('/', kind, container, file_name) AS path,
         string_split(left(file_name, length(file_name) - 4), ' - ')[1] AS name,
         string_split(left(file_name, length(file_name) - 4), ' - ')[2] AS artist,
         strpos(left(file_name, length(file_name) - 4), ' - ') AS sep
  FROM lib0)"""

DEFAULT_IMAGE_SQL = "'static/default-cover.jpg'"

ITEMS = """items AS (
  SELECT l.l_orderkey AS list_id,
         row_number() OVER (PARTITION BY l.l_orderkey
                            ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                                     l.l_returnflag <> 'R') - 1 AS position,
         CAST(p.p_partkey AS VARCHAR) AS id, p.p_name AS name, s.s_name AS artist,
         CASE WHEN l.l_returnflag = 'R' THEN """ + DEFAULT_IMAGE_SQL + """ ELSE 'img/' || p.p_brand END AS image
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey)"""

ARTISTS = """shipped AS (
  SELECT l.l_suppkey, list_sort(list_distinct(list(p.p_type))) AS genres, count(*) AS n
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_suppkey),
artists AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS id, s.s_name AS name,
         CASE WHEN s.s_acctbal < 0 THEN NULL ELSE 'img/' || s.s_name END AS image,
         coalesce(sh.n, 0) AS followers, CAST(s.s_nationkey AS BIGINT) AS popularity,
         coalesce(sh.genres, []) AS genres, s.s_acctbal
  FROM supplier s LEFT JOIN shipped sh ON sh.l_suppkey = s.s_suppkey)"""


def _sq(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def html_unescape_sql(x: str) -> str:
    """Python's ``html.unescape`` as a DuckDB expression (same algorithm as
    ``text.html_unescape``)."""
    from moodlake.functions.text import (ENTITY_PIECES, HTML5_ENTITIES, LEGACY_ENTITIES, MAX_LEGACY_NAME,
                                         charref_fixes)
    ents = "MAP {" + ", ".join(f"{_sq(k)}: {_sq(v)}" for k, v in HTML5_ENTITIES.items()) + "}"
    legacy = "MAP {" + ", ".join(f"{_sq(k)}: {_sq(v)}" for k, v in LEGACY_ENTITIES.items()) + "}"
    fixes = " ".join(f"WHEN {n} THEN chr({ord(ch)})" for n, ch in charref_fixes().items())
    name = "substr(p, 2)"
    prefixes = ", ".join(f"({legacy})[substr({name}, 1, {k})] || substr({name}, {k + 1})"
                         for k in range(MAX_LEGACY_NAME, 1, -1))
    hx = "regexp_extract(p, '^&#[xX]([0-9a-fA-F]+)', 1)"
    dec = "regexp_extract(p, '^&#([0-9]+)', 1)"
    num = f"(CASE WHEN {hx} <> '' THEN TRY_CAST('0x' || {hx} AS BIGINT) ELSE TRY_CAST({dec} AS BIGINT) END)"
    huge = (f"length(ltrim(CASE WHEN {hx} <> '' THEN {hx} ELSE {dec} END, '0')) > "
            f"CASE WHEN {hx} <> '' THEN 6 ELSE 7 END")
    invalid = (f"({num} BETWEEN 1 AND 8 OR {num} = 11 OR {num} BETWEEN 14 AND 31 OR {num} BETWEEN 127 AND 159"
               f" OR {num} BETWEEN 64976 AND 65007 OR ({num} & 65534) = 65534)")
    numeric = (f"CASE WHEN {huge} THEN chr(65533) "
               f"WHEN {num} IN ({', '.join(str(n) for n in charref_fixes())}) THEN CASE {num} {fixes} END "
               f"WHEN {num} BETWEEN 55296 AND 57343 OR {num} > 1114111 THEN chr(65533) "
               f"WHEN {invalid} THEN '' ELSE chr(CAST({num} AS INTEGER)) END")
    piece = (f"CASE WHEN starts_with(p, '&') AND length(p) > 1 THEN "
             f"CASE WHEN starts_with(p, '&#') THEN {numeric} "
             f"ELSE coalesce(({ents})[{name}], {prefixes}, p) END ELSE p END")
    pattern = ENTITY_PIECES.replace("'", "''")
    return (f"CASE WHEN {x} IS NOT NULL THEN array_to_string(list_transform("
            f"regexp_extract_all({x}, '{pattern}'), lambda p: {piece}), '') END")


def more_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # scored record of every play (R1 batch form)
    q["scored_plays"] = ("WITH " + PLAYS + ",\n" + VARIANTS + ",\n"
                         + scoring_ctes("variants", ["doc_id", "lyrics_missing"], "lyrics", None, True, True, True)
                         + f"""
SELECT p.play_id, concat_ws('_', p.id, strftime(p."timestamp", '%Y-%m-%dT%H:%M:%S.%gZ')) AS combined_id,
       p.topic, CASE WHEN s.compound = 0 THEN '0.0'
          ELSE regexp_replace(regexp_replace(CAST(CAST(s.compound AS DECIMAL(6,4)) AS VARCHAR),
               '0+$', ''), '\\.$', '.0') END AS sentiment,
       s.emotion, {category("p.lyrics = 'Lyrics not found'", "s.compound")} AS sentiment_category,
       md5({clean("p.lyrics")}) AS cleaned_md5
FROM plays p JOIN scores s ON s.doc_id = p.doc_id
 AND s.lyrics_missing = (p.lyrics = 'Lyrics not found' AND p.lyrics IS NOT NULL)""")
    q["clean_text"] = f"""SELECT doc_id, md5({clean('text')}) AS cleaned_md5,
        CAST(length({clean('text')}) AS INTEGER) AS cleaned_len,
        {clean('text')} IS NOT NULL AND {clean('text')} <> '' AS present FROM documents"""
    q["clean_title"] = f"""SELECT doc_id,
        {py_strip("regexp_extract(split_part(text, chr(10), 1), '^[^\\[(]*', 0)")} AS title FROM documents"""
    q["drop_first_line"] = """SELECT doc_id, md5(regexp_replace(text, '^[^\\n]*\\n', '')) AS body_md5
        FROM documents"""
    q["validate_lyrics"] = """WITH sung AS (SELECT doc_id, CASE doc_id % 10 WHEN 1 THEN '[FN#1] ' || text
          WHEN 2 THEN replace(text, 'e', '"') ELSE text END AS text FROM documents)
        SELECT doc_id,
        CAST(length(text) - length(replace(text, '"', '')) AS INTEGER) AS quotes,
        strpos(text, '[FN#') > 0 AS footnote,
        md5(CASE WHEN strpos(text, '[FN#') > 0 OR length(text) - length(replace(text, '"', '')) >= 50
                 THEN 'Lyrics not found' ELSE regexp_replace(text, '^[^\\n]*\\n', '') END) AS lyrics_md5
        FROM sung"""
    title = "regexp_extract(html, '<title>(.*?)</title>', 1)"
    q["html_unescape"] = f"""SELECT page_id, {html_unescape_sql(title)} AS title, CAST(length(u) AS INTEGER) AS length,
        md5(u) AS page_md5 FROM (SELECT *, {html_unescape_sql("html")} AS u FROM pages)"""
    q["percent_decode"] = f"""SELECT page_id, url_decode(replace(url, '+', '%2B')) AS decoded,
        replace({title}, ' ', '+') || '+%zzA' AS decoded_title FROM pages"""
    q["after_equals"] = """SELECT page_id,
        CASE WHEN strpos(url, '=') > 0 THEN substr(url, strpos(url, '=') + 1) END AS after_eq FROM pages"""
    q["search_keys"] = """SELECT p_partkey, p_name || ' ' || p_brand AS key_spaced,
        p_name || p_brand AS key_joined FROM part"""
    q["iso_and_key"] = "WITH " + PLAYS + """
SELECT play_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_timestamp,
       concat_ws('_', id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ')) AS combined_id FROM plays"""
    q["parse_envelope"] = "WITH " + PLAYS + """
SELECT id, name, artist, topic, genre, md5(lyrics) AS lyrics_md5,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_timestamp FROM plays"""
    q["play_envelope"] = "WITH " + PLAYS + """
SELECT play_id, md5(CAST(json_object('topic', topic, 'name', name, 'artist', artist, 'lyrics', lyrics,
                                     'genre', genre, 'id', id) AS VARCHAR)) AS value_md5 FROM plays"""
    q["unwrap_message"] = """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""
    q["union_feeds"] = "WITH " + PLAY_KEYS + "\nSELECT play_id, topic, doc_id FROM pk"
    q["by_feed"] = "WITH " + PLAYS + """
SELECT play_id, name, artist, genre FROM plays WHERE topic = 'song_italy_top'"""
    q["flatten_tracks"] = "WITH " + ITEMS + "\nSELECT list_id, position, id, name, artist, image FROM items"
    q["favourite_neighbors"] = "WITH " + ITEMS + """
SELECT list_id, position, id,
  coalesce(lag(id) OVER w, last_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_id,
  coalesce(lead(id) OVER w, first_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_id
FROM items WINDOW w AS (PARTITION BY list_id ORDER BY position)"""
    q["artist_profile"] = "WITH " + ARTISTS + """
SELECT id, name, image, followers, popularity, array_to_string(genres, ', ') AS genres,
       CASE WHEN len(genres) = 0 OR genres[1] IS NULL OR genres[1] = '' THEN 'not applicable'
            ELSE genres[1] END AS primary_genre FROM artists"""
    q["artist_cards"] = "WITH " + ARTISTS + f"""
SELECT name, id, coalesce(image, {DEFAULT_IMAGE_SQL}) AS image FROM artists"""
    q["with_genre"] = "WITH " + ITEMS + ",\n" + ARTISTS + """
SELECT i.list_id, i.position, i.artist || CASE WHEN i.list_id % 5 = 0 THEN ' (unknown)' ELSE '' END AS artist,
       CASE WHEN a.id IS NULL THEN NULL
            WHEN CAST(a.id AS BIGINT) % 7 = 0 OR len(a.genres) = 0 OR a.genres[1] = '' THEN 'not applicable'
            ELSE a.genres[1] END AS genre
FROM items i LEFT JOIN artists a ON a.name = i.artist || CASE WHEN i.list_id % 5 = 0 THEN ' (unknown)' ELSE '' END"""
    q["parse_file_split"] = "WITH " + FILES + "\nSELECT path, name, artist FROM lib"
    q["parse_file_index"] = "WITH " + FILES + """,
ix AS (SELECT kind, container, path,
         CASE WHEN sep > 0 THEN left(left(file_name, length(file_name) - 4), sep - 1) END AS name,
         CASE WHEN sep > 0 THEN substr(left(file_name, length(file_name) - 4), sep + 3) END AS artist
       FROM lib)
SELECT path, name, artist, concat_ws('/', kind, container, name || ' - ' || artist || '.mp3') AS rebuilt FROM ix"""
    q["by_artist"] = "WITH " + FILES + "\nSELECT path, kind, container, name FROM lib WHERE artist = 'Brand#3'"
    q["by_container"] = "WITH " + FILES + """
SELECT path, name, artist FROM lib WHERE kind = 'playlists' AND container = '1-URGENT'"""
    q["distinct_artists"] = "WITH " + FILES + """,
r AS (SELECT artist, CASE kind WHEN 'albums' THEN 0 WHEN 'playlists' THEN 1 ELSE 2 END AS kr,
             coalesce(container, '') AS c, file_name FROM lib WHERE artist IS NOT NULL)
SELECT artist, first_kind_rank, first_container, first_file FROM (
  SELECT artist, kr AS first_kind_rank, c AS first_container, file_name AS first_file,
         row_number() OVER (PARTITION BY artist ORDER BY kr, c, file_name) AS rn FROM r) WHERE rn = 1"""
    q["artist_library"] = "WITH " + FILES + """
SELECT path, kind, container, name,
       CASE kind WHEN 'albums' THEN 0 WHEN 'playlists' THEN 1 ELSE 2 END AS kind_rank
FROM lib WHERE artist = 'Brand#3'"""
    q["delete_song"] = "WITH " + FILES + """
SELECT path FROM lib WHERE NOT coalesce(kind = 'songs' AND name = 'red widget' AND artist = 'Brand#17', false)"""
    q["delete_container"] = "WITH " + FILES + """
SELECT path FROM lib WHERE NOT coalesce(kind = 'playlists' AND container = '1-URGENT', false)"""
    q["delete_from"] = "WITH " + FILES + """,
doomed AS (SELECT DISTINCT name, artist FROM lib WHERE kind = 'songs' AND artist = 'Brand#3'),
kept AS (
  SELECT * FROM lib l WHERE NOT (l.kind = 'playlists' AND l.container = '2-HIGH'
    AND EXISTS (SELECT 1 FROM doomed d WHERE d.name IS NOT DISTINCT FROM l.name
                AND d.artist IS NOT DISTINCT FROM l.artist)))
SELECT kind, container, count(*) AS songs FROM kept WHERE container IS NOT NULL GROUP BY kind, container"""
    q["delete_everywhere"] = "WITH " + FILES + """,
doomed AS (SELECT DISTINCT name, artist FROM lib WHERE kind = 'songs' AND artist = 'Brand#3')
SELECT path FROM lib l WHERE NOT EXISTS (SELECT 1 FROM doomed d WHERE d.name IS NOT DISTINCT FROM l.name
                                         AND d.artist IS NOT DISTINCT FROM l.artist)"""
    q["library_delete"] = "WITH " + FILES + """,
doomed AS (SELECT DISTINCT name, artist FROM lib WHERE kind = 'playlists' AND container = '3-MEDIUM')
SELECT path FROM lib l WHERE NOT EXISTS (SELECT 1 FROM doomed d WHERE d.name IS NOT DISTINCT FROM l.name
                                         AND d.artist IS NOT DISTINCT FROM l.artist)"""
    q["library_neighbors"] = "WITH " + FILES + """
SELECT kind, container, file_name,
  coalesce(lag(file_name) OVER w, last_value(file_name) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_file_name,
  coalesce(lead(file_name) OVER w, first_value(file_name) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_file_name
FROM lib WINDOW w AS (PARTITION BY kind, container ORDER BY file_name)"""
    q["duplicate_members"] = """WITH k AS (
  SELECT l_orderkey, l_linenumber FROM (SELECT DISTINCT * FROM lineitem)
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT l.* FROM lineitem l SEMI JOIN k ON k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber"""
    q["dedupe_keep_first"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
             l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn FROM lineitem) WHERE rn = 1"""
    q["purge_duplicates"] = """WITH k AS (
  SELECT l_orderkey, l_linenumber FROM (SELECT DISTINCT * FROM lineitem)
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
ids AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem SEMI JOIN k USING (l_orderkey, l_linenumber))
SELECT l.* FROM lineitem l ANTI JOIN ids USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)"""
    q["circular_neighbors"] = """SELECT conv_id, turn, role,
  coalesce(lag(turn) OVER w, last_value(turn) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_turn,
  coalesce(lag(role) OVER w, last_value(role) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_role,
  coalesce(lead(turn) OVER w, first_value(turn) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_turn,
  coalesce(lead(role) OVER w, first_value(role) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_role
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""
    q["number_items"] = """SELECT o_orderkey, o_orderpriority,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS item_number FROM orders"""
    q["page"] = """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
  ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100"""
    q["with_lyrics"] = """WITH t AS (
  SELECT doc_id, 'song ' || CAST(doc_id AS VARCHAR) || CASE lang WHEN 'de' THEN ' [Remastered]'
         WHEN 'fr' THEN ' (live)' ELSE CASE WHEN doc_id % 7 = 0 THEN ' unknown' ELSE '' END END AS name,
         source AS artist FROM documents),
dim AS (SELECT 'song ' || CAST(doc_id AS VARCHAR) AS title, source AS artist,
  CASE WHEN strpos(text, '[FN#') > 0 OR length(text) - length(replace(text, '"', '')) >= 50
       THEN 'Lyrics not found' ELSE regexp_replace(text, '^[^\\n]*\\n', '') END AS lyrics,
  row_number() OVER (PARTITION BY 'song ' || CAST(doc_id AS VARCHAR), source ORDER BY doc_id) AS rn
  FROM documents),
j AS (SELECT t.doc_id, t.name, coalesce(d.lyrics, 'Lyrics not found') AS lyrics FROM t
  LEFT JOIN dim d ON d.rn = 1 AND d.artist = t.artist AND d.title = """ + py_strip(
        "regexp_extract(t.name, '^[^\\[(]*', 0)") + """)
SELECT doc_id, name, md5(lyrics) AS lyrics_md5, lyrics = 'Lyrics not found' AS not_found FROM j"""
    q["with_track_id"] = "WITH " + FILES + """,
cat AS (SELECT p_name || p_brand AS k, min(p_partkey) AS id FROM part GROUP BY p_name || p_brand)
SELECT l.path, l.name, l.artist, c.id AS track_id FROM lib l LEFT JOIN cat c ON c.k = l.name || l.artist
WHERE l.kind = 'songs'"""
    rel = ("CASE WHEN lower(name) = '{q}' THEN 0 WHEN starts_with(lower(name), '{q}') THEN 1 "
           "WHEN contains(lower(name), '{q}') THEN 2 END")
    parts = []
    for kind, src, cap in (("artist", "SELECT s_suppkey AS id, s_name AS name FROM supplier", 12),
                           ("album", "SELECT n_nationkey AS id, n_name AS name FROM nation", 12),
                           ("song", "SELECT p_partkey AS id, p_name AS name FROM part", 10),
                           ("playlist", "SELECT c_custkey AS id, c_name AS name FROM customer", 12)):
        parts.append(f"""SELECT * FROM (SELECT '{kind}' AS kind, CAST(id AS VARCHAR) AS id, name,
    {rel.format(q='12')} AS relevance FROM ({src})) x WHERE relevance IS NOT NULL""" + f"""
    QUALIFY row_number() OVER (ORDER BY relevance, name, id) <= {cap}""")
    body = "\nUNION ALL\n".join(f"SELECT *, row_number() OVER (ORDER BY relevance, name, id) AS rank FROM ({p})"
                                for p in parts)
    q["search_all"] = body
    pq = "customer#0000001"
    q["search_playlist"] = f"""SELECT * FROM (
  SELECT 'playlist' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         {rel.format(q=pq).replace('name', 'c_name')} AS relevance FROM customer) x
WHERE relevance IS NOT NULL QUALIFY row_number() OVER (ORDER BY relevance, name, id) <= 1""".replace(
        "SELECT * FROM (", "SELECT *, CAST(1 AS BIGINT) AS rank FROM (", 1)
    q["artist_top_tracks"] = """WITH pl AS (
  SELECT s.s_name AS artist, l.l_partkey AS track_id, p.p_name AS name,
         CASE WHEN n.n_nationkey % 3 = 0 THEN [n.n_name, 'IT'] ELSE [n.n_name] END AS markets
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey),
c AS (SELECT artist, track_id, count(*) AS plays, min(name) AS name FROM pl WHERE list_contains(markets, 'IT')
      GROUP BY artist, track_id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY artist ORDER BY plays DESC, track_id) AS rank FROM c)
WHERE rank <= 3"""
    q["track_neighbors"] = "WITH " + ITEMS + """,
n AS (SELECT list_id, position, id, name, artist,
  coalesce(lag(id) OVER w, last_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_id,
  coalesce(lead(id) OVER w, first_value(id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_id
FROM items WINDOW w AS (PARTITION BY list_id ORDER BY position))
SELECT list_id, position, id, prev_id, next_id FROM n
WHERE name = 'red widget' AND artist = 'Supplier#000000007' ORDER BY list_id, position LIMIT 1"""
    q["album_cards"] = f"""SELECT 'album-' || CAST(o.o_orderkey AS VARCHAR) AS name, CAST(o.o_orderkey AS VARCHAR) AS id,
  CASE WHEN o.o_orderstatus = 'F' THEN {DEFAULT_IMAGE_SQL} ELSE 'img/album-' || CAST(o.o_orderkey AS VARCHAR) END AS image,
  c.c_name AS artist
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""
    q["artist_albums"] = f"""SELECT artist, id, name, image, released, rank FROM (
  SELECT n.n_name AS artist, CAST(o.o_orderkey AS VARCHAR) AS id, 'album-' || CAST(o.o_orderkey AS VARCHAR) AS name,
    CASE WHEN o.o_orderstatus = 'F' THEN {DEFAULT_IMAGE_SQL} ELSE 'img/album-' || CAST(o.o_orderkey AS VARCHAR) END AS image,
    CAST(o.o_orderdate AS DATE) AS released,
    row_number() OVER (PARTITION BY n.n_name ORDER BY CAST(o.o_orderdate AS DATE) DESC, CAST(o.o_orderkey AS VARCHAR)) AS rank
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey) WHERE rank <= 50"""
    q["playlist_cards"] = f"""SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS id,
  CASE WHEN c_acctbal < 0 THEN {DEFAULT_IMAGE_SQL} ELSE 'img/' || c_name END AS image FROM customer"""
    q["to_frames"] = """SELECT event_id, md5(CAST(json_object('event_id', event_id, 'user_id', user_id,
  'event_type', event_type, 'value', value, 'props', props) AS VARCHAR)) AS value_md5 FROM events"""
    q["sql_functions"] = f"""SELECT doc_id, md5({clean('text')}) AS cleaned_md5,
  {py_strip("regexp_extract(split_part(text, chr(10), 1), '^[^\\[(]*', 0)")} AS title,
  md5(CASE WHEN strpos(text, '[FN#') > 0 OR length(text) - length(replace(text, '"', '')) >= 50
           THEN 'Lyrics not found' ELSE regexp_replace(text, '^[^\\n]*\\n', '') END) AS lyrics_md5,
  CAST(length(text) - length(replace(text, '"', '')) AS INTEGER) AS quotes,
  md5(regexp_replace(text, '^[^\\n]*\\n', '')) AS body_md5, md5({html_unescape_sql('text')}) AS unescaped_md5,
  source || 'é+%zz' AS decoded, lang || '=' || source AS after_eq, lang || '-' || source AS key,
  {category("doc_id % 5 = 0", "(doc_id % 9 - 4) / 4.0")} AS category,
  doc_id || '_' || strftime(make_timestamp(doc_id * 1000000), '%Y-%m-%dT%H:%M:%S.%gZ') AS combined,
  CASE WHEN doc_id % 9 = 4 THEN '0.0' ELSE regexp_replace(regexp_replace(CAST(CAST((doc_id % 9 - 4) / 4.0 AS DECIMAL(6,4)) AS VARCHAR),
    '0+$', ''), '\\.$', '.0') END AS score,
  'albums/' || lang || '/' || source || ' - ' || doc_id || '.mp3' AS path,
  lang AS split_name, source AS split_artist, lang AS index_name, source || ' - ' || doc_id AS index_artist FROM documents"""
    return q


def queries_sql() -> dict[str, str]:
    q = scoring_sql()
    q.update(more_sql())
    from moodlake.plans import browse
    q.update(browse.queries_sql())
    # The streams must equal their batch forms.
    for g in ("day", "week", "month"):
        q[f"stream_trend_{g}"] = q[f"taste_trend_{g}"]
    q["stream_scoring"] = ("SELECT combined_id, topic, sentiment, emotion, sentiment_category, cleaned_md5 FROM ("
                           + q["scored_plays"] + ")")
    q["stream_replay"] = q["stream_restart"] = q["stream_scoring"]
    return q
