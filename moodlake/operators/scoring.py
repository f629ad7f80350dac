"""Lexicon scoring: sentiment compound and dominant emotion.

Plan shape: ``posexplode(split(cleaned))`` → broadcast hash join with the
lexicon (map side, no shuffle); of the tokens that are in it neither as
valued nor as rule words, one per text stays → one ``groupBy(key, language)``
that collects a text's hits. The valence rules (negation, intensity,
contrast) are one ordered fold over the hits, whose state holds the places of
the last negators and intensity words and the side of the contrast word: the
work is linear in the words of a text. The dominant emotion is counted over the labels of the same
hits, so labels are open and scoring costs one shuffle and no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions.text import NOT_APPLICABLE, clean_text, is_present, score_text
from moodlake.operators.lexicon import (BUILTIN_LEXICON, COMPOUND_ALPHA, CONTRAST_AFTER_PCT, CONTRAST_BEFORE_PCT,
                                        CONTRAST_WORDS, EMOTIONS, INTENSIFIERS, INTENSITY_MILLI, LANGUAGES,
                                        NEGATION_SCALAR_PCT, NEGATION_WINDOW, NEGATORS)

WORD_FIELDS = "_wlang string, _word string, _val long, _emos array<string>, _neg boolean, _boost int, _turn boolean"


def _rule_words(negation: bool, contrast: bool, intensity: bool) -> dict[tuple[str, str], list]:
    """``(lang, word)`` to ``[negates, boosts, turns]`` of the rules in use."""
    out: dict[tuple[str, str], list] = {}
    for lang in LANGUAGES:
        for w in NEGATORS[lang] if negation else ():
            out.setdefault((lang, w), [False, 0, False])[0] = True
        for w, sign in INTENSIFIERS[lang].items() if intensity else ():
            out.setdefault((lang, w), [False, 0, False])[1] = sign
        if contrast:
            out.setdefault((lang, CONTRAST_WORDS[lang]), [False, 0, False])[2] = True
    return out


def _values(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A small inline table of the lexicon's columns (a JVM-side local relation)."""
    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, list):
            return f"array({', '.join(lit(x) for x in v)})"
        return repr(v) if isinstance(v, str) else str(v)
    names = [f.split()[0] for f in WORD_FIELDS.split(", ")]
    kinds = [f.split()[1] for f in WORD_FIELDS.split(", ")]
    cast = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, kinds))
    body = ", ".join(f"({', '.join(lit(v) for v in r)})" for r in rows)
    return spark.sql(f"SELECT {cast} FROM VALUES {body} AS w({', '.join(names)})")


def _words(spark: SparkSession, lexicon: DataFrame | None, rules: dict) -> DataFrame:
    """One row per language and word, valued words and rule words alike. No
    join hint: Catalyst and AQE broadcast it by its size in bytes."""
    if lexicon is None:
        known = {(l, w): (v, [e]) for l, w, v, e in BUILTIN_LEXICON}
        return _values(spark, [(*k, *known.get(k, (None, None)), *rules.get(k, [False, 0, False]))
                               for k in sorted(known.keys() | rules.keys())])
    rows = lexicon.select(F.col("lang").alias("_wlang"), F.col("word").alias("_word"),
                          F.col("valence_milli").cast("long").alias("_val"), F.array("emotion").alias("_emos"),
                          F.lit(False).alias("_neg"), F.lit(0).alias("_boost"), F.lit(False).alias("_turn"))
    if rules:
        rows = rows.unionByName(_values(spark, [(*k, None, None, *r) for k, r in rules.items()]))
    first = F.max_by("_boost", F.abs("_boost"))
    return rows.groupBy("_wlang", "_word").agg(
        F.max("_val").alias("_val"), F.array_compact(F.array_distinct(F.flatten(F.collect_list("_emos")))).alias("_emos"),
        F.max("_neg").alias("_neg"), first.alias("_boost"), F.max("_turn").alias("_turn"))


# Token weights are integers in 1e-8 (three negation factors and one
# contrast factor, each in percent); valences are in 1e-3, so sums of
# valence x weight are exact integers in 1e-11.
WEIGHT_ONE = 100_000_000
SUM_UNIT = 1e11


def compound_from_units(s_units: Column) -> Column:
    """A6 on a sum kept in 1e-11 units (exact with rule scaling)."""
    s = F.coalesce(s_units, F.lit(0)).cast("double") / SUM_UNIT
    return F.round(s / F.sqrt(s * s + F.lit(float(COMPOUND_ALPHA))), 4)


def fold_hits(hits: Column) -> Column:
    """Sum in 1e-11 of ``array<struct<i, val, neg, boost, turn>>`` in token order.

    State: places of the last negators and intensity words within reach (as many as the
    window holds), sums before, at and after the first contrast word."""
    places = range(1, NEGATION_WINDOW + 1)
    far = F.lit(-NEGATION_WINDOW - 1)
    zero = F.lit(0).cast("long")
    start = F.struct(*[far.alias(f"n{k}") for k in places], *[far.alias(f"b{k}") for k in places],
                     *[F.lit(0).alias(f"s{k}") for k in places], F.lit(False).alias("turned"),
                     zero.alias("before"), zero.alias("at"), zero.alias("after"))
    milli = F.array(*[F.lit(m) for m in INTENSITY_MILLI])

    def step(a: Column, x: Column) -> Column:
        def near(place: Column) -> Column:
            return (x["i"] - place) <= NEGATION_WINDOW

        boost, factor = F.lit(0), F.lit(1).cast("long")
        for k in places:
            boost = boost + F.when(near(a[f"b{k}"]), a[f"s{k}"] * F.get(milli, x["i"] - a[f"b{k}"] - 1)).otherwise(0)
            factor = factor * F.when(near(a[f"n{k}"]), NEGATION_SCALAR_PCT).otherwise(100)
        value = F.coalesce((x["val"] + F.signum(x["val"]).cast("int") * boost) * factor, zero)
        here = x["turn"] & ~a["turned"]
        shift = [F.when(x[flag], x["i"] if j == 1 and field != "s" else x["boost"] if j == 1 else a[f"{field}{j - 1}"])
                 .otherwise(a[f"{field}{j}"]).alias(f"{field}{j}")
                 for flag, field in (("neg", "n"), ("boosts", "b"), ("boosts", "s")) for j in places]
        return F.struct(*shift, (a["turned"] | x["turn"]).alias("turned"),
                        (a["before"] + F.when(a["turned"] | here, zero).otherwise(value)).alias("before"),
                        (a["at"] + F.when(here, value).otherwise(zero)).alias("at"),
                        (a["after"] + F.when(a["turned"], value).otherwise(zero)).alias("after"))

    def finish(a: Column) -> Column:
        return F.when(a["turned"], a["before"] * CONTRAST_BEFORE_PCT + a["at"] * 100 + a["after"] * CONTRAST_AFTER_PCT) \
                .otherwise(a["before"] * 100)

    return F.aggregate(hits, start, step, finish)


def top_label(labels: Column, order: list[str]) -> Column:
    """The commonest label; ties go by their place in ``order``, labels not in it last, by name."""
    place = F.array(*[F.lit(e) for e in order]) if order else F.array().cast("array<string>")
    counted = F.transform(F.array_distinct(labels), lambda l: F.struct(
        (-F.size(F.filter(labels, lambda x: x == l))).alias("n"),
        F.coalesce(F.nullif(F.array_position(place, l), F.lit(0)), F.lit(len(order) + 1)).alias("rank"), l.alias("label")))
    return F.array_min(counted)["label"]


def score_texts(df: DataFrame, keys: list[str], text: str, lang: str | None = "lang",
                lexicon: DataFrame | None = None, cleaned: str | None = None,
                negation: bool = False, contrast: bool = False, intensity: bool = False,
                label_order: list[str] = EMOTIONS) -> DataFrame:
    """Score each distinct key of ``df`` once.

    Returns ``keys + [compound DOUBLE, sentiment STRING, emotion STRING]``.
    ``df`` must hold one text per key (a song's lyrics). Text NULL or empty
    after cleaning → compound 0.0 and emotion NULL; text without any
    lexicon hit → emotion ``not applicable``. ``negation`` scales a word's
    valence when a negator of its language precedes it, ``intensity`` moves it away from or
    towards zero by the intensity words before it, and ``contrast`` damps
    what precedes the first contrast word and stresses what follows
    (emotion counts are affected by none; a word with several emotions
    counts for each, its valence once). Any label of the lexicon can be the
    emotion; ties go by ``label_order``.

    Where ``lang`` is None, or a row's language is NULL or none of
    ``LANGUAGES``, every language's words are looked up in the same join and
    the language with the most hits is the text's (ties: alphabetical).
    """
    words = _words(df.sparkSession, lexicon, _rule_words(negation, contrast, intensity))
    if cleaned is None:
        df = df.withColumn("_cleaned", clean_text(text))
        cleaned = "_cleaned"
    known = F.when(F.col(lang).isin(LANGUAGES), F.col(lang)) if lang else F.lit(None)
    toks = df.select(*keys, known.cast("string").alias("_lang"), is_present(cleaned).alias("_present"),
                     F.posexplode_outer(F.split(F.col(cleaned), " ")).alias("_i", "_w"))
    same = (F.col("_w") == F.col("_word")) & (F.col("_lang").isNull() | (F.col("_lang") == F.col("_wlang")))
    # The first token stands for its text where there is no hit (texts without any token keep their NULL row).
    hits = toks.join(words, same, "left").where("_word is not null or _i = 0 or _i is null")
    hit = F.when(F.col("_word").isNotNull(), F.struct(
        F.col("_i").alias("i"), F.col("_val").alias("val"), F.col("_neg").alias("neg"), F.col("_boost").alias("boost"),
        (F.col("_boost") != 0).alias("boosts"), F.col("_turn").alias("turn")))
    per = hits.groupBy(*keys, "_wlang").agg(
        F.max("_present").alias("_present"), F.count("_val").alias("_hits"),
        F.collect_list(hit).alias("_h"), F.collect_list(F.when(F.col("_val").isNotNull(), F.col("_emos"))).alias("_l"))
    per = per.select(*keys, "_wlang", "_present", "_hits", fold_hits(F.array_sort("_h")).alias("_s"),
                     top_label(F.flatten("_l"), label_order).alias("_e"))
    agg = (per.groupBy(*keys).agg(F.max("_present").alias("_present"),
                                  F.min_by(F.struct("_s", "_e"), F.struct((-F.col("_hits")).alias("h"), "_wlang")).alias("_b"))
              .select(*keys, "_present", "_b.*"))
    compound = compound_from_units(F.col("_s"))
    emotion = F.when(F.col("_present"), F.coalesce("_e", F.lit(NOT_APPLICABLE)))
    return agg.select(*keys, compound.alias("compound"),
                      score_text(compound).alias("sentiment"), emotion.alias("emotion"))


def song_key(lyrics: str = "lyrics", song_id: str = "id", lang: str | None = None) -> Column:
    """A song as one struct ``(id, lang, md5(lyrics))``."""
    named = F.col(lang) if lang else F.lit(None).cast("string")
    return F.struct(F.col(song_id).alias("id"), named.alias("lang"), F.md5(F.col(lyrics)).alias("h"))


def score_songs(songs: DataFrame, lexicon: DataFrame | None = None,
                negation: bool = True, contrast: bool = True, intensity: bool = True) -> DataFrame:
    """``_song, compound, sentiment, emotion`` of songs ``_song, _lang, _cleaned``, one row each."""
    return score_texts(songs, ["_song"], "_cleaned", lang="_lang", lexicon=lexicon, cleaned="_cleaned",
                       negation=negation, contrast=contrast, intensity=intensity)


def join_songs(plays: DataFrame, songs: DataFrame) -> DataFrame:
    """Plays with the columns of their ``_song``. The join is on the key's fields rather
    than on the struct: both sides then get their own shuffle under the join (the song side
    is small), so AQE can split the partition of a song that holds a third of all plays."""
    songs = songs.withColumnRenamed("_song", "_k")
    cond = [F.col("_song")[f].eqNullSafe(F.col("_k")[f]) for f in ("id", "lang", "h")]
    return plays.join(songs, cond, "left").drop("_k")


def score_plays(plays: DataFrame, lexicon: DataFrame | None = None,
                lyrics: str = "lyrics", lang: str | None = None, song_id: str = "id",
                negation: bool = True, contrast: bool = True, intensity: bool = True) -> DataFrame:
    """Per-play scored record: each distinct (id, lang, lyrics) is cleaned
    and scored once, then joined back. Adds ``cleaned_lyrics, sentiment,
    emotion, compound``. A play names no language (its genre is a music
    genre): by default the lyrics' own words decide it.

    A song is keyed by one struct ``(id, lang, md5(lyrics))``: struct
    equality treats NULL fields as equal, so the key is null-safe and still a
    plain equi-join key; the songs and their scores share its partitioning.
    Exploded token rows never carry the lyrics. A hot song is folded by the
    partial ``dropDuplicates``, and its partition of the join-back is split
    by AQE's skew handling (tested in ``tests/test_skew.py``).
    """
    keyed = plays.withColumn("_song", song_key(lyrics, song_id, lang))
    songs = (keyed.select("_song", lyrics).dropDuplicates(["_song"])
                  .select("_song", F.col("_song")["lang"].alias("_lang"), clean_text(lyrics).alias("_cleaned")))
    scores = score_songs(songs, lexicon, negation, contrast, intensity)
    scored_songs = songs.select("_song", F.col("_cleaned").alias("cleaned_lyrics")).join(scores, "_song")
    out = join_songs(keyed, scored_songs)
    return out.select(*plays.columns, "cleaned_lyrics", "sentiment", "emotion", "compound")
