"""Word lexicon used by the scoring job.

The lexicon is a dimension table ``(lang, word, valence_milli, emotion)``
with one row per ``(lang, word)``. Valences are integers in thousandths so
sums are exact in any order. The built-in list below is a small example of
unrecorded origin; a real deployment passes its own table with ``load_lexicon``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Emotion labels in tie-break order (first label wins a tie).
EMOTIONS = ["fear", "anger", "anticipation", "trust", "surprise",
            "positive", "negative", "sadness", "disgust", "joy"]

# Fixed value: normalisation constant of the compound score s / sqrt(s^2 + a).
COMPOUND_ALPHA = 15

# Negation scalar of the valence model (a lexicon word preceded
# within three tokens by a negator is scaled by it, once per negator).
NEGATION_SCALAR_PCT = -74
NEGATION_WINDOW = 3

# Contrast rule — sentiment before the first contrast word of
# a text is scaled by 0.5, after it by 1.5 (percent).
CONTRAST_BEFORE_PCT = 50
CONTRAST_AFTER_PCT = 150
CONTRAST_WORDS = {"en": "but", "fr": "mais", "de": "aber", "es": "pero"}

# Negators per language (whole tokens after cleaning).
NEGATORS = {
    "en": ["not", "no", "never", "none", "nothing", "nobody", "neither", "nor", "nowhere", "cannot",
           "dont", "doesnt", "didnt", "isnt", "arent", "wasnt", "werent", "wont", "cant", "couldnt",
           "shouldnt", "wouldnt", "aint", "without"],
    "fr": ["ne", "pas", "jamais", "rien", "aucun", "aucune", "personne", "sans"],
    "de": ["nicht", "kein", "keine", "keinen", "keinem", "keiner", "nie", "niemals", "nichts", "ohne"],
    "es": ["no", "nunca", "jamás", "nada", "ningún", "ninguna", "ninguno", "tampoco", "sin"],
}

# Intensity words (1 strengthens, -1 weakens the lexicon word after
# it) and what one adds to that word's valence, in thousandths, from one, two and three tokens before it.
INTENSITY_MILLI = [293, 278, 264]
INTENSIFIERS = {
    "en": {"very": 1, "really": 1, "so": 1, "extremely": 1, "totally": 1, "completely": 1, "absolutely": 1,
           "deeply": 1, "truly": 1, "incredibly": 1, "especially": 1, "more": 1, "most": 1,
           "almost": -1, "barely": -1, "hardly": -1, "slightly": -1, "somewhat": -1, "partly": -1, "less": -1},
    "fr": {"très": 1, "vraiment": 1, "tellement": 1, "extrêmement": 1, "totalement": 1, "trop": 1,
           "peu": -1, "presque": -1, "légèrement": -1},
    "de": {"sehr": 1, "wirklich": 1, "extrem": 1, "total": 1, "völlig": 1, "besonders": 1,
           "kaum": -1, "etwas": -1, "fast": -1, "wenig": -1},
    "es": {"muy": 1, "realmente": 1, "tan": 1, "extremadamente": 1, "totalmente": 1, "demasiado": 1,
           "poco": -1, "casi": -1, "apenas": -1},
}

# Languages a text can be scored in.
LANGUAGES = sorted(NEGATORS)

LEXICON_SCHEMA = T.StructType([
    T.StructField("lang", T.StringType(), False),
    T.StructField("word", T.StringType(), False),
    T.StructField("valence_milli", T.IntegerType(), False),
    T.StructField("emotion", T.StringType(), False),
])

# The built-in word list (lang, word, valence in 1/1000, emotion).
BUILTIN_LEXICON = [
    ("en", "love", 3200, "joy"), ("en", "happy", 2700, "joy"),
    ("en", "good", 1900, "positive"), ("en", "great", 3100, "joy"),
    ("en", "best", 3200, "positive"), ("en", "hope", 1900, "anticipation"),
    ("en", "free", 1600, "joy"), ("en", "like", 1500, "positive"),
    ("en", "well", 1100, "positive"), ("en", "kind", 1700, "trust"),
    ("en", "true", 1600, "trust"), ("en", "safe", 1900, "trust"),
    ("en", "sweet", 2000, "joy"), ("en", "smile", 1500, "joy"),
    ("en", "win", 2800, "anticipation"), ("en", "wow", 2800, "surprise"),
    ("en", "sad", -2100, "sadness"), ("en", "bad", -2500, "negative"),
    ("en", "hate", -2700, "anger"), ("en", "fear", -2200, "fear"),
    ("en", "cry", -2100, "sadness"), ("en", "pain", -2300, "sadness"),
    ("en", "alone", -1000, "sadness"), ("en", "lost", -1300, "sadness"),
    ("en", "angry", -2300, "anger"), ("en", "dead", -3300, "fear"),
    ("en", "war", -2900, "fear"), ("en", "broken", -1900, "sadness"),
    ("en", "wrong", -2100, "negative"), ("en", "sick", -2000, "disgust"),
    ("en", "dirty", -1900, "disgust"), ("en", "not", -100, "negative"),
    ("fr", "amour", 3000, "joy"), ("fr", "heureux", 2700, "joy"),
    ("fr", "bon", 1900, "positive"), ("fr", "bien", 1500, "positive"),
    ("fr", "espoir", 1900, "anticipation"), ("fr", "joie", 2800, "joy"),
    ("fr", "beau", 2400, "joy"), ("fr", "vrai", 1500, "trust"),
    ("fr", "libre", 1600, "joy"), ("fr", "surprise", 1100, "surprise"),
    ("fr", "triste", -2100, "sadness"), ("fr", "mal", -2000, "negative"),
    ("fr", "peur", -2200, "fear"), ("fr", "haine", -2700, "anger"),
    ("fr", "colère", -2300, "anger"), ("fr", "mort", -3000, "fear"),
    ("fr", "douleur", -2300, "sadness"), ("fr", "seul", -1000, "sadness"),
    ("fr", "pleurer", -2000, "sadness"), ("fr", "guerre", -2800, "fear"),
    ("fr", "sale", -1800, "disgust"), ("fr", "pas", -100, "negative"),
    ("de", "liebe", 3000, "joy"), ("de", "glück", 2800, "joy"),
    ("de", "gut", 1900, "positive"), ("de", "schön", 2300, "joy"),
    ("de", "hoffnung", 1900, "anticipation"), ("de", "freude", 2800, "joy"),
    ("de", "frei", 1600, "joy"), ("de", "treu", 1800, "trust"),
    ("de", "wahr", 1500, "trust"), ("de", "überraschung", 1200, "surprise"),
    ("de", "traurig", -2100, "sadness"), ("de", "schlecht", -2500, "negative"),
    ("de", "angst", -2200, "fear"), ("de", "hass", -2700, "anger"),
    ("de", "wut", -2400, "anger"), ("de", "tod", -3000, "fear"),
    ("de", "schmerz", -2300, "sadness"), ("de", "allein", -1000, "sadness"),
    ("de", "krieg", -2800, "fear"), ("de", "falsch", -1700, "negative"),
    ("de", "ekel", -2200, "disgust"), ("de", "nicht", -100, "negative"),
    ("es", "amor", 3000, "joy"), ("es", "feliz", 2700, "joy"),
    ("es", "bueno", 1900, "positive"), ("es", "bien", 1500, "positive"),
    ("es", "esperanza", 1900, "anticipation"), ("es", "alegría", 2800, "joy"),
    ("es", "libre", 1600, "joy"), ("es", "verdad", 1500, "trust"),
    ("es", "hermoso", 2400, "joy"), ("es", "sorpresa", 1200, "surprise"),
    ("es", "triste", -2100, "sadness"), ("es", "malo", -2500, "negative"),
    ("es", "miedo", -2200, "fear"), ("es", "odio", -2700, "anger"),
    ("es", "ira", -2300, "anger"), ("es", "muerte", -3000, "fear"),
    ("es", "dolor", -2300, "sadness"), ("es", "guerra", -2800, "fear"),
    ("es", "llorar", -2000, "sadness"), ("es", "asco", -2200, "disgust"),
    ("es", "no", -100, "negative"),
]


def builtin_lexicon(spark: SparkSession) -> DataFrame:
    """The built-in list as a DataFrame: an inline ``VALUES`` table, so it
    is a JVM-side local relation of known size (no Python worker)."""
    return spark.sql(f"SELECT * FROM VALUES {lexicon_values_sql()} AS lex(lang, word, valence_milli, emotion)")


def load_lexicon(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a user lexicon with the four lexicon columns: words in lower case,
    one valence per (lang, word) (the largest given), one row per emotion."""
    df = spark.read.format(fmt).schema(LEXICON_SCHEMA).load(path) if fmt != "parquet" \
        else spark.read.parquet(path)
    rows = df.select(F.lower("lang").alias("lang"), F.lower("word").alias("word"),
                     F.col("valence_milli").cast("int").alias("valence_milli"), F.col("emotion"))
    one = rows.groupBy("lang", "word").agg(F.max("valence_milli").alias("valence_milli"),
                                           F.collect_set("emotion").alias("emotions"))
    return one.select("lang", "word", "valence_milli", F.explode_outer("emotions").alias("emotion"))


def lexicon_values_sql() -> str:
    """The built-in list as a SQL ``VALUES`` body (for SQL-only engines)."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({q(l)}, {q(w)}, {v}, {q(e)})" for l, w, v, e in BUILTIN_LEXICON)
