"""Lexicon scoring (J6, A6, A7) against a brute-force Python scorer."""

import math

from pyspark.sql import functions as F

from moodlake.operators.lexicon import BUILTIN_LEXICON, COMPOUND_ALPHA, EMOTIONS
from moodlake.operators.scoring import score_plays, score_texts

LEX = {(l, w): (v, e) for l, w, v, e in BUILTIN_LEXICON}


def brute(text_clean, lang):
    if not text_clean:
        return 0.0, None
    s, counts = 0, {}
    for w in text_clean.split(" "):
        hit = LEX.get((lang, w))
        if hit:
            s += hit[0]
            counts[hit[1]] = counts.get(hit[1], 0) + 1
    x = s / 1000.0
    comp = round(x / math.sqrt(x * x + COMPOUND_ALPHA), 4)
    if not counts:
        return comp, "not applicable"
    best = max(counts.values())
    return comp, next(e for e in EMOTIONS if counts.get(e) == best)


ROWS = [
    (1, "en", "I love love this, happy day!"),
    (2, "en", "sad and bad and sad"),
    (3, "en", ""),
    (4, "en", None),
    (5, "en", "nothing to see"),
    (6, "de", "die liebe und der tod"),
    (7, "de", "I love you"),          # English word, German lexicon: no hit
    (8, "en", "fear hate"),           # tie: fear before anger
    (9, "fr", "Lyrics not found"),
    (10, "es", "amor, amor... y dolor!"),
]


def test_score_texts_matches_brute_force(spark):
    from tests.test_text import py_clean
    df = spark.createDataFrame(ROWS, "id INT, lang STRING, text STRING")
    got = {r.id: (r.compound, r.emotion) for r in score_texts(df, ["id"], "text", "lang").collect()}
    for i, lang, text in ROWS:
        assert got[i] == brute(py_clean(text), lang), (i, text)


def test_empty_and_null_text(spark):
    df = spark.createDataFrame(ROWS, "id INT, lang STRING, text STRING")
    got = {r.id: r for r in score_texts(df, ["id"], "text", "lang").collect()}
    assert got[3].emotion is None and got[3].compound == 0.0 and got[3].sentiment == "0.0"
    assert got[4].emotion is None
    assert got[5].emotion == "not applicable"
    assert got[8].emotion == "fear"


def test_score_plays_scores_each_song_once_and_joins_back(spark):
    plays = spark.createDataFrame(
        [("a", "en", "love"), ("a", "en", "love"), ("a", "en", "Lyrics not found"), (None, "en", "sad")],
        "id STRING, genre STRING, lyrics STRING")
    out = score_plays(plays).orderBy(F.col("id").asc_nulls_first(), "lyrics").collect()
    assert len(out) == 4
    assert out[0].emotion == "sadness" and out[0].cleaned_lyrics == "sad"
    assert {r.emotion for r in out[1:]} == {"negative", "joy"}


def test_score_plan_is_one_shuffle_with_broadcast_lexicon(spark):
    df = spark.createDataFrame(ROWS, "id INT, lang STRING, text STRING")
    plan = score_texts(df, ["id"], "text", "lang")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_user_lexicon_and_bounded_broadcast(spark, tmp):
    from moodlake.operators.lexicon import load_lexicon
    path = f"{tmp}/lex"
    spark.createDataFrame([("EN", "Zap", 1500, "surprise")],
                          "lang STRING, word STRING, valence_milli INT, emotion STRING").write.parquet(path)
    lex = load_lexicon(spark, path)
    df = spark.createDataFrame([(1, "en", "zap zap love")], "id INT, lang STRING, text STRING")
    r = score_texts(df, ["id"], "text", "lang", lexicon=lex).first()
    assert r.emotion == "surprise" and r.compound == round(3.0 / math.sqrt(9.0 + 15), 4)


def test_language_is_the_texts_own_whatever_the_genre(spark):
    from moodlake.operators.scoring import score_plays
    rows = [("1", "pop", "love happy"), ("2", None, "love happy"), ("3", "en", "amour joie"), ("4", "rock", "zzz")]
    plays = spark.createDataFrame(rows, "id string, genre string, lyrics string")
    got = {r.id: (r.compound, r.emotion) for r in score_plays(plays).collect()}
    assert got["1"] == got["2"] and got["1"][0] > 0.8 and got["1"][1] == "joy"
    assert got["3"][0] > 0.8 and got["4"] == (0.0, "not applicable")


def test_rules_apply_to_plays_and_words_may_have_two_emotions(spark, tmp):
    import os
    from moodlake.operators.lexicon import load_lexicon
    from moodlake.operators.scoring import score_plays
    plays = spark.createDataFrame([("1", "not good"), ("2", "good")], "id string, lyrics string")
    got = {r.id: r.compound for r in score_plays(plays).collect()}
    assert got["1"] < 0 < got["2"]
    path = os.path.join(tmp, "lex")
    spark.createDataFrame([("en", "War", -2900, "fear"), ("en", "war", -2900, "anger"), ("en", "Love", 3200, "joy")],
                          "lang string, word string, valence_milli int, emotion string").write.parquet(path)
    one = score_texts(spark.createDataFrame([(1, "en", "war")], "id int, lang string, text string"), ["id"], "text",
                      lexicon=load_lexicon(spark, path)).first()
    assert one.compound == -0.5994 and one.emotion == "fear"


def brute_negated(text_clean, lang, contrast=False):
    from moodlake.operators.lexicon import CONTRAST_WORDS, NEGATORS
    if not text_clean:
        return 0.0
    toks = text_clean.split(" ")
    but = CONTRAST_WORDS.get(lang)
    at = toks.index(but) if contrast and but in toks else None
    s = 0
    for i, w in enumerate(toks):
        hit = LEX.get((lang, w))
        if hit:
            f = 1_000_000
            for k in (1, 2, 3):
                if i - k >= 0 and toks[i - k] in NEGATORS.get(lang, []):
                    f = f * -74 // 100
            if at is not None:
                f = f * (50 if i < at else 150 if i > at else 100) // 100
            s += hit[0] * f
    x = s / 1e9
    return round(x / math.sqrt(x * x + COMPOUND_ALPHA), 4)


def test_negation_option(spark):
    from tests.test_text import py_clean
    rows = ROWS + [(11, "en", "I do not love this"), (12, "en", "not never love"),
                   (13, "en", "love not"), (14, "de", "nicht gut aber liebe"), (15, "en", "not a b c love")]
    df = spark.createDataFrame(rows, "id INT, lang STRING, text STRING")
    got = {r.id: r.compound for r in score_texts(df, ["id"], "text", "lang", negation=True).collect()}
    for i, lang, text in rows:
        assert got[i] == brute_negated(py_clean(text), lang), (i, text)
    assert got[11] < 0 < got[12]


def test_contrast_option(spark):
    from tests.test_text import py_clean
    rows = ROWS + [(11, "en", "I love it but I hate it"), (12, "en", "sad but happy but sad"),
                   (13, "de", "liebe aber nicht gut"), (14, "fr", "triste mais bon"), (15, "en", "but love")]
    df = spark.createDataFrame(rows, "id INT, lang STRING, text STRING")
    got = {r.id: r.compound for r in
           score_texts(df, ["id"], "text", "lang", negation=True, contrast=True).collect()}
    for i, lang, text in rows:
        assert got[i] == brute_negated(py_clean(text), lang, contrast=True), (i, text)
    assert got[11] < 0


def brute_rules(text_clean, lang):
    """Negation, intensity and contrast, token by token."""
    from moodlake.operators.lexicon import CONTRAST_WORDS, INTENSIFIERS, INTENSITY_MILLI, NEGATORS
    toks = text_clean.split(" ") if text_clean else []
    at = toks.index(CONTRAST_WORDS[lang]) if CONTRAST_WORDS[lang] in toks else None
    s = 0
    for i, w in enumerate(toks):
        if (lang, w) not in LEX:
            continue
        v = LEX[lang, w][0]
        v += (1 if v > 0 else -1) * sum(INTENSIFIERS[lang].get(toks[i - d], 0) * INTENSITY_MILLI[d - 1]
                                        for d in (1, 2, 3) if i >= d)
        f = 100
        for d in (1, 2, 3):
            f *= -74 if i >= d and toks[i - d] in NEGATORS[lang] else 100
        s += v * f * (100 if at is None or i == at else 50 if i < at else 150) // 100
    x = s / 1e11 * 100 / 100
    return round(x / math.sqrt(x * x + COMPOUND_ALPHA), 4)


def test_rules_equal_brute_force_on_random_texts(spark):
    import random
    r = random.Random(1)
    words = ["good", "bad", "not", "very", "but", "slightly", "love", "x", "so", "never", "hate", "no"]
    rows = [(i, "en", " ".join(r.choice(words) for _ in range(r.randint(1, 40)))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, lang string, text string")
    got = {x.id: x.compound for x in score_texts(df, ["id"], "text", "lang", negation=True, contrast=True, intensity=True).collect()}
    assert got == {i: brute_rules(t, "en") for i, _, t in rows}
    assert got != {x.id: x.compound for x in score_texts(df, ["id"], "text", "lang", negation=True, contrast=True).collect()}


def test_a_label_outside_the_fixed_ten_can_win(spark):
    lex = spark.createDataFrame([("en", "sea", 100, "calm"), ("en", "sky", 100, "awe"), ("en", "war", -2900, "fear")],
                                "lang string, word string, valence_milli int, emotion string")
    df = spark.createDataFrame([(1, "en", "sea sea war"), (2, "en", "sea war"), (3, "en", "sea sky"), (4, "en", "land")],
                               "id int, lang string, text string")
    got = {r.id: r.emotion for r in score_texts(df, ["id"], "text", lexicon=lex).collect()}
    assert got == {1: "calm", 2: "fear", 3: "awe", 4: "not applicable"}


def test_cost_grows_with_the_words_not_their_square(spark):
    import time
    unit = "the good of not very bad but this love was "

    def seconds(words, texts):
        df = spark.range(texts).select("id", F.lit("en").alias("lang"), F.repeat(F.lit(unit), words // 10).alias("text"))
        best = None
        for _ in range(2):
            t = time.perf_counter()
            score_texts(df, ["id"], "text", negation=True, contrast=True, intensity=True).write.format("noop").mode("overwrite").save()
            best = min(best or 1e9, time.perf_counter() - t)
        return best

    seconds(1000, 8)
    # 20 times the words of a text, quadratic work would be 400 times.
    assert seconds(20_000, 8) < 25 * seconds(1000, 8)
