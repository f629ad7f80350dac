"""Toxicity of texts after noisy-channel deobfuscation.

A trigram model over letters is counted on the words of all documents. Tokens
that look disguised (letters mixed with digits or signs, a letter three times
in a row, letters one by one with spaces between, look-alikes of letters only)
span a lattice: each sign may stand for itself's look-alikes or for nothing,
each repetition or gap may be dropped. A look-alike at the edge of an ordinary
word is read or dropped, the word itself stays ("!" at an edge is a mark). The Viterbi path under the letter model and the channel's costs is the
restored word; other tokens have one path and stay as they are.

Restored texts are scored by a logistic model over the presence of words and
word beginnings, selected by their association with the toxic label and fitted
on a bounded sample of the labelled training rows (``SAMPLE_TOXIC`` toxic and
``SAMPLE_CLEAN`` other documents, the smallest by hash of doc_id).

Defined results: null and empty texts get the score of a text without words;
without labelled rows, or with one class only, every score is the share of
toxic rows (0 where there is none); of several labels of a doc_id the toxic one
counts, and of several texts of a sampled doc_id the smallest is learned from; repeated rows are scored alike; an empty table gives no rows; extra
columns are not read. Whole texts are counted and scored, tokens of any length
alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import materialize, per_process

SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 12000
FEATURES = 1024
MIN_SUPPORT = 4
PREFIXES = range(4, 9)
MAX_CACHED = 80_000
# Longer tokens are restored anew each time, not kept.
MAX_KEY = 64
# Characters after which the common beginning of all paths is put aside.
SETTLE = 64

# Letters: 0 word border, 1-26 a-z, 27-58 U+00E0 to U+00FF, 59 any other letter.
ALPHABET = 60
# Look-alikes of signs and digits.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
# Costs of the channel, as negative natural logarithms.
COST_LOOK, COST_SIGN_DROPPED, COST_DIGIT_DROPPED, COST_REPEAT_DROPPED, COST_GAP_DROPPED = 1.0, 0.7, 6.0, 0.3, 0.7
# A leading "@" or "$" is no punctuation, so dropping it costs more than a separator.
COST_LEAD_DROPPED = 4.0
_EDGE = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
# Edge signs that can be no letter; "!" at an edge ends or opens a sentence.
_PLAIN_EDGE = "".join(c for c in _EDGE if c not in LOOKS or c == "!")


def letter(c: str) -> int:
    n = ord(c)
    return n - 96 if 97 <= n <= 122 else n - 0xE0 + 27 if 0xE0 <= n <= 0xFF else 59


def _letter_table():
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            table[i] = letter(c.lower()[0])
    return table


def letter_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``cell, n``: letter trigrams of all texts, counted per task first, then summed."""
    def count(batches: Iterator) -> Iterator:
        table = per_process("letter_table", _letter_table)
        total = np.zeros(ALPHABET ** 3, np.int64)
        for pdf in batches:
            for t in pdf["text"]:
                if not t:
                    continue
                x = np.concatenate(([0, 0], table[np.frombuffer(t.encode("utf-32-le"), "<u4")], [0])).astype(np.int64)
                # One border between words.
                x = x[np.r_[True, True, (x[2:] != 0) | (x[1:-1] != 0)]] if len(x) > 3 else x
                cells = (x[:-2] * ALPHABET + x[1:-1]) * ALPHABET + x[2:]
                if len(cells) > 20_000:
                    total += np.bincount(cells, minlength=ALPHABET ** 3)
                else:
                    np.add.at(total, cells, 1)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at, "n": total[at]})

    src = docs.select(F.col(text).alias("text"))
    return (src.mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")))


def letter_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of a letter after two others, smoothed by shorter contexts (ALPHABET cubed numbers)."""
    n3 = np.zeros(ALPHABET ** 3)
    pdf = letter_counts(docs, text).toPandas()   # at most ALPHABET cubed rows
    n3[pdf["cell"].to_numpy(np.int64)] = pdf["n"].to_numpy(float)
    n3 = n3.reshape(ALPHABET, ALPHABET, ALPHABET)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 1) / (n1.sum() + ALPHABET)
    p2 = (n2 + 10 * p1) / (n2.sum(axis=1, keepdims=True) + 10)
    p3 = (n3 + 10 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 10)
    return np.log(p3).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per character of a disguised token its readings and their costs; a blank
    is a gap between single letters (a word border, or nothing)."""
    out, before = [], ""
    for c in token:
        if c == " ":
            out.append([(" ", 0.0), ("", COST_GAP_DROPPED)])
        elif c.isalpha():
            out.append([(c, 0.0), ("", COST_REPEAT_DROPPED)] if c == before else [(c, 0.0)])
        else:
            drop = COST_DIGIT_DROPPED if c.isdigit() else COST_SIGN_DROPPED
            out.append([*((x, COST_LOOK) for x in LOOKS.get(c, "")), ("", drop)])
        before = c
    return out


def decode(token: str, model: np.ndarray) -> str:
    """The cheapest path through the token's lattice under the letter model."""
    return cheapest(lattice(token), model)


def cheapest(readings_of: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The cheapest path under the letter model, in time linear in the length:
    what all paths have in common is put aside every ``SETTLE`` characters."""
    log_p = model.item    # a plain float, faster than a numpy one
    settled: list[str] = []
    paths = {(0, 0): (0.0, "")}
    for at, readings in enumerate(readings_of, 1):
        ahead: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in paths.items():
            for c, extra in readings:
                if c == "":
                    state, total, longer = (a, b), cost + extra, text
                else:
                    k = 0 if c == " " else letter(c)
                    state, total, longer = (b, k), cost + extra - log_p(a, b, k), text + c
                if state not in ahead or (total, longer) < ahead[state]:
                    ahead[state] = (total, longer)
        paths = ahead
        if at % SETTLE == 0:
            shared = commonprefix([text for _, text in paths.values()])
            settled.append(shared)
            paths = {k: (cost, text[len(shared):]) for k, (cost, text) in paths.items()}
    return "".join(settled) + min((cost - log_p(a, b, 0), text) for (a, b), (cost, text) in paths.items())[1]


def edge_word(lead: str, core: str, tail: str, model: np.ndarray) -> str:
    """The cheapest path of an ordinary word between signs: only the signs have readings.
    All paths meet at the word's first and again at its last two letters, so the sides are decoded alone."""
    before = after = ""
    if lead:
        signs = lattice(lead)
        if lead[0] in "@$":
            signs[0] = [(c, COST_LEAD_DROPPED if c == "" else cost) for c, cost in signs[0]]
        before = cheapest(signs + [[(c, 0.0)] for c in core[:2]], model)[:-2]
    if tail:
        after = cheapest([[(c, 0.0)] for c in core[-2:]] + lattice(tail), model)[2:]
    return before + core + after


_RUN = re.compile(r"(.)\1\1")
_HEX = re.compile(r"[0-9a-f]{12,}")


# Amounts and table cells: digits with signs other than "@" before or between them.
_NUMBER = re.compile(r"[^\w@]*\d[\d\W]*")


def disguised(word: str) -> bool:
    """Whether a lower-case token (plain edge signs gone) has more than one path."""
    if len(word) < 2:
        return False
    if word.isalpha():
        return bool(_RUN.search(word))
    letters = sum(map(str.isalpha, word))
    if not letters:
        looks = {c for c in word if c in LOOKS}
        return len(looks) >= 2 and not all(map(str.isdigit, looks)) and not _NUMBER.fullmatch(word)
    return letters + sum(c in LOOKS for c in word) >= 2 and not _HEX.fullmatch(word)


def restored_words(token: str, model: np.ndarray) -> tuple[str, ...]:
    """The words a token stands for, lower case (none if it holds no letter and no disguise)."""
    word = token.lower().strip(_PLAIN_EDGE)
    if word.isalpha():
        return tuple(decode(word, model).split()) if _RUN.search(word) else (word,)
    core = word.strip(_EDGE)
    if len(core) < len(word) and len(core) > 1 and core.isalpha() and not disguised(core):
        start = word.index(core)
        return (edge_word(word[:start], core, word[start + len(core):], model),)
    if disguised(word):
        return tuple(decode(word, model).split())
    return (word.strip(_EDGE),) if any(map(str.isalpha, word)) else ()


def tokens(text: str) -> list[str]:
    """White-space tokens; three or more single letters in a row are one token with blanks."""
    out, run = [], []
    for t in text.split():
        if len(t) == 1:
            run.append(t)
            continue
        if run:
            out.extend([" ".join(run)] if len(run) >= 3 else run)
            run = []
        out.append(t)
    out.extend([" ".join(run)] if len(run) >= 3 else run)
    return out


def restored_text(text: str | None, model: np.ndarray) -> str:
    """The text's words after deobfuscation, joined by blanks."""
    return " ".join(w for t in tokens(text or "") for w in restored_words(t, model))


def word_features(word: str) -> list[int]:
    """Hashes of the word and of its beginnings."""
    import xxhash
    b = [word + "$"] + [word[:k] for k in PREFIXES if len(word) >= k]
    return [xxhash.xxh3_64_intdigest(x.encode()) & 0x7FFFFFFFFFFFFFFF for x in b]


def text_features(text: str | None, model: np.ndarray, known: dict, select: dict | None = None) -> set:
    """Distinct features of a whole text (only those in ``select``, as its values)."""
    out: set = set()
    for t in set(tokens(text or "")):
        got = known.get(t)
        if got is None:
            got = [f for w in restored_words(t, model) for f in word_features(w)]
            if select is not None:
                got = [select[f] for f in got if f in select]
            got = tuple(got)     # () is one object: most words have no selected feature
            if len(known) > MAX_CACHED:
                known.clear()
            if len(t) <= MAX_KEY:
                known[t] = got
        out.update(got)
    return out


def training_sample(labels: DataFrame, train: Column) -> DataFrame:
    """``doc_id, toxic`` of at most SAMPLE_TOXIC + SAMPLE_CLEAN labelled documents."""
    one = (labels.where(train & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
                 .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (one.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC)
               .unionByName(one.where("toxic <> 1").orderBy(*order).limit(SAMPLE_CLEAN)))


def learn(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> dict:
    """The letter model, the selected features and the logistic weights."""
    letters = letter_model(docs, text)
    sample = training_sample(labels, train)
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
                .join(F.broadcast(sample), "doc_id"))   # bounded by the sample's parameters
    # One text per sampled id, the smallest, so that rows are bounded too (partial aggregates fold repeated ids).
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = materialize(rows.repartition(32, F.xxhash64("doc_id", "text")), "sample")
    sent = docs.sparkSession.sparkContext.broadcast(letters)

    def count(batches: Iterator) -> Iterator:
        known: dict = {}
        n: dict[int, list[int]] = {}
        for pdf in batches:
            for y, t in zip(pdf["toxic"], pdf["text"]):
                for f in text_features(t, sent.value, known):
                    n.setdefault(f, [0, 0])[int(y == 1)] += 1
        yield pd.DataFrame([(f, a, b) for f, (a, b) in n.items()], columns=["f", "n0", "n1"])

    sizes = {int(r[0]): r[1] for r in rows.groupBy((F.col("toxic") == 1).cast("int")).count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    model = {"letters": letters, "select": {}, "weights": np.zeros(0), "bias": None,
             "share": toxic / max(1, toxic + clean)}
    if not toxic or not clean:
        return model
    counts = rows.mapInPandas(count, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rate1, rate0 = (F.col("n1") + 0.5) / (toxic + 1), (F.col("n0") + 0.5) / (clean + 1)
    chosen = (counts.where((F.col("n1") >= MIN_SUPPORT) & (rate1 > 2 * rate0))
                    .withColumn("gain", F.sqrt("n1") * F.log(rate1 / rate0))
                    .orderBy(F.desc("gain"), "f").limit(FEATURES).select("f"))
    select = {r[0]: i for i, r in enumerate(chosen.collect())}

    def present(batches: Iterator) -> Iterator:
        known: dict = {}
        for pdf in batches:
            yield pd.DataFrame({"toxic": (pdf["toxic"] == 1).astype(int),
                                "at": [sorted(text_features(t, sent.value, known, select)) for t in pdf["text"]]})

    data = rows.mapInPandas(present, "toxic int, at array<int>").toPandas()   # bounded by the sample
    model["select"] = select
    model["weights"], model["bias"] = fit([list(a) for a in data["at"]], data["toxic"].to_numpy(float), len(select))
    return model


def fit(active: list[list[int]], y: np.ndarray, n: int, steps: int = 300, ridge: float = 1.0):
    """Logistic regression with a ridge penalty, by accelerated gradient steps in a fixed order of rows."""
    order = sorted(range(len(y)), key=lambda i: (active[i], y[i]))
    x = np.zeros((len(y), n), np.float32)
    for row, i in enumerate(order):
        x[row, active[i]] = 1
    y = y[order]
    w, bias = np.zeros(n), math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    speed = 4 / (x.sum(axis=1).max(initial=0) + 1)
    look_w, look_b = w.copy(), bias
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ look_w.astype(np.float32) + look_b, -30, 30)))
        grad_w = x.T @ (p - y).astype(np.float32) / len(y) + ridge * look_w / len(y)
        new_w, new_b = look_w - speed * grad_w, look_b - speed * float((p - y).mean())
        ahead = k / (k + 3)
        look_w, look_b = new_w + ahead * (new_w - w), new_b + ahead * (new_b - bias)
        w, bias = new_w, new_b
    return w, bias


def score(docs: DataFrame, model: dict, text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)   # letter model and FEATURES weights

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, known = sent.value, {}
        for s in batches:
            if m["bias"] is None:
                yield pd.Series([float(m["share"])] * len(s))
                continue
            z = [m["bias"] + sum(m["weights"][i] for i in sorted(text_features(t, m["letters"], known, m["select"])))
                 for t in s]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500))))

    cols = [c.alias(k) for k, c in (keep or {}).items()]
    out = docs.select(*cols, toxic(F.col(text)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
