"""Personal data: base patterns, then information-theoretic sanitisation, in
DataFrame expressions only.

Base spans (e-mail, IP address, card, phone) are protected entities. For every
word of a document that holds one, the corpus tells how strongly it reveals the
entity: with document counts over all N documents,

    PMI(e; t) = log(N * docs(e with t) / (docs(e) * docs(t))),  IC(e) = log(N / docs(e)),

and disclosure = PMI / IC, 1 for a word found with the entity only. A word
whose disclosure reaches ``GENERALISE`` is replaced by a category mark wherever
it stands in documents that hold the entity, one that reaches ``REMOVE`` is
removed. Words need ``MIN_CONTEXTS`` different texts with the same entity, so
that copies prove nothing. Pairs are pruned by bounds that lose none: docs(e
with t) <= docs(e), so a disclosure of ``GENERALISE`` = g needs docs(t) <=
N^(1-g) * docs(e)^g, and docs(t) and docs(e) are at least ``MIN_CONTEXTS``.
Entities that stand in the same texts have the same counts with every word, and
words of the same texts with every entity: each such class is paired once, so
that a list of many addresses and names, in several versions, is one pair.

Defined results: a null text counts as empty, has no spans and stays null when
redacted; repeated rows count each as documents and get the same spans; an
empty table gives no rows; extra columns pass through the redaction untouched.
Whole texts are searched, in time linear in their length and spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import fresh, materialize
from moodlake.llm.spans import let, match_spans, replaced

KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
MIN_CONTEXTS = 3
GENERALISE = 0.6
REMOVE = 0.95

# The contract's patterns. Lookbehinds and possessive loops keep long runs of
# letters or digits from being tried again from each of their characters; the
# matches are the same, since a match always starts where its run starts (or
# where the match before it ended) and nothing follows the last loop.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that every text with a valid span passes.
GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
    "card": lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_SPAN = "array<struct<kind:string,start:int,end:int,hit:string>>"
WORD = r"\p{L}[\p{L}\p{N}']*+"
FILLER = "\ua66e"   # a letter, so that a word beside a span ends where it did


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    twice = F.transform(each, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(twice, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


VALID = {
    "email": lambda h: F.lit(True),
    "ip": lambda h: F.rlike(h, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
    "card": lambda h: F.length(_digits(h)).between(16, 19) & luhn(_digits(h)),
    "phone": lambda h: F.length(_digits(h)).between(8, 15),
}


def _spans_of(kind: str, text: Column) -> Column:
    found = F.filter(match_spans(text, F.lit(PATTERNS[kind])), lambda m: VALID[kind](m["hit"]))
    typed = F.transform(found, lambda m: F.struct(
        F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["hit"].alias("hit")))
    return F.when(GATES[kind](text), typed).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All valid base spans by kind, then start: ``array<struct<kind, start, end, hit>>``."""
    return F.concat(*[_spans_of(kind, text) for kind in KINDS])


def _entity(s: Column) -> Column:
    return F.concat(s["kind"], F.lit(":"), F.lower(s["hit"]))


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _outside(text: Column, spans: Column) -> Column:
    """The text with a blank for each span."""
    return replaced(text, F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))),
                    lambda s: F.lit(" "))


def _masked(text: Column, spans: Column) -> Column:
    """The text with ``FILLER`` for each letter, digit and apostrophe of the spans: no word
    begins in them, and every place stays."""
    return replaced(text, F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                s["hit"].alias("hit"))),
                    lambda s: F.regexp_replace(s["hit"], r"[\p{L}\p{N}']", FILLER))


def _keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text: spans depend on nothing else."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _class(name: str) -> list[Column]:
    """Two hashes that stand for a group's set of texts (each text once in the group)."""
    return [F.bit_xor(k).alias(f"{name}{k[1]}") for k in ("k1", "k2")]


# Columns that name a class of entities and a class of words.
ENTITIES = ["e1", "e2"]
WORDS = ["t1", "t2", "n_term"]


def disclosing_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """``entity, term, disclosure`` of the words at or above ``GENERALISE``, and
    which texts they concern: one row per text, ``k1, k2, terms`` with ``terms``
    an array of ``struct<term, disclosure>``."""
    t = F.coalesce(F.col(text), F.lit(""))
    near = docs.select(t.alias("t")).select("t", base_spans(F.col("t")).alias("spans")).where(F.size("spans") > 0)
    k1, k2 = _keys(F.col("t"))
    # One row per distinct text and the number of its documents.
    rows = near.select(k1.alias("k1"), k2.alias("k2"), F.array_distinct(F.transform("spans", _entity)).alias("entities"),
                       _words(_outside(F.col("t"), F.col("spans"))).alias("words"))
    rows = materialize(rows.groupBy("k1", "k2").agg(F.first("entities").alias("entities"), F.first("words").alias("words"),
                                                    F.count(F.lit(1)).alias("copies")), "entities")
    n_docs = docs.count()
    held = rows.select("k1", "k2", "copies", F.explode("entities").alias("entity"))
    # Entities of the same texts tell the same: they make one class, named by its texts' hashes.
    entity = materialize(held.groupBy("entity").agg(
        F.sum("copies").alias("n_entity"), F.count(F.lit(1)).alias("texts"), *_class("e"))
        .where((F.col("texts") >= MIN_CONTEXTS) & (F.col("n_entity") < n_docs)).drop("texts"), "counts")
    most = F.pow(F.lit(float(n_docs)), 1 - GENERALISE) * F.pow(F.col("n_entity").cast("double"), GENERALISE) * (1 + 1e-9)
    widest = entity.agg(F.max(most)).first()[0] or 0.0
    # Documents that hold a word, over the whole corpus; common and lone words go here.
    term = (docs.select(F.explode(_words(t)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
                .where(F.col("n_term").between(MIN_CONTEXTS, F.lit(widest))))
    owned = materialize(held.join(entity, "entity").select("k1", "k2", "copies", *ENTITIES, "n_entity", most.alias("most"))
                            .dropDuplicates(["k1", "k2", *ENTITIES]), "owned")
    ids = owned.groupBy("k1", "k2").agg(F.max("most").alias("text_most"))
    worded = materialize(rows.join(ids, ["k1", "k2"]).select("k1", "k2", "text_most", F.explode("words").alias("term"))
                             .join(term, "term").where(F.col("n_term") <= F.col("text_most")).drop("text_most"), "worded")
    # So do words of the same texts and the same count.
    alike = worded.groupBy("term").agg(*_class("t"))
    worded = materialize(worded.join(alike, "term"), "words")
    classes = worded.select("k1", "k2", *WORDS).distinct()
    pairs = materialize(owned.join(classes, ["k1", "k2"]).where(F.col("n_term") <= F.col("most")).drop("most"), "pairs")
    joint = (pairs.groupBy(*ENTITIES, *WORDS).agg(F.sum("copies").alias("n_joint"), F.count(F.lit(1)).alias("contexts"),
                                                   F.first("n_entity").alias("n_entity"))
                  .where(F.col("contexts") >= MIN_CONTEXTS))
    pmi = F.log(n_docs * F.col("n_joint") / (F.col("n_entity") * F.col("n_term").cast("double")))
    disclosure = F.try_divide(pmi, F.log(n_docs / F.col("n_entity")))
    flagged = materialize(joint.select(*ENTITIES, *WORDS, disclosure.alias("disclosure"))
                               .where(F.col("disclosure") >= GENERALISE), "disclosing")
    # From the pairs again: a text gets only words that it holds itself.
    concerned = pairs.select("k1", "k2", *ENTITIES, *WORDS).join(flagged, [*ENTITIES, *WORDS])
    best = concerned.groupBy("k1", "k2", *WORDS).agg(F.max("disclosure").alias("disclosure"))
    best = best.join(worded, ["k1", "k2", *WORDS])
    return best.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("term", "disclosure"))).alias("terms"))


def _term_spans(text: Column, base: Column, terms: Column) -> Column:
    """Places of the words, outside the base spans; kind ``term`` or ``term-removed``."""
    names = F.transform(terms, lambda x: x["term"])
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}'])(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{N}'])"))
    weight = F.map_from_arrays(names, F.transform(terms, lambda x: x["disclosure"]))
    typed = let(weight, lambda w: F.transform(match_spans(_masked(text, base), pattern), lambda m: F.struct(
        F.when(F.coalesce(F.try_element_at(w, F.lower(m["hit"])), F.lit(0.0)) >= REMOVE, F.lit(TERM + "-removed"))
         .otherwise(F.lit(TERM)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["hit"].alias("hit"))))
    return F.when(F.size(F.coalesce(terms, F.array().cast("array<struct<term:string,disclosure:double>>"))) > 0,
                  typed).otherwise(F.array().cast(_SPAN))


def find_personal_data(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): ``base`` and
    ``terms``, arrays of ``struct<kind, start, end, hit>``."""
    out, k1, k2, terms = (fresh(docs, c) for c in ("personal", "k1", "k2", "terms"))
    known = materialize(disclosing_terms(docs, text).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("terms").alias(terms)), "terms")
    t = F.coalesce(F.col(text), F.lit(""))
    h1, h2 = _keys(t)
    keyed = docs.withColumn(out, base_spans(t))
    joined = keyed.join(known, (h1 == F.col(k1)) & (h2 == F.col(k2)), "left")
    spans = F.struct(F.col(out).alias("base"), _term_spans(t, F.col(out), F.col(terms)).alias("terms"))
    return joined.withColumn(out, spans).drop(k1, k2, terms), out


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by marks; of spans that overlap the
    later one's rest goes with the earlier one's mark."""
    def mark(s: Column) -> Column:
        return F.when(s["kind"] == TERM + "-removed", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    return replaced(text, F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))), mark)


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing words taken out of ``text``."""
    found, s = find_personal_data(docs, text)
    # Generated, not projected: a Python function that reads the text would take the whole expression
    # in as its argument, with lambdas that Spark does not hand to Python.
    clean = F.explode(F.array(redacted(F.col(text), F.concat(f"{s}.base", f"{s}.terms"))))
    return found.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    found, s = find_personal_data(docs, text)
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    kinds = F.transform(f"{s}.base", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.transform(f"{s}.base", line)
    rest = F.transform(F.array_sort(F.transform(f"{s}.terms", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))), line)
    return found.select(F.col(doc_id).alias("doc_id"), *counts,
                        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, rest), ",").alias("spans"))
