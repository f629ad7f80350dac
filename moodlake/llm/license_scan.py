"""License scan with ordered signature rules, in DataFrame expressions only.

Hand-written name patterns of license families are combined with the ways a
license is stated (identifier tag, address, grant sentence, title) into some
hundreds of ordered regular expressions. A rule runs only on texts that hold
its family's keyword, and only texts with one of a few stems are looked at.
Overlaps are resolved by containment, then priority: a detection inside
another's interval goes (of equal intervals the earlier rule stays); of two
that still overlap the later rule goes.

Beside it the base phrases are found as consecutive words.

Defined results: a null or empty text has no words, places or labels and score
0; repeated rows are scanned alike; an empty table gives no rows; extra columns
are not read. Whole texts are scanned.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.spans import match_spans

# Base phrases and labels.
BASE = [(("cc", "by"), "cc-by"), (("general", "public", "license"), "gpl"), (("all", "rights", "reserved"), "reserved")]
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Families: label, keyword (lower case, one word that every alternative of the
# name holds; alternatives without a common word are families of their own),
# name as written in prose, identifiers as in tags and addresses (None: in an
# earlier family of the label).
_V = r"(?:,?\s+|-)(?:version\s+|v\.?\s?)?"
FAMILIES = [
    ("apache-2.0", "apache", rf"apache\s+(?:software\s+)?licen[sc]e(?:{_V}2(?:\.0)?)?", r"apache-2\.0"),
    ("apache-1.1", "apache", rf"apache\s+(?:software\s+)?licen[sc]e{_V}1\.1", r"apache-1\.1"),
    ("apache-1.0", "apache", rf"apache\s+(?:software\s+)?licen[sc]e{_V}1\.0", r"apache-1\.0"),
    ("mit", "mit", r"mit(?:\s*/\s*x11)?\s+licen[sc]e", r"mit"),
    ("mit", "expat", r"expat(?:\s*/\s*x11)?\s+licen[sc]e", None),
    ("mit-0", "attribution", r"mit\s+no\s+attribution(?:\s+licen[sc]e)?", r"mit-0"),
    ("x11", "x11", r"x11\s+licen[sc]e", r"x11"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2[- ]clause|two[- ]clause)\s+bsd\s+licen[sc]e", r"bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3[- ]clause|three[- ]clause)\s+bsd\s+licen[sc]e", r"bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:original|4[- ]clause|four[- ]clause)\s+bsd\s+licen[sc]e", r"bsd-4-clause"),
    ("0bsd", "bsd", r"(?:zero[- ]clause\s+bsd|bsd\s+zero\s+clause)(?:\s+licen[sc]e)?", r"0bsd"),
    ("bsd", "bsd", r"bsd(?:[- ]style)?\s+licen[sc]e", r"bsd"),
    ("gpl-1.0", "gpl", rf"(?:gnu\s+)?gpl{_V}1(?:\.0)?\b", r"gpl-1\.0(?:-only|-or-later|\+)?"),
    ("gpl-2.0", "gpl", rf"(?:gnu\s+)?gpl{_V}2(?:\.0)?\b", r"gpl-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-3.0", "gpl", rf"(?:gnu\s+)?gpl{_V}3(?:\.0)?\b", r"gpl-3\.0(?:-only|-or-later|\+)?"),
    ("gpl-1.0", "general", rf"(?:gnu\s+)?general\s+public\s+licen[sc]e{_V}1(?:\.0)?\b", r"gplv1"),
    ("gpl-2.0", "general", rf"(?:gnu\s+)?general\s+public\s+licen[sc]e{_V}2(?:\.0)?\b", r"gplv2"),
    ("gpl-3.0", "general", rf"(?:gnu\s+)?general\s+public\s+licen[sc]e{_V}3(?:\.0)?\b", r"gplv3"),
    ("gpl", "general", r"(?:gnu\s+)?general\s+public\s+licen[sc]e", r"gpl"),
    ("lgpl-2.0", "general", rf"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[sc]e{_V}2(?:\.0)?\b", r"lgpl-2\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", "lesser", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e{_V}2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-3.0", "lesser", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e{_V}3(?:\.0)?\b", r"lgpl-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl", "lesser", r"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e", r"lgpl"),
    ("lgpl", "lgpl", r"(?:gnu\s+)?lgpl(?:v?[23](?:\.[01])?)?\b", r"lgpl(?:-[23]\.[01])?"),
    ("agpl-3.0", "affero", rf"(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e(?:{_V}3(?:\.0)?)?", r"agpl-3\.0(?:-only|-or-later|\+)?"),
    ("agpl-3.0", "agpl", r"(?:gnu\s+)?agpl(?:v?3(?:\.0)?)?\b", r"agpl"),
    ("gfdl", "documentation", r"(?:gnu\s+)?free\s+documentation\s+licen[sc]e", r"gfdl-1\.[123](?:-only|-or-later)?"),
    ("mpl-1.1", "mozilla", rf"mozilla\s+public\s+licen[sc]e{_V}1\.1", r"mpl-1\.1"),
    ("mpl-2.0", "mozilla", rf"mozilla\s+public\s+licen[sc]e{_V}2(?:\.0)?", r"mpl-2\.0"),
    ("mpl", "mozilla", r"mozilla\s+public\s+licen[sc]e", r"mpl"),
    ("epl-1.0", "eclipse", rf"eclipse\s+public\s+licen[sc]e{_V}1(?:\.0)?", r"epl-1\.0"),
    ("epl-2.0", "eclipse", rf"eclipse\s+public\s+licen[sc]e{_V}2(?:\.0)?", r"epl-2\.0"),
    ("edl-1.0", "eclipse", r"eclipse\s+distribution\s+licen[sc]e", r"edl-1\.0"),
    ("cddl-1.0", "development", r"common\s+development\s+and\s+distribution\s+licen[sc]e", r"cddl-1\.[01]"),
    ("cpl-1.0", "common", r"common\s+public\s+licen[sc]e", r"cpl-1\.0"),
    ("ipl-1.0", "ibm", r"ibm\s+public\s+licen[sc]e", r"ipl-1\.0"),
    ("eupl-1.2", "european", r"european\s+union\s+public\s+licen[sc]e", r"eupl-1\.[012]"),
    ("isc", "isc", r"isc\s+licen[sc]e", r"isc"),
    ("zlib", "zlib", r"zlib(?:/libpng)?\s+licen[sc]e", r"zlib"),
    ("libpng", "png", r"(?:png\s+reference\s+library|libpng)\s+licen[sc]e", r"libpng(?:-2\.0)?"),
    ("bsl-1.0", "boost", r"boost\s+software\s+licen[sc]e", r"bsl-1\.0"),
    ("busl-1.1", "business", r"business\s+source\s+licen[sc]e", r"busl-1\.1"),
    ("artistic-1.0", "artistic", rf"artistic\s+licen[sc]e{_V}1(?:\.0)?", r"artistic-1\.0(?:-perl|-cl8)?"),
    ("artistic-2.0", "artistic", rf"artistic\s+licen[sc]e(?:{_V}2(?:\.0)?)?", r"artistic-2\.0"),
    ("psf-2.0", "python", r"python\s+software\s+foundation\s+licen[sc]e", r"(?:psf|python)-2\.0"),
    ("ruby", "ruby", r"ruby(?:'s)?\s+licen[sc]e", r"ruby"),
    ("php-3.01", "php", r"php\s+licen[sc]e", r"php-3\.0[01]?"),
    ("ofl-1.1", "font", r"(?:sil\s+)?open\s+font\s+licen[sc]e", r"ofl-1\.[01]"),
    ("unlicense", "unlicense", r"(?:the\s+)?unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("wtfpl", "want", r"do\s+what\s+the\s+\w+\s+you\s+want\s+to\s+public\s+licen[sc]e", r"wtf-pl"),
    ("ms-pl", "microsoft", r"microsoft\s+public\s+licen[sc]e", r"ms-pl"),
    ("ms-rl", "microsoft", r"microsoft\s+reciprocal\s+licen[sc]e", r"ms-rl"),
    ("osl-3.0", "software", r"open\s+software\s+licen[sc]e", r"osl-[123]\.[01]"),
    ("afl-3.0", "academic", r"academic\s+free\s+licen[sc]e", r"afl-[123]\.[012]"),
    ("ecl-2.0", "educational", r"educational\s+community\s+licen[sc]e", r"ecl-[12]\.0"),
    ("upl-1.0", "universal", r"universal\s+permissive\s+licen[sc]e", r"upl-1\.0"),
    ("ncsa", "ncsa", r"(?:university\s+of\s+illinois\s*/\s*)?ncsa\s+(?:open\s+source\s+)?licen[sc]e", r"ncsa"),
    ("postgresql", "postgres", r"postgres(?:ql)?\s+licen[sc]e", r"postgresql"),
    ("openssl", "openssl", r"openssl\s+licen[sc]e", r"openssl"),
    ("curl", "curl", r"curl\s+licen[sc]e", r"curl"),
    ("vim", "vim", r"vim\s+licen[sc]e", r"vim"),
    ("odbl-1.0", "database", r"open\s+(?:data\s+commons\s+)?(?:open\s+)?database\s+licen[sc]e", r"odbl-1\.0"),
    ("odc-by-1.0", "commons", r"open\s+data\s+commons\s+attribution\s+licen[sc]e", r"odc-by-1\.0"),
    ("pddl-1.0", "dedication", r"public\s+domain\s+dedication\s+and\s+licen[sc]e", r"pddl-1\.0"),
    ("cc0-1.0", "cc0", r"cc0(?:\s+1\.0)?(?:\s+universal)?", r"cc0-1\.0"),
    ("cc-by-nc-nd", "commons", r"creative\s+commons\s+attribution[- ]non[- ]?commercial[- ]no[- ]?deriv\w*", r"cc-by-nc-nd-[1234]\.0"),
    ("cc-by-nc-sa", "commons", r"creative\s+commons\s+attribution[- ]non[- ]?commercial[- ]share[- ]?alike", r"cc-by-nc-sa-[1234]\.0"),
    ("cc-by-nc", "commons", r"creative\s+commons\s+attribution[- ]non[- ]?commercial", r"cc-by-nc-[1234]\.0"),
    ("cc-by-nd", "commons", r"creative\s+commons\s+attribution[- ]no[- ]?deriv\w*", r"cc-by-nd-[1234]\.0"),
    ("cc-by-sa", "commons", r"creative\s+commons\s+attribution[- ]share[- ]?alike", r"cc-by-sa-[1234]\.0"),
    ("cc-by", "commons", r"creative\s+commons\s+attribution", r"cc-by-[1234]\.0"),
    ("cc-by-nc-nd", "cc", r"\bcc[- ]by[- ]nc[- ]nd\b", r"by-nc-nd"),
    ("cc-by-nc-sa", "cc", r"\bcc[- ]by[- ]nc[- ]sa\b", r"by-nc-sa"),
    ("cc-by-nc", "cc", r"\bcc[- ]by[- ]nc\b", r"by-nc"),
    ("cc-by-sa", "cc", r"\bcc[- ]by[- ]sa\b", r"by-sa"),
    ("public-domain", "domain", r"(?:released\s+(?:in)?to|placed\s+in|in)\s+the\s+public\s+domain", r"public-domain"),
    ("proprietary", "proprietary", r"proprietary\s+(?:and\s+confidential|licen[sc]e)", r"proprietary"),
    ("reserved", "reserved", r"all\s+rights\s+reserved", r"licenseref-reserved"),
    ("copyright", "copyright", r"copyright\s+(?:\(c\)\s*|©\s*)?(?:19|20)[0-9]{2}", r"licenseref-copyright"),
]
# Ways of stating a license, strongest first: name, strength, pattern around {name} or {id}.
FORMS = [
    ("tag", 1.0, r"spdx-license-identifier:\s*{id}(?![\w.-])"),
    ("address", 0.95, r"https?://[\w./-]*?(?:licen[sc]es?|legalcode|opensource\.org)/{id}(?![\w.])"),
    ("grant", 0.9, r"(?:licen[sc]ed|released|distributed|available|published|provided|redistributed?)\s+(?:\w+\s+){{0,3}}?under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?{name}"),
    ("title", 0.7, r"(?<![\w-]){name}(?![\w])"),
]


def _stems() -> list[str]:
    """Stems of which every text with a detection holds one (lower case): those of tags and addresses, "licen" for
    names that always hold it (outside all brackets), the keyword of other names."""
    out = {"licen", "legalcode", "opensource.org"}
    for _, keyword, name, _ in FAMILIES:
        flat = name
        while (less := re.sub(r"\([^()]*\)", "", flat)) != flat:
            flat = less
        if "licen" not in flat:
            out |= {"cc by", "cc-by"} if name.startswith(r"\bcc[- ]by") else {keyword}
    return sorted(s for s in out if not any(o in s for o in out - {s}))


STEMS = _stems()


def rules() -> list[tuple[int, str, str, str, float]]:
    """Ordered rules: priority, label, keyword, pattern, strength."""
    out = []
    for form, strength, around in FORMS:
        for label, keyword, name, ident in FAMILIES:
            if ident is None and "{id}" in around:
                continue
            # An identifier need not hold the prose keyword: its own first letters gate it.
            gate = keyword if "{name}" in around else ident.replace("\\", "").split("(")[0].split("[")[0]
            out.append((len(out), label, gate, "(?i)" + around.format(name=f"(?:{name})", id=f"(?:{ident})"), strength))
    return out


def _rule_array(only: list | None = None) -> Column:
    return F.array(*[F.struct(F.lit(p).alias("prio"), F.lit(label).alias("label"), F.lit(k).alias("keyword"),
                              F.lit(rx).alias("pattern"), F.lit(s).alias("strength"))
                     for p, label, k, rx, s in (only or rules())])


_DETECTION = "array<struct<start:int,end:int,prio:int,label:string,strength:double>>"


def detections(text: Column, low: Column) -> Column:
    """Detections of one text after suppression, in order of place:
    ``array<struct<start, end, prio, label, strength>>`` (code points).
    ``low`` is the text in lower case, a column of its own: it is read often."""
    none = F.array().cast(_DETECTION)
    gated = F.lit(False)
    for stem in STEMS:
        gated = gated | F.contains(low, F.lit(stem))
    running = F.filter(_rule_array(), lambda r: F.contains(low, r["keyword"]))
    found = F.flatten(F.transform(running, lambda r: F.transform(
        match_spans(text, r["pattern"]),
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), r["prio"].alias("prio"),
                           r["label"].alias("label"), r["strength"].alias("strength")))))
    return F.when(gated, bound(found, suppressed)).otherwise(none)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def suppressed(found: Column) -> Column:
    """Containment first: of detections inside another the wider stays. Then
    priority: in its order, a detection stays if it overlaps none that stays already."""
    order = F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), d["prio"].alias("prio"),
                                                  d["label"].alias("label"), d["strength"].alias("strength")))
    first = F.struct(F.lit(-1).alias("reach"), F.array().cast(_DETECTION).alias("out"))

    def widest(acc: Column, d: Column) -> Column:
        end = -d["back"]
        row = F.struct(d["start"].alias("start"), end.alias("end"), d["prio"].alias("prio"),
                       d["label"].alias("label"), d["strength"].alias("strength"))
        return F.when(acc["reach"] >= end, acc).otherwise(
            F.struct(end.alias("reach"), F.concat(acc["out"], F.array(row)).alias("out")))

    def free(kept: Column, d: Column) -> Column:
        return ~F.exists(kept, lambda k: (k["start"] < d["end"]) & (d["start"] < k["end"]))

    def by_priority(kept: Column) -> Column:
        # Starts and ends both grow now: most detections touch no neighbour and stay as they are.
        crowded = F.filter(kept, lambda d, i: (
            F.coalesce(F.get(kept, i - 1)["end"] > d["start"], F.lit(False))
            | F.coalesce(F.get(kept, i + 1)["start"] < d["end"], F.lit(False))))
        alone = F.filter(kept, lambda d, i: ~(
            F.coalesce(F.get(kept, i - 1)["end"] > d["start"], F.lit(False))
            | F.coalesce(F.get(kept, i + 1)["start"] < d["end"], F.lit(False))))
        ranked = F.array_sort(F.transform(crowded, lambda d: F.struct(d["prio"].alias("prio"), d["start"].alias("start"), d.alias("d"))))
        chosen = F.aggregate(ranked, F.array().cast(_DETECTION), lambda acc, r: F.when(
            free(acc, r["d"]), F.concat(acc, F.array(r["d"]))).otherwise(acc))
        return F.array_sort(F.concat(alone, chosen))

    return bound(F.aggregate(F.array_sort(order), first, widest)["out"], by_priority)


def count_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(_WORD + "+"), F.lit(0))).cast("long")


def phrase_starts(text: Column, low: Column, phrase: tuple[str, ...]) -> Column:
    """Word positions at which the phrase's words stand consecutively."""
    hint = F.lit(max(phrase, key=len) if len(phrase) > 2 else phrase[0])
    pattern = F.lit(f"(?i)(?<!{_WORD})" + _GAP.join(phrase) + f"(?!{_WORD})")
    none = F.array().cast("array<long>")
    cuts = F.transform(F.split(text, pattern, F.lit(-1)), count_words)
    acc = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    starts = F.aggregate(cuts, acc, lambda a, n: F.struct(
        (a["at"] + n + len(phrase)).alias("at"), F.concat(a["out"], F.array(a["at"] + n)).alias("out")))["out"]
    # The last cut is followed by no phrase.
    whole = bound(starts, lambda s: F.slice(s, F.lit(1), F.size(s) - 1))
    return F.when(F.contains(low, hint) & F.rlike(text, pattern), whole).otherwise(none)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its words, base places and labels, ``detections`` and ``score``."""
    t = F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.col(doc_id).alias("doc_id"), t.alias("t")).withColumn("low", F.lower("t"))
    places = [phrase_starts(F.col("t"), F.col("low"), p) for p, _ in BASE]
    out = src.select("doc_id", count_words(F.col("t")).alias("n_words"), F.array(*places).alias("places"),
                     detections(F.col("t"), F.col("low")).alias("detections"))
    every = F.flatten("places")
    base = F.array_compact(F.array(*[F.when(F.size(F.col("places")[i]) > 0, F.lit(label))
                                     for i, (_, label) in enumerate(BASE)]))
    strength = F.array_max(F.concat(F.array(F.lit(0.0)), F.transform("detections", lambda d: d["strength"]),
                                    F.when(F.size(base) > 0, F.array(F.lit(0.6))).otherwise(F.array().cast("array<double>"))))
    return out.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).alias("first_word"), F.array_max(every).alias("last_word"),
        F.array_sort(base).alias("base_labels"),
        F.array_sort(F.array_union(base, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        strength.alias("score"), "detections")


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                          F.array_join("base_labels", ",").alias("base_labels"),
                          F.array_join("labels", ",").alias("labels"), "score")
