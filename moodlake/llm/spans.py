"""Positions of regular-expression matches and texts cut at spans, in DataFrame
expressions only. All work is linear in the text and its spans: running values
are folded in blocks, since a fold that appends to one array copies it each time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,hit:string>>"
# Values of a block of a running fold, and code points of a chunk of a text.
BLOCK = 128
CHUNK = 1024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For every int of an array the fold of those before it, from 0."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def fold(items: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(items, start, lambda acc, x: F.struct(
            join(acc["at"], of(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def whole(v: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(BLOCK))
        blocks = F.transform(firsts, lambda i: fold(F.slice(v, i, F.lit(BLOCK)), lambda x: x))
        return let(blocks, lambda bs: F.flatten(F.zip_with(
            bs, fold(bs, lambda b: b["at"])["out"],
            lambda b, before: F.transform(b["out"], lambda x: join(before, x)))))

    return let(values, whole)


def match_spans(text: Column, pattern: Column) -> Column:
    """``array<struct<start, end, hit>>`` of the leftmost non-overlapping
    matches, in code points, end exclusive. The text is cut at the matches;
    the lengths of cuts and matches in turn give every position."""
    def placed(hits: Column) -> Column:
        # The last cut follows the last match: one cut more than matches.
        pairs = F.zip_with(F.slice(F.split(text, pattern, F.lit(-1)), F.lit(1), F.size(hits)), hits,
                           lambda c, h: F.struct(F.char_length(c).alias("cut"), F.char_length(h).alias("long"),
                                                 h.alias("hit")))
        return let(pairs, lambda ps: F.zip_with(
            ps, running(F.transform(ps, lambda p: p["cut"] + p["long"]), lambda a, b: a + b),
            lambda p, before: F.struct((before + p["cut"]).alias("start"),
                                       (before + p["cut"] + p["long"]).alias("end"), p["hit"].alias("hit"))))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)),
               lambda hits: F.when(F.size(hits) == 0, F.array().cast(SPANS)).otherwise(placed(hits)))


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with ``mark(span)`` for every span (structs that begin with
    start and end, in any order); of spans that overlap, the later one's rest
    goes with the earlier one's mark. Pieces are read from the chunks that hold
    them, so none is searched from the text's beginning."""
    def piece(chunks: Column, start: Column, end: Column) -> Column:
        low = F.floor(start / CHUNK).cast("int")
        held = F.slice(chunks, low + 1, F.floor(end / CHUNK).cast("int") - low + 1)
        return F.substr(F.array_join(held, ""), start - low * CHUNK + 1, end - start)

    def cut(ordered: Column, chunks: Column) -> Column:
        # Where the text stands after the spans before each one.
        ats = running(F.transform(ordered, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        pieces = F.zip_with(ordered, ats, lambda s, at: F.when(s["start"] >= at, F.concat(
            piece(chunks, at, s["start"]), mark(s))).otherwise(F.lit("")))
        return F.concat(F.array_join(pieces, ""), piece(chunks, F.array_max(F.transform(ordered, lambda s: s["end"])),
                                                        F.char_length(text)))

    chunked = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))
    done = let(F.array_sort(spans), lambda ordered: let(chunked, lambda chunks: cut(ordered, chunks)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
