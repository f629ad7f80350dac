"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set holds the hashes of its distinct ``SIZE``-word shingles.
Documents with equal sets are one class, and classes are joined exactly:

1. Two sets at the threshold share one of their first n - ceil(0.75 n) + 1
   shingles in any order common to all. The order is by hash, very frequent
   shingles last, so that passages of many documents stay out of the search.
   (Which shingles count as frequent is read off a sample and bounded; it
   shapes the work, any choice gives the same links.) Shingles that only one
   class holds are dropped.
2. Classes meet in tiles of one shingle and one band of set sizes (sizes within
   a factor of 4/3, so partners are in the same band or the one below). Large
   tiles are cut into blocks of ``TILE`` classes that meet pairwise. In a tile
   each pair's bitmaps are compared: every differing bit is an element that
   only one of the sets has, which bounds the overlap from above. Where
   classes meet in many tiles, bitmaps are sent in a narrow form, laid over
   themselves, and each distinct pair that passes is compared by the whole ones.
3. Pairs that pass are verified by intersecting the sorted arrays, computed
   again from the texts of these classes only.

The first round lets each class ask in one tile and keeps its best pair, which
joins most groups of near copies. The other two rounds take every shingle, but
only pairs whose components still differ: the second, of each class its ``BEST``
best partners in a tile; the third, for classes that had more than those and
whose shingles still meet several components, all partners. So a group of k
near copies costs about k pairs, not k squared, and no link between components is lost. Components are those of all links.
``class_links`` gives all links between different sets instead, which is quadratic in a group by nature.

Defined results: null and empty texts (and texts of white space) have an empty
set, link with nothing and are their own component; texts under ``SIZE`` words
have one shingle, all their words; very long texts are one row of their batch
(batches are bounded by bytes) and one array of 8 bytes a shingle; rows repeated or with equal sets are one
class; a null doc_id takes part and is never the smallest of a component with
another id; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import discard, fresh, materialize
from moodlake.llm.components import components

SIZE = 5
PERCENT = 75
# Frequent shingles: found in at least MIN_SEEN of one in SAMPLE distinct texts, the most frequent MAX_FREQUENT of them.
SAMPLE, MIN_SEEN, MAX_FREQUENT = 64, 3, 100_000
TILE = 2000
BEST = 8
# The second round's tiles compare bitmaps folded to one part in COARSE, distinct pairs that pass the whole ones.
COARSE = 4
# Pairs of bitmaps under way in a task, and bytes of one side's bitmaps compared at once.
PAIRS, COMPARED_BYTES = 1 << 17, 1 << 21


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    import xxhash
    words = (text or "").encode().lower().split()   # bytes: only A-Z change, only ASCII spaces split
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    take = min(size, len(words))
    out = np.full(len(words) - take + 1, take, np.uint64)
    for k in range(take):
        out = (out ^ h[k:k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def needed(a, b, percent: int = PERCENT):
    """Smallest overlap of sets of a and b elements at the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def bitmap(s: np.ndarray) -> np.ndarray:
    """Bits of the hashes' low ends, at least four per element, as bytes."""
    width = 64
    while width < 4 * len(s):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits)


def coarse(bits: np.ndarray) -> np.ndarray:
    return folded(bits, max(2, len(bits) // COARSE))


def folded(m: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows) narrowed to ``width`` bytes by laying their parts over each other."""
    while m.shape[-1] > width:
        half = m.shape[-1] // 2
        m = m[..., :half] | m[..., half:]
    return m


def set_digest(s: np.ndarray) -> tuple[int, int]:
    import xxhash
    d = xxhash.xxh3_128_digest(s.astype("<u8").tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def frequent_shingles(docs: DataFrame, size: int = SIZE) -> np.ndarray:
    """Sorted hashes of the shingles that go last in the common order (at most MAX_FREQUENT)."""
    def hashes(batches: Iterator) -> Iterator:
        for pdf in batches:
            s = [shingle_set(t, size).view(np.int64) for t in pdf["text"]]
            yield pd.DataFrame({"token": np.concatenate(s) if s else np.empty(0, np.int64)})

    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").distinct()
    top = (some.mapInPandas(hashes, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") >= MIN_SEEN).orderBy(F.desc("n"), "token").limit(MAX_FREQUENT))
    return np.sort(top.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per document ``doc_id, n, d1, d2`` (set size and digest), the prefix as
    ``rare`` and ``frequent`` hashes, the bitmap ``bits`` and its narrow form ``coarse``."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, size))   # at most MAX_FREQUENT numbers

    def sign(batches: Iterator) -> Iterator:
        last = sent.value
        for pdf in batches:
            rows = []
            for t in pdf["text"]:
                s = shingle_set(t, size)
                if not len(s):
                    rows.append((0, 0, 0, [], [], b"", b""))
                    continue
                if len(last):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    often = last[at] == s
                else:
                    often = np.zeros(len(s), bool)
                take = prefix_length(len(s), percent)
                rare, bits = s[~often][:take], bitmap(s)
                rows.append((len(s), *set_digest(s), rare.view(np.int64),
                             s[often][:take - len(rare)].view(np.int64), bits.tobytes(), coarse(bits).tobytes()))
            out = pd.DataFrame(rows, columns=["n", "d1", "d2", "rare", "frequent", "bits", "coarse"])
            out.insert(0, "text_key", pdf["text_key"].to_numpy())
            out.insert(0, "doc_id", pdf["doc_id"])
            yield out

    # Ids travel as text: pandas would turn a column of numbers with nulls into floats.
    keyed = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = keyed.mapInPandas(sign, "doc_id string, text_key long, n long, d1 long, d2 long, rare array<long>, "
                                  "frequent array<long>, bits binary, coarse binary")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def shared_tokens(reps: DataFrame) -> DataFrame:
    """``token, frequent, cls, n``: prefix shingles that more than one class
    holds. Rows are sorted by token within partitions and compared with their
    neighbours, so nothing is gathered; frequent shingles are spread and kept."""
    rows = reps.select("cls", "n", F.explode(F.concat(
        F.transform("rare", lambda t: F.struct(t.alias("token"), F.lit(False).alias("frequent"))),
        F.transform("frequent", lambda t: F.struct(t.alias("token"), F.lit(True).alias("frequent"))))).alias("t"))
    rows = rows.select("t.token", "t.frequent", "cls", "n")
    spread = F.when(F.col("frequent"), F.pmod(F.col("cls"), F.lit(1024))).otherwise(F.lit(0))

    def keep(batches: Iterator) -> Iterator:
        held, held_yes = None, False     # last row so far; whether it is shared already
        for pdf in batches:
            if not len(pdf):
                continue
            token, cls = pdf["token"].to_numpy(), pdf["cls"].to_numpy()
            before_t = np.r_[held["token"].iloc[0] if held is not None else ~token[0], token[:-1]]
            before_c = np.r_[held["cls"].iloc[0] if held is not None else cls[0], cls[:-1]]
            with_before = (token == before_t) & (cls != before_c)
            yes = with_before | pdf["frequent"].to_numpy()
            yes[:-1] |= with_before[1:]
            if held is not None and (held_yes or with_before[0]):
                yield held
            yield pdf[:-1][yes[:-1]]
            held, held_yes = pdf[-1:], bool(yes[-1])
        if held is not None and held_yes:
            yield held

    return (rows.repartition(F.col("token"), spread).sortWithinPartitions("token", "cls")
                .mapInPandas(keep, "token long, frequent boolean, cls long, n long"))


def tiled(rows: DataFrame, bits: DataFrame, tile: int) -> DataFrame:
    """Deal ``token, cls, n, comp, asks`` into tiles: every class that asks does so in the tile of
    its size band and is a partner there and in the band above. Tiles without
    two components to compare go before the bitmaps are attached; tiles of more
    than ``tile`` classes are cut into a grid of blocks, in which a class asks
    along one row and is a partner along one column."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4.0 / 3)) + 1e-9).cast("int")
    roles = rows.withColumn("band", band).select("token", "cls", "n", "comp", F.explode(F.array(
        F.struct(F.col("band").alias("band"), F.col("asks").alias("asks")),
        F.struct((F.col("band") + 1).alias("band"), F.lit(False).alias("asks")))).alias("r"))
    roles = roles.select("token", "r.band", "r.asks", "cls", "n", "comp")
    tiles = (roles.groupBy("token", "band")
                  .agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("cuts"), F.max("asks").alias("asked"),
                       F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                  .where("asked and lo <> hi").select("token", "band", "cuts"))
    kept = roles.join(tiles, ["token", "band"])
    own = F.pmod(F.xxhash64("cls"), F.col("cuts")).cast("int")
    line = F.sequence(F.lit(0), F.col("cuts") - 1)
    both = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("asks").alias("asks"), F.lit(True).alias("offers")))
    column = F.transform(line, lambda k: F.struct(k.alias("x"), own.alias("y"), F.lit(False).alias("asks"), F.lit(True).alias("offers")))
    row = F.transform(line, lambda k: F.struct(own.alias("x"), k.alias("y"), F.lit(True).alias("asks"), F.lit(False).alias("offers")))
    places = F.when(F.col("cuts") == 1, both).when(F.col("asks"), F.concat(row, column)).otherwise(column)
    placed = kept.select("token", "band", "cls", "n", "comp", F.explode(places).alias("b"))
    return placed.select(F.xxhash64("token", "band", "b.x", "b.y").alias("tile"), "b.asks", "b.offers",
                         "cls", "n", "comp").join(bits, "cls")


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of each row of ``x`` and ``y`` (bitmaps as bytes), the wider ones folded."""
    width = min(x.shape[1], y.shape[1])
    x, y = folded(x, width), folded(y, width)
    if width % 8 == 0:
        x, y = x.view(np.uint64), y.view(np.uint64)
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def tile_pairs(rows: pd.DataFrame, best: int | None, percent: int = PERCENT) -> pd.DataFrame:
    """``a, b, more`` (see ``candidate_pairs``) of whole tiles, sorted by ``tile, n, cls``: a row
    that asks meets the rows before it that offer. All askers' pairs are compared at once, ``PAIRS`` at a time."""
    n, cls, comp = (rows[c].to_numpy(np.int64) for c in ("n", "cls", "comp"))
    raws = rows["bits"].to_numpy()
    widths = np.fromiter(map(len, raws), np.int64, len(raws))
    maps, place = {}, np.empty(len(raws), np.int64)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        maps[w], place[at] = np.frombuffer(b"".join(raws[at]), np.uint8).reshape(-1, w), np.arange(len(at))
    # Offering rows of an asker: of its tile, from the smallest set it can be linked with up to itself.
    tile = np.unique(rows["tile"].to_numpy(), return_inverse=True)[1].astype(np.int64) << 40
    askers, offers = np.flatnonzero(rows["asks"].to_numpy(bool)), np.flatnonzero(rows["offers"].to_numpy(bool))
    first = np.searchsorted((tile + n)[offers], tile[askers] - (-percent * n[askers] // 100))
    count = np.maximum(np.searchsorted(offers, askers) - first, 0)
    upto, out = np.cumsum(count), [np.empty((3, 0), np.int64)]
    k = 0
    while k < len(askers):
        end = max(k + 1, int(np.searchsorted(upto, upto[k] - count[k] + PAIRS, side="right")))
        many = count[k:end]
        i = np.repeat(askers[k:end], many)
        j = offers[np.arange(len(i)) + np.repeat(first[k:end] - (np.cumsum(many) - many), many)]
        k = end
        near = (comp[i] != comp[j]) & (widths[i] <= 2 * widths[j]) & (widths[j] <= 2 * widths[i])
        i, j = i[near], j[near]
        differ = np.zeros(len(i), np.int64)
        for w in np.unique(widths[i]).tolist():
            for v in (w // 2, w, 2 * w):
                of = np.flatnonzero((widths[i] == w) & (widths[j] == v))
                step = max(1, COMPARED_BYTES // max(v, 1))
                for p in range(0, len(of), step):
                    part = of[p:p + step]
                    differ[part] = differing(maps[w][place[i[part]]], maps[v][place[j[part]]])
        slack = (n[i] + n[j] - differ) // 2 - needed(n[i], n[j], percent)
        i, j, slack = i[slack >= 0], j[slack >= 0], slack[slack >= 0]
        more = np.zeros(len(i), np.int64)
        if best is not None:
            order = np.lexsort((cls[j], -slack, i))
            i, j = i[order], j[order]
            start = np.searchsorted(i, i)
            more = (np.searchsorted(i, i, side="right") - start > best).astype(np.int64)
            taken = np.arange(len(i)) - start < best
            i, j, more = i[taken], j[taken], more[taken]
        out.append(np.stack((cls[i], cls[j], more)))
    a, b, more = np.concatenate(out, axis=1)
    return pd.DataFrame({"a": a, "b": b, "more": more.astype(bool)})


def candidate_pairs(tiles: DataFrame, best: int | None, percent: int = PERCENT) -> DataFrame:
    """``a, b, more``: pairs of a tile whose bitmaps allow the overlap needed and
    whose components differ: each asker's ``best`` ones (``more`` where it had others), or all."""
    def compare(batches: Iterator) -> Iterator:
        held = None      # the rows of the last tile so far
        for pdf in batches:
            if not len(pdf):
                continue
            rows = pdf if held is None else pd.concat((held, pdf), ignore_index=True)
            cut = int(np.searchsorted(rows["tile"].to_numpy(), rows["tile"].iloc[-1]))
            if cut:
                yield tile_pairs(rows[:cut], best, percent)
            held = rows[cut:]
        if held is not None:
            yield tile_pairs(held, best, percent)

    dealt = tiles.repartition("tile").sortWithinPartitions("tile", "n", "cls")
    return dealt.mapInPandas(compare, "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more"))


def bounded(pairs: DataFrame, bits: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b`` of the distinct pairs whose whole bitmaps (``cls, n, bits``) allow the overlap needed."""
    @F.pandas_udf("boolean")
    def allowed(n: pd.Series, bits: pd.Series, m: pd.Series, other: pd.Series) -> pd.Series:
        out = []
        for a, x, b, y in zip(n, bits, m, other):
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            width = min(len(x), len(y))
            differ = int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum(dtype=np.int64))
            out.append((a + b - differ) // 2 >= needed(a, b, percent))
        return pd.Series(out, dtype=bool)

    one = bits.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = bits.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    met = pairs.select("a", "b").join(one, "a").join(two, "b")
    return met.where(allowed("n_a", "bits_a", "n_b", "bits_b")).select("a", "b")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``a, b, overlap`` of the distinct pairs at or above the threshold, by
    intersecting sorted arrays. Each array is computed once from its text and
    sent to its pairs; a pair's two arrays are neighbours after sorting."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("cls"))
    ids = ends.select("cls").distinct()
    wanted = classes.join(ids, "cls").select("cls", "d1", "d2", F.col("first_id").alias("w_id"))

    def sets(batches: Iterator) -> Iterator:
        for pdf in batches:
            rows = []
            for cls, d1, d2, t in zip(pdf["cls"], pdf["d1"], pdf["d2"], pdf["text"]):
                s = shingle_set(t, size)
                if len(s) and set_digest(s) == (d1, d2):   # else another text under the same id
                    rows.append((cls, s.tobytes()))
            yield pd.DataFrame(rows, columns=["cls", "set"])

    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")))
    arrays = texts.select("cls", "d1", "d2", "text").mapInPandas(sets, "cls long, set binary")

    def intersect(batches: Iterator) -> Iterator:
        a = b = first = None      # the pair under way and its first array
        for pdf in batches:
            rows = []
            for x, y, cls, raw in zip(pdf["a"], pdf["b"], pdf["cls"], pdf["set"]):
                if (x, y) != (a, b):
                    a, b, first = x, y, (cls, raw)
                elif first is not None and cls != first[0]:    # repeated rows give an array twice
                    s, t = np.frombuffer(first[1], np.uint64), np.frombuffer(raw, np.uint64)
                    common, first = len(np.intersect1d(s, t, assume_unique=True)), None
                    if common >= needed(len(s), len(t), percent):
                        rows.append((a, b, common))
            yield pd.DataFrame(rows, columns=["a", "b", "overlap"]).astype("int64")

    met = ends.join(arrays, "cls").repartition("a", "b").sortWithinPartitions("a", "b", "cls")
    return met.select("a", "b", "cls", "set").mapInPandas(intersect, "a long, b long, overlap long")


class Joined:
    """Tables of one join: ``sig`` per row, ``classes`` of equal sets, the shared prefix shingles and bitmaps."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, size: int, percent: int):
        self.docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                                F.xxhash64(text).alias("text_key"))
        self.size, self.percent = size, percent
        self.sig = materialize(signatures(self.docs, size, percent), "signatures")
        classes = (self.sig.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first_id"))
                       .withColumn("cls", F.monotonically_increasing_id()))
        self.classes = materialize(classes, "classes")
        self.shared = materialize(shared_tokens(self._reps(self.classes, "rare", "frequent")), "shared")
        involved = self.classes.join(self.shared.select("cls").distinct(), "cls")
        self.bits = materialize(self._reps(involved, "bits", "coarse").dropDuplicates(["cls"]), "bitmaps")

    def _reps(self, of: DataFrame, *cols: str) -> DataFrame:
        """Signature columns of one document of each class; its id spreads copies over the join."""
        c = of.select("cls", F.col("d1").alias("c1"), F.col("d2").alias("c2"), "first_id")
        cond = (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
        return self.sig.select("doc_id", "d1", "d2", "n", *cols).join(c, cond).select("cls", "n", *cols)

    def pairs(self, rows: DataFrame, best: int | None, tile: int) -> DataFrame:
        """Candidates of one round; the one of ``BEST`` partners meets in every open shingle and sends narrow bitmaps."""
        sent = self.bits.select("cls", F.col("coarse" if best == BEST else "bits").alias("bits"))
        return materialize(candidate_pairs(tiled(rows, sent, tile), best, self.percent), "pairs")

    def links(self, pairs: DataFrame) -> DataFrame:
        near = materialize(bounded(pairs, self.bits, self.percent), "near")
        return materialize(verified(near, self.classes, self.docs, self.size, self.percent), "links")

    def roots(self, tile: int) -> DataFrame:
        """``node, root``: components of classes, by rounds of best partners."""
        # First round: one rare and one frequent shingle per class, the best partner.
        asked = self.shared.groupBy("cls", "n", "frequent").agg(F.min("token").alias("token"))
        tried = self.pairs(asked.withColumn("comp", F.col("cls")).withColumn("asks", F.lit(True)), 1, tile)
        links, again = self.links(tried), None
        roots = materialize(components(links), "roots")
        for best in (BEST, None):
            labelled = self.shared.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
                "token", "cls", "n", F.coalesce("root", "cls").alias("comp"))
            if again is None:
                labelled = labelled.withColumn("asks", F.lit(True))
            else:
                labelled = labelled.join(again.withColumn("asks", F.lit(True)), "cls", "left").withColumn(
                    "asks", F.coalesce("asks", F.lit(False)))
            # Shingles of several components, one of whose classes asks.
            open_tokens = labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                                        F.max("asks").alias("asked")).where("lo <> hi and asked")
            rest = materialize(labelled.join(open_tokens.select("token"), "token", "left_semi"), "open")
            found = self.pairs(rest, best, tile)
            new = materialize(found.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "new")
            linked, tried = self.links(new), tried.unionByName(new)
            discard(rest)
            if not linked.isEmpty():
                links = links.unionByName(linked)
                discard(roots)
                roots = materialize(components(links), "roots")
            again = materialize(found.where("more").select(F.col("a").alias("cls")).distinct(), "again")
            if again.isEmpty():
                break
        return roots


def class_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                percent: int = PERCENT, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and what they link: ``a, b, overlap``
    over class numbers, and ``doc_id, cls`` per row of ``docs`` with a set.
    Rows of one class have equal sets. The pairs of a group grow with the square of its different texts."""
    join = Joined(docs, doc_id, text, size, percent)
    every = join.shared.withColumn("comp", F.col("cls")).withColumn("asks", F.lit(True))
    links = join.links(join.pairs(every, None, tile))
    members = join.sig.join(join.classes.select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "cls"),
                            (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2"))).select("doc_id", "cls")
    return links, members


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                       percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, text_key`` per row of
    ``docs``: the smallest doc_id of its component and of its class of equal
    sets; ``text_key`` is ``xxhash64`` of the text."""
    join = Joined(docs, doc_id, text, size, percent)
    roots = join.roots(tile)
    # The smallest document of every component, then of every class.
    of_class = join.classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    lowest = of_class.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = materialize(of_class.join(lowest, "root").select(
        F.col("d1").alias("c1"), F.col("d2").alias("c2"), "component_id", F.col("first_id").alias("class_id")), "known")
    rows = materialize(join.sig.select("doc_id", "text_key", "n", "d1", "d2"), "rows")
    discard(join.sig, join.shared, join.bits, join.classes, roots)
    out = rows.join(known, (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")), "left")
    alone = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "text_key")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    doc_id. Of rows repeated as a whole one stays; rows without an id stay
    unless they are linked to one with an id; documents with an empty set stay."""
    found = materialize(jaccard_components(docs, doc_id, text, **kw), "found")
    g_id, g_key = fresh(docs, "g_id"), fresh(docs, "g_key")
    key = [F.col("doc_id").alias(g_id), F.col("text_key").alias(g_key)]
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*key).distinct()
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(g_id)) & (F.xxhash64(text) == F.col(g_key))
    kept = docs.join(gone, same, "left_anti")
    # Repeated rows: only rows whose id and text occur again go through the distinct.
    again = materialize(found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*key), "again")
    if again.isEmpty():
        return kept
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").distinct())
