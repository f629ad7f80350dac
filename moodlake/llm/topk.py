"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are scaled and floored to integers; the score is the exact integer
inner product. Since q.x = (|q|^2 + |x|^2 - |q-x|^2) / 2, a lower bound of the
squared distance bounds the score from above. For a cut of the vector into
segments, each segment of w components contributes at least
w * ((difference of means)^2 + (difference of deviations)^2); finer cuts bound
tighter. The first candidates a query meets are scored as they are, which
gives it a k-th best score; from then on strips of candidates are filtered coarse to
fine against that score, and only the survivors' scores are computed. Strips hold
a fixed number of pairs, so memory does not grow with a block that prunes badly.

Candidates stay: they are dealt over salted shares of a bounded number of
components, and a task holds one share with its statistics while the queries
go by in blocks. Where shares are fewer than ``TASKS``, groups of queries split
the work further. Each task gives k rows per query, merged per query.

Defined results: vectors that are null, empty, hold a null or non-finite
component, or have no id take no part; of vectors of different lengths only
equal lengths are compared; ties go to the smaller id; a row never matches a
row of its own id; repeated rows are candidates each; with fewer than k
candidates all are returned; an empty table gives no rows. Scaled components
must fit 64-bit integers, as must scores.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Segments per resolution, coarse to fine (those not above the vector's length).
RESOLUTIONS = (1, 4, 16)
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 1024
SHARE_VALUES = 4_000_000    # components of the candidates that one task holds
TASKS = 24                  # shares x query groups, at least
PAIRS = 1 << 17             # pairs of a strip
SEED = 32                   # candidates scored before the first bound, at least


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """``id, v``: vectors that take part, as 64-bit integers."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (df.select(F.col(vec_id).cast("long").alias("id"), F.when(~bad & (F.size(v) > 0), ints).alias("v"))
              .where("id is not null and v is not null"))


def segment_stats(m, cuts: int):
    """Means and deviations per segment, each times the square root of the segment's width."""
    import numpy as np
    edges = np.linspace(0, m.shape[1], cuts + 1).astype(int)
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        part = m[:, a:b].astype(float)
        out += [part.mean(axis=1) * np.sqrt(b - a), part.std(axis=1) * np.sqrt(b - a)]
    return np.stack(out, axis=1)


def described(x, cuts: list):
    """Squared norms, statistics at each resolution and the largest component."""
    import numpy as np
    return (x.astype(float) ** 2).sum(axis=1), [segment_stats(x, c) for c in cuts], float(np.abs(x).max(initial=0))


class Searcher:
    """The k best candidates so far of one block of queries of one length."""

    def __init__(self, ids, vectors, k: int):
        import numpy as np
        self.ids, self.q, self.k = ids, vectors, k
        dims = vectors.shape[1]
        self.cuts = [c for c in RESOLUTIONS if c <= dims]
        self.norm, self.stats, self.peak = described(vectors, self.cuts)
        # Best first: score descending, then id; missing places hold None-like rows.
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)
        self.measured = 0

    def offer(self, ids, x, known=None) -> None:
        """Candidates of one block; ``known`` are their norms, statistics and peak."""
        import numpy as np
        norm, theirs, peak = known or described(x, self.cuts)
        small = self.peak * peak * x.shape[1] < 2 ** 53
        start = 0
        if np.isinf(self.floor).any():
            start = min(len(x), max(SEED, 4 * self.k))
            rows, cols = (g.ravel() for g in np.meshgrid(np.arange(len(self.q)), np.arange(start), indexing="ij"))
            self._score(rows, cols, ids, x, small)
        strip = max(1, PAIRS // max(len(self.q), 1))
        for a in range(start, len(x), strip):
            # While many pairs of the strip stay, bounds are matrix products; then pair by pair.
            b = min(a + strip, len(x))
            both = self.norm[:, None] + norm[None, a:b]
            least = 2 * (self.floor[:, None] - 1 - 1e-9 * both) - both      # -d2 must reach this
            rows = cols = None
            open_ = np.ones((len(self.q), b - a), dtype=bool)
            for mine, other in zip(self.stats, theirs):
                if rows is None:
                    part = other[a:b]
                    open_ &= 2 * mine @ part.T - (mine ** 2).sum(axis=1)[:, None] - (part ** 2).sum(axis=1)[None, :] >= least
                    if open_.sum() <= open_.size // 16:
                        rows, cols = np.nonzero(open_)
                else:
                    stay = -((mine[rows] - other[cols + a]) ** 2).sum(axis=1) >= least[rows, cols]
                    rows, cols = rows[stay], cols[stay]
            if rows is None:
                rows, cols = np.nonzero(open_)
            if small and len(rows) > open_.size // 16:      # exact in doubles: all products are below 2^53
                score = (self.q.astype(float) @ x[a:b].T.astype(float)).astype(np.int64)[rows, cols]
                self.measured += len(rows)
                stay = (self.ids[rows] != ids[cols + a]) & (score >= self.floor[rows])
                self._keep(rows[stay], ids[cols[stay] + a], score[stay])
            else:
                self._score(rows, cols + a, ids, x, small)

    def _score(self, rows, cols, ids, x, small: bool) -> None:
        """Exact scores of pairs, some at a time, kept where they are among the k best."""
        import numpy as np
        other = self.ids[rows] != ids[cols]
        rows, cols = rows[other], cols[other]
        self.measured += len(rows)
        step = max(1, (64 * PAIRS) // x.shape[1])
        for a in range(0, len(rows), step):
            r, c = rows[a:a + step], cols[a:a + step]
            if small:
                score = np.einsum("ij,ij->i", self.q[r].astype(float), x[c].astype(float)).astype(np.int64)
            else:
                score = (self.q[r] * x[c]).sum(axis=1)
            stay = score >= self.floor[r]
            self._keep(r[stay], ids[c[stay]], score[stay])

    def _keep(self, rows, ids, score) -> None:
        import numpy as np
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else []
        for a, b in zip(first, np.r_[first[1:], len(rows)]):
            r, b = rows[a], min(b, a + self.k)
            merged = self.best[r] + list(zip((-score[a:b]).tolist(), ids[a:b].tolist()))
            merged.sort()
            self.best[r] = merged[:self.k]
            if len(self.best[r]) == self.k:
                self.floor[r] = -self.best[r][-1][0]


def _blocks(pdf, size: int):
    """Rows of equal vector length, in blocks of ``size``."""
    import numpy as np
    for _, same in pdf.groupby(pdf["v"].map(len), sort=True):
        for a in range(0, len(same), size):
            part = same.iloc[a:a + size]
            yield part["id"].to_numpy(np.int64), np.stack(part["v"].to_numpy()).astype(np.int64)


def top_k(df: DataFrame, is_query: Column, k: int, scale: float, vec_id: str = "vec_id",
          vector: str = "embedding", query_block: int = QUERY_BLOCK, shares: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row where ``is_query`` (an
    expression over ``id``), against all rows."""
    every = integer_vectors(df, vec_id, vector, scale)
    if shares is None:
        n, width = every.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
        shares = max(1, -(-n * (width or 0) // SHARE_VALUES))
    groups = max(1, -(-TASKS // shares))
    # Place in the input, not the id alone, salts the shares: an id may hold a third of the rows.
    c = every.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shares)).cast("int").alias("share"),
                     F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(False).alias("asks"), "id", "v")
    q = every.where(is_query).select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("grp"), F.lit(True).alias("asks"), "id", "v")
    # One task a cell; a few cells that share one are taken one after another.
    dealt = c.unionByName(q).repartition(shares * groups, "share", "grp").sortWithinPartitions("share", "grp", "asks", "id")

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        here, held = None, {}

        def answers(part):
            rows = []
            for ids, m in _blocks(part, query_block):
                one = Searcher(ids, m, k)
                for other, x, known in held.get(m.shape[1], []):
                    one.offer(other, x, known)
                rows += [(int(q), -s, i) for q, best in zip(one.ids, one.best) for s, i in best]
            return pd.DataFrame(rows, columns=["query_id", "score", "vec_id"])

        for pdf in batches:
            key = pdf["share"].to_numpy(np.int64) * groups + pdf["grp"].to_numpy(np.int64)
            edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(pdf) else []
            for a, b in zip(edges, np.r_[edges[1:], len(pdf)]):
                part = pdf.iloc[a:b]
                if key[a] != here:
                    here, held = key[a], {}
                for ids, x in _blocks(part[~part["asks"]], CANDIDATE_BLOCK):
                    cuts = [c for c in RESOLUTIONS if c <= x.shape[1]]
                    held.setdefault(x.shape[1], []).append((ids, x, described(x, cuts)))
                if part["asks"].any():
                    yield answers(part[part["asks"]])

    partial = dealt.mapInPandas(search, "query_id long, score long, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
