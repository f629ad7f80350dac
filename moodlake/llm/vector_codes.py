"""Vector codes: product quantisation whose nearest entries are found by a GNAT.

Vectors become integers and are cut into equal parts; each part position has
a codebook of a few entries that starts from the vectors with the smallest ids
and is refined by rounds of assignment and integer means. The search for a
part's nearest entry goes through a geometric near-neighbour access tree over
the codebook: a node holds split points, the entries nearest to each form a
child, and for every split and child the range of their distances is stored. A
query's distance to a split rules out every child whose range lies wholly
beyond the best distance so far; only strictly worse entries are ever ruled
out, as ranges and distances are rounded away from each other. Distances that
decide are squared integers; equal ones go to the lower index.

Each round is one pass of the vectors, which stay where they are: a task gives
the sums and counts of its parts per entry, Spark adds them, and the driver
takes one number per codebook component (a bound set by entries and
dimensions, not by rows). The tree has a codebook's size and goes to the tasks.

Cases: vectors that are null, empty or hold null or non-finite components take
no part, nor do vectors without the commonest length that the parts divide
(ties: the longer). Components beyond a long saturate, errors too. Null ids come
last among the starting vectors, equal ids by vector; with fewer vectors than entries the codebook is
that much smaller. Repeated rows count each. Labels may be null: all nulls are
one label. An empty table gives an empty result. Only the three named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096.0
ARITY = 4                   # split points of a node
MARGIN = 2.0 ** -48         # relative rounding allowance of a distance, many times the true error
MAX_LONG = 2 ** 63 - 1


def _square(a, b):
    """Squared distances of the rows of ``a`` to the vector ``b``, exact."""
    d = a - b
    return (d * d).sum(axis=1)


class Gnat:
    """Nearest entries of integer vectors. ``measured`` counts distances taken."""

    def __init__(self, entries, arity: int = ARITY):
        self.entries, self.arity, self.measured = entries, arity, 0
        self.root = self._node(list(range(len(entries))))

    def _node(self, ids: list):
        """``(splits, children, low, high)``; children is None at a leaf."""
        import numpy as np

        if len(ids) <= self.arity:
            return ids, None, None, None
        points = self.entries[ids]
        # Split points far from each other: each next is the farthest from those before.
        picked, near = [0], _square(points, points[0])
        while len(picked) < self.arity:
            far = int(np.argmax(near))
            if near[far] == 0:      # only copies of split points are left
                far = next(i for i in range(len(ids)) if i not in picked)
            picked.append(far)
            near = np.minimum(near, _square(points, points[far]))
        rest = [i for i in range(len(ids)) if i not in picked]
        to = np.array([_square(points[rest], points[p]) for p in picked])
        owner = np.argmin(to, axis=0)
        low, high = np.zeros((len(picked),) * 2), np.zeros((len(picked),) * 2)
        children = []
        for j in range(len(picked)):
            mine = [k for k in range(len(rest)) if owner[k] == j]
            children.append(self._node([ids[rest[k]] for k in mine]) if mine else None)
            if mine:
                reach = np.sqrt(to[:, mine].astype(float))
                low[:, j], high[:, j] = reach.min(axis=1) * (1 - MARGIN), reach.max(axis=1) * (1 + MARGIN)
        return [ids[p] for p in picked], children, low, high

    def nearest(self, queries):
        """Index and squared distance of each query's nearest entry, ties to the lower index."""
        import numpy as np

        best = np.full(len(queries), MAX_LONG if queries.dtype != object else 1 << 400, dtype=queries.dtype)
        index = np.full(len(queries), len(self.entries))
        if len(queries):
            self._search(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _search(self, node, queries, rows, best, index) -> None:
        import numpy as np

        splits, children, low, high = node
        open_ = np.ones((len(splits), len(rows)), dtype=bool)
        for i, entry in enumerate(splits):
            # A ruled-out split point belongs to no ruled-out child: it is always measured.
            d = _square(queries[rows], self.entries[entry])
            self.measured += len(rows)
            better = (d < best[rows]) | ((d == best[rows]) & (entry < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], entry
            if children is None:
                continue
            at, reach = np.sqrt(d.astype(float)), np.sqrt(best[rows].astype(float)) * (1 + MARGIN)
            for j, child in enumerate(children):
                if child is not None:
                    open_[j] &= ~((at * (1 - MARGIN) - reach > high[i, j]) | (at * (1 + MARGIN) + reach < low[i, j]))
        for j, child in enumerate(children or []):
            if child is not None and open_[j].any():
                self._search(child, queries, rows[open_[j]], best, index)


def _matrix(column, width: int):
    """The vectors of an Arrow list column as rows of integers. Where squares of
    differences could pass a long, Python's own integers are used."""
    import numpy as np

    m = np.asarray(column.flatten(), dtype=np.int64).reshape(-1, width)
    room = int((2.0 ** 62 / max(width, 1)) ** 0.5 / 2)
    big = len(m) and (int(m.max()) > room or int(m.min()) < -room)
    return m.astype(object) if big else m


def _nearest(books, m):
    """Per part: the part's columns, index and squared distance of the nearest entries."""
    import numpy as np

    step = m.shape[1] // len(books)
    for p, book in enumerate(books):
        entries = np.array(book, dtype=object)
        room = int((2.0 ** 62 / max(m.shape[1], 1)) ** 0.5 / 2)
        small = m.dtype != object and max(abs(x) for e in book for x in e) <= room
        part = m[:, p * step:(p + 1) * step]
        index, d = Gnat(entries.astype(np.int64) if small else entries).nearest(part if small else part.astype(object))
        yield p, part, index, d


def _sums(books, width: int):
    """Task function: component sums and counts of the parts assigned to each entry."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, part, index, _ in _nearest(books, _matrix(batch.column("v"), width)):
                for e in np.unique(index):
                    mine = part[index == e]
                    n, s = total.get((p, int(e)), (0, [0] * mine.shape[1]))
                    total[p, int(e)] = n + len(mine), [a + int(b) for a, b in zip(s, mine.astype(object).sum(axis=0))]
        rows = [(p, e, i, n, str(x)) for (p, e), (n, s) in total.items() for i, x in enumerate(s)]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([r[0] for r in rows], pa.int32()), "entry": pa.array([r[1] for r in rows], pa.int32()),
            "at": pa.array([r[2] for r in rows], pa.int32()), "n": pa.array([r[3] for r in rows], pa.int64()),
            "s": pa.array([r[4] for r in rows], pa.string())})
    return run


def _codes(books, width: int):
    """Task function: code and error of every vector."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            m = _matrix(batch.column("v"), width)
            codes = np.zeros((len(m), len(books)), dtype=np.uint8)
            error = np.zeros(len(m), dtype=object)
            for p, _, index, d in _nearest(books, m):
                codes[:, p] = index
                error += d.astype(object)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([bytes(c).hex() for c in codes], pa.string()),
                 pa.array([min(int(x), MAX_LONG) for x in error], pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def _integers(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def kept(embeddings: DataFrame, parts: int = PARTS, scale: float = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the vectors that take part, as integers."""
    e = F.col("embedding")
    whole = F.forall(e, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))   # NaN is greater than infinity
    rows = embeddings.where(e.isNotNull() & (F.size(e) > 0) & (F.size(e) % parts == 0) & whole)
    rows = rows.select("vec_id", "label", _integers(e, scale).alias("v"))
    top = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.where(F.size("v") == (top["width"] if top else 0))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list:
    """Codebooks ``[part][entry][component]`` of ``vectors`` (columns ``vec_id, v``)."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first:
        return []
    width = len(first[0]["v"])
    step = width // parts
    books = [[list(r["v"][p * step:(p + 1) * step]) for r in first] for p in range(parts)]
    for _ in range(rounds):
        part = vectors.select("v").mapInArrow(_sums(books, width), "part int, entry int, at int, n long, s string")
        sums = part.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        for r in sums.collect():    # at most entries x dimensions rows
            books[r["part"]][r["entry"]][r["at"]] = int(r["s"]) // r["n"]
    return books


def encode(vectors: DataFrame, books: list) -> DataFrame:
    """``vec_id, label, code, error`` of ``vectors`` (columns ``vec_id, label, v``)."""
    types = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    if not books:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    width = len(books) * len(books[0][0])
    return vectors.select("vec_id", "label", "v").mapInArrow(_codes(books, width), schema)


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: float = SCALE) -> DataFrame:
    """Every kept vector's code and error, its label's error and the digest of all codebooks."""
    import hashlib

    vectors = materialize(kept(embeddings, parts, scale), "vectors")    # read by every round
    books = train(vectors, parts, entries, rounds)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = materialize(encode(vectors, books), "codes")
    whole = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long")
    labels = coded.groupBy(F.col("label").alias("of")).agg(whole.alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
