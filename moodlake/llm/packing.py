"""Bounded-space online packing of token ids into fixed windows.

Each partition keeps ``open_windows`` windows open and reads its documents
once. A document longer than the window fills whole windows of its own; the
rest goes to the open window that it fills best; when none fits, the fullest
is emitted and a new one opened. The windows left open at the end of all
partitions are merged: they are dealt into groups of ``merge_group``
partitions, cut where needed, and filled up one after another.

Defined results: a null or empty text is its end token alone; every row is
packed, repeated rows too (``doc_id`` may be null or repeated); an empty table
gives no pieces; other columns are not read. A text of any length is cut into
windows, never shortened.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import materialize
from moodlake.llm.tokens import DEFAULT_TOKENIZER, encoder

WINDOW = 4096
OPEN_WINDOWS = 64
MERGE_GROUP = 64

PIECE = ("doc_id string, start long, length long, ids binary, doc_tokens long, "
         "window_id long, offset long, left_open boolean")


def online_pieces(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = 2, window: int = WINDOW,
                  open_windows: int = OPEN_WINDOWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of every document and the window each was placed in.
    ``window_id`` holds the partition in its upper bits, as
    ``monotonically_increasing_id`` does."""
    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        made = TaskContext.get().partitionId() << 33
        fill, held = {}, {}   # open windows: tokens placed, pieces not yet sent
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "window_id", "offset", "left_open"]

        def frame(rows):
            return pd.DataFrame(rows, columns=names)

        for pdf in batches:
            ready = []
            for key, ids in zip(pdf["doc_id"], enc.encode(pdf["text"].fillna("").tolist())):
                ids += end
                total, at = len(ids) // 4, 0
                while total - at >= window:
                    ready.append((key, at, window, ids[4 * at:4 * (at + window)], total, made, 0, False))
                    made, at = made + 1, at + window
                if (n := total - at) == 0:
                    continue
                best = max((w for w in fill if fill[w] + n <= window), key=fill.get, default=None)
                if best is None:
                    if len(fill) >= open_windows:
                        done = max(fill, key=fill.get)
                        del fill[done]
                        ready.extend(held.pop(done))
                    best, made = made, made + 1
                    fill[best], held[best] = 0, []
                held[best].append((key, at, n, ids[4 * at:], total, best, fill[best], False))
                fill[best] += n
                if fill[best] == window:
                    del fill[best]
                    ready.extend(held.pop(best))
            if ready:
                yield frame(ready)
        if held:
            yield frame([r[:-1] + (True,) for w in held.values() for r in w])

    # Ids travel as text: pandas would turn a column of numbers with nulls into floats.
    src = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return src.mapInPandas(pack, PIECE).withColumn("doc_id", F.col("doc_id").cast("long"))


def merged(pieces: DataFrame, window: int, merge_group: int) -> DataFrame:
    """Merge the windows left open: inside each group of ``merge_group``
    partitions (at most ``merge_group * open_windows`` windows) whole windows
    are placed best-fit, fullest first. Pieces keep their order and bytes."""
    left = (pieces.where("left_open").groupBy("window_id")
                  .agg(F.max(F.col("offset") + F.col("length")).alias("fill"))
                  .withColumn("part", F.shiftright("window_id", 33))
                  .withColumn("grp", F.floor(F.col("part") / merge_group)))

    def place(pdf):
        import pandas as pd
        room, out = {}, []
        for w, n in sorted(zip(pdf["window_id"], pdf["fill"]), key=lambda x: (-x[1], x[0])):
            best = min((k for k, r in room.items() if r >= n), key=room.get, default=None)
            if best is None:
                best, room[w] = w, window
            out.append((w, best, window - room[best]))
            room[best] -= n
        return pd.DataFrame(out, columns=["window_id", "sequence_id", "shift"])

    moved = left.groupBy("grp").applyInPandas(place, "window_id long, sequence_id long, shift long")
    kept = pieces.where(~F.col("left_open")).withColumn("sequence_id", F.col("window_id"))
    opened = (pieces.where("left_open").join(moved, "window_id")
                    .withColumn("offset", F.col("offset") + F.col("shift")).drop("shift"))
    return kept.unionByName(opened).drop("window_id", "left_open")


def pack_documents(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = 2, window: int = WINDOW,
                   open_windows: int = OPEN_WINDOWS, merge_group: int = MERGE_GROUP,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``;
    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers."""
    pieces = materialize(online_pieces(docs, tokenizer, end_id, window, open_windows, doc_id, text), "pieces")
    return merged(pieces, window, merge_group)


def digest(pieces: DataFrame) -> DataFrame:
    """The packing contract's columns: the ids as their CRC-32."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
