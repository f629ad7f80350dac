"""Song-library operators: duplicates, deletes, neighbours, unions.

A library entry is ``kind`` (songs / albums / playlists), ``container``
(album or playlist name; NULL for loose songs), ``file_name``, ``name``,
``artist``, ``path``. Lists (playlists, favourites, chat turns) are rows
with a container key and a ``position``.

No operator here gathers a container into one task: duplicates and
keep-first are partial aggregates, deletes are anti-joins, neighbours are
found inside range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.functions.envelope import DEFAULT_IMAGE
from moodlake.functions.text import parse_file_index, parse_file_split
from moodlake.operators.ranking import first_per_key, row_numbers
from moodlake.session import materialize

# Library folder kinds.
KINDS = ["songs", "albums", "playlists"]


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def with_names(df: DataFrame, file_col: str = "file_name", form: str = "split") -> DataFrame:
    """T5a / T5b applied to a listing: adds ``name`` and ``artist``."""
    name, artist = (parse_file_split if form == "split" else parse_file_index)(F.col(file_col))
    return df.withColumn("name", name).withColumn("artist", artist)


# --- duplicates (J4, M5) -------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by at least two *different* records: one partial aggregate
    over two 64-bit hashes of the record, nulls told apart by place, so it holds longs and never sorts."""
    rec = [x for c in df.columns for x in (F.col(c), F.col(c).isNull())]
    one, two = F.xxhash64(*rec), F.xxhash64(F.lit(1), *rec)
    agg = df.groupBy(*keys).agg(F.min(one).alias("_lo1"), F.max(one).alias("_hi1"),
                                F.min(two).alias("_lo2"), F.max(two).alias("_hi2"))
    return agg.filter((F.col("_lo1") != F.col("_hi1")) | (F.col("_lo2") != F.col("_hi2"))).select(*keys)


def duplicate_members(df: DataFrame, keys: list[str] = ("name", "artist")) -> DataFrame:
    """J4 (parity): every record whose key is shared with a different
    record — the first one too; byte-identical copies do not count."""
    keys = list(keys)
    dup = duplicate_keys(df, keys)
    return df.join(dup, on=_null_safe_on(df, dup, keys), how="left_semi")


def dedupe_keep_first(df: DataFrame, keys: list[str] = ("name", "artist"),
                      order: list[str] = ("position",)) -> DataFrame:
    """J4 (intent): keep the first record per key."""
    return first_per_key(df, list(keys), list(order))


def purge_duplicates(df: DataFrame, keys: list[str] = ("name", "artist"),
                     id_col: str = "id") -> DataFrame:
    """M5: delete by id every duplicate member (parity: no copy survives)."""
    return library_delete(df, duplicate_members(df, keys), [id_col])


# --- deletes (J5, M1-M4) -------------------------------------------------

def library_delete(df: DataFrame, doomed: DataFrame, on: list[str]) -> DataFrame:
    """Remove rows matching the delete set (anti-join). The distinct
    delete keys are an aggregate stage, so AQE knows their real size before
    the join and broadcasts them only when small; no extra counting job."""
    keys = doomed.select(*on).distinct()
    return df.join(keys, on=_null_safe_on(df, keys, on), how="left_anti")


def delete_song(df: DataFrame, name: str, artist: str) -> DataFrame:
    """M1: delete one loose song file."""
    hit = (F.col("kind") == "songs") & (F.col("name") == name) & (F.col("artist") == artist)
    return df.filter(~F.coalesce(hit, F.lit(False)))


def delete_container(df: DataFrame, kind: str, container: str) -> DataFrame:
    """M2: delete a whole album or playlist."""
    hit = (F.col("kind") == kind) & (F.col("container") == container)
    return df.filter(~F.coalesce(hit, F.lit(False)))


def delete_from(df: DataFrame, kind: str, container: str, doomed: DataFrame) -> DataFrame:
    """M3: delete songs (``name, artist``) from one container. Containers
    are derived from the remaining rows, so an emptied one vanishes."""
    scope = (F.col("kind") == kind) & (F.col("container") == container)
    inside = df.filter(scope)
    outside = df.filter(~F.coalesce(scope, F.lit(False)))
    return outside.unionByName(library_delete(inside, doomed, ["name", "artist"]))


def delete_everywhere(df: DataFrame, doomed: DataFrame) -> DataFrame:
    """M4: delete songs (``name, artist``) from every container."""
    return library_delete(df, doomed, ["name", "artist"])


def containers(df: DataFrame) -> DataFrame:
    """Non-empty containers with their song count."""
    return (df.filter(F.col("container").isNotNull())
              .groupBy("kind", "container").agg(F.count(F.lit(1)).alias("songs")))


# --- unions (U1-U3, A5) --------------------------------------------------

def append_pages(*dfs: DataFrame) -> DataFrame:
    """Concatenate lists, duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def kind_rank(order: list[str]) -> Column:
    expr = None
    for i, k in enumerate(order):
        expr = (F.when(F.col("kind") == k, F.lit(i)) if expr is None
                else expr.when(F.col("kind") == k, F.lit(i)))
    return expr.otherwise(F.lit(len(order)))


def artist_library(df: DataFrame, artist: str,
                   kind_order: list[str] = ("albums", "playlists", "songs")) -> DataFrame:
    """One artist's songs over all containers, with ``kind_rank`` for
    the view's order (albums → playlists → songs, or songs first)."""
    return df.filter(F.col("artist") == artist).withColumn("kind_rank", kind_rank(list(kind_order)))


def distinct_artists(df: DataFrame, kind_order: list[str] = ("albums", "playlists", "songs")) -> DataFrame:
    """A5: each artist once with where it was first seen (kind in
    ``kind_order``, then container, then file name)."""
    first = F.min(F.struct(kind_rank(list(kind_order)).alias("kind_rank"),
                           F.coalesce(F.col("container"), F.lit("")).alias("container"),
                           F.col("file_name").alias("file_name")))
    agg = df.filter(F.col("artist").isNotNull()).groupBy("artist").agg(first.alias("_f"))
    return agg.select("artist", F.col("_f")["kind_rank"].alias("first_kind_rank"),
                      F.col("_f")["container"].alias("first_container"),
                      F.col("_f")["file_name"].alias("first_file"))


# --- ordered lists (W1, W2, W4) -------------------------------------------

def number_items(df: DataFrame, order: list, partition: list[str] = ("topic",),
                 out: str = "item_number") -> DataFrame:
    """Running item number (1, 2, …) per feed in list order."""
    return row_numbers(df, list(partition), list(order), out=out)


def list_ranges(df: DataFrame, container: list[str], order: list[str]) -> DataFrame:
    """``df`` dealt over range partitions by list and order and written once, with
    its partition (``_pid``) and place (``_mid``). A long list spans several
    partitions, so no (list, ``_pid``) group outgrows one partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *container, *order).sortWithinPartitions(*container, *order)
                .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    return materialize(ranged, "neighbors")


def circular_neighbors(df: DataFrame, container: list[str], position: str,
                       fields: list[str] = ("name", "artist")) -> DataFrame:
    """Previous and next item in a circular list.

    The first item's previous is the last, the last item's next is the
    first; a one-item list points at itself. Positions may have gaps or
    repeat (repeated ones are ordered by the fields). Rows are
    range-partitioned by list and position and written once; neighbours come
    from ``lag`` / ``lead`` inside a partition, and one row per list and
    partition holds its first and last item, which mends the borders and the
    list's ends. Adds ``prev_<f>`` and ``next_<f>``.
    """
    container, fields = list(container), list(fields)
    order = [position, *[f for f in fields if f != position and f not in container]]
    ranged = list_ranges(df, container, order)
    item = F.struct(*[F.col(f) for f in fields])
    part = Window.partitionBy(*container, "_pid").orderBy("_mid")
    inner = ranged.withColumn("_prev", F.lag(item).over(part)).withColumn("_next", F.lead(item).over(part))
    ends = ranged.groupBy(*container, "_pid").agg(F.min_by(item, "_mid").alias("_first"),
                                                  F.max_by(item, "_mid").alias("_last"))
    # As many rows per list as range partitions hold a part of it.
    along = Window.partitionBy(*container).orderBy("_pid")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        *[F.col(c).alias(f"_b{i}") for i, c in enumerate(container)], F.col("_pid").alias("_bpid"),
        F.coalesce(F.lag("_last").over(along), F.last("_last").over(whole)).alias("_before"),
        F.coalesce(F.lead("_first").over(along), F.first("_first").over(whole)).alias("_after"))
    on = [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(container)] + [F.col("_pid") == F.col("_bpid")]
    out = inner.join(ends, on).withColumn("_prev", F.coalesce("_prev", "_before")) \
               .withColumn("_next", F.coalesce("_next", "_after"))
    return out.select(*df.columns, *[F.col("_prev")[f].alias(f"prev_{f}") for f in fields],
                      *[F.col("_next")[f].alias(f"next_{f}") for f in fields])


def neighbors_of(items: DataFrame, name: str, artist: str, order: str = "position",
                 default_image: str = DEFAULT_IMAGE) -> DataFrame:
    """W1 lookup with the W3 first-match rule over one list (``name, artist,
    image`` and an ``order`` column): one row ``name, artist, image`` and the
    neighbours of the track's first place, circular. A track that is not in the
    list gets empty names and the default image, as the player shows.

    The list is not numbered or sorted: one aggregate finds the track's
    first key, a second one the largest key below it, the smallest above it
    and both ends. Each task keeps five rows.
    """
    key = F.struct(F.col(order).alias("at"), F.col("name").alias("name"), F.col("artist").alias("artist"),
                   F.col("image").alias("image"))
    keyed = items.select(key.alias("k"))
    match = (F.col("k.name") == name) & (F.col("k.artist") == artist)
    hit = keyed.agg(F.min(F.when(match, F.col("k")))).scalar()
    near = keyed.agg(F.max(F.when(F.col("k") < hit, F.col("k"))).alias("below"),
                     F.min(F.when(F.col("k") > hit, F.col("k"))).alias("above"),
                     F.min("k").alias("first"), F.max("k").alias("last"), F.min(F.when(match, F.col("k"))).alias("hit"))

    def side(inner: str, wrap: str, field: str) -> Column:
        found = F.coalesce(F.col(inner), F.col(wrap))[field]
        return F.coalesce(F.when(F.col("hit").isNotNull(), found), F.lit("")).alias(f"{'prev' if inner == 'below' else 'next'}_{field}")

    return near.select(F.lit(name).alias("name"), F.lit(artist).alias("artist"),
                       F.coalesce(F.col("hit.image"), F.lit(default_image)).alias("image"),
                       *[side(i, w, f) for i, w in (("below", "last"), ("above", "first")) for f in ("name", "artist")])
