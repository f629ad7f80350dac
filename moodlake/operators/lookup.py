"""Dimension lookups (J1-J3) with the reference's first-hit rule.

Each dimension is first reduced to one row per lookup key with a partial
aggregate (``first_per_key``), then joined with a left outer join, so a
miss keeps the row. The join conditions are null-safe expressions, which
differ from the aggregate's partitioning: both sides shuffle under the
join, so AQE can split the partition of a hot key on the track side. The reduced dimension is an aggregate stage: AQE sees
its real size before the join and broadcasts it only when small;
otherwise the join shuffles and AQE splits hot keys of the play side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.functions.envelope import primary_genre
from moodlake.functions.text import SENTINEL_LYRICS, clean_title, search_key, validate_lyrics
from moodlake.operators.ranking import first_per_key


def with_lyrics(tracks: DataFrame, lyrics_dim: DataFrame, order: str = "rank") -> DataFrame:
    """Lyrics by (clean title, artist). ``lyrics_dim`` has ``title,
    artist, lyrics`` and an ``order`` column (best hit first; ties go to the
    smaller md5 of the lyrics). Raw lyrics go through the validity gate and
    first-line cut; a miss → sentinel.

    The winner is chosen on keys, order and digest alone, for the keys that
    some track asks for; only then is its text fetched, once per key.
    """
    keyed = tracks.withColumn("_kt", clean_title("name"))
    wanted = keyed.select(F.col("_kt").alias("_wt"), F.col("artist").alias("_wa")).distinct()
    dim = lyrics_dim.select(F.col("title").alias("_t"), F.col("artist").alias("_a"), F.col(order).alias("_o"),
                            F.md5("lyrics").alias("_d"), F.col("lyrics").alias("_l"))
    asked = [F.col("_t").eqNullSafe(F.col("_wt")), F.col("_a").eqNullSafe(F.col("_wa"))]
    best = (dim.drop("_l").join(wanted, asked, "left_semi")
               .groupBy("_t", "_a").agg(F.min(F.struct("_o", "_d")).alias("_b"))
               .select(F.col("_t").alias("_bt"), F.col("_a").alias("_ba"), F.col("_b._o").alias("_bo"), F.col("_b._d").alias("_bd")))
    won = [F.col(x).eqNullSafe(F.col(y)) for x, y in (("_t", "_bt"), ("_a", "_ba"), ("_o", "_bo"), ("_d", "_bd"))]
    fetched = dim.join(best, won, "left_semi")
    # Repeated rows of the dimension: one of the equal texts stays.
    one = Window.partitionBy("_t", "_a").orderBy("_d")
    fetched = fetched.withColumn("_n", F.row_number().over(one)).where("_n = 1").select(
        "_t", "_a", validate_lyrics("_l").alias("_lyrics"))
    j = keyed.join(fetched, [F.col("_kt").eqNullSafe(F.col("_t")), F.col("artist").eqNullSafe(F.col("_a"))], "left")
    return j.select(*tracks.columns,
                    F.coalesce(F.col("_lyrics"), F.lit(SENTINEL_LYRICS)).alias("lyrics"))


def with_genre(tracks: DataFrame, artists_dim: DataFrame, order: str = "rank") -> DataFrame:
    """Primary genre of the first artist hit by name; miss → NULL,
    empty genres → ``not applicable``."""
    dim = first_per_key(artists_dim.select("name", order, "genres"), ["name"], [order])
    dim = dim.select(F.col("name").alias("_artist"), F.struct(F.col("genres")).alias("_hit"))
    j = tracks.join(dim, F.col("artist").eqNullSafe(F.col("_artist")), "left")
    return j.select(*tracks.columns, primary_genre("_hit").alias("genre"))


def with_track_id(plays: DataFrame, catalog: DataFrame, order: str = "rank") -> DataFrame:
    """Id of the first catalogue hit for ``name + artist`` (no
    separator); a miss gives NULL."""
    cat = catalog.withColumn("_key", search_key("name", "artist", ""))
    dim = first_per_key(cat.select("_key", order, F.col("id").alias("_id")), ["_key"], [order])
    dim = dim.select(F.col("_key").alias("_dkey"), "_id")
    j = plays.withColumn("_key", search_key("name", "artist", "")).join(
        dim, F.col("_key").eqNullSafe(F.col("_dkey")), "left")
    return j.select(*plays.columns, F.col("_id").alias("track_id"))
