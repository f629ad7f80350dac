"""Taste trend on the live stream of scored records.

Event-time windows with a watermark: days are ``window("1 day")``; weeks
start on Monday, which is ``window("7 days", "7 days", "4 days")`` because
the epoch fell on a Thursday. Months are not a fixed duration, so they are
rolled up from the day counts (``month_rollup``).

The store keeps replayed rows beside the first ones, so the stream drops
rows whose key it has seen before it counts. The keys are kept for as long as
the watermark admits rows of their time; a row that comes later than that is
late and dropped anyway, so a replay never counts, however late it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEEK_OFFSET = "4 days"


def stream_trend(scored: DataFrame, grain: str = "day", dim: str = "emotion",
                 watermark: str = "1 day", ts: str = "timestamp", key: str | None = "combined_id") -> DataFrame:
    """Plays per window, feed and ``dim``, each ``key`` counted once (``key=None``
    counts every row). Rows later than the watermark
    are dropped (the late-data policy); append mode emits a window once it
    is closed.

    ``window`` aligns days on the UTC epoch, so the instant is first shifted
    by the session zone's offset: windows are then calendar days of the
    session zone, like the batch trend, whatever the zone.
    """
    zone = scored.sparkSession.conf.get("spark.sql.session.timeZone")
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    # No other columns: the rows are shuffled to drop the keys seen before.
    src = scored.select("topic", dim, *([key] if key else []), local.alias("_local")).withWatermark("_local", watermark)
    if key:
        src = src.dropDuplicatesWithinWatermark([key])
    if grain == "day":
        win = F.window("_local", "1 day")
    elif grain == "week":
        win = F.window("_local", "7 days", "7 days", WEEK_OFFSET)
    else:
        raise ValueError("streaming grain is day or week; roll months up from days")
    agg = src.groupBy(win.alias("w"), "topic", dim).agg(F.count(F.lit(1)).alias("plays"))
    # Window starts are midnights of the shifted clock: their UTC date is
    # the local date (epoch arithmetic, independent of the session zone).
    period = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w")["start"]) / 86400).cast("int"))
    return agg.select(period.alias("period"), "topic", dim, "plays")


def month_rollup(days: DataFrame, dim: str = "emotion") -> DataFrame:
    """Months from day counts (batch or ``foreachBatch``)."""
    return (days.groupBy(F.trunc("period", "month").alias("period"), "topic", dim)
                .agg(F.sum("plays").cast("long").alias("plays")))
