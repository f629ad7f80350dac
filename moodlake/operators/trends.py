"""Dashboard roll-ups (A1-A4) and top-N buckets (L4).

Each roll-up takes scored plays and an optional ``weight`` column: when the
input is already pre-aggregated (one row per song and feed with a play
count), the roll-up sums the weight instead of counting rows, so the big
play table is shuffled only once, in partial-aggregate form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month")


def _n(weight: str | None) -> Column:
    if weight is None:
        return F.count(F.lit(1)).alias("plays")
    return F.sum(weight).cast("long").alias("plays")


def counts_by(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(_n(weight))


def mood_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """A1: plays per feed and emotion."""
    return counts_by(df, ["topic", "emotion"], weight)


def category_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Plays per feed and sentiment category."""
    return counts_by(df, ["topic", "sentiment_category"], weight)


def genre_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """A2: plays per feed and genre."""
    return counts_by(df, ["topic", "genre"], weight)


def artist_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """A3: plays per feed and artist."""
    return counts_by(df, ["topic", "artist"], weight)


def period_start(ts: Column, grain: str) -> Column:
    """Start date of the day, ISO week (Monday) or month of ``ts``.
    Works on dates, so the result does not depend on the session zone."""
    d = F.to_date(ts)
    if grain == "day":
        return d
    if grain == "week":
        return F.date_sub(d, F.pmod(F.dayofweek(d) + 5, F.lit(7)))
    if grain == "month":
        return F.trunc(d, "month")
    raise ValueError(f"grain must be one of {GRAINS}")


def taste_trend(df: DataFrame, grain: str, dim: str = "emotion", ts: str = "timestamp",
                weight: str | None = None, bucket: str | None = None) -> DataFrame:
    """A4: plays per period, feed and ``dim``. ``bucket`` names an existing
    day column when the input is pre-aggregated by day."""
    src = F.col(bucket) if bucket else F.col(ts)
    return (df.withColumn("period", period_start(src, grain))
              .groupBy("period", "topic", dim).agg(_n(weight)))


def top_n(df: DataFrame, by: str, n: int, partition: str | None = "topic",
          count_col: str = "plays") -> DataFrame:
    """L4: the ``n`` largest buckets (count desc, then key asc), per
    partition when given. Adds ``rank``."""
    order = [F.col(count_col).desc(), F.col(by).asc_nulls_last()]
    if partition is None:
        # Top-k then merge (TakeOrderedAndProject): n rows per task at most.
        top = df.orderBy(*order).limit(n)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    # rank <= n lets Catalyst insert a partial group limit before the shuffle.
    w = Window.partitionBy(partition).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)
