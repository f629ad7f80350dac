"""Streaming plans over the driver tables (R1-R5 end to end).

Each call starts a fresh run below the shared checkpoint folder, drives the
stream with ``availableNow`` (everything present, then stop) and returns
the stored result as a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.session import sub_dir
from moodlake.sources.frames import frames_from_tables, read_frames
from moodlake.streaming.scoring import frames_from_events, run_scoring, stream_events
from moodlake.streaming.sinks import compact_keyed, read_keyed, read_rows, read_stored
from moodlake.streaming.trend import month_rollup, stream_trend

FRAME_BATCHES = 3    # micro-batches that read the captured message log
BATCH_FILES = 8      # files of the log that one of them takes, one task each


def _run_dir(spark: SparkSession, name: str) -> str:
    return sub_dir(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def score_stream_to_sink(spark: SparkSession, sf_dir: str, spread: bool = False) -> str:
    """Run R1 over the events stream; return the sink path."""
    base = _run_dir(spark, "scoring")
    q = run_scoring(stream_events(spark, sf_dir), f"{base}/sink", f"{base}/checkpoint", available_now=True,
                    prepare=lambda events: frames_from_events(events, sf_dir, spread))
    q.awaitTermination()
    return f"{base}/sink"


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select("combined_id", "topic", "sentiment", "emotion", "sentiment_category",
                       F.md5("cleaned_lyrics").alias("cleaned_md5"))


_READ = ["topic", "sentiment", "emotion", "sentiment_category", "cleaned_lyrics"]


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + K1: the keyed documents the scoring stream stored."""
    return _documents(read_keyed(spark, score_stream_to_sink(spark, sf_dir), columns=_READ))


def captured_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The plays' frames as JSON-lines files, the message log's stand-in (S1); a song's plays share a
    file, side by side, so that the lyrics they repeat are compressed away."""
    frames = frames_from_tables(spark, sf_dir, FRAME_BATCHES * BATCH_FILES)
    frames.select(F.col("value").cast("string").alias("value"), "timestamp").write.json(path, compression="gzip")


def _score_log(spark: SparkSession, base: str, checkpoint: str, after_write=None) -> None:
    frames = read_frames(spark, "files", path=f"{base}/log", maxFilesPerTrigger=BATCH_FILES)
    run_scoring(frames, f"{base}/sink", f"{base}/{checkpoint}", available_now=True, after_write=after_write).awaitTermination()


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 + K1: the log is scored, compacted, scored again from the start on a
    fresh checkpoint and compacted again; every key is one document still."""
    base = _run_dir(spark, "replay")
    captured_log(spark, sf_dir, f"{base}/log")
    for checkpoint in ("first", "second"):
        _score_log(spark, base, checkpoint)
        docs = compact_keyed(spark, f"{base}/sink", f"{base}/compact")
    return _documents(docs)


class Crash(Exception):
    """The failure that ``stream_restart`` injects."""


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the query fails when its second batch is stored but not committed
    and is started again on the same checkpoint: that batch is stored once
    more in its own folder, the first one is not. All stored rows, unresolved."""
    base = _run_dir(spark, "restart")
    captured_log(spark, sf_dir, f"{base}/log")

    def fail(batch_id: int) -> None:
        if batch_id == 1:
            raise Crash("stored, not committed")

    try:
        _score_log(spark, base, "checkpoint", fail)
    except StreamingQueryException as e:
        if "stored, not committed" not in str(e):
            raise
    _score_log(spark, base, "checkpoint")
    return _documents(read_stored(spark, f"{base}/sink"))


def stream_trend_rows(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Emotion trend computed by a second stream that reads the scored
    records as they land. Complete mode, so open windows are included and the
    result equals the batch trend. Months are rolled up from the stream's days."""
    sink = score_stream_to_sink(spark, sf_dir, spread=grain == "month")
    base = _run_dir(spark, "trend")
    scored = spark.readStream.schema(read_rows(spark, sink).schema).parquet(sink)
    trend = stream_trend(scored, "week" if grain == "week" else "day")
    out = f"{base}/result"

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = month_rollup(batch) if grain == "month" else batch
        rows.write.mode("overwrite").parquet(out)

    q = (trend.writeStream.outputMode("complete").foreachBatch(each)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
