"""Message-log frames and JSON-lines ingest.

``read_frames`` is the streaming source: ``value BINARY, timestamp``. On a
cluster it is the Kafka source; where the connector is not on the class
path, a directory of JSON-lines files stands in with the same two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions.envelope import play_envelope
from moodlake.sources.tables import plays


def read_frames(spark: SparkSession, source: str = "kafka", **opts) -> DataFrame:
    """``value`` (bytes) and ``timestamp`` (log time) as a stream.

    ``source="kafka"`` needs ``kafka.bootstrap.servers`` and ``subscribe``
    (no starting offset is set, so a new query starts at the latest one).
    ``source="files"`` reads JSON-lines frames from ``path`` — records
    ``{"value": <text>, "timestamp": <time>}``, new files picked up per batch.
    """
    if source == "kafka":
        df = spark.readStream.format("kafka").options(**opts).load()
        return df.select("value", "timestamp")
    path = opts.pop("path")
    df = (spark.readStream.schema("value STRING, timestamp TIMESTAMP")
          .option("maxFilesPerTrigger", opts.pop("maxFilesPerTrigger", 1000))
          .options(**opts).json(path))
    return df.select(F.col("value").cast("binary").alias("value"), "timestamp")


def read_json_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One JSON object per line, as text in ``message`` (parse with
    ``unwrap_message``)."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path).select(F.col("value").alias("message"))


def frames_from_tables(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Batch frames built from the plays (in ``parts``, see there): envelope JSON as bytes and the
    play time as the log timestamp (``play_id, value, timestamp``)."""
    p = plays(spark, sf_dir, parts)
    env = play_envelope(p, value_only=False)
    return env.select("play_id", F.col("value").cast("binary").alias("value"),
                      F.col("timestamp").cast("timestamp").alias("timestamp"))
