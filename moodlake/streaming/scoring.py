"""The scoring stream.

``frames → decode → parse envelope → clean → score (lexicon join) →
category → ISO time → key → keyed sink``. Scoring needs a join with an
aggregate of the same batch, which a streaming plan cannot express
directly, so the batch scorer runs inside ``foreachBatch`` on each
micro-batch. Recovery is the checkpoint: a restart on the same checkpoint
re-reads nothing already committed, and a retried batch overwrites its own
output folder (K1).
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodlake.functions import envelope as env
from moodlake.functions import text as tx
from moodlake.functions.text import SENTINEL_LYRICS, clean_text
from moodlake.operators.scoring import score_plays, score_texts, song_key
from moodlake.session import held, remove, sub_dir
from moodlake.streaming.sinks import write_keyed_batch, write_texts

# Output columns of a scored record (13 of the reference + compound).
SCORED_COLUMNS = ["id", "name", "lyrics", "artist", "topic", "genre", "timestamp",
                  "cleaned_lyrics", "sentiment", "emotion", "sentiment_category",
                  "iso_timestamp", "combined_id", "compound"]


def parse_frames(frames: DataFrame) -> DataFrame:
    """Frames (``value, timestamp``) → envelope fields and time."""
    return env.parse_envelope(env.decode_frames(frames))


def score_frames(frames: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Batch form of R1: frames (``value, timestamp``) → scored records."""
    return score_parsed(parse_frames(frames), lexicon)


def _records(scored: DataFrame) -> DataFrame:
    """The columns of a scored record, of which a narrow one holds no text but ``text_key``."""
    iso = tx.iso_timestamp("timestamp")
    made = {"sentiment": F.coalesce(F.col("sentiment"), F.lit("0.0")),
            "sentiment_category": tx.sentiment_category("lyrics", F.coalesce(F.col("compound"), F.lit(0.0))),
            "iso_timestamp": iso, "combined_id": tx.combined_id("id", iso),
            "compound": F.coalesce(F.col("compound"), F.lit(0.0))}
    narrow = "text_key" in scored.columns
    texts = ["lyrics", "cleaned_lyrics"] if narrow else []
    return scored.select(*[made[c].alias(c) if c in made else c for c in SCORED_COLUMNS if c not in texts],
                         *(["text_key"] if narrow else []))


def score_parsed(parsed: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Scored records of parsed frames."""
    return _records(score_plays(parsed, lexicon=lexicon, lyrics="lyrics", song_id="id"))


def split_songs(parsed: DataFrame) -> DataFrame:
    """Distinct rows ``_song, play, lyrics`` and their count ``n``: a play without its lyrics, or
    (``play`` NULL, ``_text``) a text, whose ``_song`` names no id. One pass over the frames, and as both are
    grouped before the shuffle, a task sends a text once however often it is played and by how many
    ids. ``_song`` has the id and, as bytes, the hash of the text; it is not repeated in ``play``."""
    rest = [c for c in parsed.columns if c not in ("lyrics", "id")]
    song = song_key().withField("h", F.unhex(F.md5("lyrics")))
    both = parsed.withColumn("_song", song).withColumn("_text", F.explode(F.array(F.lit(False), F.lit(True))))
    return (both.select("_text", F.when(F.col("_text"), F.col("_song").withField("id", F.lit(None).cast("string")))
                        .otherwise(F.col("_song")).alias("_song"),
                        F.when(~F.col("_text"), F.struct(*rest)).alias("play"),
                        F.when(F.col("_text"), F.col("lyrics")).alias("lyrics"))
                .groupBy("_text", "_song", "play", "lyrics").agg(F.count(F.lit(1)).alias("n")))


def text_key() -> Column:
    return F.lower(F.hex(F.col("_song")["h"])).alias("text_key")


def split_texts(split: DataFrame) -> DataFrame:
    """The texts of ``split_songs`` rows, one per ``text_key``: ``text_key, text, cleaned``."""
    return split.where("_text and _song.h is not null").select(
        text_key(), F.col("lyrics").alias("text"), clean_text("lyrics").alias("cleaned"))


def score_stored(texts: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Scores of ``split_texts`` rows by the hash ``_h``; of the lyrics only the sentinel is kept."""
    scores = score_texts(texts, ["text_key"], "cleaned", lang=None, lexicon=lexicon, cleaned="cleaned",
                         negation=True, contrast=True, intensity=True)
    missing = F.when(F.col("text_key") == F.md5(F.lit(SENTINEL_LYRICS).cast("binary")), F.lit(SENTINEL_LYRICS))
    return scores.select(F.unhex("text_key").alias("_h"), missing.alias("lyrics"), "compound", "sentiment", "emotion")


def score_split(split: DataFrame, scores: DataFrame) -> DataFrame:
    """Scored plays of ``split_songs`` rows, of which ``split_records`` makes the records. Plays without
    a text meet no score. Both sides get their own shuffle, as in ``join_songs``."""
    once = F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))
    plays = split.where("not _text").select("_song", "play.*", once.alias("_n")).drop("_n")
    return plays.join(scores, F.col("_song")["h"] == F.col("_h"), "left").drop("_h")


def split_records(scored: DataFrame) -> DataFrame:
    """Records with ``text_key`` for their text, of the plays of ``score_split``."""
    return _records(scored.select("*", F.col("_song")["id"].alias("id"), text_key()))


def run_name(checkpoint: str) -> str:
    """One run per checkpoint: the name carries a hash of the full path, so
    two checkpoints with the same folder name never share output folders."""
    digest = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    return f"{os.path.basename(checkpoint.rstrip('/')) or 'run'}-{digest}"


def run_scoring(frames: DataFrame, sink_path: str, checkpoint: str,
                lexicon: DataFrame | None = None, available_now: bool = False,
                query_name: str | None = None, after_write=None, prepare=lambda batch: batch) -> StreamingQuery:
    """Start the scoring stream (R1). ``available_now`` (R4) processes what
    is there and stops — the daily harvest run; otherwise the default
    micro-batch trigger keeps it running. ``after_write(batch_id)`` is called when a
    batch is stored and not yet committed; an error there stops the query
    like a crash between the two, and a restart stores that batch again.
    ``prepare`` makes frames of a batch that holds something else; joins belong there and not in the
    streaming plan, whose shuffle files stay as long as the batch lasts.

    A batch is used several times (texts, their scores, the join back), so its plays without
    their lyrics and its texts are kept for the batch, in files below the shared checkpoint
    folder: the source is read once, what is kept, shuffled and stored holds a text once, not
    per play, and the shuffle files of each step go before the next one. The texts are scored as
    the store holds them, and their raw form goes when they are stored."""
    run = run_name(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        work = sub_dir(spark, "streams", f"work-{uuid.uuid4().hex[:12]}")
        at = os.path.join(work, "split")
        try:
            split = held(split_songs(parse_frames(prepare(batch))), at, partition="_text")
            texts = write_texts(split_texts(split), sink_path, run, batch_id)
            remove(spark, os.path.join(at, "_text=true"))
            scores = held(score_stored(texts, lexicon), os.path.join(work, "scores"))
            write_keyed_batch(score_split(split, scores), sink_path, run, batch_id, finish=split_records,
                              order=["_song", "timestamp"])
        finally:
            remove(spark, work)
        if after_write:
            after_write(batch_id)

    w = (frames.writeStream.foreachBatch(each).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_events(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """The events parquet of the driver tables, read as a file stream."""
    from moodlake.sources.tables import table
    schema = table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", max_files).parquet(sf_dir))


def frames_from_events(ev: DataFrame, sf_dir: str, spread: bool = False) -> DataFrame:
    """Frames of (a batch of) events: each becomes a play envelope by a join
    with the songs. ``spread`` deals the times over months."""
    from moodlake.sources.tables import feed_of, music_genre, spread_time, table
    docs = table(ev.sparkSession, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    n_docs = docs.count()
    time = spread_time(F.col("ts"), F.col("event_id")) if spread else F.col("ts")
    keyed = ev.select("event_id", time.alias("ts"), "event_type",
                      F.pmod(F.col("event_id"), F.lit(n_docs)).alias("doc_id"))
    p = keyed.join(docs, "doc_id")
    rec = F.to_json(F.struct(
        feed_of(F.col("event_type")).alias("topic"),
        F.concat(F.lit("song "), F.col("doc_id").cast("string")).alias("name"),
        F.col("source").alias("artist"),
        F.when(F.col("event_type") == "error", F.lit(SENTINEL_LYRICS)).otherwise(F.col("text")).alias("lyrics"),
        music_genre(F.col("doc_id")).alias("genre"), F.col("doc_id").cast("string").alias("id")))
    return p.select(rec.cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))
