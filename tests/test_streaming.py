"""Scoring stream: replay safety (R2, R3, K1), stream = batch."""

import json
import os

from pyspark.sql import functions as F

from moodlake.sources.frames import read_frames
from moodlake.streaming.scoring import run_scoring, score_frames
from moodlake.streaming.sinks import compact_keyed, read_keyed
from moodlake.streaming.trend import month_rollup, stream_trend

PLAYS = [
    ({"topic": "song_played", "name": "N1", "artist": "A", "lyrics": "love love", "genre": "en", "id": "1"},
     "2024-01-01T10:00:00.123"),
    ({"topic": "song_global_top", "name": "N2", "artist": "B", "lyrics": "Lyrics not found", "genre": "en",
      "id": "2"}, "2024-01-02T11:00:00"),
    ({"topic": "song_italy_top", "name": "N3", "artist": "C", "lyrics": "sad", "genre": None, "id": None},
     "2024-01-08T12:00:00"),
]


def write_frames(folder, rows, name):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for rec, ts in rows:
            f.write(json.dumps({"value": json.dumps(rec), "timestamp": ts}) + "\n")


def keyed(spark, sink):
    return sorted((r.combined_id, r.emotion, r.sentiment_category)
                  for r in read_keyed(spark, sink).collect())


def test_replay_is_idempotent(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS, "part-0.json")
    sink = os.path.join(tmp, "sink")
    frames = read_frames(spark, "files", path=src)
    run_scoring(frames, sink, os.path.join(tmp, "ck1"), available_now=True).awaitTermination()
    first = keyed(spark, sink)
    assert len(first) == 3
    # Same checkpoint again: nothing is re-read.
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck1"),
                available_now=True).awaitTermination()
    assert spark.read.parquet(sink).count() == 3
    # Fresh checkpoint: everything is replayed, keys collapse on read.
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck2"),
                available_now=True).awaitTermination()
    assert spark.read.parquet(sink).count() == 6
    assert keyed(spark, sink) == first
    # The NULL id keys by time alone.
    assert "2024-01-08T12:00:00.000Z" in [k for k, _, _ in first]


def test_new_files_are_picked_up(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS[:1], "a.json")
    sink, ck = os.path.join(tmp, "sink"), os.path.join(tmp, "ck")
    run_scoring(read_frames(spark, "files", path=src), sink, ck, available_now=True).awaitTermination()
    write_frames(src, PLAYS[1:], "b.json")
    run_scoring(read_frames(spark, "files", path=src), sink, ck, available_now=True).awaitTermination()
    assert len(keyed(spark, sink)) == 3


def test_stream_equals_batch(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS, "part-0.json")
    sink = os.path.join(tmp, "sink")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"),
                available_now=True).awaitTermination()
    batch_frames = spark.read.schema("value STRING, timestamp TIMESTAMP").json(src) \
        .select(F.col("value").cast("binary").alias("value"), "timestamp")
    batch = sorted((r.combined_id, r.emotion, r.sentiment_category, r.sentiment)
                   for r in score_frames(batch_frames).collect())
    stream = sorted((r.combined_id, r.emotion, r.sentiment_category, r.sentiment)
                    for r in read_keyed(spark, sink).collect())
    assert batch == stream
    cats = {c for _, _, c, _ in batch}
    assert "not applicable" in cats


def test_stream_trend_day_week_month(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS, "part-0.json")
    sink = os.path.join(tmp, "sink")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"),
                available_now=True).awaitTermination()
    schema = spark.read.parquet(sink).schema
    for grain in ("day", "week"):
        out = os.path.join(tmp, f"trend-{grain}")
        q = (stream_trend(spark.readStream.schema(schema).parquet(sink), grain)
             .writeStream.outputMode("complete")
             .foreachBatch(lambda b, i, out=out: b.write.mode("overwrite").parquet(out))
             .option("checkpointLocation", os.path.join(tmp, f"ck-{grain}"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    days = spark.read.parquet(os.path.join(tmp, "trend-day"))
    weeks = {(str(r.period), r.plays) for r in spark.read.parquet(os.path.join(tmp, "trend-week")).collect()}
    assert days.count() == 3
    assert ("2024-01-01", 1) in weeks and ("2024-01-08", 1) in weeks   # weeks start on Monday
    months = month_rollup(days).collect()
    assert sum(r.plays for r in months) == 3 and {str(r.period) for r in months} == {"2024-01-01"}


def test_same_frame_twice_is_one_document(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, [PLAYS[0], PLAYS[0]], "dup.json")
    sink = os.path.join(tmp, "sink")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"),
                available_now=True).awaitTermination()
    assert spark.read.parquet(sink).count() == 2
    assert len(keyed(spark, sink)) == 1


def test_compaction_partitions_by_feed_and_day(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS, "part-0.json")
    sink = os.path.join(tmp, "sink")
    for ck in ("ck1", "ck2"):   # a replay doubles the stored rows
        run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, ck),
                    available_now=True).awaitTermination()
    out = compact_keyed(spark, sink, os.path.join(tmp, "compact"))
    assert out.count() == 3
    one_day = spark.read.parquet(os.path.join(tmp, "compact")).filter("topic = 'song_played' AND day = '2024-01-01'")
    assert "PartitionFilters" in one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == 1


def test_late_rows_are_dropped_in_append_mode(spark, tmp):
    """R5 late-data policy: with a 1-day watermark, a row more than a day
    older than the newest event seen is dropped; append mode emits a day
    only once the watermark has passed it."""
    scored_dir = os.path.join(tmp, "scored")
    schema = "combined_id STRING, topic STRING, emotion STRING, timestamp TIMESTAMP"

    def land(rows, name):
        rows = [(f"{name}{i}", *r) for i, r in enumerate(rows)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(os.path.join(scored_dir, name))

    import datetime as dt
    d = dt.datetime
    land([("f", "joy", d(2024, 1, 1, 10)), ("f", "joy", d(2024, 1, 2, 10))], "b0")
    out = os.path.join(tmp, "days")
    trend = stream_trend(spark.readStream.schema(schema).parquet(os.path.join(scored_dir, "*")), "day")

    def run():
        q = (trend.writeStream.outputMode("append")
             .foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
             .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    # Newest event jumps to Jan 5: the watermark moves to Jan 4, closing Jan 1-3.
    land([("f", "joy", d(2024, 1, 5, 10))], "b1")
    run()
    # A row for Jan 2 now arrives late (older than the watermark): dropped.
    land([("f", "joy", d(2024, 1, 2, 11)), ("f", "joy", d(2024, 1, 6, 10))], "b2")
    run()
    got = {(str(r.period), r.plays) for r in spark.read.parquet(out).collect()}
    assert ("2024-01-01", 1) in got and ("2024-01-02", 1) in got
    assert ("2024-01-02", 2) not in got


def test_same_checkpoint_name_in_two_places_keeps_both_runs(spark, tmp):
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS, "part-0.json")
    sink = os.path.join(tmp, "sink")
    for parent in ("a", "b"):
        run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, parent, "checkpoint"),
                    available_now=True).awaitTermination()
    assert spark.read.parquet(sink).select("run").distinct().count() == 2
    assert spark.read.parquet(sink).count() == 6


def test_command_line_score_trend_compact(spark, tmp):
    from moodlake.__main__ import main
    src = os.path.join(tmp, "frames")
    write_frames(src, PLAYS, "part-0.json")
    sink, out, comp = (os.path.join(tmp, x) for x in ("sink", "trend", "compact"))
    assert main(["score", "--frames", src, "--sink", sink, "--checkpoint", os.path.join(tmp, "ck"),
                 "--available-now"]) == 0
    assert len(keyed(spark, sink)) == 3
    assert main(["trend", "--scored", sink, "--out", out, "--checkpoint", os.path.join(tmp, "ckt"),
                 "--available-now", "--watermark", "0 seconds"]) == 0
    assert main(["compact", "--scored", sink, "--out", comp]) == 0
    assert spark.read.parquet(comp).count() == 3


def run_trend(spark, sink, base, grain="day"):
    """The trend stream in append mode on its own checkpoint: closed windows so far."""
    from moodlake.streaming.sinks import read_stored
    out = os.path.join(base, "closed")
    trend = stream_trend(spark.readStream.schema(read_stored(spark, sink).schema).parquet(sink), grain)
    q = (trend.writeStream.outputMode("append")
         .foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted((str(r.period), r.topic, r.plays) for r in spark.read.parquet(out).collect())


def test_replayed_plays_do_not_count_twice(spark, tmp):
    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    late = [({**PLAYS[0][0], "id": "9"}, "2024-02-20T00:00:00")]     # closes all windows before it
    write_frames(src, PLAYS + [PLAYS[0]], "a.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck1"), available_now=True).awaitTermination()
    run_trend(spark, sink, os.path.join(tmp, "trend"))
    # A whole replay lands after the stream has read the first run, then the window-closing play.
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck2"), available_now=True).awaitTermination()
    run_trend(spark, sink, os.path.join(tmp, "trend"))
    write_frames(src, late, "b.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck2"), available_now=True).awaitTermination()
    got = run_trend(spark, sink, os.path.join(tmp, "trend"))
    assert got == [("2024-01-01", "song_played", 1), ("2024-01-02", "song_global_top", 1), ("2024-01-08", "song_italy_top", 1)]


def test_a_batch_reads_its_source_once(spark, tmp):
    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    write_frames(src, PLAYS, "a.json")
    q = run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [len(PLAYS)]


def test_crash_between_write_and_commit(spark, tmp):
    import pytest
    from pyspark.errors import StreamingQueryException
    src, sink, ck = (os.path.join(tmp, x) for x in ("frames", "sink", "ck"))
    for i, play in enumerate(PLAYS):
        write_frames(src, [play], f"{i}.json")
    stored = []

    def fail(batch_id):
        stored.append((batch_id, spark.read.parquet(sink).count()))
        if batch_id == 1:
            raise RuntimeError("power cut")

    def run(after):
        frames = read_frames(spark, "files", path=src, maxFilesPerTrigger=1)
        run_scoring(frames, sink, ck, available_now=True, after_write=after).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(fail)
    assert stored == [(0, 1), (1, 2)]            # the second batch was stored when it failed
    again = []
    run(again.append)
    assert again == [1, 2] and spark.read.parquet(sink).count() == 3 and len(keyed(spark, sink)) == 3


def test_compaction_touches_only_new_days(spark, tmp):
    from moodlake.streaming.sinks import touched_partitions
    src, sink, out = (os.path.join(tmp, x) for x in ("frames", "sink", "compact"))
    write_frames(src, PLAYS, "a.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    compact_keyed(spark, sink, out)
    assert touched_partitions(spark, sink, out)[0] == []

    def files():
        return {r.path: r.modificationTime for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.parquet").load(out + "/topic=*").select("path", "modificationTime").collect()}

    before = files()
    other = dict(PLAYS[0][0], lyrics="hate hate")
    write_frames(src, [(other, PLAYS[0][1])], "b.json")      # same key, written later: it wins
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    pairs, _ = touched_partitions(spark, sink, out)
    assert [(t, str(d)) for t, d in pairs] == [("song_played", "2024-01-01")]
    docs = compact_keyed(spark, sink, out)
    assert docs.count() == 3 and docs.filter("topic = 'song_played'").first().emotion == "anger"
    kept = {p for p, t in files().items() if before.get(p) == t}
    assert len(kept) == 2 and not any("song_played" in p for p in kept)


def test_the_winner_is_chosen_without_text(spark, tmp):
    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    write_frames(src, PLAYS, "a.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    plan = read_keyed(spark, sink)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Aggregate" in line:
            assert "lyrics" not in line


def stored_bytes(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names)


def test_a_text_is_stored_once_per_batch_however_often_it_is_played(spark, tmp):
    import random
    words = random.Random(5)
    lyrics = " ".join(f"w{words.randrange(10**9)}" for _ in range(5000)) + " love"
    plays = [({"topic": "song_played", "name": "N", "artist": "A", "lyrics": lyrics, "genre": "en", "id": "1"},
              f"2024-01-01T10:{i // 60:02d}:{i % 60:02d}") for i in range(120)]
    src, sink, out = (os.path.join(tmp, x) for x in ("frames", "sink", "compact"))
    for part in range(4):
        write_frames(src, plays[part::4], f"{part}.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    docs = compact_keyed(spark, sink, out)
    assert stored_bytes(sink) < 6 * len(lyrics) and stored_bytes(out) < 6 * len(lyrics)
    for rows in (read_keyed(spark, sink), docs):      # the readers give the whole records
        assert rows.count() == 120
        assert {(r.lyrics, r.cleaned_lyrics, r.emotion) for r in rows.collect()} == {(lyrics, lyrics, "joy")}


def test_rows_that_hold_their_own_texts_are_read(spark, tmp):
    """Records written whole (no ``texts``) beside a run that stores texts by key."""
    from moodlake.streaming.sinks import read_stored, write_keyed_batch
    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    write_frames(src, PLAYS[:1], "a.json")
    whole = spark.read.schema("value STRING, timestamp TIMESTAMP").json(src).select(F.col("value").cast("binary").alias("value"), "timestamp")
    write_keyed_batch(score_frames(whole), sink, "old", 0)
    write_frames(src, PLAYS[1:], "b.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    want = {(r["lyrics"], r["lyrics"].lower()) for r, _ in PLAYS}
    assert {(r.lyrics, r.cleaned_lyrics) for r in read_stored(spark, sink).collect()} == want
    assert {(r.lyrics, r.cleaned_lyrics) for r in compact_keyed(spark, sink, os.path.join(tmp, "compact")).collect()} == want


def test_the_captured_log_holds_every_frame(spark, tmp):
    from moodlake.plans.streams import captured_log
    from moodlake.sources.frames import frames_from_tables
    from tests.conftest import SF_SMALL
    captured_log(spark, SF_SMALL, os.path.join(tmp, "log"))
    log = spark.read.schema("value STRING, timestamp TIMESTAMP").json(os.path.join(tmp, "log"))
    want = frames_from_tables(spark, SF_SMALL).select(F.col("value").cast("string").alias("value"),
                                                             F.date_trunc("millisecond", "timestamp").alias("timestamp"))
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, want.collect()))
    assert stored_bytes(os.path.join(tmp, "log")) * 5 < sum(len(r.value) for r in want.collect())


def test_a_batch_leaves_no_shuffle_files(spark, tmp):
    import time
    env = spark._jvm.org.apache.spark.SparkEnv.get()

    def shuffle_files():
        found = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {os.path.basename(f) for f in found if "shuffle_" in f}

    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    write_frames(src, PLAYS, "a.json")
    before = shuffle_files()
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    until = time.time() + 20
    while (left := shuffle_files() - before) and time.time() < until:     # they go in the background
        time.sleep(0.2)
    assert not left
    assert read_keyed(spark, sink).count() == 3


def test_winners_are_stored_for_repeated_keys_alone(spark, tmp):
    from moodlake.streaming.sinks import read_rows, resolve
    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    write_frames(src, PLAYS, "a.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    assert resolve(read_rows(spark, sink), os.path.join(tmp, "w1")).count() == 3
    assert spark.read.parquet(os.path.join(tmp, "w1")).count() == 0
    other = dict(PLAYS[2][0], lyrics="hate hate")        # its id is null, and so is its key
    write_frames(src, [(other, PLAYS[2][1])], "b.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    docs = resolve(read_rows(spark, sink), os.path.join(tmp, "w2"))
    assert spark.read.parquet(os.path.join(tmp, "w2")).count() == 1
    assert docs.count() == 3 and [r.emotion for r in docs.filter("topic = 'song_italy_top'").collect()] == ["anger"]


def event_tables(spark, folder, texts):
    """``events`` and ``documents`` of two plays per text."""
    import pandas as pd
    docs = [(i, t, "en", "s") for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    n = 2 * len(texts)
    pd.DataFrame({"event_id": range(n), "ts": pd.to_datetime([f"2024-01-0{1 + i % 3} 10:00:0{i % 10}" for i in range(n)]).astype("datetime64[us]"),
                  "user_id": 1, "event_type": [["view", "signup", "buy", "error"][i % 4] for i in range(n)], "value": 1.0,
                  "props": "{}"}).to_parquet(f"{folder}/events.parquet", index=False)     # one file: the stream takes no folder


def test_the_join_of_events_leaves_no_shuffle_files_while_a_batch_lasts(spark, tmp, monkeypatch):
    import time
    from moodlake.plans import streams
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        return {os.path.basename(f) for f in found.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    event_tables(spark, tmp, ["love", "hate", "love love", "sad", "joy"])
    before, left, run = shuffle_files(), [], streams.run_scoring

    def stored(batch_id):                       # not committed yet, the batch lasts
        until = time.time() + 20
        while (now := shuffle_files() - before) and time.time() < until:
            time.sleep(0.2)
        left.append(now)

    monkeypatch.setattr(streams, "run_scoring", lambda *a, **k: run(*a, **k, after_write=stored))
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    try:
        sink = streams.score_stream_to_sink(spark, tmp)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert left == [set()] and read_keyed(spark, sink).count() == 10


def test_raw_texts_go_when_they_are_stored(spark, tmp, monkeypatch):
    import glob
    import random
    from moodlake.session import checkpoint_dir
    from moodlake.streaming import scoring
    words = random.Random(6)
    lyrics = " ".join(f"w{words.randrange(10**9)}" for _ in range(5000))
    plays = [({**PLAYS[0][0], "id": str(i), "lyrics": lyrics}, f"2024-01-01T10:00:0{i}") for i in range(5)]
    src, sink, seen, write = os.path.join(tmp, "frames"), os.path.join(tmp, "sink"), [], scoring.write_keyed_batch
    write_frames(src, plays, "a.json")
    work = checkpoint_dir(spark).removeprefix("file:") + "/streams/work-*"
    before = set(glob.glob(work))

    def watched(*a, **k):
        seen.append(sum(stored_bytes(f) for f in set(glob.glob(work)) - before))
        return write(*a, **k)

    monkeypatch.setattr(scoring, "write_keyed_batch", watched)
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    assert len(seen) == 1 and 0 < seen[0] < len(lyrics) / 2
    assert stored_bytes(sink) < 3 * len(lyrics)          # five songs of one text
    assert {(r.lyrics, r.cleaned_lyrics) for r in read_keyed(spark, sink).collect()} == {(lyrics, lyrics)}


def test_null_texts_and_texts_of_two_songs_equal_the_batch(spark, tmp):
    play = PLAYS[0][0]
    plays = PLAYS + [({**play, "id": "5"}, "2024-01-03T10:00:00"), ({**play, "id": "6", "lyrics": None}, "2024-01-03T10:00:01"),
                     ({**play, "id": "7", "lyrics": ""}, "2024-01-03T10:00:02"), ({**play, "id": None, "lyrics": None}, "2024-01-03T10:00:03")]
    src, sink = os.path.join(tmp, "frames"), os.path.join(tmp, "sink")
    write_frames(src, plays, "a.json")
    run_scoring(read_frames(spark, "files", path=src), sink, os.path.join(tmp, "ck"), available_now=True).awaitTermination()
    frames = spark.read.schema("value STRING, timestamp TIMESTAMP").json(src).select(F.col("value").cast("binary").alias("value"), "timestamp")
    columns = ["combined_id", "lyrics", "cleaned_lyrics", "sentiment", "emotion", "sentiment_category", "compound"]

    def rows(df):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

    assert rows(read_keyed(spark, sink)) == rows(score_frames(frames)) and len(rows(score_frames(frames))) == 7
