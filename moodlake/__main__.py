"""Command line: run the streams the way the original application runs its
Spark script (spark-submit / python -m moodlake ...).

  score    R1: frames (Kafka or JSON-lines files) → scored records in the keyed sink
  trend    R5: scored records (read as a stream) → daily or weekly trend table
  compact  K1: resolve keys once, store documents partitioned by feed and day

Paths default to folders below the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="moodlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("score", help="run the scoring stream (R1)")
    s.add_argument("--kafka-servers", help="bootstrap servers; without it --frames is read")
    s.add_argument("--topic", default="data")
    s.add_argument("--frames", help="folder of JSON-lines frames {value, timestamp}")
    s.add_argument("--sink", help="keyed sink folder")
    s.add_argument("--checkpoint", help="stream checkpoint folder")
    s.add_argument("--lexicon", help="parquet lexicon (lang, word, valence_milli, emotion)")
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    t = sub.add_parser("trend", help="run the trend stream (R5)")
    t.add_argument("--scored", required=True, help="keyed sink folder written by 'score'")
    t.add_argument("--out", required=True)
    t.add_argument("--checkpoint")
    t.add_argument("--grain", choices=["day", "week"], default="day")
    t.add_argument("--watermark", default="1 day")
    t.add_argument("--available-now", action="store_true")
    c = sub.add_parser("compact", help="compact the keyed sink (K1)")
    c.add_argument("--scored", required=True)
    c.add_argument("--out", required=True)
    p.add_argument("--master", help="Spark master (default: the launcher's)")
    p.add_argument("--scale", action="store_true", help="use the large-cluster settings")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from moodlake.session import get_session, sub_dir
    spark = get_session(args.master, scale=args.scale)

    if args.cmd == "score":
        from moodlake.operators.lexicon import load_lexicon
        from moodlake.sources.frames import read_frames
        from moodlake.streaming.scoring import run_scoring
        if args.kafka_servers:
            frames = read_frames(spark, "kafka", **{"kafka.bootstrap.servers": args.kafka_servers,
                                                    "subscribe": args.topic})
        elif args.frames:
            frames = read_frames(spark, "files", path=args.frames)
        else:
            print("score needs --kafka-servers or --frames", file=sys.stderr)
            return 2
        lexicon = load_lexicon(spark, args.lexicon) if args.lexicon else None
        q = run_scoring(frames, args.sink or sub_dir(spark, "scored"),
                        args.checkpoint or sub_dir(spark, "streams", "scoring"),
                        lexicon=lexicon, available_now=args.available_now, query_name="moodlake-scoring")
        q.awaitTermination()
    elif args.cmd == "trend":
        from moodlake.streaming.scoring import run_name
        from moodlake.streaming.sinks import batch_path, read_stored
        from moodlake.streaming.trend import stream_trend
        schema = read_stored(spark, args.scored).schema
        trend = stream_trend(spark.readStream.schema(schema).parquet(args.scored), args.grain,
                             watermark=args.watermark)
        out, checkpoint = args.out, args.checkpoint or sub_dir(spark, "streams", f"trend-{args.grain}")
        run = run_name(checkpoint)
        w = (trend.writeStream.outputMode("append")
             # Each batch overwrites its own folder: a retried batch replaces itself.
             # A run is its checkpoint, so a fresh one leaves older runs whole.
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(batch_path(out, run, i)))
             .option("checkpointLocation", checkpoint))
        if args.available_now:
            w = w.trigger(availableNow=True)
        w.start().awaitTermination()
    elif args.cmd == "compact":
        from moodlake.streaming.sinks import compact_keyed
        compact_keyed(spark, args.scored, args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
