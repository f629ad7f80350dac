"""K1: keyed, replay-safe store of scored records (and its reader).

A keyed document store overwrites a document whose id reappears. Plain
files cannot upsert, so every micro-batch is written to its own folder
``run=<run>/batch=<id>/topic=<feed>/day=<day>`` in overwrite mode: a batch that
is retried after a failure replaces its own output, and a new run (fresh
checkpoint) never touches an old one. Beside the data each batch leaves a
manifest of the (feed, day) partitions it touched.

Plays of one song share its text: a batch stores each distinct text (lyrics
and cleaned lyrics) once, in ``_texts/run=<run>/batch=<id>``, and its rows
hold the ``text_key``. The readers give the whole records: they join a row to
the texts of its own batch, so a batch that is stored again brings both.

Keys are resolved by the latest write: the winner of a repeated key is chosen over
narrow columns (write time, run, batch, place in the file), and whole rows
are fetched for winners only. ``compact_keyed`` does that for the partitions
that batches since the last compaction touched, and for no others; the key
holds the play time, so a document never moves to another day.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.session import held, remove, shuffles_removed, sub_dir

MANIFEST = "_manifest"       # hidden from readers of the data
DONE = "_compacted"
TEXTS = "_texts"
PARTITIONS = {"run": "string", "batch": "bigint", "topic": "string", "day": "date"}
STORE_COLUMNS = ["written_at", "run", "batch", "day"]
TEXT_COLUMNS = {"lyrics": "text", "cleaned_lyrics": "cleaned"}     # of a record, and of the stored texts


def batch_path(path: str, run: str, batch_id: int) -> str:
    return os.path.join(path, f"run={run}", f"batch={batch_id}")


def _manifest_path(path: str, run: str, batch_id: int) -> str:
    return os.path.join(path, MANIFEST, f"run={run}", f"batch={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)


def write_texts(texts: DataFrame, path: str, run: str, batch_id: int) -> DataFrame:
    """Store the texts of one micro-batch (``text_key, text, cleaned``, one row per key) before its rows,
    and read them back (idempotent per ``(run, batch_id)``)."""
    target = batch_path(os.path.join(path, TEXTS), run, batch_id)
    with shuffles_removed(texts.sparkSession):
        texts.write.mode("overwrite").option("compression", "zstd").parquet(target)
    return texts.sparkSession.read.schema(texts.schema).parquet(target)


def write_keyed_batch(df: DataFrame, path: str, run: str, batch_id: int, ts: str = "timestamp",
                      finish=lambda rows: rows, order: list[str] = []) -> None:
    """Write one micro-batch (its rows hold their texts, or keys of those that ``write_texts`` has
    stored) and its manifest (idempotent per ``(run, batch_id)``). Rows are dealt by feed and day, so a batch leaves few files;
    AQE splits the share of a hot feed. ``finish`` makes the records of the dealt rows: what it
    derives is not shuffled. Rows lie in ``order`` within a feed and day."""
    spark = df.sparkSession
    target = batch_path(path, run, batch_id)
    dealt = df.withColumn("day", F.to_date(F.col(ts))).hint("rebalance", F.col("topic"), F.col("day"))
    if order:
        dealt = dealt.sortWithinPartitions("topic", "day", *order)
    rows = finish(dealt).withColumn("written_at", F.current_timestamp()).withColumn("day", F.to_date(F.col(ts)))
    with shuffles_removed(spark):
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("topic", "day").parquet(target)
        # Counted from the files written: partition values and footers, no data.
        written = spark.read.schema(_typed(rows.schema)).parquet(target)
        (written.groupBy("topic", "day").agg(F.count(F.lit(1)).alias("n"))
                .write.mode("overwrite").parquet(_manifest_path(path, run, batch_id)))


def _typed(schema: T.StructType) -> T.StructType:
    """``schema`` with the partition columns in their own types (never inferred from folder names)."""
    return T.StructType([T.StructField(f.name, T._parse_datatype_string(PARTITIONS[f.name]))
                         if f.name in PARTITIONS else f for f in schema])


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every stored row as it lies in the files: texts by ``text_key`` (NULL where a row holds its own)."""
    schema = _typed(spark.read.parquet(path).schema)
    missing = [c for c in ("text_key", *TEXT_COLUMNS) if c not in schema.names]
    return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in missing] + schema.fields)).parquet(path)


def with_texts(rows: DataFrame, path: str, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Whole records (or their ``columns``) of stored rows, joined by ``keys`` to the texts stored below ``path``."""
    spark = rows.sparkSession
    columns = columns if columns is not None else [c for c in rows.columns if c != "text_key"]
    read = {c: t for c, t in TEXT_COLUMNS.items() if c in columns}
    if not read or not _exists(spark, os.path.join(path, TEXTS)):
        return rows.select(*columns)
    texts = read_texts(spark, path).select(*keys, *read.values())
    found = rows.withColumnsRenamed({c: f"_own_{c}" for c in read}).join(texts, keys, "left")
    return found.select(*[F.coalesce(read[c], f"_own_{c}").alias(c) if c in read else c for c in columns])


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text_key, text, cleaned, run, batch``; in a compacted store a key lies there once, of any batch."""
    return spark.read.schema("text_key string, text string, cleaned string, run string, batch bigint").parquet(
        os.path.join(path, TEXTS))


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """Every stored record, replays included, with ``written_at, run, batch, topic, day``."""
    return with_texts(read_rows(spark, path), path, ["run", "batch", "text_key"])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``run, batch, topic, day, n``: the partitions each batch touched."""
    return spark.read.schema("topic string, day date, n bigint, run string, batch bigint").parquet(
        os.path.join(path, MANIFEST))


def resolve(stored: DataFrame, work: str, key: str = "combined_id") -> DataFrame:
    """The winning row of each key: latest write, then later run, batch and
    place. The aggregate holds no text. It is stored below ``work`` for the keys that lie there more
    than once; the rows of all others have won, and are not shuffled where those are few."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    rows = stored.select("*", *place)
    latest = F.max(F.struct("written_at", "run", "batch", "_file", "_row")).alias("_w")
    again = rows.groupBy(key).agg(latest, F.count(F.lit(1)).alias("_n")).where("_n > 1")
    won = held(again.select(F.col(key).alias("_k"), F.col("_w._file").alias("_f"), F.col("_w._row").alias("_r")), work)
    found = rows.join(won, F.col(key).eqNullSafe(F.col("_k")), "left")
    first = F.col("_f").isNull() | ((F.col("_file") == F.col("_f")) & (F.col("_row") == F.col("_r")))
    return found.where(first).drop("_file", "_row", "_k", "_f", "_r")


def _work_dir(spark: SparkSession) -> str:
    return sub_dir(spark, "streams", f"winners-{uuid.uuid4().hex[:12]}")


def read_keyed(spark: SparkSession, path: str, key: str = "combined_id",
               columns: list[str] | None = None) -> DataFrame:
    """The stored documents: one row per key, the latest write wins.
    Only ``columns`` (all, if not given) are read besides the key."""
    stored = read_rows(spark, path)
    keep = columns if columns is not None else [c for c in stored.columns if c not in [*STORE_COLUMNS, "text_key"]]
    won = resolve(stored, _work_dir(spark), key)
    return with_texts(won, path, ["run", "batch", "text_key"], [key, *[c for c in keep if c != key]])


def _any_of(parts: list) -> Column:
    """Filter on partition values (NULL partitions included)."""
    cond = F.lit(False)
    for topic, day in parts:
        cond = cond | (F.col("topic").eqNullSafe(F.lit(topic)) & F.col("day").eqNullSafe(F.lit(day)))
    return cond


def touched_partitions(spark: SparkSession, path: str, out: str) -> tuple[list, DataFrame]:
    """(feed, day) pairs of the batches that no compaction into ``out`` has
    taken in yet, and those batches. The pairs are feeds x days, not rows."""
    manifest = read_manifest(spark, path)
    done_path = os.path.join(out, DONE)
    if _exists(spark, done_path):
        done = spark.read.schema("run string, batch bigint, files bigint").parquet(done_path)
        manifest = manifest.join(done, ["run", "batch"], "left_anti")
    pairs = [(r.topic, r.day) for r in manifest.select("topic", "day").distinct().collect()]
    return pairs, manifest.select("run", "batch").distinct()


def compact_keyed(spark: SparkSession, path: str, out: str, key: str = "combined_id") -> DataFrame:
    """Store the documents partitioned by feed and day, so that dashboard
    reads prune partitions instead of resolving keys on every read. Reads and
    rewrites (dynamic partition overwrite) the partitions touched since the
    last compaction into ``out`` alone; a compaction that failed is simply run again."""
    pairs, batches = touched_partitions(spark, path, out)
    if pairs:
        taken = batches.withColumn("files", F.lit(len(pairs)).cast("long")).collect()   # one row per batch
        work = _work_dir(spark)
        with shuffles_removed(spark):
            _compact_texts(spark, path, out, batches)
            docs = resolve(read_rows(spark, path).where(_any_of(pairs)), work, key)
            docs = docs.drop("written_at", "run", "batch")
            (docs.hint("rebalance", F.col("topic"), F.col("day"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
                 .partitionBy("topic", "day").parquet(out))
        remove(spark, work)
        spark.createDataFrame(taken, "run string, batch long, files long").coalesce(1).write.mode("append").parquet(
            os.path.join(out, DONE))
    return with_texts(read_rows(spark, out), out, ["text_key"])


def _compact_texts(spark: SparkSession, path: str, out: str, batches: DataFrame) -> None:
    """Add the texts of ``batches`` to those of the compacted store, each key once."""
    if not _exists(spark, os.path.join(path, TEXTS)):
        return
    texts = read_texts(spark, path).join(batches, ["run", "batch"], "left_semi").dropDuplicates(["text_key"])
    if _exists(spark, os.path.join(out, TEXTS)):
        texts = texts.join(read_texts(spark, out).select("text_key"), "text_key", "left_anti")
    texts.drop("run", "batch").write.mode("append").option("compression", "zstd").parquet(os.path.join(out, TEXTS))
