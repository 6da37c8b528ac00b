"""Watching a folder: a file source, a gate for files still being written, retries after a pause, exactly-once sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

POLL_SECONDS, STABLE_SECONDS, COOLDOWN_SECONDS = 30, 60, 60


def watched(spark: SparkSession, folder: str, schema, fmt: str = "parquet", most: int = 0) -> DataFrame:
    """New files below a folder; ``most`` limits how many a poll takes (0: no limit)."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", most) if most else reader).format(fmt).load(folder)


def settled(files: DataFrame, clock=None, stable_seconds: int = STABLE_SECONDS) -> DataFrame:
    """Of ``binaryFile`` rows, those that nobody has written to for some time."""
    now = clock if clock is not None else F.unix_seconds(F.current_timestamp())
    return files.where(now - F.unix_seconds("modificationTime") >= stable_seconds)


def unchanged(spark: SparkSession, files: DataFrame, snapshot: str, clock: int, stable_seconds: int = STABLE_SECONDS) -> DataFrame:
    """Files (``path, size, mtime``) that are as the last poll saw them and old enough; ``snapshot`` is then this poll's.

    The snapshot is a small table of names in a shared folder, with one version a poll (``clock``, seconds, which rises).
    """
    versions = spark.read.schema("path string, size long, mtime long, poll long").parquet(snapshot) if _exists(spark, snapshot) else None
    files.select("path", "size", "mtime", F.lit(clock).cast("long").alias("poll")).write.mode("append").parquet(snapshot)
    if versions is None:
        return files.limit(0)
    before = versions.where(F.col("poll") < clock)
    last = before.agg(F.max("poll").alias("poll"))
    seen = before.join(F.broadcast(last), "poll", "left_semi")
    return files.join(seen.select("path", "size", "mtime"), ["path", "size", "mtime"], "left_semi").where(F.lit(clock) - F.col("mtime") >= stable_seconds)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def ingest(rows: DataFrame, out: str, checkpoint: str, key: list[str], once: bool = True) -> StreamingQuery:
    """Appends each key once: a batch that comes again overwrites its own folder, and keys of other batches are left out.

    ``once``: all there is, then ends; else a poll every ``POLL_SECONDS``.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        fresh = batch.dropDuplicates(key)
        if epoch and _exists(batch.sparkSession, out):
            schema = fresh.select(key).schema.add("batch", "long")
            done = batch.sparkSession.read.schema(schema).parquet(out).where(F.col("batch") < epoch)
            fresh = fresh.join(done.select(key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{POLL_SECONDS} seconds")).start()


def run_until_idle(query: StreamingQuery, idle_seconds: float, step: float = 1.0) -> None:
    """Stops a polling query once it has taken nothing for some time."""
    last, quiet = None, 0.0
    while query.isActive and quiet < idle_seconds:
        query.awaitTermination(max(1, round(step)))
        now = next((p["batchId"] for p in reversed(query.recentProgress) if p["numInputRows"]), None)
        quiet, last = (quiet + step, last) if now == last else (0.0, now)
    query.stop()


def tumbling(events: DataFrame, minutes: int = 60, late: str = "10 minutes") -> DataFrame:
    """Counts by type and event-time window; also runs on a bounded frame."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), "n")


def retry_after(failures: DataFrame, cooldown: int = COOLDOWN_SECONDS) -> DataFrame:
    """``path, until`` of the last failure of each path."""
    return failures.groupBy("path").agg((F.max("failed_at") + cooldown).alias("until"))
