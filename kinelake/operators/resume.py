"""What is left to do: readiness, resuming, cooling down, completeness, dealing out to workers. All as joins of sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.operators import ranks


def worker_split(rows: DataFrame, order: str, workers: int) -> DataFrame:
    """Contiguous parts of ``ceil(n / workers)`` rows by a numeric column; the last workers may get none."""
    n = rows.agg(F.count("*").alias("_n"))
    placed = ranks.numbered(rows, [order], ranks.cut_points(rows, order, []), [], "_r")
    return placed.crossJoin(F.broadcast(n)).withColumn("worker", F.floor(F.col("_r") / F.ceil(F.col("_n") / workers))).drop("_r", "_n")


def page(rows: DataFrame, order: str, offset: int, most: int) -> DataFrame:
    """``most`` of 0: no limit."""
    out = rows.orderBy(order).offset(offset)
    return out.limit(most) if most else out


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def stable(now: DataFrame, before: DataFrame) -> DataFrame:
    """Files that haven't changed since the snapshot before."""
    return now.join(before, ["path", "size", "mtime"], "left_semi")


def cooled(rows: DataFrame, cooling: DataFrame, now: Column) -> DataFrame:
    return rows.join(cooling.where(F.col("until") > now), "path", "left_anti")


def ready(now: DataFrame, before: DataFrame, cooling: DataFrame, done: DataFrame, clock: Column, stable_seconds: float) -> DataFrame:
    """Old enough, unchanged, not cooling, not done."""
    aged = now.where(clock - F.col("mtime") >= stable_seconds)
    return pending(cooled(stable(aged, before), cooling, clock), done, "path")


def incomplete(counts: DataFrame, expected: int, key: str) -> DataFrame:
    return counts.groupBy(key).agg(F.count("*").alias("n"), (F.count("*") == expected).alias("complete"))


def paired(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """By ordinal; what the longer side has beyond the shorter is left out."""
    return left.join(right, keys)


def cache_misses(frames: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    return frames.join(cache.select(*keys), keys, "left_anti")


def annotation_state(videos: DataFrame, lines: DataFrame) -> DataFrame:
    """``missing`` without annotation, ``discard`` if a line says so, ``normal`` with intervals, else ``empty``. ``lines``: ``video, line, start_ms``."""
    seen = lines.groupBy("video").agg(F.max(F.lower(F.trim("line")) == "discard").alias("discard"), F.count("start_ms").alias("n"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("discard"), "discard").when(F.col("n") > 0, "normal").otherwise("empty")
    return videos.join(seen, "video", "left").select("video", state.alias("state"))
