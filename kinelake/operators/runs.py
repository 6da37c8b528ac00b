"""Runs over whole videos: from frames to labelled samples and files, and what is said about a run afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.operators import dataset, features, frames
from kinelake.sources import writers


def default_times(rows: DataFrame, fps: float = frames.FPS) -> DataFrame:
    """Frames without times get ``frame_idx / fps``."""
    return rows.withColumn("ts", F.coalesce("ts", F.col("frame_idx") / fps) if "ts" in rows.columns else F.col("frame_idx") / fps)


def process_rounds(poses: DataFrame, intervals: DataFrame, n: int = frames.SAMPLE_FRAMES) -> DataFrame:
    """``video, start_frame, start_time, end_time, features, label, relationship`` of all samples of all videos.

    Frames (``video, frame_idx, p`` and, where known, ``ts``) without a person are taken out and the rest counted anew, so
    that samples are of consecutive kept frames; ``start_frame`` counts kept frames. One exchange by video but for the labels.
    """
    kept = default_times(poses).where(~_empty(F.col("p")))
    kept = kept.withColumn("frame_idx", F.row_number().over(frames.by_video()) - 1)
    vectors = features.features_139(kept, n)
    w = frames.by_video()
    times = kept.select("video", F.col("frame_idx").alias("start_frame"), F.col("ts").alias("start_time"), F.lead("ts", n - 1).over(w).alias("end_time")).where("end_time is not null")
    return frames.interval_label(times, intervals).join(vectors, ["video", "start_frame"])


def _empty(p: Column) -> Column:
    from kinelake.functions.geometry import no_person

    return no_person(p)


def write_rounds(samples: DataFrame, poses: DataFrame, folder: str, preview: int = 25) -> None:
    """The files of a run below a folder: ``features`` (CSV by video), ``tensor``, ``details``, ``preview`` and its ``report``."""
    rows = samples.withColumnRenamed("relationship", "fall_relationship")
    writers.features_csv(rows, f"{folder}/features", ["video"])
    per_frame = features.features_121(default_times(poses).where(~_empty(F.col("p"))).withColumn("frame_idx", F.row_number().over(frames.by_video()) - 1))
    x = per_frame.groupBy("video", "start_frame").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "features"))), lambda s: s["features"]).alias("X"))
    numbered = dataset.sample_details(samples.withColumn("num_frames", F.lit(frames.SAMPLE_FRAMES)), ["start_frame"])
    writers.details_csv(numbered, f"{folder}/details")
    labelled = x.join(samples.select("video", "start_frame", F.col("label").alias("y")), ["video", "start_frame"])
    writers.tensor(labelled.withColumn("sample_idx", F.col("start_frame").cast("long")), f"{folder}/tensor", ["video"])
    keyed = samples.withColumn("key", F.concat_ws("/", "video", F.col("start_frame").cast("string")))
    chosen = dataset.balanced(keyed, "label", "key", preview).drop("key")
    writers.json_lines(chosen, f"{folder}/preview")
    writers.texts(writers.report_lines(chosen), f"{folder}/report")


def timing_sums(times: DataFrame, mode: str, seconds: str, base: str) -> DataFrame:
    """``mode, runs, total, mean, speedup`` (total of the mode ``base`` by that of each)."""
    sums = times.groupBy(F.col(mode).alias("mode")).agg(F.count(seconds).alias("runs"), F.sum(seconds).alias("total"), F.avg(seconds).alias("mean"))
    first = sums.where(F.col("mode") == base).select(F.col("total").alias("_base"))  # one row
    return sums.join(F.broadcast(first), how="left").select("mode", "runs", "total", "mean", F.try_divide("_base", "total").alias("speedup"))


def failed_names(results: DataFrame, key: str, failed: Column) -> DataFrame:
    return results.where(failed).select(key).distinct()


def merged_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """``part, n`` of each frame, and of all under the name ``all``."""
    sized = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, rows in parts.items()]
    out = sized[0]
    for s in sized[1:]:
        out = out.unionByName(s)
    return out.unionByName(out.agg(F.lit("all").alias("part"), F.sum("n").alias("n")))


def cache_counts(rows: DataFrame, cache: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Hits and misses of a cache (one row a key) for each group."""
    marked = rows.join(cache.select(*keys).withColumn("_hit", F.lit(True)), keys, "left")
    return marked.groupBy(*by).agg(F.count_if(F.col("_hit")).alias("hits"), F.count_if(F.col("_hit").isNull()).alias("misses"))


def fixed_rates(rows: DataFrame, value: str, dt: float) -> DataFrame:
    """``velocity`` and ``acceleration`` as differences over one fixed time step; null where frames before are missing."""
    w = frames.by_video()
    moved = rows.withColumn("velocity", (F.col(value) - F.lag(value).over(w)) / dt)
    return moved.withColumn("acceleration", (F.col("velocity") - F.lag("velocity").over(w)) / dt)


def rate_stats(rows: DataFrame, by: list[str], columns: tuple[str, ...] = ("velocity", "acceleration")) -> DataFrame:
    """Mean, population deviation, least and most of each column."""
    stats = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]
    return rows.groupBy(*by).agg(*stats)


def relative_timeline(rows: DataFrame) -> DataFrame:
    """``t, middle, until``: each frame's time, half way to the next, and the next; the last frame has none."""
    later = F.lead("ts").over(frames.by_video())
    first = F.min("ts").over(frames.by_video().rowsBetween(Window.unboundedPreceding, 0))
    spans = rows.select("video", "frame_idx", (F.col("ts") - first).alias("t"), (later - F.col("ts")).alias("dt")).where("dt is not null")
    return spans.select("video", "frame_idx", "t", (F.col("t") + F.col("dt") / 2).alias("middle"), (F.col("t") + F.col("dt")).alias("until"))


def lookup_annotations(videos: DataFrame, files: DataFrame) -> DataFrame:
    """``video, path`` (null: none): a video's annotation file among ``path`` relative to the annotations' folder.

    In this order: ``name/annotation.txt``, ``name.txt`` and ``name/annotation.txt`` at any depth; of several the first path.
    """
    parts = F.split("path", "/")
    whole = files.where(F.col("path").endswith("/annotation.txt")).select("path", F.get(parts, F.size(parts) - 2).alias("video"), F.when(F.size(parts) == 2, 0).otherwise(2).alias("priority"))
    flat = files.where((F.size(parts) == 1) & F.col("path").endswith(".txt")).select("path", F.regexp_replace("path", r"\.txt$", "").alias("video"), F.lit(1).alias("priority"))
    best = whole.unionByName(flat).groupBy("video").agg(F.min_by("path", F.struct("priority", "path")).alias("path"))
    return videos.join(best, "video", "left").select("video", "path")


def read_plans(rows: DataFrame, json: str = "json") -> DataFrame:
    """``n, first, last`` of plans, a list of times as JSON; null for a malformed one."""
    plan = F.from_json(json, "array<double>", {"mode": "PERMISSIVE"})
    keys = [c for c in rows.columns if c != json]
    size = F.when(plan.isNotNull(), F.size(plan))
    return rows.select(*keys, size.alias("n"), F.get(plan, F.lit(0)).alias("first"), F.get(plan, size - 1).alias("last"))
