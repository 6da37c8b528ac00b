"""Ordered frames: cleaning, gaps, windows, differences, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions.text import frame_of, hashed_choice, rounded_text

INTERVAL_CHOICES_MS = (250, 300, 350, 400, 450, 500)
SAMPLE_FRAMES, GAP_THRESHOLD, FPS = 11, 20, 20.0


def by_video(video: str = "video", frame: str = "frame_idx"):
    return Window.partitionBy(video).orderBy(frame)


def kept_frames(frames: DataFrame) -> DataFrame:
    """Frames with a person; a missing flag is none."""
    return frames.where(F.coalesce("has_person", F.lit(False)))


def person_runs(frames: DataFrame) -> DataFrame:
    """``video, start_frame, end_frame, n_frames`` of maximal runs of frames without a person."""
    away = frames.select("video", "frame_idx", (~F.coalesce("has_person", F.lit(False))).alias("away"))
    island = F.col("frame_idx") - F.row_number().over(Window.partitionBy("video", "away").orderBy("frame_idx"))
    return away.withColumn("island", island).where("away").groupBy("video", "island").agg(F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame"), F.count("*").alias("n_frames")).drop("island")


def gaps(frames: DataFrame, threshold: int = GAP_THRESHOLD) -> DataFrame:
    """Half-open runs of ``threshold`` frames or more; one that reaches the last frame is never closed and isn't given."""
    last = frames.groupBy("video").agg(F.max("frame_idx").alias("last"))
    found = person_runs(frames).where(F.col("n_frames") >= threshold).join(last, "video").where("end_frame < last")
    return found.select("video", F.col("start_frame").alias("gap_start"), (F.col("end_frame") + 1).alias("gap_end"))


def gap_segments(frames: DataFrame, threshold: int = GAP_THRESHOLD) -> DataFrame:
    """Frames outside gaps with ``segment_id``: how many gaps end before them. A gap that begins at 0 isn't cut out."""
    edges = gaps(frames, threshold)
    marked = (
        frames.join(edges.select("video", F.col("gap_start").alias("frame_idx"), F.col("gap_end")), ["video", "frame_idx"], "left")
        .withColumn("until", F.max(F.when(F.col("frame_idx") > 0, F.col("gap_end"))).over(by_video().rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("segment_id", F.count("gap_end").over(by_video().rowsBetween(Window.unboundedPreceding, 0)))
    )
    return marked.where(F.col("until").isNull() | (F.col("frame_idx") >= F.col("until"))).select("video", "frame_idx", "segment_id")


def split_at(frames: DataFrame, bounds: DataFrame) -> DataFrame:
    """``part`` of each frame by ordinals ``bound``: those that don't rise above all before them are skipped."""
    rising = bounds.withColumn("top", F.max("bound").over(Window.partitionBy("video").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)))
    rising = rising.where("bound > coalesce(top, 0)").select("video", F.col("bound").alias("frame_idx"), F.lit(1).alias("cut"))
    return frames.join(rising, ["video", "frame_idx"], "left").withColumn("part", F.count("cut").over(by_video().rowsBetween(Window.unboundedPreceding, 0)))


def walk_ms(n: int, *key: Column) -> Column:
    """Sum of n hashed steps."""
    total = F.lit(0).cast("long")
    for i in range(1, n):
        total = total + 250 + 50 * hashed_choice(len(INTERVAL_CHOICES_MS), *key, F.lit(i))
    return total


def sliding_samples(frames: DataFrame, carry: list[str], n: int = SAMPLE_FRAMES) -> DataFrame:
    """Windows of n consecutive frames with ``start_time, end_time`` of a synthetic walk and arrays of the carried columns.

    Windows that are cut off, hold a frame without a person, or end after the last frame are left out.
    """
    ahead = by_video().rowsBetween(0, n - 1)
    rows = frames.select(
        "video",
        F.col("frame_idx").alias("start_frame"),
        F.col("ts").alias("start_time"),
        F.count("*").over(ahead).alias("n"),
        F.min(F.coalesce("has_person", F.lit(False))).over(ahead).alias("all_seen"),
        F.max("ts").over(Window.partitionBy("video")).alias("last"),
        *[F.collect_list(c).over(ahead).alias(c) for c in carry],
    ).where((F.col("n") == n) & F.col("all_seen"))
    timed = rows.withColumn("end_time", F.col("start_time") + walk_ms(n, F.col("video"), F.col("start_frame")) / 1000)
    return timed.where("end_time <= last").select("video", "start_frame", "start_time", "end_time", *carry)


def strided_samples(frames: DataFrame, steps_ms=INTERVAL_CHOICES_MS, fps: float = FPS, n: int = SAMPLE_FRAMES) -> DataFrame:
    """Per step width, every frame from which n frames at that width fit into the video."""
    last = frames.groupBy("video").agg(F.max("frame_idx").alias("last"))
    steps = F.explode(F.array(*[F.struct(F.lit(ms).alias("interval_ms"), F.lit(int(ms / 1000 * fps)).alias("step")) for ms in steps_ms])).alias("s")
    wide = frames.select("video", F.col("frame_idx").alias("start_frame"), steps).join(last, "video")
    fits = wide.where(F.col("start_frame") + (n - 1) * F.col("s.step") <= F.col("last"))
    return fits.select("video", "start_frame", "s.interval_ms", (F.col("start_frame") + (n - 1) * F.col("s.step")).alias("end_frame"))


def timeline_split(intervals: DataFrame, totals: DataFrame, fps: float = FPS) -> DataFrame:
    """``video, first, last``: each interval a segment of its own, and what lies between, before and after."""
    w = Window.partitionBy("video").orderBy("start_ms", "end_ms")
    framed = intervals.select("video", frame_of(F.col("start_ms"), fps).alias("s"), frame_of(F.col("end_ms"), fps).alias("e"), F.row_number().over(w).alias("k"))
    order = Window.partitionBy("video").orderBy("k")
    both = framed.withColumn("before", F.coalesce(F.lag("e").over(order) + 1, F.lit(0)))
    inner = both.select("video", F.explode(F.array(F.struct(F.col("before").alias("first"), (F.col("s") - 1).alias("last"), F.lit(True).alias("gap")), F.struct(F.col("s").alias("first"), F.col("e").alias("last"), F.lit(False).alias("gap")))).alias("x")).select("video", "x.*")
    final = framed.groupBy("video").agg(F.max_by("e", "k").alias("e"))
    tail = totals.join(final, "video", "left").select("video", F.coalesce(F.col("e") + 1, F.lit(0)).alias("first"), (F.col("n") - 1).cast("int").alias("last")).where("last >= first")
    return inner.where("not gap or last >= first").select("video", "first", "last").unionByName(tail)


def interval_label(samples: DataFrame, intervals: DataFrame, bucket_ms: float = 60_000.0) -> DataFrame:
    """``label`` and ``relationship`` of each sample: the first interval inside it, else the last that meets it.

    Both sides are laid into buckets of time, so that the join is by video and bucket and a long video is many keys; a pair
    that meets in several buckets counts the same as once. Samples without intervals are kept.
    """
    buckets = lambda a, b: F.explode(F.sequence(F.floor(a / bucket_ms), F.greatest(F.floor(a / bucket_ms), F.floor(b / bucket_ms))))
    i = intervals.select("video", "ord", "start_ms", "end_ms", buckets(F.col("start_ms"), F.col("end_ms")).alias("_bucket"))
    cut = samples.select("video", "start_frame", "start_time", "end_time", buckets(F.col("start_time") * 1000, F.col("end_time") * 1000).alias("_bucket"))
    near = cut.join(i, ["video", "_bucket"]).where((F.col("start_ms") <= F.col("end_time") * 1000) & (F.col("end_ms") >= F.col("start_time") * 1000))
    inside = (F.col("start_ms") >= F.col("start_time") * 1000) & (F.col("end_ms") <= F.col("end_time") * 1000)
    pair = F.concat(rounded_text(F.col("start_ms")), F.lit("-"), rounded_text(F.col("end_ms")))
    found = near.groupBy("video", "start_frame").agg(F.min_by(F.when(inside, pair), F.when(inside, F.col("ord"))).alias("hit"), F.max_by(pair, "ord").alias("met"))
    text = F.when(F.col("hit").isNotNull(), F.concat(F.lit("fall_in_sample:"), "hit")).otherwise(F.coalesce(F.concat(F.lit("overlap:"), "met"), F.lit("")))
    return samples.join(found, ["video", "start_frame"], "left").withColumns({"label": F.col("hit").isNotNull().cast("int"), "relationship": text}).drop("hit", "met")


def velocity(value: str, ts: str = "ts") -> Column:
    dt = F.col(ts) - F.lag(ts).over(by_video())
    return F.when(dt > 0, (F.col(value) - F.lag(value).over(by_video())) / dt).when(dt.isNotNull(), 0.0)


def acceleration(v: str = "velocity", ts: str = "ts") -> Column:
    w = by_video()
    total = F.col(ts) - F.lag(ts, 2).over(w)
    return (F.col(v) - F.lag(v).over(w)) / F.when(total > 0, total / 2).otherwise(1.0)


def round_plan(videos: DataFrame) -> DataFrame:
    """``video, round_idx, ord, ts_ms``: hashed steps in each round from 0 on, as long as they are below ``duration_ms``."""
    rounds = videos.where("duration_ms > 0").select("video", "duration_ms", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("round_idx"))
    most = F.ceil(F.col("duration_ms") / min(INTERVAL_CHOICES_MS)).cast("int")
    steps = rounds.select("*", F.explode(F.sequence(F.lit(0), most - 1)).alias("ord"))
    step = F.when(F.col("ord") == 0, 0).otherwise(250 + 50 * hashed_choice(6, F.col("video"), F.col("round_idx"), F.col("ord")))
    w = Window.partitionBy("video", "round_idx").orderBy("ord")
    timed = steps.withColumn("step", step).withColumn("ts_ms", F.sum("step").over(w))
    return timed.where("ts_ms < duration_ms").select("video", "round_idx", "ord", "ts_ms")


def plan_deltas(plan: DataFrame) -> DataFrame:
    w = Window.partitionBy("video", "round_idx").orderBy("ord")
    return plan.withColumn("delta_ms", F.bround((F.lead("ts_ms").over(w) / 1000 - F.col("ts_ms") / 1000) * 1000, 0).cast("long")).where("delta_ms is not null")
