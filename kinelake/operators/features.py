"""Feature vectors of samples: the 139 columns of a sample's last frame, the 121 of each frame, and the older layout.

A sample is the frame and the ten before it. Only the box over these eleven needs the window; earlier positions come by
``lag``, so no frames are collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions import geometry as G
from kinelake.operators.frames import SAMPLE_FRAMES, by_video


def framed(frames: DataFrame, n: int = SAMPLE_FRAMES) -> DataFrame:
    """``video, frame_idx, ts, p`` with the box of the sample that ends here, and the two frames before."""
    w = by_video()
    span = w.rowsBetween(-(n - 1), 0)
    seen = G.is_visible(F.col("p"))
    side = lambda f, a: f(F.filter(F.col("p"), lambda v, i: i % 2 == a))
    with_sides = frames.withColumns({"seen": seen, "lo_x": side(F.array_min, 0), "hi_x": side(F.array_max, 0), "lo_y": side(F.array_min, 1), "hi_y": side(F.array_max, 1)})
    only = lambda c: F.when(F.col("seen"), F.col(c))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    boxed = with_sides.withColumns(
        {
            "left": zero(F.min(only("lo_x")).over(span)),
            "right": zero(F.max(only("hi_x")).over(span)),
            "top": zero(F.min(only("lo_y")).over(span)),
            "bottom": zero(F.max(only("hi_y")).over(span)),
            "before": F.count("*").over(span),
            "p1": F.lag("p", 1).over(w),
            "p2": F.lag("p", 2).over(w),
            "t1": F.lag("ts", 1).over(w),
            "t2": F.lag("ts", 2).over(w),
        }
    )
    return boxed.withColumns({"width": F.col("right") - F.col("left"), "height": F.col("bottom") - F.col("top")})


def union_box(frames: DataFrame, n: int = SAMPLE_FRAMES) -> DataFrame:
    return framed(frames, n).where(F.col("before") == n).select("video", (F.col("frame_idx") - (n - 1)).alias("start_frame"), "left", "top", "right", "bottom", "width", "height")


def _norm(p: str, clip: bool) -> Column:
    return G.box_norm(F.col(p), F.col("left"), F.col("top"), F.col("width"), F.col("height"), clip)


def _rate(now: Column, past: Column, dt: Column) -> Column:
    return F.zip_with(now, past, lambda a, b: F.when(dt > 0, (a - b) / dt).otherwise(0.0))


def features_139(frames: DataFrame, n: int = SAMPLE_FRAMES) -> DataFrame:
    """``video, start_frame, features`` (139 doubles)."""
    rows = framed(frames, n).where(F.col("before") == n)
    rows = rows.withColumns({"n0": _norm("p", True), "n1": _norm("p1", True), "n2": _norm("p2", True), "dt": F.col("ts") - F.col("t1"), "dt1": F.col("t1") - F.col("t2")})
    rows = rows.withColumns({"v0": _rate(F.col("n0"), F.col("n1"), F.col("dt")), "v1": _rate(F.col("n1"), F.col("n2"), F.col("dt1"))})
    mean = F.when(F.col("dt") + F.col("dt1") > 0, (F.col("dt") + F.col("dt1")) / 2).otherwise(1.0)
    speedup = F.zip_with("v0", "v1", lambda a, b: (a - b) / mean)
    p = F.col("p")
    last = F.array(G.spine_leg_angle(p), G.hip_centre(p, 1) - G.hip_centre(F.col("p1"), 1), G.body_orientation(p))
    return rows.select("video", (F.col("frame_idx") - (n - 1)).alias("start_frame"), F.concat("n0", "v0", speedup, G.relative_positions(p), last).alias("features"))


def frame_shape(rows: DataFrame) -> DataFrame:
    """``w, h, ratio, area`` of each frame against the union box."""
    w = F.when(F.col("seen"), (F.col("hi_x") - F.col("lo_x")) / G.divisor(F.col("width"))).otherwise(0.0)
    h = F.when(F.col("seen"), (F.col("hi_y") - F.col("lo_y")) / G.divisor(F.col("height"))).otherwise(0.0)
    return rows.withColumns({"w": w, "h": h}).withColumns({"ratio": F.when(F.col("h") > 0, F.col("w") / F.col("h")).otherwise(0.0), "area": F.col("w") * F.col("h")})


def features_121(frames: DataFrame, n: int = SAMPLE_FRAMES) -> DataFrame:
    """``video, start_frame, k, features`` (121 doubles) of frames 1 .. n-1 of each sample; positions aren't clipped.

    All windows are by video, so rows are dealt and sorted once; a sample's frames come as a list from the window ahead.
    """
    w = by_video()
    each = F.struct("ts", "t1", "p", "p1", "seen", "lo_x", "hi_x", "lo_y", "hi_y")
    ends = [F.lead(c, n - 1).over(w).alias(c) for c in ("left", "top", "width", "height")]
    samples = framed(frames, n).select("video", F.col("frame_idx").alias("start_frame"), F.collect_list(each).over(w.rowsBetween(0, n - 1)).alias("fs"), *ends).where(F.size("fs") == n)
    later = F.slice("fs", 2, n - 1)
    side = lambda lo, hi, ext: F.transform(later, lambda f: F.when(f["seen"], (f[hi] - f[lo]) / G.divisor(F.col(ext))).otherwise(0.0))
    samples = samples.withColumns({"ws": side("lo_x", "hi_x", "width"), "hs": side("lo_y", "hi_y", "height")})
    samples = samples.withColumns({"ratios": F.zip_with("ws", "hs", lambda a, b: F.when(b > 0, a / b).otherwise(0.0)), "areas": F.zip_with("ws", "hs", lambda a, b: a * b)})
    shaped = samples.select("video", "start_frame", "left", "top", "width", "height", "ws", "hs", "ratios", "areas", F.posexplode(later).alias("k0", "f"))
    shaped = shaped.select("*", (F.col("k0") + 1).alias("k"), "f.ts", "f.t1", "f.p", "f.p1").drop("f", "k0")
    p = F.col("p")
    hip = lambda a, lo, ext: (G.hip_centre(p, a) - F.col(lo)) / G.divisor(F.col(ext))
    shaped = shaped.withColumn("norm", _norm("p", False))
    rel = G.by_axis(F.col("norm"), lambda v: v - hip(0, "left", "width"), lambda v: v - hip(1, "top", "height"))
    last = F.array(G.spine_leg_angle(p), G.hip_centre(p, 1) - G.hip_centre(F.col("p1"), 1), G.body_orientation(p))
    dts = F.array_repeat(F.col("ts") - F.col("t1"), n - 1)
    return shaped.select("video", "start_frame", "k", F.concat("norm", dts, "ws", "hs", "ratios", "areas", rel, last).alias("features"))


def features_legacy(frames: DataFrame, n: int = SAMPLE_FRAMES) -> DataFrame:
    """The older 139 columns: positions as shares of a 1920 x 1080 screen, no velocity or acceleration."""
    rows = framed(frames, n).where(F.col("before") == n)
    p = F.col("p")
    last = F.array(G.spine_leg_angle(p), G.hip_centre(p, 1) - G.hip_centre(F.col("p1"), 1), G.body_orientation(p))
    return rows.select("video", (F.col("frame_idx") - (n - 1)).alias("start_frame"), F.concat(G.screen_norm(p), F.array_repeat(F.lit(0.0), 68), G.relative_positions(p), last).alias("features"))


def minmax_norm(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``normed``, ``least``, ``most``: zeros where all values of a group are equal."""
    w = Window.partitionBy(*by)
    sized = rows.withColumns({"least": F.min(value).over(w), "most": F.max(value).over(w)})
    return sized.withColumn("normed", F.when(F.col("most") > F.col("least"), (F.col(value) - F.col("least")) / (F.col("most") - F.col("least"))).otherwise(0.0))


def unfolded(rows: DataFrame, keys: list[str], features: str = "features") -> DataFrame:
    """One row for each entry of a vector."""
    return rows.select(*keys, F.posexplode(features).alias("feature", "value"))


def wide(rows: DataFrame, keys: list[str], width: int, features: str = "features") -> DataFrame:
    """One column ``feat_i`` for each entry of a vector."""
    return rows.select(*keys, *[F.get(F.col(features), F.lit(i)).alias(f"feat_{i}") for i in range(width)])
