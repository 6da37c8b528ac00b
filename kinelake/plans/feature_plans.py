"""Queries over positions: boxes, geometry, feature vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinelake.functions import geometry as G
from kinelake.operators import features as V
from kinelake.operators.frames import by_video
from kinelake.plans.tables import ANGLE, ORIENTATION, POSES, poses, query


def _r(c):
    return F.round(c, 6)


def _long(rows, keys):
    return V.unfolded(rows, keys).withColumn("value", _r(F.col("value")) + 0.0)


_HIP = "((p[24] + p[26]) / 2 - (p1[24] + p1[26]) / 2)"
_X = "(case when i % 2 = 0 then {} else {} end)"
_NORM = _X.format("({0}[i + 1] - lft) / dw", "({0}[i + 1] - tp) / dh")
_CLIP = "greatest(0.0, least(1.0, " + _NORM + "))"
_REL = _X.format("p[i + 1] - (p[23] + p[25]) / 2", "p[i + 1] - (p[24] + p[26]) / 2")
_N0, _N1, _N2 = (_CLIP.format(x) for x in ("p", "p1", "p2"))
_V0 = f"(case when ts - t1 > 0 then ({_N0} - {_N1}) / (ts - t1) else 0.0 end)"
_V1 = f"(case when t1 - t2 > 0 then ({_N1} - {_N2}) / (t1 - t2) else 0.0 end)"


@query(f"with {POSES} select video, frame_idx - 10 as start_frame, round(lft, 6) as \"left\", round(tp, 6) as top, round(rgt, 6) as \"right\", round(btm, 6) as bottom, round(bw, 6) as width, round(bh, 6) as height from pb where before = 11")
def union_bbox(spark, sf_dir):
    b = V.union_box(poses(spark, sf_dir))
    return b.select("video", "start_frame", *[_r(F.col(c)).alias(c) for c in ("left", "top", "right", "bottom", "width", "height")])


@query(f"""with {POSES}, q as (select video, frame_idx, case when seen then (list_max(xs) - list_min(xs)) / dw else 0.0 end as w, case when seen then (list_max(ys) - list_min(ys)) / dh else 0.0 end as h from pb where before = 11)
 select video, frame_idx, round(w, 6) as w, round(h, 6) as h, round(case when h > 0 then w / h else 0.0 end, 6) as ratio, round(w * h, 6) as area from q""")
def bbox_wh_ratio_area(spark, sf_dir):
    rows = V.frame_shape(V.framed(poses(spark, sf_dir)).where("before = 11"))
    return rows.select("video", "frame_idx", *[_r(F.col(c)).alias(c) for c in ("w", "h", "ratio", "area")])


@query(f"with {POSES} select video, frame_idx, i::int as feature, round({_N0}, 6) + 0.0 as value from pb, range(0, 34) r(i) where before = 11")
def pos_norm(spark, sf_dir):
    rows = V.framed(poses(spark, sf_dir)).where("before = 11")
    return _long(rows.withColumn("features", V._norm("p", True)), ["video", "frame_idx"])


@query(f"with {POSES} select video, frame_idx, i::int as feature, round({_REL}, 6) + 0.0 as value from pf, range(0, 34) r(i)")
def rel_pos(spark, sf_dir):
    return _long(poses(spark, sf_dir).withColumn("features", G.relative_positions(F.col("p"))), ["video", "frame_idx"])


@query(f"with {POSES} select video, frame_idx, seen, list_sum(list_transform(xs, lambda v: case when v = 0 then 0 else 1 end)) = 0 as empty from pg")
def frame_visibility(spark, sf_dir):
    return poses(spark, sf_dir).select("video", "frame_idx", G.is_visible(F.col("p")).alias("seen"), G.no_person(F.col("p")).alias("empty"))


@query(f"with {POSES} select video, frame_idx, round({ANGLE}, 6) as angle from pf")
def spine_leg_angle(spark, sf_dir):
    return poses(spark, sf_dir).select("video", "frame_idx", _r(G.spine_leg_angle(F.col("p"))).alias("angle"))


@query(f"with {POSES} select video, frame_idx, round({ORIENTATION}, 6) as orientation from pf")
def body_orientation(spark, sf_dir):
    return poses(spark, sf_dir).select("video", "frame_idx", _r(G.body_orientation(F.col("p"))).alias("orientation"))


@query(f"with {POSES} select video, frame_idx, round({_HIP}, 6) + 0.0 as hip_delta from px where p1 is not null")
def hip_delta(spark, sf_dir):
    hip = G.hip_centre(F.col("p"), 1)
    rows = poses(spark, sf_dir).withColumn("hip", hip)
    return rows.select("video", "frame_idx", (_r(F.col("hip") - F.lag("hip").over(by_video())) + 0.0).alias("hip_delta")).where("hip_delta is not null")


@query(f"with {POSES}, m as (select *, min(p[1]) over (partition by video) as lo, max(p[1]) over (partition by video) as hi from pf) select video, frame_idx, round(case when hi > lo then (p[1] - lo) / (hi - lo) else 0.0 end, 6) as normed from m")
def minmax_norm(spark, sf_dir):
    rows = poses(spark, sf_dir).withColumn("v", F.col("p")[0])
    return V.minmax_norm(rows, "v", ["video"]).select("video", "frame_idx", _r(F.col("normed")).alias("normed"))


@query(f"""with {POSES}, b as (select * from pb where before = 11)
 select video, start_frame, feature, round(value, 6) + 0.0 as value from (
 select video, frame_idx - 10 as start_frame, i::int as feature, {_N0} as value from b, range(0, 34) r(i)
 union all select video, frame_idx - 10, (34 + i)::int, {_V0} from b, range(0, 34) r(i)
 union all select video, frame_idx - 10, (68 + i)::int, ({_V0} - {_V1}) / case when ts - t1 + (t1 - t2) > 0 then (ts - t1 + (t1 - t2)) / 2 else 1.0 end from b, range(0, 34) r(i)
 union all select video, frame_idx - 10, (102 + i)::int, {_REL} from b, range(0, 34) r(i)
 union all select video, frame_idx - 10, 136, {ANGLE} from b union all select video, frame_idx - 10, 137, {_HIP} from b union all select video, frame_idx - 10, 138, {ORIENTATION} from b)""")
def features_139(spark, sf_dir):
    return _long(V.features_139(poses(spark, sf_dir)), ["video", "start_frame"])


@query(f"""with {POSES}, e as (select video, frame_idx - 10 as start_frame, lft, tp, dw, dh from pb where before = 11),
 f as (select e.*, x.frame_idx - e.start_frame as k, x.p, x.p1, x.ts, x.t1, case when seen then (list_max(xs) - list_min(xs)) / e.dw else 0.0 end as w, case when seen then (list_max(ys) - list_min(ys)) / e.dh else 0.0 end as h
  from e join px x on x.video = e.video and x.frame_idx between e.start_frame and e.start_frame + 10),
 g as (select *, case when h > 0 then w / h else 0.0 end as q from f),
 s as (select a.video, a.start_frame, a.k, b.k as j, b.w, b.h, b.q from g a join g b using (video, start_frame) where a.k > 0 and b.k > 0)
 select video, start_frame, k, feature, round(value, 6) + 0.0 as value from (
 select video, start_frame, k, i::int as feature, {_NORM.format("p")} as value from g, range(0, 34) r(i)
 union all select video, start_frame, k, (34 + i)::int, ts - t1 from g, range(0, 10) r(i)
 union all select video, start_frame, k, (43 + j)::int, w from s union all select video, start_frame, k, (53 + j)::int, h from s union all select video, start_frame, k, (63 + j)::int, q from s union all select video, start_frame, k, (73 + j)::int, w * h from s
 union all select video, start_frame, k, (84 + i)::int, {_X.format("(p[i + 1] - lft) / dw - ((p[23] + p[25]) / 2 - lft) / dw", "(p[i + 1] - tp) / dh - ((p[24] + p[26]) / 2 - tp) / dh")} from g, range(0, 34) r(i)
 union all select video, start_frame, k, 118, {ANGLE} from g union all select video, start_frame, k, 119, {_HIP} from g union all select video, start_frame, k, 120, {ORIENTATION} from g) where k > 0""")
def features_121(spark, sf_dir):
    return _long(V.features_121(poses(spark, sf_dir)), ["video", "start_frame", "k"])


@query(f"""with {POSES}, b as (select * from pb where before = 11)
 select video, start_frame, feature, round(value, 6) + 0.0 as value from (
 select video, frame_idx - 10 as start_frame, i::int as feature, {_X.format("p[i + 1] / 1920.0", "p[i + 1] / 1080.0")}::double as value from b, range(0, 34) r(i)
 union all select video, frame_idx - 10, i::int, 0.0::double from b, range(34, 102) r(i)
 union all select video, frame_idx - 10, (102 + i)::int, {_REL} from b, range(0, 34) r(i)
 union all select video, frame_idx - 10, 136, {ANGLE} from b union all select video, frame_idx - 10, 137, {_HIP} from b union all select video, frame_idx - 10, 138, {ORIENTATION} from b)""")
def features_legacy(spark, sf_dir):
    return _long(V.features_legacy(poses(spark, sf_dir)), ["video", "start_frame"])
