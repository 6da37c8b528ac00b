"""Queries over frames: cleaning, windows, labels, plans, annotations, resuming."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinelake.functions.text import annotation_interval, extended_line, frame_of, hashed_choice, in_range, rate, seconds
from kinelake.operators import frames as O
from kinelake.operators import profiling, resume
from kinelake.plans.tables import ANNOTATIONS, FRAMES, INTERVALS, annotations, frames, intervals, query, read
from kinelake.sources.readers import timestamps

_CHOICE = "(('0x' || substr(md5(concat_ws('|', {})), 1, 8))::bigint % {})"
_WALK = " + ".join("250 + 50 * " + _CHOICE.format(f"video, frame_idx, {i}", 6) for i in range(1, 11))


def _windows(spark, sf_dir):
    """Eleven frames from each frame on, by their real times."""
    from pyspark.sql import Window

    w = Window.partitionBy("video").orderBy("frame_idx")
    f = frames(spark, sf_dir).select("video", F.col("frame_idx").alias("start_frame"), F.col("ts").alias("start_time"), F.lead("ts", 10).over(w).alias("end_time"))
    return f.where("end_time is not null")


@query(f"""with {FRAMES}, s as (select video, frame_idx as start_frame, ts as start_time, ts + ({_WALK}) / 1000.0::double as end_time, count(*) over w as n,
 bool_and(has_person) over w as ok, max(ts) over (partition by video) as last, list(event_type) over w as kinds, sum(value) over w as total from fr
 window w as (partition by video order by frame_idx rows between current row and 10 following))
 select video, start_frame, round(start_time, 6) as start_time, round(end_time, 6) as end_time, array_to_string(kinds, ',') as kinds from s where n = 11 and ok and end_time <= last""")
def sliding_samples(spark, sf_dir):
    s = O.sliding_samples(frames(spark, sf_dir), ["event_type"])
    return s.select("video", "start_frame", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"), F.array_join("event_type", ",").alias("kinds"))


@query(f"""with {FRAMES}, {INTERVALS}, s as (select * from (select video, frame_idx as start_frame, ts as start_time, lead(ts, 10) over (partition by video order by frame_idx) as end_time from fr) where end_time is not null),
 j as (select s.video, s.start_frame, iv.ord, iv.start_ms, iv.end_ms, iv.start_ms >= start_time * 1000 and iv.end_ms <= end_time * 1000 as inside from s join iv on s.video = iv.video and iv.start_ms <= end_time * 1000 and iv.end_ms >= start_time * 1000),
 g as (select video, start_frame, min(case when inside then ord end) as hit, max(ord) as met from j group by all)
 select s.video, s.start_frame, case when hit is not null then 1 else 0 end as label,
 case when hit is not null then 'fall_in_sample:' || round_even(a.start_ms, 0)::bigint || '-' || round_even(a.end_ms, 0)::bigint when met is not null then 'overlap:' || round_even(b.start_ms, 0)::bigint || '-' || round_even(b.end_ms, 0)::bigint else '' end as relationship
 from s left join g using (video, start_frame) left join iv a on a.video = s.video and a.ord = hit left join iv b on b.video = s.video and b.ord = met""")
def interval_label(spark, sf_dir):
    return O.interval_label(_windows(spark, sf_dir), intervals(spark, sf_dir), 86_400_000.0).select("video", "start_frame", "label", "relationship")


@query(f"with {FRAMES} select video, frame_idx from fr where has_person")
def person_filter(spark, sf_dir):
    return O.kept_frames(frames(spark, sf_dir)).select("video", "frame_idx")


_RUNS = f"{FRAMES}, runs as (select video, min(frame_idx) as start_frame, max(frame_idx) as end_frame, count(*) as n_frames from (select video, frame_idx, frame_idx - row_number() over (partition by video, has_person order by frame_idx) as g, has_person from fr) where not has_person group by video, g)"


@query(f"with {_RUNS} select * from runs")
def person_gaps(spark, sf_dir):
    return O.person_runs(frames(spark, sf_dir))


@query(f"with {_RUNS} select video, start_frame as gap_start, end_frame + 1 as gap_end from runs join (select video, max(frame_idx) as last from fr group by 1) using (video) where n_frames >= 2 and end_frame < last")
def gap_ge_threshold(spark, sf_dir):
    return O.gaps(frames(spark, sf_dir), 2)


@query(f"""with {_RUNS}, g as (select video, start_frame as gap_start, end_frame + 1 as gap_end from runs join (select video, max(frame_idx) as last from fr group by 1) using (video) where n_frames >= 2 and end_frame < last)
 select fr.video, fr.frame_idx, (select count(*) from g where g.video = fr.video and g.gap_start <= fr.frame_idx) as segment_id from fr
 where not exists (select 1 from g where g.video = fr.video and g.gap_start > 0 and fr.frame_idx >= g.gap_start and fr.frame_idx < g.gap_end)""")
def gap_segments(spark, sf_dir):
    return O.gap_segments(frames(spark, sf_dir), 2)


@query(f"""with {FRAMES}, b as (select video, frame_idx as bound from fr where event_type = 'purchase' and frame_idx > 0) select fr.video, fr.frame_idx, (select count(*) from b where b.video = fr.video and b.bound <= fr.frame_idx) as part from fr""")
def ordinal_split(spark, sf_dir):
    f = frames(spark, sf_dir)
    bounds = f.where("event_type = 'purchase'").select("video", F.col("frame_idx").alias("bound"), F.col("frame_idx").alias("ord"))
    return O.split_at(f.select("video", "frame_idx"), bounds).select("video", "frame_idx", "part")


_VEL = f"{FRAMES}, v as (select video, frame_idx, ts, case when ts - lag(ts) over w > 0 then (value - lag(value) over w) / (ts - lag(ts) over w) when lag(ts) over w is not null then 0.0 end as velocity from fr window w as (partition by video order by frame_idx))"


@query(f"with {_VEL} select video, frame_idx, round(velocity, 6) as velocity from v where velocity is not null")
def velocity(spark, sf_dir):
    return frames(spark, sf_dir).select("video", "frame_idx", F.round(O.velocity("value"), 6).alias("velocity")).where("velocity is not null")


@query(f"with {_VEL}, a as (select video, frame_idx, (velocity - lag(velocity) over w) / case when ts - lag(ts, 2) over w > 0 then (ts - lag(ts, 2) over w) / 2 else 1.0 end as acceleration from v window w as (partition by video order by frame_idx)) select video, frame_idx, round(acceleration, 6) as acceleration from a where acceleration is not null")
def acceleration(spark, sf_dir):
    v = frames(spark, sf_dir).withColumn("velocity", O.velocity("value"))
    return v.select("video", "frame_idx", F.round(O.acceleration(), 6).alias("acceleration")).where("acceleration is not null")


@query(f"with {FRAMES}, d as (select video, abs(value - lag(value) over (partition by video order by frame_idx)) as d from fr) select video, round(max(d), 6) as max_diff, round(avg(d), 6) as mean_diff from d group by 1")
def abs_diff_stats(spark, sf_dir):
    d = frames(spark, sf_dir).withColumn("d", F.abs(F.col("value") - F.lag("value").over(O.by_video())))
    return d.groupBy("video").agg(F.round(F.max("d"), 6).alias("max_diff"), F.round(F.avg("d"), 6).alias("mean_diff"))


@query(f"with {FRAMES} select fr.video, frame_idx as start_frame, ms as interval_ms, frame_idx + 10 * step as end_frame from fr join (select video, max(frame_idx) as last from fr group by 1) using (video), (values (250, 5), (300, 6), (350, 7), (400, 8), (450, 9), (500, 10)) s(ms, step) where frame_idx + 10 * step <= last")
def strided_samples(spark, sf_dir):
    f = frames(spark, sf_dir)
    return O.strided_samples(f)


def _spread(spark, sf_dir):
    """Disjoint intervals: every tenth frame begins one of three frames at 20 a second."""
    f = frames(spark, sf_dir).where("frame_idx % 10 = 4")
    return f.select("video", (F.col("frame_idx") * 50.0).alias("start_ms"), (F.col("frame_idx") * 50.0 + 100).alias("end_ms"))


_SPREAD = f"{FRAMES}, sp as (select video, frame_idx * 50.0 as start_ms, frame_idx * 50.0 + 100 as end_ms, frame_idx as s, frame_idx + 2 as e from fr where frame_idx % 10 = 4)"


@query(f"""with {_SPREAD}, o as (select *, coalesce(lag(e) over (partition by video order by s) + 1, 0) as before from sp), t as (select video, count(*) as n from fr group by 1), m as (select video, max(e) as e from sp group by 1)
 select video, before as "first", s - 1 as "last" from o where s - 1 >= before union all select video, s, e from o union all select t.video, coalesce(m.e + 1, 0), n - 1 from t left join m using (video) where n - 1 >= coalesce(m.e + 1, 0)""")
def timeline_split(spark, sf_dir):
    totals = frames(spark, sf_dir).groupBy("video").agg(F.count("*").alias("n"))
    return O.timeline_split(_spread(spark, sf_dir), totals)


@query(f"with {FRAMES}, {INTERVALS} select video, ord, trunc(start_ms / 1000 * 20)::bigint as start_frame, trunc(end_ms / 1000 * 20)::bigint as end_frame from iv")
def frame_intervals(spark, sf_dir):
    return intervals(spark, sf_dir).select("video", "ord", F.floor(F.col("start_ms") / 1000 * 20).alias("start_frame"), F.floor(F.col("end_ms") / 1000 * 20).alias("end_frame"))


@query(f"with {FRAMES}, {INTERVALS} select video, count(*) filter (start_ms >= 0 and end_ms <= 864000000) as inside from iv group by 1")
def intervals_in_range(spark, sf_dir):
    lists = intervals(spark, sf_dir).groupBy("video").agg(F.collect_list(F.struct("start_ms", "end_ms")).alias("i"))
    return lists.select("video", F.size(in_range(F.col("i"), F.lit(0.0), F.lit(864000000.0))).cast("long").alias("inside"))


@query(f"with {ANNOTATIONS} select video, line_no, start_ms, end_ms from ap where start_ms is not null")
def annotation_parse(spark, sf_dir):
    a = annotations(spark, sf_dir).withColumn("i", annotation_interval(F.col("line"))).where("i is not null")
    return a.select("video", "line_no", "i.start_ms", "i.end_ms")


@query(f"""with {ANNOTATIONS} select video, line_no, case when line_no % 7 = 0 then line_no || ';' || floor_v || '-' || (floor_v + 2 + {_CHOICE.format("line_no, 0", 6)}) else line end as line from ap""")
def annotation_extend(spark, sf_dir):
    a = annotations(spark, sf_dir)
    return a.select("video", "line_no", extended_line(F.col("line"), hashed_choice(6, F.col("line_no"), F.lit(0)).cast("double")).alias("line"))


@query(f"""with {ANNOTATIONS} select u.video, case when n is null then 'missing' when d then 'discard' when n > 0 then 'normal' else 'empty' end as state from (select distinct user_id as video from events) u
 left join (select video, bool_or(lower(trim(line)) = 'discard') as d, count(start_ms) as n from ap group by 1) using (video)""")
def annotation_state(spark, sf_dir):
    a = annotations(spark, sf_dir).withColumn("start_ms", annotation_interval(F.col("line"))["start_ms"])
    videos = read(spark, sf_dir, "events").select(F.col("user_id").alias("video")).distinct()
    return resume.annotation_state(videos, a)


@query(f"""with {FRAMES} select video, frame_idx, round(case when m > 1000 then t / 1000 else t end, 6) as ts from (select video, frame_idx, t, max(t) over (partition by video) as m from (select video, frame_idx, frame_idx * case when video % 2 = 0 then 0.5 else 250.0 end::double as t from fr))""")
def timestamp_autoscale(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("t", F.col("frame_idx") * F.when(F.col("video") % 2 == 0, 0.5).otherwise(250.0))
    lists = f.groupBy("video").agg(F.transform(F.sort_array(F.collect_list(F.struct("frame_idx", "t"))), lambda x: x["t"]).alias("ts"))
    json = F.when(F.col("video") % 3 == 0, F.to_json(F.struct(F.col("ts").alias("timestamps")))).otherwise(F.to_json("ts"))
    return timestamps(lists.select("video", json.alias("json"))).select("video", "frame_idx", F.round("ts", 6).alias("ts"))


_PLAN = "pl as (select video, round_idx, ord, sum(case when ord = 0 then 0 else 250 + 50 * " + _CHOICE.format("video, round_idx, ord", 6) + " end) over (partition by video, round_idx order by ord) as ts_ms from (select *, unnest(range(0, ceil(duration_ms / 250.0)::bigint)) as ord from (select user_id as video, count(*) * 50 as duration_ms from events group by 1), range(1, 7) r(round_idx)) qualify ts_ms < duration_ms)"


@query(f"with {_PLAN} select video, round_idx, ord, ts_ms::bigint as ts_ms from pl")
def round_plan(spark, sf_dir):
    """A video is as long as its frames at 20 a second."""
    videos = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("video")).agg((F.count("*") * int(1000 / O.FPS)).alias("duration_ms"))
    return O.round_plan(videos)


@query(f"with {_PLAN} select video, round_idx, ord, (lead(ts_ms) over w - ts_ms)::bigint as delta_ms from pl window w as (partition by video, round_idx order by ord) qualify lead(ts_ms) over w is not null")
def plan_deltas(spark, sf_dir):
    return O.plan_deltas(round_plan(spark, sf_dir)).select("video", "round_idx", "ord", "delta_ms")


@query("select event_id, case when event_id % 3 = 0 then round((event_id % 90 + 10) / 4.0, 6) when event_id % 3 = 1 then 20.0 else 20.0 end::double as fps from events")
def frame_rate(spark, sf_dir):
    n = F.col("event_id")
    text = F.when(n % 3 == 0, F.format_string("%d/4", n % 90 + 10)).when(n % 3 == 1, F.lit("30/0")).otherwise(F.lit("unknown"))
    return read(spark, sf_dir, "events").select("event_id", F.round(rate(text), 6).alias("fps"))


@query("select event_id, (row_number() over (order by event_id) - 1) // (select ceil(count(*) / 7.0)::bigint from events) as worker from events")
def worker_split(spark, sf_dir):
    return resume.worker_split(read(spark, sf_dir, "events").select("event_id"), "event_id", 7).select("event_id", F.col("worker").cast("long").alias("worker"))


@query("select event_id, user_id from events order by event_id limit 25 offset 100")
def offset_limit(spark, sf_dir):
    return resume.page(read(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 100, 25)


def _files(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("v"), "event_id").alias("path"), F.floor("value").cast("long").alias("size"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("mtime"), "event_id", "event_type")


_FILES = "f as (select 'v' || event_id as path, floor(value)::bigint as size, (epoch_us(ts) // 1000000)::bigint as mtime, event_id, event_type from events), b as (select path, case when event_id % 3 = 0 then size + 1 else size end as size, mtime from f), c as (select path, mtime + 600 as until from f where event_type = 'error'), d as (select path from f where event_id % 5 = 0), k as (select max(mtime) as clock from f)"


def _before(f):
    return f.select("path", F.when(F.col("event_id") % 3 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), "mtime")


@query(f"with {_FILES} select path from f where path not in (select path from d)")
def resume_anti(spark, sf_dir):
    f = _files(spark, sf_dir)
    return resume.pending(f, f.where("event_id % 5 = 0"), "path").select("path")


@query(f"with {_FILES} select f.path from f join b using (path) where f.size = b.size and f.mtime = b.mtime")
def stable_semi(spark, sf_dir):
    f = _files(spark, sf_dir)
    return resume.stable(f, _before(f)).select("path")


@query(f"with {_FILES} select path from f where path not in (select path from c, k where until > clock - 86400)")
def cooldown(spark, sf_dir):
    f = _files(spark, sf_dir)
    clock = f.agg(F.max("mtime").alias("clock"))
    cooling = f.where("event_type = 'error'").select("path", (F.col("mtime") + 600).alias("until")).crossJoin(F.broadcast(clock))
    return resume.cooled(f, cooling, F.col("clock") - 86400).select("path")


@query(f"with {_FILES} select f.path from f join b using (path), k where f.size = b.size and f.mtime = b.mtime and clock - f.mtime >= 3600 and f.path not in (select path from d) and f.path not in (select path from c, k where until > clock)")
def ready_files(spark, sf_dir):
    f = _files(spark, sf_dir)
    clock = F.broadcast(f.agg(F.max("mtime").alias("clock")))
    aged = f.crossJoin(clock).where(F.col("clock") - F.col("mtime") >= 3600)
    cooling = f.where("event_type = 'error'").select("path", (F.col("mtime") + 600).alias("until")).crossJoin(clock)
    return resume.pending(resume.cooled(resume.stable(aged, _before(f)), cooling, F.col("clock")), f.where("event_id % 5 = 0"), "path").select("path")


@query(f"with {FRAMES} select a.video, a.frame_idx, a.event_type, round(b.ts, 6) as ts from fr a join (select * from fr qualify 2 * frame_idx < count(*) over (partition by video)) b using (video, frame_idx)")
def positional_join(spark, sf_dir):
    """The list of times has the first half of each video's frames."""
    from pyspark.sql import Window

    f = frames(spark, sf_dir).withColumn("n", F.count("*").over(Window.partitionBy("video")))
    return resume.paired(f.select("video", "frame_idx", "event_type"), f.where("2 * frame_idx < n").select("video", "frame_idx", F.round("ts", 6).alias("ts")), ["video", "frame_idx"])


@query(f"with {FRAMES} select video, frame_idx from fr where not (frame_idx % 4 = 0)")
def cache_misses(spark, sf_dir):
    f = frames(spark, sf_dir).select("video", "frame_idx")
    return resume.cache_misses(f, f.where("frame_idx % 4 = 0"), ["video", "frame_idx"])


@query(f"with {FRAMES} select video, count(*) as n, count(*) = 60 as complete from fr group by 1")
def completeness(spark, sf_dir):
    return resume.incomplete(frames(spark, sf_dir), 60, "video")


@query("select event_type as reason, count(*) as n, array_to_string((list(event_id order by event_id))[1:5], ',') as examples from events group by 1")
def skip_reasons(spark, sf_dir):
    return profiling.reasons(read(spark, sf_dir, "events").select(F.col("event_type").alias("reason"), "event_id"), "reason", "event_id")


@query("select time_bucket(interval '60 minutes', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def events_tumbling(spark, sf_dir):
    """Batch twin of the streaming aggregation."""
    from kinelake.streaming.watch import tumbling

    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return tumbling(e).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""select user_id, min(ts) as session_start, count(*) as n from (select *, sum(new) over (partition by user_id order by ts, event_id) as g from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval '30 minutes' then 0 else 1 end as new from events)) group by user_id, g""")
def events_session(spark, sf_dir):
    from kinelake.streaming.watch import sessions

    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e).select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")
