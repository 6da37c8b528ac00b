"""Queries over whole runs: samples with features and labels, run statistics, lookups, watching a folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kinelake.operators import retrieval, runs
from kinelake.plans import document_plans, feature_plans  # noqa: F401  (its SQL is a part of one here)
from kinelake.plans.tables import FRAMES, ORACLES, POSES, frames, poses, query, read

_SAMPLES = f"""samples as (select * from (select video, frame_idx as start_frame, ts as start_time, lead(ts, 10) over (partition by video order by frame_idx) as end_time from pf) where end_time is not null),
 marks as (select video, frame_idx as ord, ts * 1000 as start_ms, (ts + 0.3) * 1000 as end_ms from pf where frame_idx % 7 = 3),
 met as (select s.video, s.start_frame, max((start_ms >= start_time * 1000 and end_ms <= end_time * 1000)::int) as label from samples s join marks m on m.video = s.video and start_ms <= end_time * 1000 and end_ms >= start_time * 1000 group by all)"""


@query(f"""with f as ({ORACLES['features_139']}), v as (select video, start_frame, sum(round(value * 1e6)::bigint)::bigint as total, count(*) as width from f group by all), {POSES}, {_SAMPLES}
 select s.video, s.start_frame, round(start_time, 6) as start_time, round(end_time, 6) as end_time, coalesce(label, 0)::int as label, total, width from samples s left join met using (video, start_frame) join v using (video, start_frame)""")
def round_features(spark, sf_dir):
    """All samples of all videos from positions, times and marks to labelled vectors, here as their sums in millionths (whole numbers: their order can't change them)."""
    p = poses(spark, sf_dir)
    marks = p.where("frame_idx % 7 = 3").select("video", F.col("frame_idx").alias("ord"), (F.col("ts") * 1000).alias("start_ms"), ((F.col("ts") + 0.3) * 1000).alias("end_ms"))
    rows = runs.process_rounds(p.select("video", "frame_idx", "p", "ts"), marks)
    total = F.aggregate(F.transform("features", lambda v: F.round(F.round(v, 6) * 1e6).cast("long")), F.lit(0).cast("long"), lambda a, v: a + v)
    return rows.select("video", "start_frame", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"), "label", total.alias("total"), F.size("features").cast("long").alias("width"))


@query(f"with {FRAMES} select video, frame_idx, round(frame_idx / 20.0, 6)::double as ts from fr")
def default_timestamps(spark, sf_dir):
    return runs.default_times(frames(spark, sf_dir).drop("ts")).select("video", "frame_idx", F.round("ts", 6).alias("ts"))


_FIXED = f"{FRAMES}, fv as (select *, (value - lag(value) over (partition by video order by frame_idx)) / 0.05::double as velocity from fr), fa as (select *, (velocity - lag(velocity) over (partition by video order by frame_idx)) / 0.05::double as acceleration from fv)"


@query(f"with {_FIXED} select video, frame_idx, round(velocity, 4) as velocity, round(acceleration, 4) as acceleration from fa where acceleration is not null")
def fixed_step_rates(spark, sf_dir):
    rows = runs.fixed_rates(frames(spark, sf_dir), "value", 0.05).where("acceleration is not null")
    return rows.select("video", "frame_idx", F.round("velocity", 4).alias("velocity"), F.round("acceleration", 4).alias("acceleration"))


@query(f"with {_FIXED} select video, " + ", ".join(f"round({f}({c}), 3) as {c}_{n}" for c in ("velocity", "acceleration") for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))) + " from fa group by 1")
def verification_stats(spark, sf_dir):
    stats = runs.rate_stats(runs.fixed_rates(frames(spark, sf_dir), "value", 0.05), ["video"])
    return stats.select("video", *[F.round(c, 3).alias(c) for c in stats.columns[1:]])


@query(f"with {FRAMES}, s as (select video, frame_idx, ts - min(ts) over (partition by video) as t, lead(ts) over (partition by video order by frame_idx) - ts as dt from fr) select video, frame_idx, round(t * 1e6)::bigint as t_us, round((t + dt / 2) * 2e6)::bigint as middle_half_us, round((t + dt) * 1e6)::bigint as until_us from s where dt is not null")
def relative_timeline(spark, sf_dir):
    """In whole microseconds, the middle in halves of them."""
    rows = runs.relative_timeline(frames(spark, sf_dir))
    whole = lambda c, k: F.round(F.col(c) * k).cast("long")
    return rows.select("video", "frame_idx", whole("t", 1e6).alias("t_us"), whole("middle", 2e6).alias("middle_half_us"), whole("until", 1e6).alias("until_us"))


@query("with s as (select event_type as mode, count(value) as runs, sum(value) as total, avg(value) as mean from events group by 1) select mode, runs, round(total, 3) as total, round(mean, 4) as mean, round((select total from s where mode = 'click') / total, 6) as speedup from s")
def timing_sums(spark, sf_dir):
    s = runs.timing_sums(read(spark, sf_dir, "events"), "event_type", "value", "click")
    return s.select("mode", "runs", F.round("total", 3).alias("total"), F.round("mean", 4).alias("mean"), F.round("speedup", 6).alias("speedup"))


@query("select distinct user_id from events where event_type = 'error' and value > 90")
def failed_names(spark, sf_dir):
    return runs.failed_names(read(spark, sf_dir, "events"), "user_id", (F.col("event_type") == "error") & (F.col("value") > 90))


@query("select event_type as part, count(*) as n from events where event_type in ('click', 'view') group by 1 union all select 'all', count(*) from events where event_type in ('click', 'view')")
def merged_counts(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return runs.merged_counts({k: e.where(F.col("event_type") == k) for k in ("click", "view")})


@query(f"with {FRAMES} select video, count(*) filter (frame_idx % 4 = 0) as hits, count(*) filter (frame_idx % 4 <> 0) as misses from fr group by 1")
def cache_counts(spark, sf_dir):
    f = frames(spark, sf_dir).select("video", "frame_idx")
    return runs.cache_counts(f, f.where("frame_idx % 4 = 0"), ["video", "frame_idx"], ["video"])


_LOOKUP = """u as (select distinct user_id as v from events),
 paths as (select v, 0 as priority, v || '/annotation.txt' as path from u where v % 5 = 0 union all select v, 1, v || '.txt' from u where v % 3 = 0 union all select v, 2, 'old/' || v || '/annotation.txt' from u where v % 2 = 0)"""


@query(f"with {_LOOKUP} select u.v::varchar as video, (select arg_min(path, priority) from paths where paths.v = u.v) as path from u")
def annotation_lookup(spark, sf_dir):
    v = read(spark, sf_dir, "events").select(F.col("user_id").alias("v")).distinct()
    name = F.col("v").cast("string")
    shapes = ((5, F.concat(name, F.lit("/annotation.txt"))), (3, F.concat(name, F.lit(".txt"))), (2, F.concat(F.lit("old/"), name, F.lit("/annotation.txt"))))
    paths = F.explode(F.filter(F.array(*[F.when(F.col("v") % k == 0, p) for k, p in shapes]), lambda p: p.isNotNull()))
    return runs.lookup_annotations(v.select(name.alias("video")), v.select(paths.alias("path")))


@query("select event_id, case when event_id % 3 < 2 then 2 end::int as n, case when event_id % 3 < 2 then round(value, 3) end as \"first\", case when event_id % 3 < 2 then round(value, 3) + 1 end as \"last\" from events")
def plan_json(spark, sf_dir):
    """A third of the plans is malformed."""
    value = F.round("value", 3)
    text = F.when(F.col("event_id") % 3 < 2, F.to_json(F.array(value, value + 1))).otherwise(F.lit("[1.0, oops"))
    return runs.read_plans(read(spark, sf_dir, "events").select("event_id", text.alias("json")))


def _within(sql: str, only: str) -> str:
    return sql.replace("from documents d left join", f"from (select * from documents where {only}) d left join").replace("from documents)", f"from documents where {only})")


@query(f"with {_within(document_plans._BM25, 'doc_id % 30 = 3')} select * from lex")
def kb_search(spark, sf_dir):
    """Within one knowledge base: the filter stands before any scoring."""
    docs = read(spark, sf_dir, "documents").where("doc_id % 30 = 3")
    return retrieval.bm25(docs, document_plans._asked(spark, sf_dir)).select("query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


@query("select user_id, event_type, count(*) as n from events group by 1, 2")
def watch_ingest(spark, sf_dir):
    """The events' file as a watched folder, taken in once, and read back from what the stream wrote."""
    from kinelake.streaming.watch import ingest, watched

    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    out = f"{at.rstrip('/')}/kinelake-watch/{uuid.uuid4().hex}"
    batch = read(spark, sf_dir, "events")
    rows = watched(spark, f"{sf_dir}/events.parquet*", batch.schema)
    ingest(rows, f"{out}/rows", f"{out}/checkpoint", ["event_id"]).awaitTermination()
    return spark.read.schema(batch.schema.add("batch", "long")).parquet(f"{out}/rows").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
