"""The driver's tables in the roles of the data model: frames, positions, intervals, annotations, chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as the frames of a video; seconds from its first."""
    e = read(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("user_id")
    idx = F.row_number().over(w.orderBy("us", "event_id")) - 1
    return e.select(F.col("user_id").alias("video"), idx.alias("frame_idx"), ((F.col("us") - F.min("us").over(w)) / 1e6).alias("ts"), (F.col("event_type") != "error").alias("has_person"), "event_type", "value", "event_id")


FRAMES = """fr as (select user_id as video, row_number() over (partition by user_id order by epoch_us(ts), event_id) - 1 as frame_idx,
 (epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id)) / 1e6::double as ts, event_type <> 'error' as has_person, event_type, value, event_id from events)"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each error an interval of an hour."""
    f = frames(spark, sf_dir).where("event_type = 'error'")
    return f.select("video", F.row_number().over(Window.partitionBy("video").orderBy("frame_idx")).alias("ord"), (F.col("ts") * 1000).alias("start_ms"), ((F.col("ts") + 3600) * 1000).alias("end_ms"))


INTERVALS = """iv as (select video, row_number() over (partition by video order by frame_idx) as ord, ts * 1000 as start_ms, (ts + 3600) * 1000 as end_ms from fr where event_type = 'error')"""


def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label as the frames of a video, 20 a second; the first 34 entries are positions."""
    e = read(spark, sf_dir, "embeddings")
    idx = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    p = F.transform(F.slice("embedding", 1, 34), lambda v: v.cast("double"))
    return e.select(F.col("label").alias("video"), idx.alias("frame_idx"), p.alias("p"), "vec_id").withColumn("ts", F.col("frame_idx") / 20.0)


#: Positions in long form: pv (one row a value), pf (one row a frame), px (frames with the box of the sample they end).
POSES = """pr as (select label as video, row_number() over (partition by label order by vec_id) - 1 as frame_idx, vec_id, list_transform(embedding[1:34], lambda v: v::double) as p from embeddings),
pf as (select *, frame_idx / 20.0::double as ts, list_transform(range(0, 17), lambda i: p[2 * i + 1]) as xs, list_transform(range(0, 17), lambda i: p[2 * i + 2]) as ys from pr),
pg as (select *, (list_sum(xs) > 0 or list_sum(ys) > 0) as seen from pf),
px as (select *, count(*) over w as before,
  coalesce(min(case when seen then list_min(xs) end) over w, 0) as lft, coalesce(max(case when seen then list_max(xs) end) over w, 0) as rgt,
  coalesce(min(case when seen then list_min(ys) end) over w, 0) as tp, coalesce(max(case when seen then list_max(ys) end) over w, 0) as btm,
  lag(p, 1) over o as p1, lag(p, 2) over o as p2, lag(ts, 1) over o as t1, lag(ts, 2) over o as t2
  from pg window w as (partition by video order by frame_idx rows between 10 preceding and current row), o as (partition by video order by frame_idx)),
pb as (select *, rgt - lft as bw, btm - tp as bh, case when rgt - lft > 0 then rgt - lft else 1 end as dw, case when btm - tp > 0 then btm - tp else 1 end as dh from px)"""

_SPINE = "((p[11] + p[13]) / 2 - (p[23] + p[25]) / 2)", "((p[12] + p[14]) / 2 - (p[24] + p[26]) / 2)"
_LEG = "((p[27] - p[31] + (p[29] - p[33])) / 2)", "((p[28] - p[32] + (p[30] - p[34])) / 2)"


def _angle(v: tuple[str, str], w: tuple[str, str]) -> str:
    norms = f"(sqrt({v[0]} * {v[0]} + {v[1]} * {v[1]}) * sqrt({w[0]} * {w[0]} + {w[1]} * {w[1]}))"
    return f"case when {norms} > 0 then acos(greatest(-1.0, least(1.0, ({v[0]} * {w[0]} + {v[1]} * {w[1]}) / {norms}))) else 0.0 end"


ANGLE, ORIENTATION = _angle(_SPINE, _LEG), _angle(_SPINE, ("0.0", "-1.0"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in all forms that annotations come in, one for each event."""
    k, v = F.col("event_id") % 7, F.round("value", 1)
    say = lambda fmt, *c: F.format_string(fmt, *c)
    whole = F.floor("value").cast("long")
    line = (
        F.when(k == 0, say("%d;%d-%d", F.col("event_id"), whole, whole + 2))
        .when(k == 1, say("%d,%d", whole * 100, whole * 100 + 1500))
        .when(k == 2, say("%d %d", whole, whole + 3))
        .when(k == 3, say("%d;x-%d", F.col("event_id"), whole))
        .when(k == 4, F.lit("fall_start,fall_end"))
        .when(k == 5, say("%d;%d-%d-%d", F.col("event_id"), whole, whole + 1, whole + 2))
        .otherwise(F.when(F.col("user_id") % 5 == 0, F.lit(" Discard ")).otherwise(F.lit("")))
    )
    return read(spark, sf_dir, "events").where(F.col("user_id") % 4 != 0).select(F.col("user_id").alias("video"), F.col("event_id").alias("line_no"), line.alias("line"))


ANNOTATIONS = """an as (select user_id as video, event_id as line_no, case event_id % 7
 when 0 then printf('%d;%d-%d', event_id, floor(value)::bigint, floor(value)::bigint + 2) when 1 then printf('%d,%d', floor(value)::bigint * 100, floor(value)::bigint * 100 + 1500)
 when 2 then printf('%d %d', floor(value)::bigint, floor(value)::bigint + 3) when 3 then printf('%d;x-%d', event_id, floor(value)::bigint) when 4 then 'fall_start,fall_end'
 when 5 then printf('%d;%d-%d-%d', event_id, floor(value)::bigint, floor(value)::bigint + 1, floor(value)::bigint + 2)
 else case when user_id % 5 = 0 then ' Discard ' else '' end end as line from events where user_id % 4 <> 0),
ap as (select *, case event_id7 when 0 then floor_v * 1000.0 when 1 then case when floor_v * 100 > 1000 or floor_v * 100 + 1500 > 1000 then floor_v * 100.0 else floor_v * 100000.0 end
  when 2 then case when floor_v > 1000 or floor_v + 3 > 1000 then floor_v * 1.0 else floor_v * 1000.0 end end::double as start_ms,
 case event_id7 when 0 then (floor_v + 2) * 1000.0 when 1 then case when floor_v * 100 > 1000 or floor_v * 100 + 1500 > 1000 then floor_v * 100.0 + 1500 else (floor_v * 100.0 + 1500) * 1000 end
  when 2 then case when floor_v > 1000 or floor_v + 3 > 1000 then floor_v + 3.0 else (floor_v + 3) * 1000.0 end end::double as end_ms
 from (select an.*, line_no % 7 as event_id7, floor(e.value)::bigint as floor_v from an join events e on e.event_id = an.line_no))"""
