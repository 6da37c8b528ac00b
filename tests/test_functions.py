"""Hand-made expectations for parsers, labels, gaps, geometry, kinematics and files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.functions import geometry, text
from kinelake.operators import features, frames, retrieval
from kinelake.sources import readers, writers
from kinelake.streaming import watch


def one(spark, value, type_, f):
    return spark.createDataFrame([(value,)], f"v {type_}").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "line, want",
    [
        ("1;8-10", (8000, 10000)),
        ("2;12.5-14.25", (12500, 14250)),
        ("8000 10000", (8000, 10000)),
        ("8000,10000", (8000, 10000)),
        ("8 10", (8000, 10000)),
        ("900,1200", (900, 1200)),
        ("1000 1000", (1000000, 1000000)),
        ("1;8-10;note", (8000, 10000)),
        ("1;8-10-12", None),
        ("3;x-5", None),
        ("fall_start,fall_end", None),
        ("8d 9", None),
        ("", None),
        (None, None),
    ],
)
def test_annotation_lines(spark, line, want):
    got = one(spark, line, "string", text.annotation_interval)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize("line, want", [("1;8-10", "1;8-12.5"), ("1;8.00-10.25", "1;8-12.75"), ("x", "x"), ("1;8-10-12", "1;8-10-12"), ("a;b-c", "a;b-c")])
def test_extended_lines(spark, line, want):
    assert one(spark, line, "string", lambda c: text.extended_line(c, F.lit(2.5))) == want


@pytest.mark.parametrize("v, want", [("25/1", 25.0), ("30000/1001", 30000 / 1001), ("1/0", 20.0), ("x", 20.0), (None, 20.0)])
def test_rate(spark, v, want):
    assert one(spark, v, "string", text.rate) == pytest.approx(want)


@pytest.mark.parametrize("n, want", [(0, []), (236, [(0, 236)]), (237, [(0, 237), (236, 237)]), (256, [(0, 256), (236, 256)]), (500, [(0, 256), (236, 492), (472, 500)])])
def test_chunks(spark, n, want):
    s = "".join(chr(0x4E00 + i) for i in range(n))
    assert one(spark, s, "string", text.chunks) == [s[a:b] for a, b in want]


@pytest.mark.parametrize("label, iv, want", [(1, [(8000, 10000)], "fall_in_sample:8000-10000"), (1, [(7000, 9000), (8000.5, 9000)], "fall_in_sample:8000-9000"), (0, [(1000, 8000), (11000, 12000)], "overlap:11000-12000"), (0, [(12000, 13000)], ""), (0, [], "")])
def test_interval_label(spark, label, iv, want):
    samples = spark.createDataFrame([("a", 0, 8.0, 11.0)], "video string, start_frame int, start_time double, end_time double")
    rows = spark.createDataFrame([("a", k, float(s), float(e)) for k, (s, e) in enumerate(iv)], "video string, ord int, start_ms double, end_ms double")
    got = frames.interval_label(samples, rows).first()
    assert (got["label"], got["relationship"]) == (label, want)


def flags(spark, pattern):
    return spark.createDataFrame([("a", i, bool(v)) for i, v in enumerate(pattern)], "video string, frame_idx int, has_person boolean")


def test_gaps(spark):
    f = flags(spark, [1, 1, 0, 0, 1, 0, 1, 1, 0])
    assert sorted((r.start_frame, r.end_frame) for r in frames.person_runs(f).collect()) == [(2, 3), (5, 5), (8, 8)]
    assert sorted(r.frame_idx for r in frames.kept_frames(f).collect()) == [0, 1, 4, 6, 7]
    g = frames.gaps(flags(spark, [1] * 5 + [0] * 20 + [1] * 5 + [0] * 19 + [1] * 3 + [0] * 30)).collect()
    assert [(r.gap_start, r.gap_end) for r in g] == [(5, 25)]
    g = frames.gaps(flags(spark, [0] * 25 + [1] * 5 + [0] * 20 + [1])).collect()
    assert sorted((r.gap_start, r.gap_end) for r in g) == [(0, 25), (30, 50)]


def test_timeline(spark):
    iv = spark.createDataFrame([("a", 5000.0, 6000.0), ("a", 10000.0, 11500.0)], "video string, start_ms double, end_ms double")
    totals = spark.createDataFrame([("a", 300), ("b", 4)], "video string, n int")
    got = frames.timeline_split(iv, totals).collect()
    assert sorted((r["first"], r["last"]) for r in got if r.video == "a") == [(0, 99), (100, 120), (121, 199), (200, 230), (231, 299)]
    assert [(r["first"], r["last"]) for r in got if r.video == "b"] == [(0, 3)]


def pose(shoulders, hips=((92, 200), (108, 200)), knees=((92, 260), (108, 260)), ankles=((92, 320), (108, 320))):
    p = np.zeros((17, 2))
    p[5:7], p[11:13], p[13:15], p[15:17] = shoulders, hips, knees, ankles
    return p.ravel().tolist()


@pytest.mark.parametrize("p, want", [(pose(((90, 100), (110, 100))), (0, 0)), (pose(((200, 195), (200, 205))), (math.pi / 2, math.pi / 2)), ([0.0] * 34, (0, 0))])
def test_angles(spark, p, want):
    got = spark.createDataFrame([(p,)], "p array<double>").select(geometry.spine_leg_angle(F.col("p")), geometry.body_orientation(F.col("p"))).first()
    assert tuple(got) == pytest.approx(want)


def test_flat_positions(spark):
    kind = "array<struct<x:float,y:float,conf:float>>"
    assert one(spark, [(float(i), 2.0, 1.0) for i in range(17)], kind, geometry.flat_positions)[:4] == [0.0, 2.0, 1.0, 2.0]
    assert one(spark, [(1.0, 1.0, 1.0)] * 5, kind, geometry.flat_positions) == [0.0] * 34
    assert one(spark, None, kind, geometry.flat_positions) == [0.0] * 34


def test_features_by_numpy(spark):
    rng = np.random.default_rng(3)
    p, t = rng.uniform(0, 500, (13, 34)), np.cumsum(rng.uniform(0.1, 0.5, 13))
    p[4] = 0
    rows = spark.createDataFrame([("a", i, float(t[i]), p[i].tolist()) for i in range(13)], "video string, frame_idx int, ts double, p array<double>")
    got = {r.start_frame: r.features for r in features.features_139(rows).collect()}
    for s in range(3):
        q, u = p[s : s + 11], t[s : s + 11]
        seen = q[[i for i in range(11) if q[i].any()]]
        lo, hi = (np.array([f(seen[:, a::2]) for a in (0, 1)]) for f in (np.min, np.max))
        n = np.clip((q - np.tile(lo, 17)) / np.tile(hi - lo, 17), 0, 1)
        v = np.diff(n, axis=0) / np.diff(u)[:, None]
        a = (v[-1] - v[-2]) / ((u[-1] - u[-3]) / 2)
        hip = (q[:, 22:24] + q[:, 24:26]) / 2
        np.testing.assert_allclose(got[s][:136], np.concatenate([n[-1], v[-1], a, q[-1] - np.tile(hip[-1], 17)]), atol=1e-9)
        assert got[s][137] == pytest.approx(hip[-1, 1] - hip[-2, 1])
    assert features.features_121(rows).count() == 30 and len(features.features_121(rows).first().features) == 121


def test_rank_fusion(spark):
    lists = [spark.createDataFrame([(0, d, i) for i, d in enumerate(x)], "query_id int, doc_id string, rank int") for x in ("abc", "bea")]
    got = [(r.doc_id, r.score) for r in retrieval.fuse(lists).orderBy("rank").collect()]
    assert got == [("b", 0.033060109), ("a", 0.032795699), ("e", 0.016393443), ("c", 0.016129032)]


def test_sources_and_sinks(spark, tmp_path):
    for name in ("x/a.mp4", "a.avi", "x/b.mov", "c.txt"):
        (tmp_path / "v" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "v" / name).write_bytes(b"123")
    videos = readers.list_videos(spark, str(tmp_path / "v"))
    assert sorted(r.video for r in videos.collect()) == ["a", "a", "b"]
    assert readers.find_video(videos, "a").first().path.endswith("a.mp4")
    lines = spark.createDataFrame([("a", "1;8-10"), ("a", "x"), ("b", "900,1200")], "video string, line string")
    writers.annotation_text(lines, str(tmp_path / "ann"))
    found = readers.parsed_annotations(readers.annotation_lines(spark, str(tmp_path / "ann"))).collect()
    assert sorted((r.video, r.start_ms) for r in found) == [("a", 8000.0), ("b", 900.0)]
    feats = spark.createDataFrame([("a", 0, [float(i) for i in range(139)], 1, 0.5, 2.5, "")], "video string, round_idx int, features array<double>, label int, start_time double, end_time double, fall_relationship string")
    writers.features_csv(feats, str(tmp_path / "csv"), ["video", "round_idx"])
    back = readers.feature_csv(spark, str(tmp_path / "csv")).first()
    assert back.feat_138 == 138.0 and back.label == 1
    np.savez(tmp_path / "t.npz", X=np.arange(12.0).reshape(2, 3, 2), y=np.array([0, 1]))
    assert [r.y for r in readers.arrays_npz(spark, str(tmp_path / "t.npz")).orderBy("sample_idx").collect()] == [0, 1]
    times = spark.createDataFrame([("a", "[0, 500, 1500]"), ("b", '{"timestamps": [0.0, 0.5]}'), ("c", "oops")], "video string, json string")
    assert sorted((r.video, r.ts) for r in readers.timestamps(times).collect()) == [("a", 0.0), ("a", 0.5), ("a", 1.5), ("b", 0.0), ("b", 0.5)]


def test_watch(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, s string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        watch.ingest(watch.watched(spark, str(tmp_path / "in"), rows.schema), str(tmp_path / "out"), str(tmp_path / "cp"), ["id"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
    files = spark.read.format("binaryFile").load(str(tmp_path / "in"))
    assert watch.settled(files, stable_seconds=3600).count() == 0 and watch.settled(files, stable_seconds=-5).count() > 0
