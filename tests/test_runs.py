"""Whole runs, the persisted catalogue, and watching a folder."""

import time

import pytest
from pyspark.sql import functions as F

from kinelake.operators import runs
from kinelake.operators.store import TABLES, Catalogue
from kinelake.plans.tables import poses
from kinelake.sources.readers import FEATURE_COLUMNS, feature_csv
from kinelake.streaming import watch

SF = "/root/testdata/sf0.001"


def test_rounds_and_their_files(spark, tmp_path):
    p = poses(spark, SF).select("video", "frame_idx", "p", "ts")
    marks = p.where("frame_idx % 7 = 3").select("video", F.col("frame_idx").alias("ord"), (F.col("ts") * 1000).alias("start_ms"), ((F.col("ts") + 0.3) * 1000).alias("end_ms"))
    samples = runs.process_rounds(p, marks)
    n = {r.video: r["count"] for r in p.groupBy("video").count().collect()}
    assert {r.video: r["count"] for r in samples.groupBy("video").count().collect()} == {v: k - 10 for v, k in n.items() if k > 10}
    runs.write_rounds(samples, p, str(tmp_path / "run"))
    rows = feature_csv(spark, str(tmp_path / "run/features"))
    assert rows.count() == samples.count() and rows.where("label = 1").count() == samples.where("label = 1").count()
    tensor = spark.read.parquet(str(tmp_path / "run/tensor"))
    first = tensor.first()
    assert tensor.count() == samples.count() and len(first.X) == 10 and all(len(x) == 121 for x in first.X) and FEATURE_COLUMNS == 139
    chosen = spark.read.json(str(tmp_path / "run/preview")).groupBy("label").count().collect()
    assert len({r["count"] for r in chosen}) == 1 and spark.read.text(str(tmp_path / "run/report")).where("value like 'video%'").count() == sum(r["count"] for r in chosen)
    assert spark.read.option("header", True).csv(str(tmp_path / "run/details")).count() == samples.count()


def test_frames_without_person_are_counted_out(spark):
    zero, seen = [0.0] * 34, [float(k % 5) for k in range(34)]
    rows = [("v", i, zero if i in (2, 3) else [x + i for x in seen]) for i in range(14)]
    p = spark.createDataFrame(rows, "video string, frame_idx int, p array<double>")
    none = spark.createDataFrame([], "video string, ord int, start_ms double, end_ms double")
    got = runs.process_rounds(p, none).orderBy("start_frame").collect()
    assert [r.start_frame for r in got] == [0, 1] and [r.start_time for r in got] == [0.0, 0.05] and [r.end_time for r in got] == [0.6, 0.65]


def test_catalogue(spark, tmp_path):
    """Create, get, delete, delete again; documents need their base and go with it."""
    c = Catalogue(spark, str(tmp_path / "kb")).create()
    c.insert_base(spark.createDataFrame([(1, "one"), (2, "two")], "knowledge_id int, title string"))
    c.create()
    assert set(TABLES) and c.table("knowledge_database").count() == 2
    c.insert_document(spark.createDataFrame([(10, "a", 1), (11, "b", 2), (12, "c", 666)], "document_id int, title string, knowledge_id int"))
    assert {r.document_id for r in c.table("knowledge_document").collect()} == {10, 11}
    chunks = [(10, 1, 0, 1, "text of one", [0.5]), (11, 2, 0, 1, "text of two", [1.5])]
    for _ in range(2):
        c.index(spark.createDataFrame([(10, 1, "a"), (11, 2, "b")], "document_id int, knowledge_id int, document_name string"), spark.createDataFrame(chunks, TABLES["chunk_info"]))
    assert c.table("chunk_info").count() == 2 and [r.chunk_content for r in c.chunks_of(2).collect()] == ["text of two"]
    one = spark.createDataFrame([(1,)], "knowledge_id int")
    codes = lambda df: [r.response_code for r in df.collect()]
    assert codes(c.get("knowledge_database", "knowledge_id", one)) == [200]
    assert codes(c.delete("knowledge_database", "knowledge_id", one)) == [200]
    assert codes(c.delete("knowledge_database", "knowledge_id", one)) == [404] and codes(c.get("knowledge_database", "knowledge_id", one)) == [404]
    assert [c.table(t).count() for t in TABLES] == [1, 1, 1, 1]
    missing = spark.createDataFrame([(666,)], "document_id int")
    assert codes(c.get("knowledge_document", "document_id", missing)) == [404]


def test_lookup_order(spark):
    paths = [("a/annotation.txt",), ("a.txt",), ("b.txt",), ("x/b/annotation.txt",), ("y/c/annotation.txt",), ("x/c/annotation.txt",), ("x/d.txt",)]
    found = runs.lookup_annotations(spark.createDataFrame([(v,) for v in "abcd"], "video string"), spark.createDataFrame(paths, "path string")).collect()
    assert {r.video: r.path for r in found} == {"a": "a/annotation.txt", "b": "b.txt", "c": "x/c/annotation.txt", "d": None}


def test_plans_of_any_form(spark):
    rows = spark.createDataFrame([(0, "[1.5, 2]"), (1, "[]"), (2, "[1,"), (3, None), (4, "{}")], "k int, json string")
    assert {r.k: (r.n, r["first"], r["last"]) for r in runs.read_plans(rows).collect()} == {0: (2, 1.5, 2.0), 1: (0, None, None), 2: (None, None, None), 3: (None, None, None), 4: (None, None, None)}


def test_keys_of_later_files_are_taken_once(spark, tmp_path):
    at, schema = str(tmp_path / "in"), "k long, v string"
    say = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at)
    for rows in ([(1, "a"), (1, "a"), (2, "b")], [(2, "again"), (3, "c")]):
        say(rows)
        watch.ingest(watch.watched(spark, at, schema), str(tmp_path / "out"), str(tmp_path / "state"), ["k"]).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_unchanged_since_the_last_poll(spark, tmp_path):
    files = lambda *rows: spark.createDataFrame(list(rows), "path string, size long, mtime long")
    snapshot = str(tmp_path / "polls")
    poll = lambda clock, *rows: sorted(r.path for r in watch.unchanged(spark, files(*rows), snapshot, clock, 60).collect())
    assert poll(1000, ("a", 5, 900), ("b", 5, 900)) == []
    assert poll(1030, ("a", 5, 900), ("b", 6, 1010), ("c", 1, 800)) == ["a"]
    assert poll(1060, ("a", 5, 900), ("b", 6, 1010), ("c", 1, 800)) == ["a", "c"]
    assert poll(1090, ("b", 6, 1010)) == ["b"]


@pytest.mark.parametrize("kind", ["tumbling", "sessions"])
def test_streams_as_their_batch_twins(spark, tmp_path, kind):
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    rows = getattr(watch, kind)(watch.watched(spark, str(tmp_path / "in"), e.schema))
    query = rows.writeStream.format("memory").queryName(f"told_{kind}").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    plain = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    assert plain(spark.table(f"told_{kind}")) == plain(getattr(watch, kind)(e))


def test_idle_queries_end(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    query = watch.watched(spark, str(tmp_path / "in"), "id long").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "s")).trigger(processingTime="1 second").start()
    began = time.time()
    watch.run_until_idle(query, 3)
    assert not query.isActive and time.time() - began < 60
