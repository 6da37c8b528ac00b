"""Queries that do the whole job: nothing is left out, whatever the sizes of blocks, lengths and buckets."""

import pytest
from pyspark.sql import functions as F

from kinelake.operators import frames as O
from kinelake.operators import profiling, ranks, resume, retrieval
from kinelake.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["bm25_topk", "rerank_topk"])
def test_all_questions(spark, name):
    assert {r.query_id for r in catalogue.QUERIES[name](spark, SF).select("query_id").distinct().collect()} == {0, 20}


def test_blocks_of_any_size(spark, monkeypatch):
    """Ties across blocks, blocks of one vector, and fewer rows than the top."""
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(40)]
    v = spark.createDataFrame(rows, "doc_id long, embedding array<float>").repartition(3)
    q = v.where("doc_id % 7 = 0").withColumnRenamed("doc_id", "query_id")
    want = {(a, d, s, k) for a, x in rows if a % 7 == 0 for k, (s, d) in enumerate(sorted(((x[0] * y[0] + x[1] * y[1], d) for d, y in rows), key=lambda p: (-p[0], p[1]))[:30])}
    for sizes in ((1, 1), (7, 2), (8192, 512)):
        monkeypatch.setattr(retrieval, "BLOCK", sizes[0])
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", sizes[1])
        assert {tuple(r) for r in retrieval.nearest(v, q, 30).collect()} == want


def test_plan_of_any_duration(spark):
    lengths = {1: 0, 2: 1, 3: 250, 4: 251, 5: 90_000, 6: 3_600_000}
    plan = O.round_plan(spark.createDataFrame(list(lengths.items()), "video long, duration_ms long"))
    found = {}
    for r in plan.collect():
        found.setdefault((r.video, r.round_idx), {})[r.ord] = r.ts_ms
    assert set(found) == {(v, k) for v in (2, 3, 4, 5, 6) for k in range(1, 7)}
    for (video, _), times in found.items():
        assert sorted(times) == list(range(len(times))) and times[0] == 0
        assert lengths[video] - 500 <= times[len(times) - 1] < lengths[video]
        assert all(250 <= times[k + 1] - times[k] <= 500 for k in range(len(times) - 1))


def test_autoscale_has_every_frame(spark):
    assert catalogue.QUERIES["timestamp_autoscale"](spark, SF).count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_all_documents_are_there_or_new(spark):
    got = catalogue.QUERIES["doc_insert_fk"](spark, SF)
    refused = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id % 2 and r.doc_id % 30 > 24}
    assert refused and {r.document_id for r in got.collect()} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()} - refused


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_queries_in_parts(spark, monkeypatch):
    """Query vectors in several broadcasts give the same neighbours."""
    v = spark.createDataFrame([(i, [float(i % 7), float(i % 11)]) for i in range(60)], "doc_id long, embedding array<float>")
    q = v.where("doc_id % 3 = 0").withColumnRenamed("doc_id", "query_id")
    want = {tuple(r) for r in retrieval.nearest(v, q, 5).collect()}
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 64)
    assert {tuple(r) for r in retrieval.nearest(v, q, 5).collect()} == want


def test_tops_are_cut_before_the_shuffle(spark):
    for name in ("knn_topk", "bm25_topk"):
        assert "WindowGroupLimit" in _plan(catalogue.QUERIES[name](spark, SF)), name


def test_no_single_partition(spark):
    for name in ("worker_split", "stratified_split", "balanced_downsample"):
        plan = _plan(catalogue.QUERIES[name](spark, SF))
        rows = [x for x in plan.splitlines() if "Window" in x and "row_number" in x]
        assert rows and all("_bucket" in x for x in rows), name


def test_features_are_dealt_once(spark):
    from kinelake.operators import features
    from kinelake.plans.tables import poses

    plan = _plan(features.features_121(poses(spark, SF)))
    assert plan.count("Exchange hashpartitioning") <= 2 and "Join" not in plan


@pytest.mark.parametrize("values", [[1, 2, 4, 10], [5.0], [3, 3, 3, 3, 3], [0] * 500 + [1] * 3, list(range(1000)), [-1.5, 2.25, None, 7.0, 7.0]])
def test_quantiles(spark, values):
    import numpy as np

    df = spark.createDataFrame([("a", None if v is None else float(v)) for v in values] + [("b", 1.0)], "name string, value double").repartition(3)
    got = {r["name"]: r.q for r in ranks.quantiles(df, "name", "value", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    known = [float(v) for v in values if v is not None]
    assert got["a"] == pytest.approx([float(np.quantile(known, s)) for s in (0, 0.25, 0.5, 0.75, 1)]) and got["b"] == [1.0] * 5


def test_describe_keeps_empty_columns(spark):
    d = profiling.describe(spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double"), ["a", "b"]).collect()
    assert {(r.name, r.n, r.q50) for r in d} == {("a", 2, 1.5), ("b", 0, None)}


def test_worker_split_of_odd_numbers(spark):
    for n in (0, 1, 9, 10):
        rows = resume.worker_split(spark.range(n).select((F.col("id") * 3 - 7).alias("k")), "k", 4).collect()
        part = -(-n // 4)
        assert sorted((r.k, r.worker) for r in rows) == [(3 * i - 7, i // part) for i in range(n)]


def test_label_in_many_buckets(spark):
    """An interval and a sample that reach over many buckets of time."""
    samples = spark.createDataFrame([("v", 0, 1.0, 900.0), ("v", 1, 5000.0, 5001.0), ("w", 0, 1.0, 2.0)], "video string, start_frame int, start_time double, end_time double")
    marks = spark.createDataFrame([("v", 1, 2000.0, 700_000.0), ("v", 2, 100.0, 9_000_000.0)], "video string, ord int, start_ms double, end_ms double")
    got = {(r.video, r.start_frame): (r.label, r.relationship) for r in O.interval_label(samples, marks).collect()}
    assert got == {("v", 0): (1, "fall_in_sample:2000-700000"), ("v", 1): (0, "overlap:100-9000000"), ("w", 0): (0, "")}
