"""The pipeline's stages against their operators, and that every decision takes effect."""

import corpus_pipeline as cp
from kinelake.llm import decontamination, jaccard, quality, secrets
from kinelake.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, SF), "t")
        assert docs.columns == columns
        rows.append(docs.count())
    assert rows == sorted(rows, reverse=True) and rows[-1] > 100 and rows[1] < rows[0] and rows[2] < rows[1]
    assert docs.where("n_chars <> length(text)").count() == 0
    classes = jaccard.jaccard_components(docs)
    assert all(r["count"] == 1 for r in classes.groupBy("component_id").count().collect())
    assert secrets.scan_secrets(docs).where("exists(secrets, s -> s.kind <> 'entropy')").count() == 0
    assert decontamination.find_contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("size(hit_spans) > 0").count() == 0
    judged = quality.judge(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).where("not kept")
    assert docs.join(judged, "doc_id", "left_semi").count() == 0
    packed = cp.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
