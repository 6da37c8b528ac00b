"""Seconds of the headline queries, warm: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from kinelake.plans.catalogue import QUERIES

NAMES = ("sliding_samples", "interval_label", "person_gaps", "acceleration", "strided_samples", "features_139", "features_121", "profile", "stratified_split", "chunk_text", "token_stats", "bm25_topk", "knn_topk", "rrf_hybrid", "ready_files", "kb_documents", "events_session")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in NAMES:
        for _ in range(2):
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
