"""Corpus pipeline: quality rules, near duplicates, decontamination, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before it kept; ``run`` writes each
stage's result in the shared folder and reads it again. All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinelake.llm import decontamination, jaccard, packing, quality, secrets
from kinelake.llm.shared import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    Null, empty and short texts go (the base rules); very long ones are measured whole; ties at a cutoff go; repeated rows
    are judged each by its text; an empty table stays empty; all columns, whatever their names, are returned as they were.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays, that of smallest id.

    Null and empty texts are no copies and stay; of rows equal in id and words one stays, unlike texts of one id all do; rows
    without an id stay; very long texts are compared whole; an empty table stays empty; all columns are returned as they were.
    """
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly such passages go.

    Null and empty texts stay; very long ones are searched whole; a document just half covered (a tie) stays; repeated rows
    are treated alike; empty tables are allowed on both sides; no column but ``text`` and ``n_chars`` is changed.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark.

    Null and empty texts stay as they are; very long ones are scanned whole; spans that touch get one mark; repeated rows
    are treated alike; an empty table stays empty; no column but ``text`` and ``n_chars`` is changed.
    """
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences.

    A null or empty text is the end id alone; very long ones are cut into pieces; pieces of equal length (ties) are told
    apart by id and number; repeated rows are packed each; an empty table gives no rows; other columns are not looked at.
    """
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontaminate), ("secrets", redact_secrets), ("packing", pack)]

#: SQL can't express the packing; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
