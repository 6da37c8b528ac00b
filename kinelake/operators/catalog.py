"""Knowledge bases and their documents as tables: reads by key, inserts, deletes. Results carry a ``response_code``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, MISSING = 200, 404


def get(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """A row for every wanted key: its record, or nulls and 404."""
    found = rows.withColumn("_found", F.lit(True))
    return wanted.join(found, key, "left").withColumn("response_code", F.when(F.col("_found"), OK).otherwise(MISSING)).drop("_found")


def insert(rows: DataFrame, new: DataFrame) -> DataFrame:
    return rows.unionByName(new)


def insert_document(documents: DataFrame, new: DataFrame, bases: DataFrame) -> DataFrame:
    """New documents whose knowledge base exists are added."""
    return documents.unionByName(new.join(bases.select("knowledge_id"), "knowledge_id", "left_semi").select(new.columns))


def delete(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    return rows.join(gone.select(key), key, "left_anti")


def delete_base(bases: DataFrame, documents: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A knowledge base goes with its documents."""
    return delete(bases, "knowledge_id", gone), delete(documents, "knowledge_id", gone)


def update(rows: DataFrame, key: str, keys: list, **values: Column) -> DataFrame:
    hit = F.col(key).isin(keys)
    return rows.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})
