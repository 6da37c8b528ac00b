"""A persisted catalogue: knowledge bases, their documents and chunks as Parquet tables below a shared folder.

A change writes a new version of a table beside the old one and then its number, so that a reader sees either; a change
that is lost with its executors leaves the old version. One writer at a time is assumed, as with a lock in a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.operators import catalog

#: tables and their columns
TABLES = {
    "knowledge_database": "knowledge_id int, title string, category string, create_dt timestamp, update_dt timestamp",
    "knowledge_document": "document_id int, title string, category string, knowledge_id int, file_path string, file_type string, create_dt timestamp, update_dt timestamp",
    "document_meta": "document_id int, knowledge_id int, document_name string, file_path string, abstract string",
    "chunk_info": "document_id int, knowledge_id int, page_number int, chunk_id int, chunk_content string, embedding_vector array<float>",
}


class Catalogue:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def create(self) -> Catalogue:
        """Makes the tables that aren't there yet; those that are stay as they are."""
        for name, schema in TABLES.items():
            if self._version(name) is None:
                self._write(name, self.spark.createDataFrame([], schema), 0)
        return self

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _version(self, name: str) -> int | None:
        """The greatest version whose marker of a finished write is there."""
        files, path = self._files()
        at = path(f"{self.folder}/{name}")
        if not files.exists(at):
            return None
        done = [int(f.getPath().getName()[1:]) for f in files.listStatus(at) if files.exists(path(f"{f.getPath()}/_SUCCESS"))]
        return max(done, default=None)

    def _write(self, name: str, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/v{version}")
        files, path = self._files()
        # the version before the last is no longer read
        files.delete(path(f"{self.folder}/{name}/v{version - 2}"), True)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}/v{self._version(name)}")

    def _change(self, name: str, rows: DataFrame) -> None:
        kinds = self.spark.createDataFrame([], TABLES[name]).schema
        columns = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds]
        self._write(name, rows.select(columns), self._version(name) + 1)

    def insert_base(self, new: DataFrame) -> None:
        self._change("knowledge_database", self.table("knowledge_database").unionByName(new, allowMissingColumns=True))

    def insert_document(self, new: DataFrame) -> None:
        """Only documents whose knowledge base exists."""
        known = new.join(self.table("knowledge_database").select("knowledge_id"), "knowledge_id", "left_semi")
        self._change("knowledge_document", self.table("knowledge_document").unionByName(known, allowMissingColumns=True))

    def index(self, meta: DataFrame, chunks: DataFrame) -> None:
        """Appends documents' descriptions and chunks; those of a ``document_id`` that is indexed already are replaced."""
        for name, rows in (("document_meta", meta), ("chunk_info", chunks)):
            old = catalog.delete(self.table(name), "document_id", rows.select("document_id").distinct())
            self._change(name, old.unionByName(rows, allowMissingColumns=True))

    def get(self, name: str, key: str, wanted: DataFrame) -> DataFrame:
        return catalog.get(self.table(name), key, wanted)

    def delete(self, name: str, key: str, wanted: DataFrame) -> DataFrame:
        """``key, response_code``: 200 for what was there and goes now, else 404. Documents and chunks go with what they belong to."""
        told = catalog.get(self.table(name).select(key), key, wanted)
        codes = self.spark.createDataFrame(told.toArrow())  # as many rows as were asked for
        for other, schema in TABLES.items():
            if f"{key} " in schema and (key == "knowledge_id" or other != "knowledge_database"):
                self._change(other, catalog.delete(self.table(other), key, wanted))
        return codes

    def chunks_of(self, knowledge_id: int) -> DataFrame:
        """What a search within one knowledge base scores: the filter stands before any scoring."""
        return self.table("chunk_info").where(F.col("knowledge_id") == knowledge_id)
