"""Sinks. All go through Spark's commit protocol; ``_SUCCESS`` stands for a done marker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.operators.features import wide


def features_csv(rows: DataFrame, path: str, by: list[str], width: int = 139) -> None:
    """``feat_0 .. feat_n, label, start_time, end_time, fall_relationship``, one folder for each key."""
    keys = [*by, "label", "start_time", "end_time", "fall_relationship"]
    flat = wide(rows, keys, width)
    flat.select(*by, *[f"feat_{i}" for i in range(width)], *keys[len(by) :]).write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)


def tensor(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """``sample_idx, X, y``, with a folder for each key of ``by``."""
    by = by or []
    rows.select(*by, "sample_idx", "X", "y").write.mode("overwrite").partitionBy(*by).parquet(path)


def texts(rows: DataFrame, path: str) -> None:
    """One text for each row, a folder for each video."""
    rows.select("video", F.col("text").alias("value")).write.mode("overwrite").partitionBy("video").text(path)


def details_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def annotation_text(lines: DataFrame, path: str) -> None:
    """``video, line``, one folder for each video."""
    lines.select("video", F.col("line").alias("value")).write.mode("overwrite").partitionBy("video").text(path)


def report_lines(rows: DataFrame) -> DataFrame:
    """A sample's calculation in words, one text for each row of ``video, start_frame, features`` (139)."""
    at = lambda i: F.format_string("%.6f", F.get(F.col("features"), F.lit(i)))
    head = F.format_string("video %s, sample %d", F.col("video").cast("string"), F.col("start_frame"))
    return rows.select("video", "start_frame", F.concat_ws("\n", head, F.concat(F.lit("spine-leg angle "), at(136)), F.concat(F.lit("hip change "), at(137)), F.concat(F.lit("orientation "), at(138))).alias("text"))


def appended(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
