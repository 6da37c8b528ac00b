"""Sources with stated schemas: nothing is inferred, malformed records become nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.functions.text import annotation_interval, rate, seconds

POINT = T.StructType([T.StructField(c, T.FloatType()) for c in ("x", "y", "conf")])
DETECTION = T.StructType([T.StructField("frame", T.StringType()), T.StructField("keypoints", T.ArrayType(POINT)), T.StructField("has_person", T.BooleanType())])
LEGACY_DETECTION = "array<struct<num_detected:int,keypoints:array<struct<x:double,y:double,name:string>>>>"
FEATURE_COLUMNS = 139
FEATURES_CSV = T.StructType([*[T.StructField(f"feat_{i}", T.DoubleType()) for i in range(FEATURE_COLUMNS)], T.StructField("label", T.IntegerType()), T.StructField("start_time", T.DoubleType()), T.StructField("end_time", T.DoubleType()), T.StructField("fall_relationship", T.StringType())])
VIDEO_KINDS = ("mp4", "avi", "mov")


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def list_videos(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size, mtime, video``, below a folder. The content column is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{mp4,avi,mov}").load(folder)
    return files.select("path", F.col("length").alias("size"), F.unix_seconds("modificationTime").alias("mtime"), stem(F.col("path")).alias("video"))


def find_video(videos: DataFrame, name: str) -> DataFrame:
    """The file of a name: by kind, then the one nearest the root, then by path."""
    kind = F.array_position(F.array(*map(F.lit, VIDEO_KINDS)), F.regexp_extract("path", r"\.([^.]*)$", 1))
    depth = F.size(F.split("path", "/"))
    return videos.where(F.col("video") == name).orderBy(kind, depth, "path").limit(1)


def first_candidate(candidates: DataFrame) -> DataFrame:
    """Of ``video, priority, path``, the path of least priority for each video."""
    return candidates.groupBy("video").agg(F.min_by("path", F.struct("priority", "path")).alias("path"))


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Frame images of some size with their ordinal."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jpg").load(folder).where("length > 0").select("path")
    by_folder = files.withColumn("video", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    return by_folder.withColumn("frame_idx", F.row_number().over(Window.partitionBy("video").orderBy("path")) - 1)


def annotation_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``video, line``: the folder of a file names the video, plainly or as ``video=name`` (the writer's form, %xx undone)."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(folder)
    named = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    # a path is an URI, and the writer escapes once more
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    video = F.when(named.startswith("video="), plain(F.regexp_replace(plain(named), "^video=", ""))).otherwise(plain(named))
    return rows.select(video.alias("video"), F.col("value").alias("line"))


def parsed_annotations(lines: DataFrame) -> DataFrame:
    return lines.withColumn("i", annotation_interval(F.col("line"))).where("i is not null").select("video", "line", "i.start_ms", "i.end_ms")


def timestamps(rows: DataFrame, json: str = "json") -> DataFrame:
    """``frame_idx, ts`` of a list or of an object with one, in seconds; a malformed value has none."""
    plain = F.from_json(json, "array<double>")
    inside = F.from_json(json, "timestamps array<double>")["timestamps"]
    keys = [c for c in rows.columns if c != json]
    return rows.select(*keys, F.posexplode(seconds(F.coalesce(inside, plain))).alias("frame_idx", "ts"))


def legacy_detections(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.from_json("value", LEGACY_DETECTION).alias("d"))
    return rows.select("path", F.posexplode("d").alias("frame_idx", "d")).select("path", "frame_idx", "d.*")


def feature_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURES_CSV).option("header", True).csv(path)


def video_rate(fraction: Column) -> Column:
    return rate(fraction)


def arrays_npz(spark: SparkSession, path: str, x: str = "X", y: str = "y") -> DataFrame:
    """Training arrays of NPZ files, ``sample_idx, X, y``. Pickled objects are refused."""
    import io

    import numpy as np
    import pandas as pd

    def read(batches):
        for batch in batches:
            for content in batch["content"]:
                with np.load(io.BytesIO(content), allow_pickle=False) as f:
                    xs, ys = f[x], f[y]
                yield pd.DataFrame({"sample_idx": range(len(xs)), "X": [v.astype(float).tolist() for v in xs], "y": ys.astype(int)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "sample_idx long, X array<array<double>>, y int")


def jdbc_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """Filters and columns are pushed into the database."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def pdf_pages(files: DataFrame) -> DataFrame:
    """``path, page_number, text`` of ``path, content``; needs ``pdfplumber`` on the executors."""
    import pandas as pd

    def read(batches):
        import io

        import pdfplumber

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with pdfplumber.open(io.BytesIO(content)) as pdf:
                    pages = [p.extract_text() or "" for p in pdf.pages]
                yield pd.DataFrame({"path": path, "page_number": range(len(pages)), "text": pages})

    return files.select("path", "content").mapInPandas(read, "path string, page_number int, text string")
