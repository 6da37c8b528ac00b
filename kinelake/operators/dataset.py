"""Class counts, splits, balancing and exports of labelled rows. Chance is an md5 of the key, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelake.operators import ranks


def dice(*key: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]).cast("binary"))


def label_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.agg(F.count_if(F.col(label) > 0).alias("fall"), F.count_if(F.col(label) == 0).alias("nofall"), F.count("*").alias("total"))


def _by_chance(rows: DataFrame, label: str, key: str, name: str) -> DataFrame:
    """Each row's place (from 1) in its class by the md5 of its key; the first digits of it deal a class over many tasks."""
    bucket = F.conv(F.substring(dice(key), 1, 3), 16, 10).cast("int")
    return ranks.numbered(rows.withColumn("_dice", dice(key)), ["_dice", key], bucket, [label], name).withColumn(name, F.col(name) + 1).drop("_dice")


def stratified_split(rows: DataFrame, label: str, key: str, share: float = 0.1) -> DataFrame:
    """``part``: in each class, ``val`` for a rounded share of the rows, else ``train``."""
    sizes = rows.groupBy(label).agg(F.bround(F.count("*") * share, 0).alias("_val"))
    return _by_chance(rows, label, key, "_rank").join(F.broadcast(sizes), label).withColumn("part", F.when(F.col("_rank") <= F.col("_val"), "val").otherwise("train")).drop("_rank", "_val")


def balanced(rows: DataFrame, label: str, key: str, most: int | None = None) -> DataFrame:
    """As many rows of each of the classes 0 and 1 as the smaller has (``most`` at most), without replacement."""
    sizes = rows.agg(F.least(F.count_if(F.col(label) > 0), F.count_if(F.col(label) == 0), *([F.lit(most)] if most else [])).alias("_n"))
    return _by_chance(rows, label, key, "_rank").crossJoin(F.broadcast(sizes)).where("_rank <= _n").drop("_rank", "_n")


def sample_details(samples: DataFrame, order: list[str]) -> DataFrame:
    """``sample_idx, label, start_time, end_time, label_name, num_frames``."""
    name = F.when(F.col("label") > 0, "fall").otherwise("nofall")
    idx = F.row_number().over(Window.partitionBy("video").orderBy(*order)) - 1
    return samples.select("video", idx.alias("sample_idx"), "label", "start_time", "end_time", name.alias("label_name"), "num_frames")


def head_long(rows: DataFrame, order: str, values: str, n: int = 20) -> DataFrame:
    """The first n rows in long form: one row for each entry of a list."""
    return rows.orderBy(order).limit(n).select(order, F.posexplode(values).alias("position", "value"))
