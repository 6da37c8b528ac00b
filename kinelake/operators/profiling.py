"""Quality profiles of numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.operators import ranks


def unpivot(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``name, value``, so that any number of columns is profiled in one pass and one shuffle."""
    return rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")).select("x.*")


def describe(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Counts, moments and exact quartiles of columns; no task holds a column's values."""
    values = unpivot(rows, columns)
    q = ranks.quantiles(values, "name", "value", [0.25, 0.5, 0.75])
    out = values.groupBy("name").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.stddev_pop("value").alias("std_pop"), F.min("value").alias("low"), F.max("value").alias("high")).join(F.broadcast(q), "name", "left")
    return out.select("name", "n", "mean", "std", "std_pop", "low", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "high")


def beyond_sigma(rows: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """How many values lie more than k standard deviations from the mean."""
    stats = rows.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))
    far = F.abs(F.col(column) - F.col("mean")) > k * F.col("std")
    return rows.crossJoin(F.broadcast(stats)).agg(F.count_if(far).alias("outliers"), F.count("*").alias("n"))  # stats is one row


def out_of_range(rows: DataFrame, column: str, low: float, high: float) -> Column:
    return rows.where((F.col(column) < low) | (F.col(column) > high))


def negation(rows: DataFrame, a: str, b: str, limit: float = 1.0) -> DataFrame:
    """Whether one column is about the other with its sign changed."""
    return rows.agg(F.avg(F.abs(F.col(a) + F.col(b))).alias("mean_abs_sum"), F.corr(a, b).alias("corr")).withColumn("negated", F.col("mean_abs_sum") < limit)


def reasons(rows: DataFrame, reason: str, key: str, examples: int = 5) -> DataFrame:
    """Count of each reason with its first examples; of each only as many are gathered."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(reason).orderBy(key))
    counts = rows.groupBy(reason).agg(F.count("*").alias("n"))
    first = rows.withColumn("_r", rank).where(F.col("_r") <= examples).groupBy(reason).agg(F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda v: v.cast("string")), ",").alias("examples"))
    return counts.join(first, reason)
