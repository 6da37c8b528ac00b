"""Row numbers and quantiles of a whole table without a task that gets all rows: rows are dealt into ordered buckets first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256


def cut_points(rows: DataFrame, column: str, by: list[str], buckets: int = BUCKETS) -> Column:
    """An expression for the ordered bucket of a number: cuts are approximate quantiles, read here (``buckets`` numbers a group).

    Groups (``by``) are a few, as columns of a profile. A wrong cut makes buckets uneven, never out of order.
    """
    at = F.percentile_approx(F.col(column).cast("double"), F.array(*[F.lit(k / buckets) for k in range(1, buckets)]), 10_000)
    found = rows.groupBy(*by).agg(at.alias("cuts")).collect()
    value = F.col(column).cast("double")
    bucket = F.lit(0)
    for r in found:
        cuts = F.array(*[F.lit(c) for c in sorted(set(r["cuts"] or []))]).cast("array<double>")
        here = F.aggregate(cuts, F.lit(0), lambda n, c: n + (c < value).cast("int"))
        mine = F.lit(True)
        for b in by:
            mine = mine & F.col(b).eqNullSafe(F.lit(r[b]))
        bucket = F.when(mine, here).otherwise(bucket)
    return bucket


def numbered(rows: DataFrame, order: list, bucket: Column, by: list[str], name: str) -> DataFrame:
    """``rows`` with their place (from 0) by ``order`` in each group, given a bucket that rises with the first of ``order``."""
    marked = rows.withColumn("_bucket", bucket)
    counts = marked.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))  # a row for each bucket
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order)) - 1
    return marked.withColumn(name, place).join(F.broadcast(base), [*by, "_bucket"]).withColumn(name, F.col(name) + F.col("_base")).drop("_bucket", "_base")


def quantiles(values: DataFrame, name: str, value: str, shares: list[float]) -> DataFrame:
    """``name, q``: exact quantiles (between two values in proportion), an array in the order of ``shares``. Nulls are left out.

    Equal values are counted together first; then only their running counts within buckets are needed.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(name, value).agg(F.count("*").alias("_k"))
    marked = counts.withColumn("_bucket", cut_points(counts, value, [name]))
    sums = marked.groupBy(name, "_bucket").agg(F.sum("_k").alias("_n"))
    whole = Window.partitionBy(name)
    base = sums.select(name, "_bucket", F.coalesce(F.sum("_n").over(whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.sum("_n").over(whole).alias("_all"))
    upto = F.sum("_k").over(Window.partitionBy(name, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = marked.withColumn("_upto", upto).join(F.broadcast(base), [name, "_bucket"]).withColumn("_last", F.col("_base") + F.col("_upto") - 1)
    first = F.col("_last") - F.col("_k") + 1
    picks = []
    for i, share in enumerate(shares):
        at = F.lit(share) * (F.col("_all") - 1)
        for j, rank in enumerate((F.floor(at), F.ceil(at))):
            picks.append(F.max(F.when((first <= rank) & (rank <= F.col("_last")), F.col(value))).alias(f"_{i}_{j}"))
    found = placed.groupBy(name).agg(F.max("_all").alias("_all"), *picks)
    part = lambda share: F.lit(share) * (F.col("_all") - 1) - F.floor(F.lit(share) * (F.col("_all") - 1))
    return found.select(name, F.array(*[F.col(f"_{i}_0") + part(s) * (F.col(f"_{i}_1") - F.col(f"_{i}_0")) for i, s in enumerate(shares)]).alias("q"))
