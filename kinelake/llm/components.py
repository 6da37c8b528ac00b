"""Connected components by alternating large-star and small-star steps, all as joins of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``u, v`` both ways; every node hands its least neighbour to its greater (large) or its lesser ones and itself (small)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u")
    out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, component`` (least node reachable) of all nodes of the edges but those that are least themselves."""
    now, before = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges"), None
    for _ in range(rounds):
        now = stored(_star(_star(now, True), False), "edges")
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    else:
        raise RuntimeError("components have not settled")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
