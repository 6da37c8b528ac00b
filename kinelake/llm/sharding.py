"""Two-pass external shuffle of records into shards.

Pass one scatters rows into memory-sized buckets by seeded hashes; pass two shuffles
each bucket by Fisher-Yates in memory. The text crosses the network once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.llm.shared import masked, partitions, table

SHARDS, SEED, BUCKET_BYTES = 16, 20_240_611, 16 << 20


def rendezvous(key, shards: int, seed: int):
    """The shard of highest seeded hash: one more shard takes rows only into itself."""
    return F.array_max(F.array(*[F.struct(F.xxhash64(key, F.lit(s), F.lit(seed)).alias("h"), F.lit(s).alias("s")) for s in range(shards)]))["s"]


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0..n-1: place i takes a random one of the places up to i."""
    order, rng = np.arange(n), np.random.Generator(np.random.PCG64(seed))
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def _bytes(docs: DataFrame):
    """About the bytes of a row: those of its texts, of nested columns as JSON, and 8 for every other column."""

    def of(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(col)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(col)))
        return F.lit(8)

    return sum((F.coalesce(of(f), F.lit(0)) + 8 for f in docs.schema), F.lit(32)).cast("long")


def shuffle_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns and rows of ``docs`` with ``shard`` int and ``slot`` long (gapless from 0 in each shard).

    Law ``key``: ``doc_id`` and the number of shards decide the shard. A null text counts as empty, a null ``doc_id`` is a
    key like others, a very long text makes its bucket larger, repeated rows (ties) are all kept and an empty table stays
    empty. Columns named ``shard`` and ``slot`` of the input's are replaced. The result depends on the rows alone, not on
    how they are partitioned.
    """
    rows, restored = masked(docs, ("doc_id", "text"))
    total = docs.agg(F.sum(_bytes(docs))).first()[0] or 0
    buckets = max(1, math.ceil(total / shards / bucket_bytes))
    rest = [F.to_json(F.struct(f.name)) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else F.col(f.name) for f in rows.schema if f.name not in ("doc_id", "text")]
    keyed = rows.withColumns(
        {
            "_kl_shard": rendezvous(F.col("doc_id"), shards, seed),
            # the text takes part, so that a key that many rows share is still spread
            "_kl_bucket": F.pmod(F.xxhash64("doc_id", "text", F.lit(seed + 1)), F.lit(buckets)).cast("int"),
            "_kl_rest": F.xxhash64(F.lit(0), *rest),
        }
    )
    before = Window.partitionBy("_kl_shard").orderBy("_kl_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("_kl_shard", "_kl_bucket").agg(F.count("*").alias("_kl_n"))
    base = counts.select("_kl_shard", "_kl_bucket", F.coalesce(F.sum("_kl_n").over(before), F.lit(0)).alias("_kl_base"))
    key = ["_kl_shard", "_kl_bucket"]
    # as many tasks as buckets, so that a task's share stays the same at any size
    dealt = keyed.repartition(max(partitions(docs), shards * buckets), *key)
    joined = dealt.join(F.broadcast(base) if buckets <= 4096 else base, key)
    columns = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def deal(key: tuple, rows: pa.Table) -> pa.Table:
        shard, bucket = key[0].as_py(), key[1].as_py()
        # rows arrive in any order: bring them into one that only they decide, then permute
        order = np.asarray(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("doc_id", "text", "_kl_rest")]))
        moved = rows.take(pa.array(order[fisher_yates(len(order), [seed, shard, bucket])]))
        slot = moved["_kl_base"].to_numpy() + np.arange(len(order))
        return pa.table([*[moved[c] for c in columns], moved["_kl_shard"], pa.array(slot, pa.int64())], names=[*columns, "shard", "slot"])

    return restored(joined.groupBy(*key).applyInArrow(deal, schema), "shard", "slot")


def op3_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return shuffle_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        rendezvous(F.col("doc_id"), SHARDS + 1, SEED).cast("int").alias("grown_shard"),
    )
