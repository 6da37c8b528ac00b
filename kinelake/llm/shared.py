"""What the operators of this subpackage share: reading tables, cutting lineage, bounded bitmaps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or where it is unset in local mode, a temporary one.

    On a cluster without the setting this raises an error, as executors can't read each other's folders.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="kinelake-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: ``df`` written as Parquet in the shared folder and read again. Survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinelake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def masked(docs: DataFrame, seen: tuple[str, ...]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with all columns but those of ``seen`` under names of their own, so that no name of an operator's meets them.

    Also a function that gives a frame with these columns the input's names and order again, and appends further columns.
    Input columns that have the name of an appended one give way to it.
    """
    names = {c: c if c in seen else f"_kl_c{i}" for i, c in enumerate(docs.columns)}

    def restored(df: DataFrame, *added: str) -> DataFrame:
        return df.select(*[F.col(names[c]).alias(c) for c in docs.columns if c not in added], *added)

    return docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]), restored


def ascii_lower(col):
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# --- bitmaps: a set of longs as a fixed number of bits. A set bit may be false, a clear one never is. ---

BITMAP_BITS, MAX_BITS = 1 << 25, 1 << 30


def bits_for(n: int, per_entry: int = 12) -> int:
    """A power of two of bits for ``n`` entries, at most ``MAX_BITS`` (128 MB), so that few clear entries look set.

    Beyond ``MAX_BITS / 2`` entries more and more do. What looks at a bitmap then does more work, in proportion to the input at most.
    """
    return min(MAX_BITS, max(1 << 20, 1 << (per_entry * n).bit_length()))


def bitmap(df: DataFrame, col: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits of ``pmod(col, bits)`` of all rows, at most ``bits / 8`` bytes on the driver whatever the input.

    Nulls count as absent; an empty frame gives a bitmap without set bits.
    """
    return bitmaps(df, col, F.when(F.col(col).isNotNull(), 1).otherwise(0), [bits])[0]


def bitmaps(df: DataFrame, col: str, level, bits: list[int]) -> list[np.ndarray]:
    """In one job, for each of ``bits`` a bitmap; a row of ``level`` n is in the first n of them.

    The maps come to the driver in eight parts, one after another, not in as many jobs as there are partitions.
    """
    at = F.pmod(F.col(col), F.get(F.array(*[F.lit(b).cast("long") for b in bits]), F.col("map"))) + 1
    rows = (
        df.where(level > 0)
        .withColumn("map", F.explode(F.sequence(F.lit(0), level - 1)))
        .groupBy("map", F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("set"))
        .coalesce(8)
        .toLocalIterator()
    )
    out = [np.zeros(b // 8, np.uint8) for b in bits]
    for r in rows:
        i, to = (r["bucket"] - 1) * 4096, out[r["map"]]
        to[i : i + 4096] |= np.frombuffer(bytes(r["set"]), np.uint8)[: len(to) - i]
    return out


def in_bitmap(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """For longs (as int64 or uint64), whether the bit is set. ``len(bits) * 8`` must be a power of two."""
    at = words.astype(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


# --- array helpers, JVM-side ---


def let(value, body):
    """``body(value)`` with the value computed once: a lambda variable is never inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def steps(n):
    """0 .. n-1, empty where n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running_sums(numbers, block: int = 256):
    """Sums before each entry of an array of ints. By blocks, as growing one array entry by entry costs its square."""

    def plain(a, first):
        begin = F.struct(first.alias("next"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(a, begin, lambda s, x: F.struct((s["next"] + x).alias("next"), F.concat(s["out"], F.array(s["next"])).alias("out")))["out"]

    def blocked(a):
        blocks = F.transform(steps(F.ceil(F.size(a) / block).cast("int")), lambda b: F.slice(a, b * block + 1, F.lit(block)))
        sums = lambda bs: plain(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x)), F.lit(0))
        return let(blocks, lambda bs: F.flatten(F.zip_with(bs, sums(bs), plain)))

    return let(numbers, blocked)
