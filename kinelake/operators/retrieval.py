"""Chunks, lexical and vector ranking, and their fusion. Queries are a stated set and are small against the corpus."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.functions.text import chunk_starts, tokens

K1, B, RRF_K, TOP = 1.2, 0.75, 60, 50
#: rows and queries of a block of vectors
BLOCK, QUERY_BLOCK, QUERY_BYTES = 2048, 512, 64 << 20


def chunked(docs: DataFrame, size: int = 256, overlap: int = 20) -> DataFrame:
    """``doc_id, chunk_id`` (from 1) and ``chunk_content``."""
    starts = docs.select("doc_id", "text", F.posexplode(chunk_starts(F.length("text"), size, overlap)).alias("k", "start"))
    return starts.select("doc_id", (F.col("k") + 1).alias("chunk_id"), F.substring(F.col("text"), F.col("start") + 1, F.lit(size)).alias("chunk_content"))


def abstracts(pages: DataFrame, pages_used: int = 4) -> DataFrame:
    """Each document's first pages, every one after a line break."""
    few = pages.where(F.col("page_number") < pages_used).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_number", "content"))).alias("p"))
    return few.select("doc_id", F.array_join(F.transform("p", lambda x: F.concat(F.lit("\n"), x["content"])), "").alias("abstract"))


def token_stats(docs: DataFrame) -> DataFrame:
    """``token, n, df``: how often each token occurs, and in how many rows. One shuffle, of sums made before it."""
    ts = docs.select(tokens(F.col("text")).alias("ts"))
    said = lambda array, n, df: F.transform(array, lambda t: F.struct(t.alias("token"), F.lit(n).alias("n"), F.lit(df).alias("df")))
    both = ts.select(F.explode(F.concat(said(F.col("ts"), 1, 0), said(F.array_distinct("ts"), 0, 1))).alias("x"))
    return both.groupBy("x.token").agg(F.sum("x.n").alias("n"), F.sum("x.df").alias("df"))


def bm25(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """``query_id, doc_id, score, rank`` (from 0). Only tokens that some query has reach the shuffle."""
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    rows = docs.select("doc_id", tokens(F.col("text")).alias("ts"))
    lengths = rows.agg(F.count("*").alias("docs"), F.avg(F.size("ts")).alias("mean_len"))
    hits = rows.select("doc_id", F.size("ts").alias("len"), F.explode("ts").alias("token")).join(asked.select("token").distinct(), "token", "left_semi")
    tf = hits.groupBy("doc_id", "len", "token").agg(F.count("*").alias("tf"))
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    n, length = F.col("docs"), F.col("len") / F.col("mean_len")
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * length))
    scored = asked.join(tf.join(df, "token"), "token").crossJoin(F.broadcast(lengths)).groupBy("query_id", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))
    return ranked(scored, top)


def ranked(scored: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each query, from 0. The bound stands on the row number itself, so that tasks drop the rest before the shuffle."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return scored.withColumn("rank", place).where(F.col("rank") <= top).withColumn("rank", F.col("rank") - 1)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """Exact cosine of unit vectors of one length, all queries against all rows; null vectors are left out.

    ``queries``: ``query_id, embedding``; they are read when this is called and broadcast, in parts of at most about
    ``QUERY_BYTES``, each of which meets all rows in a pass of its own. Rows meet queries in blocks, and a task hands on only
    the ``top`` of every query.
    """
    known = queries.where("embedding is not null").select(F.col("query_id").cast("long"), "embedding")
    size = known.agg(F.sum(F.size("embedding").cast("long"))).first()[0] or 0
    parts = max(1, -(-8 * size // QUERY_BYTES))
    found = [_nearest_part(vectors, known.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == k), top) for k in range(parts)]
    return ranked(reduce(DataFrame.unionByName, found), top)


def _nearest_part(vectors: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    block, some = BLOCK, QUERY_BLOCK
    held = vectors.sparkSession.sparkContext.broadcast(queries.toArrow().combine_chunks())

    def met(batches):
        asked = held.value
        best = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                rows = batch.slice(lo, block)
                ids = rows.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                ids, matrix = ids[order], _matrix(rows.column(1))[order].T
                for at in range(0, asked.num_rows, some):
                    score = np.round(_matrix(asked.column("embedding").slice(at, some).combine_chunks()) @ matrix, 6) + 0.0
                    near = np.argsort(-score, axis=1, kind="stable")[:, :top]
                    found = ids[near], np.take_along_axis(score, near, axis=1)
                    if at in best:
                        both = [np.concatenate(x, axis=1) for x in zip(best[at], found, strict=True)]
                        near = np.lexsort((both[0], -both[1]), axis=1)[:, :top]
                        found = tuple(np.take_along_axis(x, near, axis=1) for x in both)
                    best[at] = found
        for at, (ids, score) in best.items():
            who = asked.column("query_id").slice(at, some).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.repeat(who, ids.shape[1]), ids.ravel(), score.ravel())], names=["query_id", "doc_id", "score"])

    spread = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.where("embedding is not null").select(F.col("doc_id").cast("long"), "embedding").repartition(spread)
    return rows.mapInArrow(met, "query_id long, doc_id long, score double")


def fuse(lists: list[DataFrame], k: int = RRF_K, top: int = 10) -> DataFrame:
    """Reciprocal ranks (from 0), summed by union and one aggregation; of equal sums the earlier list's order holds."""
    parts = [x.select("query_id", "doc_id", (1 / (F.col("rank") + k)).alias("part"), F.lit(i).alias("source"), "rank") for i, x in enumerate(lists)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    summed = both.groupBy("query_id", "doc_id").agg(F.round(F.sum("part"), 9).alias("score"), F.min(F.struct("source", "rank")).alias("first"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "first", "doc_id"))
    return summed.withColumn("rank", place).where(F.col("rank") <= top).select("query_id", "doc_id", "score", (F.col("rank") - 1).alias("rank"))


def reranked(hits: DataFrame, queries: DataFrame, docs: DataFrame) -> DataFrame:
    """Hits by share of the query's tokens they have: a stand-in for a cross-encoder, with the same interface."""
    asked = queries.select("query_id", F.array_distinct(tokens(F.col("text"))).alias("asked"))
    had = docs.select("doc_id", F.array_distinct(tokens(F.col("text"))).alias("had"))
    share = F.round(F.try_divide(F.size(F.array_intersect("asked", "had")), F.size("asked")), 6)
    rows = hits.join(asked, "query_id").join(had, "doc_id").select("query_id", "doc_id", F.coalesce(share, F.lit(0.0)).alias("rerank_score"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "doc_id")) - 1)
