"""Queries over labels, numbers, documents and conversations: splits, profiles, retrieval, catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinelake.functions.text import filled
from kinelake.operators import catalog, dataset, profiling, retrieval
from kinelake.plans.tables import FRAMES, frames, query, read

_LB = "lb as (select doc_id, quality as label, md5(doc_id::varchar) as h from labels)"


def _labels(spark, sf_dir):
    return read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


@query("select count(*) filter (quality > 0) as fall, count(*) filter (quality = 0) as nofall, count(*) as total from labels")
def label_counts(spark, sf_dir):
    return dataset.label_counts(_labels(spark, sf_dir))


@query(f"with {_LB} select doc_id, label, case when row_number() over (partition by label order by h, doc_id) <= round_even(count(*) over (partition by label) * 0.1::double, 0) then 'val' else 'train' end as part from lb")
def stratified_split(spark, sf_dir):
    return dataset.stratified_split(_labels(spark, sf_dir), "label", "doc_id").select("doc_id", "label", "part")


_BAL = f"with {_LB}, r as (select *, row_number() over (partition by label order by h, doc_id) as r from lb), n as (select least(count(*) filter (label > 0), count(*) filter (label = 0)) as n from lb)"


@query(f"{_BAL} select doc_id, label from r, n where r <= n")
def balanced_downsample(spark, sf_dir):
    return dataset.balanced(_labels(spark, sf_dir), "label", "doc_id").select("doc_id", "label")


@query(f"{_BAL} select doc_id, label from r, n where r <= least(n, 25)")
def balanced_preview(spark, sf_dir):
    return dataset.balanced(_labels(spark, sf_dir), "label", "doc_id", 25).select("doc_id", "label")


@query("select vec_id, i::int as position, round(embedding[i + 1]::double, 6) as value from (select * from embeddings order by vec_id limit 20), range(0, 64) r(i)")
def long_export(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return dataset.head_long(e, "vec_id", "embedding").select("vec_id", "position", F.round(F.col("value").cast("double"), 6).alias("value"))


@query(f"with {FRAMES} select video, frame_idx as sample_idx, case when event_type = 'error' then 1 else 0 end as label, round(ts, 6) as start_time, round(ts + 1, 6) as end_time, case when event_type = 'error' then 'fall' else 'nofall' end as label_name, 11 as num_frames from fr")
def sample_details(spark, sf_dir):
    f = frames(spark, sf_dir).select("video", "frame_idx", (F.col("event_type") == "error").cast("int").alias("label"), F.round("ts", 6).alias("start_time"), F.round(F.col("ts") + 1, 6).alias("end_time"), F.lit(11).alias("num_frames"))
    return dataset.sample_details(f, ["frame_idx"])


_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" union all ".join(f"select '{c}' as name, count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, round(stddev_pop({c}), 4) as std_pop, min({c})::double as low, round(quantile_cont({c}, 0.25), 4)::double as q25, round(quantile_cont({c}, 0.5), 4)::double as q50, round(quantile_cont({c}, 0.75), 4)::double as q75, max({c})::double as high from lineitem" for c in _COLUMNS))
def profile(spark, sf_dir):
    d = profiling.describe(read(spark, sf_dir, "lineitem"), _COLUMNS)
    return d.select("name", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "std_pop")], "low", *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75")], "high")


@query("select count(*) filter (abs(value - m) > 3 * s) as outliers, count(*) as n from events, (select avg(value) as m, stddev_samp(value) as s from events)")
def outliers_3sigma(spark, sf_dir):
    return profiling.beyond_sigma(read(spark, sf_dir, "events"), "value")


@query("select round(avg(abs(l_discount + l_tax)), 6) as mean_abs_sum, round(corr(l_discount, l_tax), 6) as corr, avg(abs(l_discount + l_tax)) < 1 as negated from lineitem")
def corr_negation(spark, sf_dir):
    n = profiling.negation(read(spark, sf_dir, "lineitem"), "l_discount", "l_tax")
    return n.select(F.round("mean_abs_sum", 6).alias("mean_abs_sum"), F.round("corr", 6).alias("corr"), "negated")


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_extendedprice < 2000 or l_extendedprice > 50000")
def range_check(spark, sf_dir):
    return profiling.out_of_range(read(spark, sf_dir, "lineitem"), "l_extendedprice", 2000, 50000).select("l_orderkey", "l_linenumber", "l_extendedprice")


_CHUNKS = "ch as (select doc_id, (k + 1)::int as chunk_id, substr(text, (k * 236 + 1)::bigint, 256) as chunk_content from (select doc_id, text, unnest(range(0, ceil(length(text) / 236.0)::bigint)) as k from documents))"


@query(f"with {_CHUNKS} select * from ch")
def chunk_text(spark, sf_dir):
    return retrieval.chunked(read(spark, sf_dir, "documents"))


@query(f"with {_CHUNKS} select doc_id, string_agg(chr(10) || chunk_content, '' order by chunk_id) as abstract from ch where chunk_id <= 4 group by 1")
def doc_abstract(spark, sf_dir):
    pages = retrieval.chunked(read(spark, sf_dir, "documents")).select("doc_id", (F.col("chunk_id") - 1).alias("page_number"), F.col("chunk_content").alias("content"))
    return retrieval.abstracts(pages)


@query("""with t as (select page_id as doc_id, regexp_replace(html, '<[^>]*>', ' ', 'g') as text from pages) select doc_id, (k + 1)::int as chunk_id, substr(text, (k * 236 + 1)::bigint, 256) as chunk_content from (select doc_id, text, unnest(range(0, ceil(length(text) / 236.0)::bigint)) as k from t)""")
def page_chunks(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.regexp_replace("html", "<[^>]*>", " ").alias("text"))
    return retrieval.chunked(pages)


_TOK = "tk as (select doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')) as token from documents)"


@query(f"with {_TOK} select token, count(*) as n, count(distinct doc_id) as df from tk group by 1")
def token_stats(spark, sf_dir):
    return retrieval.token_stats(read(spark, sf_dir, "documents"))


def _asked(spark, sf_dir):
    """The questions: every benchmark item whose id is divisible by 20, in full."""
    return read(spark, sf_dir, "benchmark").where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), "text")


_BM25 = f"""{_TOK}, qt as (select distinct item_id as query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) as token from benchmark where item_id % 20 = 0),
 ln as (select d.doc_id, count(token) as len from documents d left join tk using (doc_id) group by 1), st as (select count(*) as n, avg(len) as a from ln),
 tf as (select doc_id, token, count(*) as tf from tk where token in (select token from qt) group by 1, 2), df as (select token, count(*) as df from tf group by 1),
 sc as (select query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / a))), 6) as score from qt join tf using (token) join df using (token) join ln using (doc_id), st group by 1, 2),
 lex as (select * from (select *, row_number() over (partition by query_id order by score desc, doc_id) - 1 as rank from sc) where rank < 50)"""


@query(f"with {_BM25} select * from lex")
def bm25_topk(spark, sf_dir):
    return retrieval.bm25(read(spark, sf_dir, "documents"), _asked(spark, sf_dir)).select("query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


_KNN = """vs as (select q.vec_id as query_id, e.vec_id as doc_id, round(list_sum(list_transform(range(1, 65), lambda i: e.embedding[i]::double * q.embedding[i]::double)), 6) as score from embeddings e, (select * from embeddings where vec_id % 20 = 0) q),
 vec as (select * from (select *, row_number() over (partition by query_id order by score desc, doc_id) - 1 as rank from vs) where rank < 50)"""


def _near(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").withColumn("doc_id", F.col("vec_id"))
    return retrieval.nearest(e, e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"))


@query(f"with {_KNN} select query_id, doc_id, score, rank from vec")
def knn_topk(spark, sf_dir):
    return _near(spark, sf_dir).select("query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"""with {_BM25}, {_KNN}, pt as (select query_id, doc_id, 1.0::double / (rank + 60) as part, 0 as source, rank from lex union all select query_id, doc_id, 1.0::double / (rank + 60), 1, rank from vec),
 sm as (select query_id, doc_id, round(sum(part), 9) as score, min(source * 1000 + rank) as f from pt group by 1, 2)
 select query_id, doc_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, f, doc_id) - 1 as rank from sm) where rank < 10""")
def rrf_hybrid(spark, sf_dir):
    fused = retrieval.fuse([bm25_topk(spark, sf_dir), knn_topk(spark, sf_dir)])
    return fused.select("query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"""with {_BM25}, ov as (select lex.query_id, lex.doc_id, (select count(*) from qt where qt.query_id = lex.query_id and qt.token in (select token from tk where tk.doc_id = lex.doc_id)) as hit, (select count(*) from qt where qt.query_id = lex.query_id) as n from lex)
 select query_id, doc_id, round(hit / n::double, 6) as rerank_score, row_number() over (partition by query_id order by round(hit / n::double, 6) desc, doc_id) - 1 as rank from ov""")
def rerank_topk(spark, sf_dir):
    asked, docs = _asked(spark, sf_dir), read(spark, sf_dir, "documents")
    return retrieval.reranked(retrieval.bm25(docs, asked), asked, docs).select("query_id", "doc_id", "rerank_score", F.col("rank").cast("long").alias("rank"))


# --- catalogue: a knowledge base for each nation of the tables, documents of them ---


def _bases(spark, sf_dir):
    return read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("knowledge_id"), F.col("n_name").alias("title"))


def _documents(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(F.col("doc_id").cast("int").alias("document_id"), F.substring("text", 1, 20).alias("title"), (F.col("doc_id") % 30).cast("int").alias("knowledge_id"), F.col("lang").alias("category"))


_KB = "kb as (select n_nationkey::int as knowledge_id, n_name as title from nation), dc as (select doc_id::int as document_id, substr(text, 1, 20) as title, (doc_id % 30)::int as knowledge_id, lang as category from documents)"


@query(f"with {_KB} select k::int as knowledge_id, title, case when title is null then 404 else 200 end as response_code from range(20, 30) r(k) left join kb on kb.knowledge_id = k")
def kb_get(spark, sf_dir):
    return catalog.get(_bases(spark, sf_dir), "knowledge_id", spark.range(20, 30).select(F.col("id").cast("int").alias("knowledge_id")))


@query(f"with {_KB} select * from kb union all select 1000, 'NEW'")
def kb_insert(spark, sf_dir):
    return catalog.insert(_bases(spark, sf_dir), spark.range(1).select(F.lit(1000).alias("knowledge_id"), F.lit("NEW").alias("title")))


@query(f"with {_KB} select document_id, knowledge_id from dc where knowledge_id not in (3, 4, 5)")
def kb_delete(spark, sf_dir):
    gone = spark.range(3, 6).select(F.col("id").cast("int").alias("knowledge_id"))
    return catalog.delete_base(_bases(spark, sf_dir), _documents(spark, sf_dir), gone)[1].select("document_id", "knowledge_id")


@query(f"with {_KB} select k::int as document_id, title, knowledge_id, category, case when category is null then 404 else 200 end as response_code from range(190, 210) r(k) left join dc on document_id = k where k <> 666")
def doc_get(spark, sf_dir):
    return catalog.get(_documents(spark, sf_dir), "document_id", spark.range(190, 210).select(F.col("id").cast("int").alias("document_id")))


@query(f"with {_KB} select document_id from dc where document_id % 2 = 0 union all select document_id from dc where document_id % 2 <> 0 and knowledge_id in (select knowledge_id from kb)")
def doc_insert_fk(spark, sf_dir):
    """Documents of even number are there; all others are new."""
    d = _documents(spark, sf_dir)
    return catalog.insert_document(d.where("document_id % 2 = 0"), d.where("document_id % 2 <> 0"), _bases(spark, sf_dir)).select("document_id")


@query(f"with {_KB} select document_id from dc where document_id >= 40")
def doc_delete(spark, sf_dir):
    d = _documents(spark, sf_dir)
    return catalog.delete(d, "document_id", d.where("document_id < 40")).select("document_id")


@query(f"with {_KB} select document_id, case when document_id in (1, 2, 3) then 'changed' else category end as category from dc")
def doc_update(spark, sf_dir):
    return catalog.update(_documents(spark, sf_dir), "document_id", [1, 2, 3], category=F.lit("changed")).select("document_id", "category")


@query(f"with {_KB} select kb.title, count(*) as n from dc join kb using (knowledge_id) group by 1")
def kb_documents(spark, sf_dir):
    return _documents(spark, sf_dir).drop("title").join(_bases(spark, sf_dir), "knowledge_id").groupBy("title").agg(F.count("*").alias("n"))


_PROMPT = "Answer from the material.\nMaterial: {#material#}\nQuestion: {#question#}\n"


@query("select conv_id, 'Answer from the material.' || chr(10) || 'Material: conversation ' || conv_id || chr(10) || 'Question: ' || text || chr(10) as prompt from conversations where role = 'user' and turn = 0")
def chat_prompt(spark, sf_dir):
    """Only a first question is filled into the template; later turns go as they are."""
    first = read(spark, sf_dir, "conversations").where("role = 'user' and turn = 0")
    return first.select("conv_id", filled(_PROMPT, material=F.concat(F.lit("conversation "), F.col("conv_id").cast("string")), question=F.col("text")).alias("prompt"))


@query("select r_name, n_name, count(*) as orders, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2")
def catalogue_totals(spark, sf_dir):
    t = lambda n: read(spark, sf_dir, n)
    j = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
