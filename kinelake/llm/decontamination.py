"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Training words are streamed through the automaton; at each word the length of the longest suffix that occurs in some
item is known. Where it reaches the window, the last words are a passage of an item.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import defaultdict
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.llm.shared import masked, table

WINDOW, BLOCK_BYTES, MAX_ITEM_BYTES, MAX_COVERAGE = 10, 2 << 20, 1 << 30, 0.5

#: Bytes outside words become spaces and A-Z become a-z; bytes of other scripts stay, so no code point is cut.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_FOLD).split() if text else []


class SuffixAutomaton:
    """Of several word sequences. ``follow`` streams a sequence and reports where windows end."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], defaultdict(set)
        short = []
        for key, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            last = 0
            for c in ids:
                last = self._extend(last, c)
                self.ends[last].add(key)
            if 0 < len(ids) < window:
                short.append((key, ids))
        self.children = defaultdict(list)
        for v, u in enumerate(self.link):
            if u >= 0:
                self.children[u].append(v)
        # whole items shorter than a window: the state that holds them, and from there to all longer matches
        self.short = defaultdict(list)
        for key, ids in short:
            v = 0
            for c in ids:
                v = self.next[v][c]
            self.short[v].append((len(ids), key))
        self.has_short, self.at_window, self.found = [False] * len(self.link), [-1] * len(self.link), {}
        for v in sorted(range(len(self.link)), key=self.length.__getitem__):
            u = self.link[v]
            self.has_short[v] = v in self.short or (u >= 0 and self.has_short[u])
            if self.length[v] >= window:
                self.at_window[v] = v if self.length[u] < window else self.at_window[u]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def items_at(self, state: int) -> set[str]:
        """Items in which the strings of a state occur."""
        if state not in self.found:
            out, todo = set(), [state]
            while todo:
                v = todo.pop()
                out |= self.ends.get(v, set())
                todo += self.children.get(v, ())
            self.found[state] = out
        return self.found[state]

    def follow(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans of words inside windows, and the items that have these windows."""
        nxt, link, length, get, window = self.next, self.link, self.length, self.vocab.get, self.window
        spans: list[list[int]] = []
        items: set[str] = set()
        v = n = 0
        for i, w in enumerate(words):
            c = get(w)
            if c is None:
                v = n = 0
                continue
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            else:
                while v > 0 and c not in nxt[v]:
                    v = link[v]
                n = length[v] + 1 if c in nxt[v] else 0
                v = nxt[v].get(c, 0)
            back = 0
            if n >= window:
                back = window
                items |= self.items_at(self.at_window[v])
            if self.has_short[v]:
                u = v
                while u > 0 and self.has_short[u]:
                    for m, key in self.short.get(u, ()):
                        if m <= n:
                            back = max(back, m)
                            items.add(key)
                    u = link[u]
            if back:
                if spans and spans[-1][1] >= i - back + 1:
                    spans[-1][0], spans[-1][1] = min(spans[-1][0], i - back + 1), i + 1
                    while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                        a, b = spans.pop()
                        spans[-1][0], spans[-1][1] = min(spans[-1][0], a), b
                else:
                    spans.append([i - back + 1, i + 1])
        return [(a, b) for a, b in spans], items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_compiled: dict[tuple, SuffixAutomaton] = {}


def _automaton(name: tuple, block: list[tuple], window: int) -> SuffixAutomaton:
    """One automaton at a time stays in a worker, for its later tasks."""
    if name not in _compiled:
        _compiled.clear()
        _compiled[name] = SuffixAutomaton([(k, words_of(t)) for k, t in block], window)
    return _compiled[name]


def _sorted_keys(keys: set) -> list:
    """As strings; a null one, if there, last."""
    return sorted(k for k in keys if k is not None) + [None] * (None in keys)


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``hit_spans`` (word places, end exclusive) and ``item_ids``.

    ``window`` consecutive words of an item, or a whole item of fewer words, make a window. Items without words have none;
    items of one ``item_id`` (or of none: it stands in ``item_ids`` as null, last) count as one item; a null text has no
    words; very long texts are streamed whole; repeated rows are judged alike; an empty table stays empty; columns of the
    input's with those three names are replaced.

    The items go to the tasks in blocks of about ``block_bytes`` of text, so that a task holds one block's automaton at a
    time: the first block's hits are found with the rows, without a shuffle; those of each further block in tasks of their
    own, and joined by ``doc_id`` and text. All items together may have ``MAX_ITEM_BYTES``; more raise an error.
    """
    docs = docs.drop("n_words", "hit_spans", "item_ids")
    known = items.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_ITEM_BYTES:
        raise ValueError(f"the items have {size} bytes of text; MAX_ITEM_BYTES is {MAX_ITEM_BYTES}")
    blocks, run = max(1, math.ceil(size / block_bytes)), uuid.uuid4().hex
    columns = docs.columns

    def scanned(rows: DataFrame, b: int, hits_only: bool) -> DataFrame:
        block = [(r[0], r[1].encode()) for r in known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toLocalIterator()]
        names = rows.columns
        at, width = names.index("text"), len(names)
        keep = [c for c in names if not (hits_only and c == "text")]

        def scan(batches):
            automaton = _automaton((run, b), block, window)
            for batch in batches:
                counts, hits, found = [], [], []
                for t in batch.column(at).cast(pa.binary()):
                    words = words_of(t.as_py())
                    spans, keys = automaton.follow(words)
                    counts.append(len(words))
                    hits.append([{"start": a, "end": e} for a, e in spans])
                    found.append(_sorted_keys(keys))
                added = [pa.array(counts, pa.int64()), pa.array(hits, _SPANS_ARROW), pa.array(found, pa.list_(pa.string()))]
                out = pa.RecordBatch.from_arrays([*batch.columns[:width], *added], names=[*names, "n_words", "hit_spans", "item_ids"])
                yield out.select([*keep, "n_words", "hit_spans", "item_ids"]).filter(pa.array([bool(h) for h in hits], pa.bool_())) if hits_only else out

        fields = [f for f in rows.schema.fields if f.name in keep]
        return rows.mapInArrow(scan, T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("hit_spans", _SPANS), T.StructField("item_ids", T.ArrayType(T.StringType()))]))

    out = scanned(docs, 0, False)
    if blocks == 1:
        return out
    key = [F.col("doc_id").alias("_kl_id"), F.xxhash64("text").alias("_kl_hash")]
    distinct = docs.where("text is not null").select(*key, "text")
    more = reduce(DataFrame.unionByName, [scanned(distinct, b, True) for b in range(1, blocks)])
    more = more.groupBy("_kl_id", "_kl_hash").agg(F.array_distinct(F.flatten(F.collect_set("hit_spans"))).alias("_kl_spans"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("_kl_items"))
    joined = out.join(more, F.col("doc_id").eqNullSafe(F.col("_kl_id")) & (F.xxhash64("text") == F.col("_kl_hash")), "left")
    ids = F.array_distinct(F.concat("item_ids", F.coalesce("_kl_items", F.array().cast("array<string>"))))
    ordered = F.concat(F.array_sort(F.filter(ids, lambda x: x.isNotNull())), F.filter(ids, lambda x: x.isNull()))

    @F.pandas_udf(_SPANS)
    def merged(a, b):
        import pandas as pd

        plain = lambda spans: [(s["start"], s["end"]) for s in spans] if spans is not None else []
        return pd.Series([[{"start": x, "end": y} for x, y in _merge(plain(p) + plain(q))] for p, q in zip(a, b, strict=True)])

    return joined.select(*columns, "n_words", F.when(F.col("_kl_spans").isNull(), F.col("hit_spans")).otherwise(merged("hit_spans", "_kl_spans")).alias("hit_spans"), ordered.alias("item_ids"))


def _without(text: str, spans: list) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_FOLD))]
    out, last = [], 0
    for s in spans:
        out.append(raw[last : at[s["start"]][0]])
        last = at[s["end"] - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` with its columns: hit spans are cut from the text, documents of which more than ``max_coverage`` of the words is hit go.

    ``n_chars``, where there is one, is counted again for changed texts; no other column is changed. Null, empty and very
    long texts, ties, repeated rows, empty tables and null items are as in ``find_contamination``; a text without words stays.
    """
    rows, restored = masked(docs, ("doc_id", "text"))
    found = find_contamination(rows, items, window)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = found.where(hit <= max_coverage * F.col("n_words"))

    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        return pd.Series([_without(t, s) if t is not None and len(s) else t for t, s in zip(text, spans, strict=True)])

    out = kept.withColumn("text", cut("text", "hit_spans"))
    if "n_chars" in docs.columns:
        at = rows.columns[docs.columns.index("n_chars")]
        out = out.withColumn(at, F.when(F.size("hit_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(at)))
    return restored(out)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
