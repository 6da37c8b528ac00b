"""Exact Jaccard join of sets of word n-grams by prefixes under several global token orders.

Tokens are ordered by how many documents have them (one, and by powers of eight), then by a hash; each order has a hash of
its own. Words and sets are told apart by 64-bit hashes of words and of shingles.
Two sets of similarity ``percent`` or more share a token among the first ``n - ceil(percent n / 100) + 1`` of either under
every such order. Tokens of one document only can't be shared, so a document needs enough others to have partners at all.

Which tokens are shared, and by how many, is held in bitmaps sized by their numbers, at most 128 MB each. A false bit moves a
token in the order, for all documents alike, and costs work but no link. Candidates come from shared prefix tokens of the first order and are dropped
unless prefixes meet under all other orders, for which only prefixes are fetched; the sets of those left are then compared. Groups of many documents around one text are
first held against their most typical member; what that leaves in different components is compared pair by pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm.components import components
from kinelake.llm.shared import bitmap, bitmaps, bits_for, in_bitmap, masked, partitions, stored, table
from kinelake.llm.words import Words, mix, runs, shard_of, slices_by, texts_of

GRAM, PERCENT, ORDERS, FLUSH_TOKENS, HOT_KEYS = 5, 75, 3, 1_000_000, 10_000
#: a token's grade in the order: how many of these numbers of documents it reaches
GRADES = (2, 8, 64, 512, 4096)
_SEEDS = [np.uint64(s) for s in (0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def shingles(words: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of fewer words, the one of all; of none, none."""
    return np.unique(mix(runs(words, min(gram, len(words))))) if len(words) else np.zeros(0, np.uint64)


def _sets(batches, gram: int, wanted: np.ndarray | None = None):
    """``doc_id, set`` of rows ``doc_id, text``; if given, of those whose ``doc_id`` is in the bitmap."""
    for batch in batches:
        if wanted is not None:
            batch = batch.filter(pa.array(in_bitmap(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), wanted)))
        for lo in range(0, batch.num_rows, 256):
            some = batch.slice(lo, 256)
            words = Words([t.lower() for t in texts_of(some.column(1))])
            for key, n, last in zip(some.column(0).to_pylist(), words.size.tolist(), words.last.tolist(), strict=True):
                yield key, shingles(words.hash[last - n : last], gram)


def _sign(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets have in common; the entries are spread evenly already."""
    return int(s.sum(dtype=np.uint64).astype(np.int64)), int((s * s).sum(dtype=np.uint64).astype(np.int64))


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kind.types, strict=True)], schema=kind)


def _signatures(docs: DataFrame, gram: int) -> DataFrame:
    """``doc_id, n_shingles, s1, s2, t`` of every row ``doc_id, text, t``."""

    def sign(batches):
        for batch in batches:
            rows = [(key, len(s), *_sign(s)) for key, s in _sets([batch], gram)]
            yield pa.RecordBatch.from_arrays([*_batch(rows, kind).columns, batch.column(2)], names=[*kind.names, "t"])

    kind = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_shingles", "s1", "s2")])
    return docs.mapInArrow(sign, "doc_id long, n_shingles long, s1 long, s2 long, t long")


def grade(tokens: np.ndarray, graded: list[np.ndarray]) -> np.ndarray:
    """How many of the bitmaps' numbers of documents each token reaches (bitmaps without the first)."""
    out = np.zeros(len(tokens), np.uint8)
    for bits in graded[1:]:
        out += in_bitmap(tokens, bits)
    return out


def token_bitmaps(docs: DataFrame, firsts, gram: int = GRAM, grades: tuple[int, ...] = GRADES, bits: int | None = None) -> list[np.ndarray]:
    """For each of ``grades`` the bitmap of the tokens that so many documents have, counted over the first of equal sets.

    Tokens are shuffled as ``width`` bytes, in blocks: as few as keep chance meetings of the expected number rare. The
    bitmaps are sized by the numbers of their tokens unless ``bits`` is given.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width, shards = (5 if size < 1 << 36 else 6 if size < 1 << 43 else 8), 4 * partitions(docs)

    def narrow(h: np.ndarray) -> bytes:
        return h.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()

    def flush(sets: list[np.ndarray]):
        h, n = np.unique(np.concatenate(sets), return_counts=True)
        out = [(b, narrow(h[i][n[i] == 1]), narrow(h[i][n[i] > 1]), np.minimum(n[i][n[i] > 1], 255).astype(np.uint8).tobytes()) for b, i in slices_by(shard_of(h << np.uint64(24), shards))]
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)]], names=["shard", "once", "often", "times"])

    def emit(batches):
        sets, total = [], 0
        for _, s in _sets(batches, gram, firsts.value):
            if len(s):
                sets.append(s)
                total += len(s)
            if total >= FLUSH_TOKENS:
                yield flush(sets)
                sets, total = [], 0
        if sets:
            yield flush(sets)

    def wide(blobs: list[bytes]) -> np.ndarray:
        raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
        out = np.zeros((len(raw), 8), np.uint8)
        out[:, :width] = raw
        return out.reshape(-1).view(np.uint64)

    def count(found: pa.Table) -> pa.Table:
        once, often = wide(found["once"].to_pylist()), wide(found["often"].to_pylist())
        times = np.frombuffer(b"".join(found["times"].to_pylist()), np.uint8)
        h, at = np.unique(np.concatenate([once, often]), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.ones(len(once)), times]), len(h))
        return pa.table({"token": pa.array(h[n > 1].view(np.int64)), "n": pa.array(n[n > 1].astype(np.int64))})

    found = docs.select("doc_id", "text").mapInArrow(emit, "shard int, once binary, often binary, times binary").groupBy("shard").applyInArrow(count, "token long, n long")
    found = stored(found, "tokens")
    numbers = found.agg(*[F.count_if(F.col("n") >= g).alias(f"g{g}") for g in grades]).first()
    level = sum(((F.col("n") >= g).cast("int") for g in grades[1:]), F.lit(1))
    return bitmaps(found, "token", level, [bits or bits_for(numbers[f"g{g}"]) for g in grades])


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix(shared: np.ndarray, grades: np.ndarray, n: int, order: int, percent: int) -> np.ndarray:
    """Shared tokens among the first ones of a set of ``n`` under an order; tokens of one document come first of all."""
    places = n - least_overlap(n, percent) + 1 - (n - len(shared))
    if places <= 0:
        return shared[:0]
    return shared[np.lexsort((mix(shared ^ _SEEDS[order]), grades))[:places]]


def _candidates(docs: DataFrame, firsts, graded, gram: int, percent: int) -> DataFrame:
    """``doc_id, s1, s2, n, shared`` (bytes), ``m`` (tokens that many have) of the documents with shared tokens enough."""

    def pick(batches):
        rows: list[tuple] = []
        for key, s in _sets(batches, gram, firsts.value):
            mine = s[in_bitmap(s, graded.value[0])]
            if len(s) and len(mine) >= least_overlap(len(s), percent):
                rows.append((key, *_sign(s), len(s), mine.tobytes(), int((grade(mine, graded.value) > 0).sum())))
            if len(rows) >= 1000:
                yield _batch(rows, kind)
                rows = []
        yield _batch(rows, kind)

    kind = pa.schema([*[(c, pa.int64()) for c in ("doc_id", "s1", "s2", "n")], ("shared", pa.binary()), ("m", pa.int64())])
    return docs.select("doc_id", "text").mapInArrow(pick, "doc_id long, s1 long, s2 long, n long, shared binary, m long")


def _postings(cands: DataFrame, graded, percent: int) -> DataFrame:
    """``token, class, n, s`` (shared tokens), ``m`` (those that many have), ``early`` of the prefixes under the first order.

    Sets of which the other is no smaller must overlap more, so they meet in a shorter prefix of the smaller: ``early``.
    """

    def early(n: int) -> int:
        return -(-2 * percent * n // (100 + percent))

    def post(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                out: list[list] = [[], [], [], [], [], []]
                for key, n, raw, m in zip(*[batch.slice(lo, 512).column(i).to_pylist() for i in range(4)], strict=True):
                    mine = np.frombuffer(raw, np.uint64)
                    tokens = prefix(mine, grade(mine, graded.value), n, 0, percent)
                    for column, v in zip(out, (tokens.view(np.int64), *[np.full(len(tokens), x) for x in (key, n, len(mine), m)], np.arange(len(tokens)) < len(mine) - early(n) + 1), strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["token", "class", "n", "s", "m", "early"])

    return cands.select("class", "n", "shared", "m").mapInArrow(post, "token long, class long, n long, s long, m long, early boolean")


def _filters(cands: DataFrame, graded, orders: int, percent: int) -> DataFrame:
    """``class, prefixes``: of every order but the first, the prefix's tokens, each by its last 32 bits, sorted.

    Tokens that meet in these bits by chance keep a pair for verification; a pair whose prefixes meet is never lost.
    """

    def cut(batches):
        for batch in batches:
            found = []
            for n, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                mine = np.frombuffer(raw, np.uint64)
                grades = grade(mine, graded.value)
                found.append([np.unique(prefix(mine, grades, n, o, percent).astype(np.uint32)).tobytes() for o in range(1, orders)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["class", "prefixes"])

    return cands.select("class", "n", "shared").mapInArrow(cut, "class long, prefixes array<binary>")


def _sided(pairs: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs ``a, b`` with the columns of both their classes, as ``<column>_a`` and ``<column>_b``."""
    sides = [facts.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", *[f"{c}_{x}" for c in columns for x in "ab"])


def _chosen(rows: DataFrame, good) -> DataFrame:
    """``a, b`` of the rows for whose further columns ``good`` is true."""

    def choose(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                kept = [good(*facts) for facts in zip(*[some.column(i).to_pylist() for i in range(2, some.num_columns)], strict=True)]
                yield some.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return rows.mapInArrow(choose, "a long, b long")


def _meet(x: bytes, y: bytes, kind: type) -> int:
    return len(np.intersect1d(np.frombuffer(x, kind), np.frombuffer(y, kind), assume_unique=True))


def filtered(pairs: DataFrame, filters: DataFrame) -> DataFrame:
    """Of pairs ``a, b``, those whose prefixes meet under all the other orders. Only prefixes are fetched, no sets."""
    return _chosen(_sided(pairs, filters, ["prefixes"]), lambda x, y: all(_meet(p, q, np.uint32) for p, q in zip(x, y, strict=True)))


def verified(pairs: DataFrame, cands: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a, b``, those that are similar by their whole sets."""

    def similar(na: int, nb: int, x: bytes, y: bytes) -> bool:
        common = _meet(x, y, np.uint64)
        return 100 * common >= percent * (na + nb - common)

    return _chosen(_sided(pairs, cands, ["n", "shared"]), similar)


_CLASS = ["s1", "s2", "n_shingles"]


def jaccard_components(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, orders: int = ORDERS, bits: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the smallest ``doc_id`` reachable by links.

    Texts are lower-cased (A-Z) and cut into words at white space (9-13, 32); a text of fewer words than ``gram`` has one
    shingle, an empty or null text none and no links; very long texts are taken whole. Equal sets (ties) are one class, and
    links are looked for between classes, so no link between different texts is lost. Rows that repeat a ``doc_id`` with
    other texts are classes of their own, and each gets its class's component; a null ``doc_id`` joins the component of its
    text; an empty table stays empty; other columns are not looked at. ``bits`` fixes the size of the bitmaps.
    """
    return _components(docs, gram, percent, orders, bits).select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def _components(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, orders: int = ORDERS, bits: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, s1, s2, t`` (hash of the text) and ``component`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
    known = rows.where("doc_id is not null")
    signed = stored(_signatures(rows, gram), "signatures")
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*_CLASS).agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    classes = stored(classes.withColumn("class", F.xxhash64(*_CLASS)), "classes")
    context = docs.sparkSession.sparkContext
    number = classes.agg(F.count("*"), F.sum("rows")).first()
    # bitmaps of at most 128 MB; a false bit in the first lets a copy through
    firsts = context.broadcast(bitmap(classes, "first", bits or bits_for(number[0])))
    graded = context.broadcast(token_bitmaps(known, firsts, gram, GRADES, bits))
    found = _candidates(known, firsts, graded, gram, percent).withColumnRenamed("n", "n_shingles")
    cands = found.join(classes.select(*_CLASS, F.col("first").alias("doc_id"), "class"), [*_CLASS, "doc_id"]).dropDuplicates(["class"])
    cands = stored(cands.select("class", F.col("n_shingles").alias("n"), "shared", "m"), "candidates")
    posts = stored(_postings(cands, graded, percent), "postings")
    filters = stored(_filters(cands, graded, orders, percent), "filters")

    def may_link(x: str, y: str):
        """Of the tokens that many have, and of those that a few have, the overlap is at most the fewer of the two."""
        n, s, m = (tuple(F.col(c + k) for k in (x, y)) for c in "nsm")
        overlap = F.least(*m) + F.least(s[0] - m[0], s[1] - m[1])
        return 100 * overlap >= percent * (n[0] + n[1] - overlap)

    def side(rows: DataFrame, x: str) -> DataFrame:
        return rows.select("token", F.col("class").alias(x), *[F.col(c).alias(c + x) for c in "nsm"], *[F.col("component").alias("c" + x) for c in rows.columns if c == "component"])

    # the most typical document of each token's group: few tokens of its own, then the smallest id
    centre = posts.groupBy("token").agg(F.min(F.struct((1 - F.col("m") / F.col("n")).alias("rare"), "class", "n", "s", "m")).alias("c"), F.count("*").alias("k"))
    star = side(posts, "a").join(side(centre.where("k > 1").select("token", "c.*"), "b"), "token").where((F.col("a") != F.col("b")) & may_link("a", "b"))
    pairs = stored(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = stored(verified(stored(filtered(pairs, filters), "filtered"), cands, percent), "links")
    placed = posts.join(components(links).withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    placed = stored(placed, "placed")
    open_tokens = placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    rest = placed.join(open_tokens, "token")
    # of two sets of one size, that with fewer shared tokens (and so fewer early ones) stands on the early side
    across = side(rest.where("early"), "a").join(side(rest, "b"), "token")
    across = across.where((F.struct("na", "sa", "a") < F.struct("nb", "sb", "b")) & (F.col("ca") != F.col("cb")) & may_link("a", "b"))
    more = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    edges = links.unionByName(verified(stored(filtered(more, filters), "across"), cands, percent))
    # a component's least doc_id is that of one of its classes
    linked = classes.join(components(edges).withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = linked.groupBy("component").agg(F.min("first").alias("least"), F.count("*").alias("of"))
    named = _dealt_join(linked, least, ["component"], "of", number[0]).select(*_CLASS, "rows", "least")
    return _dealt_join(signed, named, _CLASS, "rows", number[1] or 0).select("doc_id", *_CLASS, "t", F.coalesce("least", "doc_id").alias("component"))


def _dealt_join(rows: DataFrame, facts: DataFrame, key: list[str], number: str, total: int) -> DataFrame:
    """``rows`` left join ``facts`` (one row a key, with the ``number`` of its rows), where a key may have most of ``total`` rows.

    Keys of more than ``total / HOT_KEYS`` rows (there are fewer than ``HOT_KEYS``) are known to all tasks, and dealt over several salts.
    """
    share = max(64, total // HOT_KEYS)
    parts = F.when(F.col(number) > share, F.ceil(F.col(number) / share)).otherwise(1).cast("int")
    hot = F.broadcast(facts.where(F.col(number) > share).select(*key, parts.alias("_parts")))
    salted = rows.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.coalesce("_parts", F.lit(1))).cast("int"))
    dealt = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop(number)
    return salted.join(dealt, [*key, "_salt"], "left").drop("_parts", "_salt")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of smallest ``doc_id`` of each component, once; rows without a ``doc_id`` stay.

    Of rows that have this ``doc_id`` in common, one of each class stays, as unlike texts needn't be copies of each other.
    Null, empty and very long texts, ties and empty tables are as in ``jaccard_components``; all columns are returned as they are.
    """
    rows, restored = masked(docs, ("doc_id", "text"))
    first = _components(docs).where("doc_id = component").groupBy(F.col("doc_id").alias("_kl_id"), *_CLASS).agg(F.min("t").alias("_kl_t"))
    known = rows.where("doc_id is not null").withColumns({"_kl_id": F.col("doc_id").cast("long"), "_kl_t": F.xxhash64("text")})
    kept = known.join(first.select("_kl_id", "_kl_t").distinct(), ["_kl_id", "_kl_t"], "left_semi").dropDuplicates(["_kl_id", "_kl_t"])
    return restored(kept.drop("_kl_id", "_kl_t").unionByName(rows.where("doc_id is null")))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
