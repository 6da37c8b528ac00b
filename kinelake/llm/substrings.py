"""Removal of repeated passages by repeated-phrase automata.

Nominate: every window of ``window`` words has an anchor, the phrase of half as many words inside it whose hash is least, so
equal windows have equal anchors wherever they stand. Hashes of anchors are shuffled (about a sixth as many as words);
anchors that occur once drop out.

Confirm: words around the other anchors go to the shard of the anchor, each different window once for some
megabytes of input. The shard compares windows word by word. Those that recur make passages, each known by its first place.

Locate: documents are dealt into blocks, and each block gets the passages that it needs. It compiles their phrases into
Aho-Corasick automata of bounded size, streams its whole documents through each, and extends every match word by word
along the passages with that phrase. Each occurrence found so, but the first place itself, is covered.

Nothing but the automata's matches, compared word by word, removes a word. A passage that fills a third of the rows reaches
a shard once for each part of the input, and a block once.
"""

from __future__ import annotations

import math
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelake.llm.shared import bitmap, bits_for, in_bitmap, partitions, stored, table
from kinelake.llm.words import Words, joined, mix, runs, shard_of, slices_by, texts_of

WINDOW, PART_BYTES, SHARD_BYTES, BLOCK_BYTES, PHRASES = 20, 3 << 20, 4 << 20, 6 << 20, 20_000


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least one of every ``width`` consecutive values, by doubling."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at


class _Part:
    """Words of some documents in one row, by key, with the windows that lie within a document."""

    def __init__(self, docs: list[tuple[int, int, bytes]], window: int):
        docs.sort(key=lambda d: d[:2])
        self.window, self.phrase = window, window // 2
        self.key, self.block = np.array([d[:2] for d in docs], np.int64).reshape(-1, 2).T
        self.words = Words([d[2] for d in docs])
        size, hashes = self.words.size, self.words.hash
        self.begin = self.words.last - size
        self.doc = np.repeat(np.arange(len(docs)), size)
        n = max(0, len(hashes) - window + 1)
        at = np.arange(n)
        self.start = at[at + window <= self.words.last[self.doc[:n]]]
        short = runs(hashes, self.phrase)
        self.hash = mix(joined(short[: max(0, len(short) - self.phrase)], short[self.phrase :], self.phrase))
        self.phrases = mix(short)
        self.anchor = first_least(self.phrases, window - self.phrase + 1)[self.start] if n else self.start

    def raw(self, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The texts of ranges of words, each with the blank after it."""
        raw, a, e = self.words.raw, self.words.begin[begin], self.words.end[end - 1] + 1
        return [raw[x:y] for x, y in zip(a.tolist(), e.tolist(), strict=True)]


def _parts(batches, window: int, limit: int = PART_BYTES):
    """Documents (``key, block, text``) in parts of about ``limit`` bytes."""
    docs, total = [], 0
    for batch in batches:
        for k, b, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
            docs.append((k, b, t))
            total += len(t)
            if total >= limit:
                yield _Part(docs, window)
                docs, total = [], 0
    if docs:
        yield _Part(docs, window)


def recurring_anchors(rows: DataFrame, window: int, shards: int) -> np.ndarray:
    """Bitmap of the hashes of anchors that occur twice or more, sized by their number."""

    def emit(batches):
        for part in _parts(batches, window):
            h, n = np.unique(part.phrases[np.unique(part.anchor)], return_counts=True)
            out = [(b, h[i][n[i] == 1].tobytes(), h[i][n[i] > 1].tobytes()) for b, i in slices_by(shard_of(h, shards))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2)]], names=["shard", "once", "often"])

    def count(found: pa.Table) -> pa.Table:
        once, often = (np.frombuffer(b"".join(found[c].to_pylist()), np.uint64) for c in ("once", "often"))
        h, n = np.unique(once, return_counts=True)
        twice = np.union1d(np.union1d(h[n > 1], np.intersect1d(h, often)), often)
        return pa.table({"anchor": pa.array(twice.view(np.int64))})

    found = stored(rows.mapInArrow(emit, "shard int, once binary, often binary").groupBy("shard").applyInArrow(count, "anchor long"), "anchors")
    return bitmap(found, "anchor", bits_for(found.count()))


# --- what is sent: columns of numbers and words in one compressed blob ---


def _pack(columns: list[np.ndarray], words: list[bytes]) -> bytes:
    head = np.array([len(c.tobytes()) for c in columns], np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(c.tobytes() for c in columns) + b"".join(words))


def _unpack(blobs: list[bytes], types: tuple) -> tuple[list[np.ndarray], list[bytes]]:
    columns, words = [[] for _ in types], []
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        at = 4 * len(types)
        for column, size, kind in zip(columns, np.frombuffer(raw[:at], np.uint32).tolist(), types, strict=True):
            column.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
            at += size
        words += raw[at:].split()
    return [np.concatenate([*c, np.zeros(0, t)]) for c, t in zip(columns, types, strict=True)], words


_SENT = (np.int64, np.int32, np.uint8, np.uint8, np.uint32, np.int32)
_PASSAGE = (np.int64, np.int32, np.uint8)


class _Numbers(dict):
    """Words by the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _repeat_slices(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` (``size[i]`` of them) of all i in one row."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def surroundings(part: _Part, maybe: np.ndarray, shards: int) -> list[tuple[int, bytes]]:
    """Of the windows with a nominated anchor, each different one once, by shard: runs of one anchor with their words.

    A run has the first place in the part, the blocks where its windows stand, and whether they stand twice in the part.
    """
    start, anchor = part.start[maybe], part.anchor[maybe]
    if not len(start):
        return []
    doc = part.doc[start]
    place, key = start - part.begin[doc], part.key[doc]
    order = np.argsort(part.hash[start])
    h = part.hash[start][order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new) - 1
    first = np.minimum.reduceat(order, np.flatnonzero(new))  # windows stand by key and place
    moved = (key[order] != key[first[group]]) | (place[order] != place[first[group]])
    twice = np.bincount(group, moved, len(first)) > 0
    # blocks of each group: distinct pairs, and one number that equal sets have in common
    pairs = np.unique((group.astype(np.uint64) << np.uint64(32)) | part.block[doc][order].astype(np.uint64))
    of, block = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int32)
    held = np.bincount(of, minlength=len(first))
    sign = np.add.reduceat(mix(block.astype(np.uint64)), np.cumsum(held) - held)
    at, by = start[first], anchor[first]
    row = np.argsort(at)
    s, a, t, g = at[row], by[row], twice[row], sign[row]
    cut = np.concatenate([[True], (np.diff(s) != 1) | (np.diff(a) != 0) | (t[1:] != t[:-1]) | (g[1:] != g[:-1])])
    begin, head = s[cut], row[cut]
    end = s[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(s) - 1]])] + part.window
    raw = part.raw(begin, end)
    lead = np.cumsum(held) - held
    out = []
    for b, i in slices_by(shard_of(part.phrases[a[cut]], shards)):
        d = part.doc[begin[i]]
        columns = [
            part.key[d],
            (begin[i] - part.begin[d]).astype(np.int32),
            (end[i] - begin[i]).astype(np.uint8),
            t[cut][i].astype(np.uint8),
            held[head[i]].astype(np.uint32),
            block[_repeat_slices(lead[head[i]], held[head[i]])],
        ]
        out.append((b, _pack(columns, [raw[j] for j in i.tolist()])))
    return out


def passages(blobs: list[bytes], window: int) -> list[tuple[int, bytes]]:
    """A shard's recurring windows, compared word by word, as passages for each block that has some of them.

    A passage is a run of windows around one anchor that all have their first place in a row: ``key, start, size`` and words.
    """
    (key, start, size, twice, held, block), words = _unpack(blobs, _SENT)
    if not len(key):
        return []
    ids = np.fromiter(map(_Numbers().__getitem__, words), np.uint32, len(words))
    size, lead = size.astype(np.int64), np.cumsum(held.astype(np.int64)) - held
    begin = np.cumsum(size) - size
    windows = size - window + 1
    # runs by their first place, so that a group's first window is the one of least number
    by = np.lexsort((start, key))
    run = np.repeat(by, windows[by])
    step = _repeat_slices(np.zeros(len(key), np.int64), windows[by])
    at, place = begin[run] + step, start[run] + step
    if ((np.diff(key[run]) == 0) & (np.diff(place) < 0)).any():  # unlike texts of one key
        sort = np.lexsort((place, key[run]))
        run, step, at, place = run[sort], step[sort], at[sort], place[sort]

    def grouped(same: np.ndarray):
        order = np.argsort(same)
        new = np.concatenate([[True], same[order][1:] != same[order][:-1]])
        heads = np.flatnonzero(new)
        return order, np.cumsum(new) - 1, np.minimum.reduceat(order, heads)

    order, group, first = grouped(mix(runs(mix(ids.astype(np.uint64) + np.uint64(1)), window))[at])
    # word by word: unequal windows of one hash (in practice none) are told apart
    view = np.lib.stride_tricks.sliding_window_view(ids, window)
    late = np.flatnonzero(order != first[group])
    for lo in range(0, len(late), 100_000):
        i = late[lo : lo + 100_000]
        if (view[at[order[i]]] != view[at[first[group[i]]]]).any():
            order, group, first = grouped(np.unique(view[at], axis=0, return_inverse=True)[1].ravel())
            break
    source = first[group]
    moved = (key[run[order]] != key[run[source]]) | (place[order] != place[source]) | (twice[run[order]] > 0)
    recurs = (np.bincount(group, moved, len(first)) > 0)[group]
    mine, source = run[order[recurs]], source[recurs]
    # (block, run of the first place, step there) of every window, each once
    n = held[mine].astype(np.int64)
    to, j = block[_repeat_slices(lead[mine], n)].astype(np.int64), np.repeat(source, n)
    r, t = run[j], step[j]
    sort = np.lexsort((t, r, to))
    to, r, t = to[sort], r[sort], t[sort]
    other = np.concatenate([[True], (np.diff(to) != 0) | (np.diff(r) != 0) | (np.diff(t) != 0)]) if len(to) else np.zeros(0, bool)
    to, r, t = to[other], r[other], t[other]
    if not len(to):
        return []
    cut = np.concatenate([[True], (np.diff(to) != 0) | (np.diff(r) != 0) | (np.diff(t) != 1)])
    last = t[np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(t) - 1]])]
    to, r, t = to[cut], r[cut], t[cut]
    out = []
    for b, i in slices_by(to):
        lo, long = begin[r[i]] + t[i], last[i] - t[i] + window
        text = [b" ".join(words[a:e]) + b" " for a, e in zip(lo.tolist(), (lo + long).tolist(), strict=True)]
        out.append((b, _pack([key[r[i]], (start[r[i]] + t[i]).astype(np.int32), long.astype(np.uint8)], text)))
    return out


def _reach(n: int, alike) -> int:
    """The largest ``m`` up to ``n`` with ``alike(m)``, which falls once: by doubling, then halving."""
    lo, hi = 0, min(n, 96)
    while alike(hi):
        if hi == n:
            return n
        lo, hi = hi, min(n, 4 * hi)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if alike(mid) else (lo, mid)
    return lo


class PassageFinder:
    """Aho-Corasick automata of the passages' phrases, ``limit`` phrases in each.

    Passages whose windows follow each other are joined. Their phrases are cut one after another, half a window long, so
    that every window holds a whole one. Nodes of an automaton list their edges, so a word is spelt in three characters of
    about the cube root of the number of words each; each of the three has its own range, so that matches can't begin
    inside a word.
    """

    def __init__(self, blobs: list[bytes], window: int, limit: int = PHRASES):
        (key, start, size), words = _unpack(blobs, _PASSAGE)
        self.window, self.phrase = window, window // 2
        begin = np.cumsum(size, dtype=np.int64) - size
        whole: list[tuple[int, int, list[bytes]]] = []
        for i in np.lexsort((start, key)).tolist():
            k, s, text = int(key[i]), int(start[i]), words[begin[i] : begin[i] + size[i]]
            if whole:
                last, first, have = whole[-1]
                if last == k and s == first + len(have) - window + 1 and have[1 - window :] == text[: window - 1]:
                    have += text[window - 1 :]
                    continue
            whole.append((k, s, text))
        different = dict.fromkeys(w for _, _, text in whole for w in text)
        base = math.ceil(len(different) ** (1 / 3)) + 1
        self.vocab = {w: chr(33 + k // base // base) + chr(33 + base + k // base % base) + chr(33 + 2 * base + k % base) for k, w in enumerate(different)}
        found: dict[str, list] = {}
        width = 3 * self.phrase
        for number, (k, s, text) in enumerate(whole):
            want = "".join(map(self.vocab.__getitem__, text))
            for at in range(0, len(want) - width + 1, width):
                found.setdefault(want[at : at + width], []).append((number, k, s, at, want))
        self.automata, self.having = [], []
        phrases = list(found.items())
        for lo in range(0, len(phrases), limit):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for k, (phrase, _) in enumerate(phrases[lo : lo + limit]):
                automaton.add_word(phrase, k)
            automaton.make_automaton()
            self.automata.append(automaton)
            self.having.append([h for _, h in phrases[lo : lo + limit]])

    def covered(self, key: int, words: list[bytes]) -> list[list[int]]:
        """Spans of words of a document that lie in windows of passages which start earlier."""
        if len(words) < self.window or not self.automata:
            return []
        text, back = "".join(map(self.vocab.get, words, repeat("   "))), 3 * self.phrase - 1
        spans, done = [], {}
        for automaton, having in zip(self.automata, self.having, strict=True):
            for end, k in automaton.iter(text):
                begin = end - back
                for number, source, first, at, want in having[k]:
                    shift = begin - at
                    if shift == 3 * first and key == source:
                        continue
                    # the same passage at the same place was followed to there already
                    if done.get((number, shift), -1) > end:
                        continue
                    right = _reach(min(len(text) - begin, len(want) - at), lambda m: text.startswith(want[at : at + m], begin))  # noqa: B023
                    left = _reach(min(begin, at), lambda m: text.startswith(want[at - m : at], begin - m))  # noqa: B023
                    lo, hi = (begin - left + 2) // 3, (begin + right) // 3
                    done[number, shift] = 3 * hi
                    if hi - lo >= self.window:
                        spans.append((lo, hi))
        out: list[list[int]] = []
        for a, e in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([a, e])
        return out


def _blob_batch(found: list[tuple[int, bytes]], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], names=[name, "blob"])


def recurring_passages(rows: DataFrame, window: int, shards: int) -> DataFrame:
    """``block, blob``: what each block has to look for. ``rows``: ``key, block, text``."""
    found = recurring_anchors(rows, window, shards)
    nominated = rows.sparkSession.sparkContext.broadcast(found)  # at most 128 MB, see bits_for

    def send(batches):
        for part in _parts(batches, window):
            maybe = in_bitmap(part.phrases[part.anchor], nominated.value) if len(part.anchor) else np.zeros(0, bool)
            out = surroundings(part, maybe, shards)
            if out:
                yield _blob_batch(out, "shard")

    def confirm(found: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_blob_batch(passages(found["blob"].to_pylist(), window), "block")])

    return rows.mapInArrow(send, "shard int, blob binary").groupBy("shard").applyInArrow(confirm, "block int, blob binary")


def find_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, phrases: int = PHRASES) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``removed_spans`` (word places, end exclusive) and ``kept_text``.

    Words are runs without white space (9-13, 32). A word is removed if a window over it also starts earlier: at a smaller
    ``doc_id``, or earlier in the document. ``kept_text`` has the other words, joined by one space. ``window`` is even, at
    most 80. A null text has no words; a text shorter than a window loses none; very long texts are searched whole; a null
    ``doc_id`` comes before all others; repeated rows are one document (rows of equal ``doc_id`` and other text don't
    precede each other); an empty table stays empty. Columns of those names, and those that begin with ``_kl_``, are
    replaced. No word is removed but by equal words; that a window's only copy is missed takes two equal 64-bit hashes
    of windows within a part of ``PART_BYTES``.
    """
    if window % 2 or not 2 <= window <= 80:
        raise ValueError("window must be even and at most 80")
    docs = docs.drop("n_words", "removed_spans", "kept_text", "_kl_key", "_kl_block")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    shards = max(partitions(docs), math.ceil(total / SHARD_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    keyed = docs.withColumns({"_kl_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "_kl_block": block})
    wanted = recurring_passages(keyed.select(F.col("_kl_key").alias("key"), F.col("_kl_block").alias("block"), "text"), window, shards)
    columns = docs.columns
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("removed_spans", kind), T.StructField("kept_text", T.StringType())])

    def locate(rows: pa.Table, found: pa.Table) -> pa.Table:
        finder = PassageFinder(found["blob"].to_pylist() if len(found) else [], window, phrases)
        counts, removed, kept = [], [], []
        for batch in rows.select(["_kl_key", "text"]).to_batches(max_chunksize=256):
            for key, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words, last, rest = t.split(), 0, []
                spans = finder.covered(key, words)
                for a, e in spans:
                    rest += words[last:a]
                    last = e
                counts.append(len(words))
                removed.append([{"start": a, "end": e} for a, e in spans])
                kept.append(b" ".join(rest + words[last:]).decode())
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        added = [pa.array(counts, pa.int64()), pa.array(removed, spans_type), pa.array(kept, pa.string())]
        return pa.table([*[rows[c] for c in columns], *added], names=[*columns, "n_words", "removed_spans", "kept_text"])

    return keyed.groupBy("_kl_block").cogroup(wanted.groupBy("block")).applyInArrow(locate, schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )
