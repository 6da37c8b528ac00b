"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Training rows are a bounded sample of the labelled ones: a third teaches which words mark toxic texts, further ones the
trees and the calibration. Every whole text is scored in one pass without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm.shared import stored, table

MAX_TRAIN, MAX_LEXICON, SEED = 24_000, 512, 11
#: bytes of the word beginnings that the lexicon may have beside whole words, so that inflected forms count as one
STEMS = (5, 6, 7, 8)

SECOND_PERSON = "you your yours yourself ur u tu te toi vous votre vos ton ta du dich dir dein deine ihr euch usted ustedes vosotros ti tus".split()
FEATURES = ("lexicon_density", "lexicon_hits", "lexicon_distinct", "lexicon_burst", "second_person", "proximity", "capitals", "exclaims", "punctuation", "obfuscated", "masked", "stretched", "length")

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))
_UPPER, _PUNCT = bytes(range(65, 91)), bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LEET = bytes.maketrans(b"013457@$!|+", b"oieastasilt")
_ODD = re.compile(rb"[A-Za-z]+[0-9@$!|+*]+[A-Za-z][A-Za-z0-9@$!|+*]*|[@$][A-Za-z0-9@$!|+*]{3,}")
_STRETCHED = re.compile(rb"([A-Za-z])\1\1")


def features(text: bytes, lexicon: frozenset, persons: frozenset) -> list[float]:
    """``FEATURES`` of one whole text."""
    words = text.translate(_FOLD).split()
    n, size = max(1, len(words)), max(1, len(text))
    marked = {w for w in set(words) if w in lexicon or any(w[:k] in lexicon for k in STEMS if len(w) > k)}
    hits = [i for i, w in enumerate(words) if w in marked] if marked else []
    near = burst = 0
    distinct = set()
    people = [i for i, w in enumerate(words) if w in persons]
    if hits:
        distinct = {words[i] for i in hits}
        first = 0
        for k, i in enumerate(hits):
            while hits[first] < i - 50:
                first += 1
            burst = max(burst, k - first + 1)
        if people:
            at = np.asarray(people)
            spot = np.searchsorted(at, hits)
            gap = np.minimum(np.abs(at[np.minimum(spot, len(at) - 1)] - hits), np.abs(at[np.maximum(spot - 1, 0)] - hits))
            near = 1 / (1 + float(gap.min()))
    odd = _ODD.findall(text) if len(text.translate(None, b"0123456789@$!|+*")) < len(text) else []
    plain = [w.lower().translate(_LEET) for w in odd]
    return [
        len(hits) / n,
        float(len(hits)),
        float(len(distinct)),
        float(burst),
        len(people) / n,
        near,
        (size - len(text.translate(None, _UPPER))) / size,
        text.count(b"!") / size,
        (size - len(text.translate(None, _PUNCT))) / size,
        float(sum(w in lexicon for w in plain)),
        sum(b"*" in w for w in odd) / n,
        len(_STRETCHED.findall(text)) / n,
        float(np.log1p(n)),
    ]


class Booster:
    """Gradient boosting of the logistic loss by shallow trees over binned features."""

    def __init__(self, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.l2, self.least = trees, depth, rate, bins, l2, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
        rate = float(np.clip(y.mean() if len(y) else 0.05, 0.01, 0.99))
        self.base, self.forest = float(np.log(rate / (1 - rate))), []
        b, f = self._bin(x), np.full(len(x), self.base)
        for _ in range(self.trees if 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(b, y - p, p * (1 - p))
            self.forest.append(tree)
            f = f + self._walk(tree, b)
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="right") for c, v in zip(self.cuts, x.T, strict=True)], 1) if len(x) else np.zeros(x.shape, int)

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, bin and value of the nodes of a full tree; feature -1: a leaf."""
        size = 2 ** (self.depth + 1) - 1
        feature, split, value, node = np.full(size, -1), np.zeros(size, int), np.zeros(size), np.zeros(len(g), int)
        score = lambda s, t: s * s / (t + self.l2)
        for level in range(self.depth + 1):
            first, width = 2**level - 1, 2**level
            here = np.flatnonzero(node >= first)
            at = node[here] - first
            sums, weights = np.bincount(at, g[here], width), np.bincount(at, h[here], width)
            value[first : first + width] = self.rate * sums / (weights + self.l2)
            if level == self.depth:
                break
            best, where = np.full(width, 1e-6), np.full((width, 2), -1)
            for j, cuts in enumerate(self.cuts):
                m = len(cuts) + 1
                if m < 2:
                    continue
                key = at * m + b[here, j]
                gl = np.bincount(key, g[here], width * m).reshape(width, m).cumsum(1)[:, :-1]
                hl = np.bincount(key, h[here], width * m).reshape(width, m).cumsum(1)[:, :-1]
                gain = score(gl, hl) + score(sums[:, None] - gl, weights[:, None] - hl) - score(sums, weights)[:, None]
                gain[(hl < self.least) | (weights[:, None] - hl < self.least)] = -1
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                where[top > best] = np.stack([np.full(width, j), k], 1)[top > best]
                best = np.maximum(best, top)
            feature[first : first + width], split[first : first + width] = where[:, 0], where[:, 1]
            go = here[feature[node[here]] >= 0]
            node[go] = 2 * node[go] + 1 + (b[go, feature[node[go]]] > split[node[go]])
        return feature, split, value

    def _walk(self, tree, b: np.ndarray) -> np.ndarray:
        feature, split, value = tree
        node = np.zeros(len(b), int)
        for _ in range(self.depth):
            f = feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (b[np.arange(len(b)), np.maximum(f, 0)] > split[node]), node)
        return value[node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        return self.base + sum((self._walk(t, b) for t in self.forest), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit (equal margins first become one, then adjacent violators are pooled), joined by straight lines."""
    if not len(y):
        return np.array([-8.0, 8.0]), np.array([0.0, 1.0])
    places, of = np.unique(margin, return_inverse=True)
    blocks: list[list[float]] = []
    for m, s, n in zip(places, np.bincount(of, y), np.bincount(of), strict=True):
        blocks.append([float(s), float(n), float(m)])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, w, at = blocks.pop()
            old = blocks[-1]
            blocks[-1] = [old[0] + s, old[1] + w, (old[2] * old[1] + at * w) / (old[1] + w)]
    return np.array([b[2] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


class ToxicityModel:
    """Lexicon, trees and calibration, small enough to travel with a task."""

    def __init__(self, lexicon: list[bytes], booster: Booster, knots: tuple[np.ndarray, np.ndarray]):
        self.lexicon, self.booster, self.knots = frozenset(lexicon), booster, knots

    def featurise(self, texts) -> np.ndarray:
        persons = frozenset(w.encode() for w in SECOND_PERSON)
        return np.array([features(t or b"", self.lexicon, persons) for t in texts]).reshape(-1, len(FEATURES))

    def score(self, texts) -> np.ndarray:
        return np.clip(np.interp(self.booster.margin(self.featurise(texts)), *self.knots), 0, 1)


def _word_counts(rows: DataFrame, max_lexicon: int) -> list[bytes]:
    """Words, and word beginnings of ``STEMS`` bytes, that a 64th of the toxic texts have (three at least) and that are 20 times as frequent there as in clean ones."""

    def count(batches):
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for t, y in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in set((t or b"").translate(_FOLD).split()) if len(w) <= 64}
                for w in words | {w[:k] for k in STEMS for w in words if len(w) > k}:
                    seen.setdefault(w, [0, 0])[y] += 1
            words = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([seen[w][0] for w in words], pa.int64()), pa.array([seen[w][1] for w in words], pa.int64())], names=["word", "clean", "toxic"])

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = lambda c, k: (F.col(c) + 0.5) / F.lit(float(totals.get(k, 0) + 1))
    counted = rows.select("text", "toxic").mapInArrow(count, "word binary, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    marked = counted.where((F.col("toxic") >= max(3, totals.get(1, 0) / 64)) & (share("toxic", 1) > 20 * share("clean", 0)))
    held = {bytes(r["word"]): r["toxic"] for r in marked.orderBy(F.desc("toxic"), "word").limit(8 * max_lexicon).collect()}
    # of a word and its beginnings those that more texts have stay, of equal ones the longest
    stems = {w: [w[:k] for k in STEMS if len(w) > k and w[:k] in held] for w in held}
    as_good = {s for w, of in stems.items() for s in of if held[s] == held[w]}
    return [w for w in held if w not in as_good and all(held[s] == held[w] for s in stems[w])][:max_lexicon]


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_lexicon: int = MAX_LEXICON, seed: int = SEED) -> ToxicityModel:
    """From at most ``max_train`` rows of ``labels`` (``doc_id, toxic``), those of smallest seeded hash.

    Null labels are left out; of repeated ones the largest counts; of unlike texts with one ``doc_id`` the least is taken.
    Null and empty texts, repeated rows and very long texts are rows like others. Without toxic or without clean rows (an
    empty table) the score is the same for all texts. No other columns are looked at. The labelled texts are written once,
    in the shared folder.
    """
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = known.select("doc_id", "toxic", F.xxhash64("doc_id", F.lit(seed)).alias("h")).orderBy("h", "doc_id").limit(max_train)
    # at most max_train rows of 20 bytes: small whatever the input
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = stored(found.select("text", "toxic", F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(100)).alias("part")), "labelled")
    lexicon = _word_counts(rows.where("part < 34"), max_lexicon)
    model = ToxicityModel(lexicon, Booster(), (np.zeros(1), np.zeros(1)))

    def measure(batches):
        for batch in batches:
            x = model.featurise(batch.column(0).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "toxic", "part"])

    got = rows.where("part >= 34").mapInArrow(measure, "x array<double>, toxic int, part long").collect()
    got.sort(key=lambda r: (r["part"], r["x"]))
    x, y = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES)), np.array([float(r["toxic"]) for r in got])
    held = np.array([r["part"] >= 80 for r in got], bool)
    model.booster.fit(x[~held], y[~held])
    model.knots = isotonic(model.booster.margin(x[held]), y[held])
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row's whole text.

    A null text counts as empty; equal texts get equal scores; repeated rows are scored each; very long texts are scored
    whole; an empty table stays empty; columns other than ``doc_id`` and ``text`` are not looked at.
    """

    def score(batches):
        for batch in batches:
            scores = model.score(batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
