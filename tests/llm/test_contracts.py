"""The registered queries against plain restatements of their contracts, on whole small tables; and awkward inputs."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.llm import decontamination, jaccard, packing, quality, secrets, sharding, toxicity, urls
from kinelake.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_of(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op1(spark, texts):
    rows = rows_of(spark, "op1_toxicity")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    by_text = {}
    assert all(by_text.setdefault(texts[r.doc_id], r.score) == r.score for r in rows)


def test_op3(spark, texts):
    rows = rows_of(spark, "op3_shuffle_shards")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key") and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    for s, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_op4(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = rows_of(spark, "op4_pack_sequences")
    ids = {i: [*exact.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == at[r.doc_id] and r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        assert r.length == 1024 or r.piece == 0
        at[r.doc_id] += r.length
    assert at == {i: len(v) for i, v in ids.items()}
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 1024
    demand = np.bincount([r.length for r in rows], minlength=1025)
    assert packing.least_sequences(demand) <= len(ends) <= sum(n for _, n in packing.best_fit(demand, 1024))


def test_op6(spark, texts):
    rows = {r.doc_id: r for r in rows_of(spark, "op6_quality_rules")}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        w, seen, lines = words(t), Counter(), Counter()
        for k in range(len(w) - 2):
            seen[tuple(w[k : k + 3])] += 1
        inside = {p for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for p in range(k, k + 3)}
        for line in (t or "").split("\n"):
            if words(line):
                lines[line] += 1
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), sum(n - 1 for n in lines.values()), len(inside))
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_op6_verdict(spark):
    """The cutoffs restated from the measures: orders, family, tests in order and their exact tails."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    measured = quality.measures(docs)
    rows, known = measured.withColumn("third", F.pmod(F.xxhash64("text_hash", F.lit(7)), F.lit(3))).collect(), {r.doc_id: r.quality for r in labels.collect()}
    held = {}
    for r in rows:
        if known.get(r.doc_id) is not None:
            text = held.setdefault((r.stratum, r.text_hash), [r, False])
            text[1] |= known[r.doc_id] == 1
    want = {}
    for stratum in {s for s, _ in held}:
        mine = [v for (s, _), v in held.items() if s == stratum]
        tally = {g: {"n": sum(v[1] == g for v in mine if v[0].third == 0)} | {f"{x}_{j}": sum(v[0][x] >= c for v in mine if v[0].third == 0 and v[1] == g) for x, cuts in quality.RULES.items() for j, c in enumerate(cuts)} for g in (True, False)}
        family = quality.nested_family(tally[True], tally[False])
        assert all(a >= b for v, w in zip(family, family[1:], strict=False) for a, b in zip(v, w, strict=True))
        tested = [(v[0], v[1]) for v in mine if v[0].third != 0]
        n = sum(g for _, g in tested)
        for vector in family:
            k = sum(g and any(r[x] >= c for x, c in zip(quality.RULES, vector, strict=True)) for r, g in tested)
            if k > 0.05 * n or quality.binomial_tail(k, n, 0.05) > 0.05 / 4:
                break
            want.setdefault(stratum, []).append({x: c for x, c in zip(quality.RULES, vector, strict=True) if c < float("inf")})
    got = quality.certified_cutoffs(measured, labels)
    assert "en" in got and got.keys() == want.keys() and all(got[s] in want[s] for s in got)
    judged = quality.judge(docs, labels).where("not kept and not base_failed").collect()
    assert judged and all(any(r[x] >= c for x, c in got[r.stratum].items()) for r in judged)


def test_certified_choice():
    assert quality.certified_choice([(0, 5)], 86, 9, 0.05, 0.0125) == 0 and quality.certified_choice([(0, 5)], 85, 9, 0.05, 0.0125) is None
    assert quality.certified_choice([(0, 5)], 80, 9, 0.05, 0.0125) is None and quality.certified_choice([(9, 5), (0, 9)], 100, 9, 0.05, 0.05) is None
    assert quality.certified_choice([(0, 5), (0, 8), (0, 8), (40, 9)], 200, 9, 0.05, 0.05) == 1


def test_repeat_words_with_equal_hashes(spark, monkeypatch):
    """All windows under one hash: neighbours differ, and the windows themselves are sorted."""
    monkeypatch.setattr(quality, "_HASH", 0)
    rows = [(0, "a b c x a b c y a b c"), (1, "p q r s t u"), (2, "a a a a"), (3, None)]
    got = {r.doc_id: r.n_repeat_words for r in quality.measures(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 9, 1: 0, 2: 4, 3: 0}


def test_op7(spark, texts):
    kinds = {
        "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    }
    for r in rows_of(spark, "op7_secret_scans"):
        found = [(m.start(), j, f"{k}:{m.start()}:{m.end()}") for j, (k, (p, good)) in enumerate(kinds.items()) for m in re.finditer(p, texts[r.doc_id] or "", re.A) if good(m)]
        assert r.base_sha256 == sha(",".join(s for *_, s in sorted(found))), r.doc_id
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(j == x for _, x, _ in found) for j in range(3)]
        assert {s for *_, s in found} <= set(r.spans.split(","))


def test_op8(spark):
    urls_of = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows_of(spark, "op8_url_filter"):
        host, path = urls._split(urls_of[r.page_id] or "")
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path) and r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")


def test_op9(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    rows = rows_of(spark, "op9_chat_format")
    assert sorted(r.conv_id for r in rows) == sorted(turns)
    for r in rows:
        mine = sorted(turns[r.conv_id])
        loss = "".join(t for _, role, t in mine if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(mine), sha("".join(f"{role}\n{t}\n" for _, role, t in mine)), len(loss), sha(loss))
        assert r.formatted_chars > r.loss_chars


# --- awkward inputs ---


def test_null_items(spark):
    passage = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, "x " + passage + " y"), (2, "clean"), (2, "clean"), (None, passage)], "doc_id long, text string")
    items = spark.createDataFrame([(7, passage), (None, passage), (None, "other words"), (8, None)], "item_id long, text string")
    for block in (1 << 20, 20):
        rows = decontamination.find_contamination(docs, items, block_bytes=block).collect()
        assert sorted((r.doc_id or 0, r.item_ids, [tuple(s) for s in r.hit_spans]) for r in rows) == [(0, ["7", None], [(0, 12)]), (1, ["7", None], [(1, 13)]), (2, [], []), (2, [], [])]
    with pytest.raises(ValueError):
        decontamination.MAX_ITEM_BYTES, kept = 5, decontamination.MAX_ITEM_BYTES
        try:
            decontamination.find_contamination(docs, items)
        finally:
            decontamination.MAX_ITEM_BYTES = kept


def test_columns_of_the_input_stay(spark):
    """Columns named like an operator's own neither crash it nor change."""
    text = "some words and password=abcdefgh12345 " + " ".join(f"v{k}" for k in range(60))
    names = ["n_words", "hit_spans", "item_ids", "secrets", "_salt", "_rank", "_bucket", "_kl_id", "_kl_row", "slot", "shard", "kept", "stratum", "words", "text_hash", "sequence_id", "_base", "lang"]
    values = [f"v{k}" for k in range(len(names))]
    docs = spark.createDataFrame([(1, text, len(text), *values), (2, None, 0, *values)], ["doc_id", "text", "n_chars", *names])
    items = spark.createDataFrame([(1, " ".join(f"v{k}" for k in range(10, 25)))], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for out in (decontamination.decontaminate(docs, items), secrets.redact(docs), jaccard.keep_one(docs)):
        rows = out.collect()
        assert out.columns == docs.columns and {r.doc_id for r in rows} == {1, 2}
        assert all([r[c] for c in names] == values for r in rows)
    assert quality.keep_good(docs, labels).columns == docs.columns and [r._kl_row for r in quality.keep_good(docs, labels).collect()] == [values[names.index("_kl_row")]]
    dealt = sharding.shuffle_shards(docs)
    assert dealt.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"] and all(r._bucket == values[names.index("_bucket")] for r in dealt.collect())
    pieces = packing.token_pieces(docs).withColumns({c: F.lit(c) for c in ("_salt", "_rank", "_kl_salt")})
    assert all((r._salt, r._rank, r._kl_salt) == ("_salt", "_rank", "_kl_salt") for r in packing.pack(pieces).collect())
    model = toxicity.train(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(docs, model).count() == 2


def test_repeated_ids(spark):
    """Unlike texts with one id are judged each by itself, and none is lost."""
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    docs = spark.createDataFrame([(1, a), (1, b), (1, b), (2, "short"), (2, a + " more"), (3, b + " more"), (4, None)], "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (2, "short"), (4, None)], key=str)
    components = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert (3, 1) in components and (2, 1) in components
    good = quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert sorted(r.text for r in good) == sorted([a, a + " more", b, b, b + " more"])


def test_hot_class(spark):
    """A class of most rows is named over several keys."""
    rows = [(i, "one text that nearly all rows have in common") for i in range(700)] + [(1000 + i, f"text number {i} that no other row has {i * i}") for i in range(50)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == 750 and Counter(r.component_id for r in got).most_common(1)[0] == (0, 700)


def test_long_url(spark):
    url = "http://a.example.org/" + "".join(f"p{k}x" for k in range(20000))[:80000]
    df = spark.createDataFrame([(1, url), (2, "http://x-casino.example.org/en/")], "page_id long, url string").coalesce(1)
    urls.filter_urls(df.where("page_id = 2")).collect()
    began = time.time()
    rows = {r.page_id: r for r in urls.filter_urls(df).collect()}
    assert time.time() - began < 4 and rows[1].path == url[20:]
    host, path = urls._split(url)
    weights, bias = urls.train(tuple(urls.labelled_urls()))
    x = urls._features(host, path)
    assert rows[1].probability == pytest.approx(1 / (1 + np.exp(-(x @ np.array(weights) + bias))), rel=1e-6)


@pytest.mark.parametrize("value,found", [("/q7Zk2Lw9Xv4Tn8Rb3Yc6Md1P", True), ("kQzXvBnMaSdFgHjLwErTyUiOp", True), ("_auth=q7Zk2Lw9Xv4Tn8Rb3Yc6Md1P", True), ("internationalisationOfEverything", False), ("getHTTPServerConfigurationName", False), ("/usr/local/share/applications/", False), ("-" * 40, False)])
def test_allow_list(spark, value, found):
    rows = secrets.scan_secrets(spark.createDataFrame([(1, f"see {value} here")], "doc_id long, text string")).collect()
    assert bool(rows[0].secrets) == found


def test_isotonic_pools_equal_margins():
    x, y = toxicity.isotonic(np.zeros(4), np.array([0.0, 0, 0, 1]))
    assert x.tolist() == [0.0] and y.tolist() == [0.25]
    x, y = toxicity.isotonic(np.array([2.0, 1, 1, 2, 3]), np.array([0.0, 1, 0, 0, 1]))
    assert y.tolist() == [0.25, 1.0] and x[1] == 3


@pytest.mark.parametrize("low,high", [(300, 700), (342, 520)])
def test_plan_is_no_worse_than_best_fit(low, high):
    demand = np.bincount(np.random.default_rng(low).integers(low, high, 50_000), minlength=1025)
    plan, bound = packing.plan_with_bound(demand)
    total = sum(n for _, n in plan)
    held = np.zeros(1025, int)
    for config, n in plan:
        for length, times in config.items():
            held[length] += times * n
    assert (held == demand).all() and bound <= total <= sum(n for _, n in packing.best_fit(demand, 1024)) and total <= 1.006 * bound


def test_grades_and_full_bitmaps(spark):
    """Bitmaps of any size give the same components."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs, bits=1 << 15).collect()} == want
