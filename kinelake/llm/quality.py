"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Every rule rejects documents whose measure is at or above a cutoff. Labelled documents, each text once, are the holdout, by
stratum (language). A third of them orders the choices: one nested family of cutoffs of all rules together, from lenient
to strict. The others test it: from the most lenient on, the exact binomial tail of the number of good documents that the
rules would reject together, until the first choice that can't be certified (fixed-sequence testing, at the full tolerated
share). The level is divided by the number of strata (Bonferroni). So with probability ``1 - level`` the rules falsely
reject at most ``tolerated`` of the good documents of every stratum, whichever certified choice is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm.shared import let, steps, stored, table

TOLERATED, LEVEL, MAX_STRATA = 0.05, 0.05, 256
SPACE = " \t\n\x0b\f\r"
_HASH, _AT = 0xFFFFFFFFFF, 0xFFFFFF  # a window as one long: 40 bits of its hash, 24 bits of its place
#: the nested family: steps of a rule's cutoffs before the strictest that rejects at most a share of the ordering third's good documents
FAMILY = ((2, 0.0), (1, 0.0), (0, 0.0), (0, 0.0025), (0, 0.005), (0, 0.01), (0, 0.02))

#: measure: cutoffs, most lenient first. Shares of word characters, lines or words.
RULES = {
    "symbols": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05],
    "capitals": [0.98, 0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25],
    "exclaims": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05],
    "dup_lines": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25],
    "repeats": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3],
    "digits": [0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15],
    "long_words": [60, 40, 30, 25, 20, 18, 16, 14],
}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words):
    """Words in 3-word windows found twice or more, of an array of words: sort the windows, look at neighbours.

    Windows are sorted as hash and place in one long. Where different windows meet under one hash, or places need more
    than 24 bits, the windows themselves are sorted instead.
    """

    def of(w):
        key = lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(_HASH)), 24).bitwiseOR(i.cast("long"))
        quick = let(F.sort_array(F.transform(steps(F.size(w) - 2), key)), lambda s: by_hash(w, s))
        return F.when(F.size(w) <= _AT, quick).otherwise(by_words(w))

    def by_hash(w, s):
        place = lambda x: x.bitwiseAND(F.lit(_AT)).cast("int")

        def pair(x, y):
            i, j = place(x), place(y)
            text = (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))
            return F.when(F.shiftright(x, 24) == F.shiftright(y, 24), F.when(text, 1).otherwise(2)).otherwise(0)

        found = F.transform(s, lambda x, k: pair(x, F.get(s, k + 1)))
        return let(found, lambda f: F.when(F.array_contains(f, 2), by_words(w)).otherwise(covered(s, f, place)))

    def by_words(w):
        window = lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i"))
        same = lambda x, y: F.when((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), 1).otherwise(0)
        sort = F.sort_array(F.transform(steps(F.size(w) - 2), window))
        return let(sort, lambda s: let(F.transform(s, lambda x, k: same(x, F.get(s, k + 1))), lambda f: covered(s, f, lambda x: x["i"])))

    def covered(s, f, place):
        twice = F.transform(F.filter(s, lambda x, k: (F.get(f, k) == 1) | (F.coalesce(F.get(f, k - 1), F.lit(0)) == 1)), place)
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(F.sort_array(twice), start, lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))["n"]

    return let(words, of)


def measures(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``doc_id, stratum, text_hash`` (with ``carry`` also ``_kl_row``, all columns of the row) with the counts and the measures of every whole text; a null text has no words.

    Without a column ``lang`` all rows are of one stratum. Words are runs without white space (9-13, 32).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = "[\\x20\\x09-\\x0D]"
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    known = ["doc_id", "stratum", "text_hash"] + ["_kl_row"] * carry
    rest = docs.select("doc_id", lang.alias("stratum"), F.xxhash64(text).alias("text_hash"), text.alias("text"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_kl_row")] if carry else []))
    rest = rest.select("*", F.filter(F.split("text", f"{blank}+", -1), lambda x: x != "").alias("words"), F.translate("text", SPACE, "").alias("ink"), lines.alias("lines"))
    share = lambda n, d: F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))
    without = lambda chars: F.length("ink") - F.length(F.translate("ink", chars, ""))
    counts = rest.select(
        *known,
        F.size("words").cast("long").alias("n_words"),
        F.length("ink").cast("long").alias("word_chars"),
        without("#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        without("!").alias("n_exclaims"),
        without("0123456789").alias("n_digits"),
        (F.length("ink") - F.length(F.regexp_replace("ink", "\\p{Lu}+", ""))).alias("n_capitals"),
    )
    return counts.select(
        *known,
        *COUNTS,
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbols"),
        share(F.col("n_capitals"), F.col("word_chars")).alias("capitals"),
        share(F.col("n_exclaims"), F.col("word_chars")).alias("exclaims"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_lines"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("repeats"),
        share(F.col("n_digits"), F.col("word_chars")).alias("digits"),
        share(F.col("word_chars"), F.col("n_words")).alias("long_words"),
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n trials of chance p, exactly up to rounding."""
    if k >= n:
        return 1.0
    logs = (math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1))
    return min(1.0, math.fsum(map(math.exp, logs)))


def _labelled(measured: DataFrame, labels: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """Labelled texts, each once for a stratum, with ``own`` (the stratum, or null for pooled ones), ``good`` and ``orders``; and the pooled strata."""
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = measured.join(known, "doc_id").groupBy("stratum", "text_hash").agg((F.max("quality") == 1).alias("good"), *[F.max(r).alias(r) for r in rules])
    rows = stored(rows.withColumn("orders", F.pmod(F.xxhash64("text_hash", F.lit(7)), F.lit(3)) == 0), "labelled")
    large = rows.groupBy("stratum").agg(F.count("*").alias("_all")).orderBy(F.desc("_all"), "stratum").limit(MAX_STRATA).select("stratum", F.col("stratum").alias("own"))
    marked = rows.join(F.broadcast(large), "stratum", "left")
    return marked, marked.where("own is null").select("stratum").distinct()


def nested_family(good: dict, bad: dict, rules=RULES, family=FAMILY) -> list[list[float]]:
    """Cutoffs of all rules (infinite: unused), lenient first, from tallies of the ordering third (``n`` and ``rule_j``).

    A rule takes part as far as it catches bad documents, ten times as large a share as of good ones.
    """
    out: list[list[float]] = []
    for back, share in family:
        vector = []
        for rule, cuts in rules.items():
            fits = [j for j in range(len(cuts)) if good[f"{rule}_{j}"] <= share * good["n"] and bad[f"{rule}_{j}"] * good["n"] > 10 * good[f"{rule}_{j}"] * bad["n"]]
            j = max(fits, default=-1) - back
            # no stricter than what a later choice has: cutoffs fall along the family
            vector.append(float(cuts[j]) if j >= 0 else math.inf)
        vector = [min(v, w) for v, w in zip(vector, out[-1], strict=True)] if out else vector
        if vector not in out and any(v < math.inf for v in vector):
            out.append(vector)
    return out


def certified_choice(tests: list[tuple[int, int]], n: int, n_bad: int, tolerated: float, level: float) -> int | None:
    """Of a family's ``(good rejected, bad rejected)``, in order: the certified choice that catches most bad against good documents."""
    best = None
    for j, (k, caught) in enumerate(tests):
        if k > tolerated * n or binomial_tail(k, n, tolerated) > level:
            break
        gain = caught / max(1, n_bad) - 10 * k / n
        if best is None or gain > best[0] + 1e-12:
            best = (gain, j)
    return best[1] if best and best[0] >= 0 else None


def _by_stratum(stratum, values: dict, kind: str):
    """The value of a row's stratum (null for the pooled ones), by a map of literals; null for others."""
    known = [x for s, v in values.items() if s is not None for x in (F.lit(s), v)]
    out = F.try_element_at(F.create_map(*known), stratum) if known else F.lit(None).cast(kind)
    return F.when(stratum.isNull(), values[None]).otherwise(out) if None in values else out


def _certify(marked: DataFrame, tolerated: float, level: float, rules) -> dict[str | None, list[float]]:
    """By stratum, the cutoffs of all rules. The driver gets two rows of counts for each of at most ``MAX_STRATA + 1`` strata, twice."""
    tallies = [F.sum((F.col(r) >= c).cast("long")).alias(f"{r}_{j}") for r, cuts in rules.items() for j, c in enumerate(cuts)]
    counts = {(r["own"], r["good"]): r.asDict() for r in marked.where("orders").groupBy("own", "good").agg(F.count("*").alias("n"), *tallies).collect()}
    families = {s: nested_family(counts[s, True], counts[s, False], rules) for s, g in counts if g and (s, False) in counts}
    families = {s: f for s, f in families.items() if f}
    if not families:
        return {}
    width = max(map(len, families.values()))
    numbers = lambda xs: F.array(*map(F.lit, xs))
    family = _by_stratum(F.col("own"), {s: F.array(*map(numbers, f)) for s, f in families.items()}, "array<array<double>>")
    values = F.array(*[F.col(r) for r in rules])
    hit = lambda j: F.coalesce(F.exists(F.zip_with(values, F.get(F.col("family"), F.lit(j)), lambda x, c: x >= c), lambda x: x), F.lit(False))
    tested = marked.where("not orders").withColumn("family", family).where("family is not null")
    found = {(r["own"], r["good"]): r for r in tested.groupBy("own", "good").agg(F.count("*").alias("n"), *[F.sum(hit(j).cast("long")).alias(f"k{j}") for j in range(width)]).collect()}
    out = {}
    for s, f in families.items():
        if (s, True) in found:
            good, bad = found[s, True], found.get((s, False))
            tests = [(good[f"k{j}"], bad[f"k{j}"] if bad else 0) for j in range(len(f))]
            j = certified_choice(tests, good["n"], bad["n"] if bad else 0, tolerated, level / len(families))
            if j is not None:
                out[s] = f[j]
    return out


def certified_cutoffs(measured: DataFrame, labels: DataFrame, tolerated: float = TOLERATED, level: float = LEVEL, rules=RULES) -> dict[str | None, dict[str, float]]:
    """By stratum and rule, the certified cutoff; a rule that isn't used, or a stratum without a certified choice, isn't there.

    The ``MAX_STRATA`` strata with most labelled texts stand alone; further ones that have any are pooled as one, None, and
    certified together. Null labels are left out; of repeated ones the largest counts; copies of a text count once.
    """
    found = _certify(_labelled(measured, labels, rules)[0], tolerated, level, rules)
    return {s: {r: c for r, c in zip(rules, cuts, strict=True) if c < math.inf} for s, cuts in found.items()}


def judge(docs: DataFrame, labels: DataFrame, tolerated: float = TOLERATED, level: float = LEVEL, carry: bool = False) -> DataFrame:
    """``doc_id, stratum``, counts, measures, ``base_failed``, ``rejected_by`` (names of rules) and ``kept`` of every document.

    Empty tables give no rows; a null or empty text fails the base; very long texts are measured whole; ties at a cutoff
    are rejected; repeated rows are judged alike; with too few labels nothing is certified and only the base rejects. Of
    the input's columns only ``doc_id``, ``text`` and ``lang`` are looked at; with ``carry`` all are returned in the struct
    ``_kl_row``. The measures are written once, in the shared folder.
    """
    measured = stored(measures(docs, carry), "quality")
    marked, pooled = _labelled(measured, labels, RULES)
    found = _certify(marked, tolerated, level, RULES)
    cuts = {s: F.array(*map(F.lit, c)) for s, c in found.items()}
    rows = measured
    if None in cuts:
        rows = rows.join(pooled.withColumn("_kl_pooled", F.lit(True)), "stratum", "left")
    own = _by_stratum(F.col("stratum"), {s: c for s, c in cuts.items() if s is not None}, "array<double>")
    rows = rows.withColumn("_kl_cuts", F.when(F.col("_kl_pooled"), cuts[None]).otherwise(own) if None in cuts else own)
    hits = F.filter(F.array(*[F.when(F.col(r) >= F.get("_kl_cuts", F.lit(k)), r) for k, r in enumerate(RULES)]), lambda x: x.isNotNull())
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.select(*measured.columns, failed.alias("base_failed"), hits.alias("rejected_by"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are judged kept, with their columns; each row by its own text, whatever its ``doc_id``.

    Nulls, empty and very long texts, ties, repeated rows and empty tables are as in ``judge``. Rows are written once with their measures, and not shuffled.
    """
    return judge(docs, labels, carry=True).where("kept").select("_kl_row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *COUNTS, "base_failed", "kept")
