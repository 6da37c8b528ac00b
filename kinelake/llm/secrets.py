"""Secret scans: named patterns, and sliding-window Shannon entropy over candidate strings. DataFrame operations only.

The entropy of a window of ``WINDOW`` characters is kept up by counts: as the window moves by one character one count
falls and one rises, and the sum of ``c log2 c`` is corrected by those two terms. Limits differ by character class.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelake.llm.shared import let, masked, running_sums, steps, table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}"
#: character class (whole string): least entropy in bits of some window
CLASSES = (("^[0-9]+$", 9.0), ("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.6), ("", 3.8))
#: strings that are no secrets, after leading separators: words and names without digits, UUIDs, dates and paths
ALLOWED = (
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "^[0-9/_=+-]+$",
    "^/?([a-zA-Z]+[/_=-])+[a-zA-Z0-9]{0,12}$",
    "(?i)(example|sample|placeholder|xxxxxx|000000|123456789)",
    "^[=_+/-]+$",
)
LEADING = "^[=_+/-]+"
#: without digits, names of things: at most one change from lower to upper case in so many characters
CHARS_A_CHANGE = 5


def entropy(text: Column) -> Column:
    """The largest entropy, in bits, of the windows of a string over ``ALPHABET``; of a shorter string, -1."""
    log = lambda c: F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0)
    n = len(ALPHABET)

    def moved(state, codes, k):
        """The window that ends at k: one more of codes[k], one less of codes[k - WINDOW]."""

        def with_in(code):
            c = F.get(state["counts"], code)
            total = state["sum"] - log(c) + log(c + 1)
            counts = F.transform(state["counts"], lambda v, j: v + (j == code).cast("int"))
            return F.struct(counts.alias("counts"), total.alias("sum"), state["best"].alias("best"))

        def with_out(s):
            old = F.get(codes, k - WINDOW)
            c = F.get(s["counts"], old)
            gone = F.struct(
                F.transform(s["counts"], lambda v, j: v - (j == old).cast("int")).alias("counts"), (s["sum"] - log(c) + log(c - 1)).alias("sum"), s["best"].alias("best")
            )
            return F.when(k >= WINDOW, gone).otherwise(s)

        def rated(s):
            bits = F.lit(math.log2(WINDOW)) - s["sum"] / WINDOW
            return F.struct(s["counts"].alias("counts"), s["sum"].alias("sum"), F.when(k >= WINDOW - 1, F.greatest(s["best"], bits)).otherwise(s["best"]).alias("best"))

        return let(let(let(F.get(codes, k), with_in), with_out), rated)

    start = F.struct(F.array_repeat(F.lit(0), n).alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("best"))
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return let(codes, lambda cs: F.aggregate(steps(F.size(cs)), start, lambda s, k: moved(s, cs, k))["best"])


def _found(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """Spans of leftmost non-overlapping matches as ``kind, start, end, value``: what lies between them gives the places."""

    def of(parts, matches, values):
        gaps = F.transform(steps(F.size(matches)), lambda k: F.length(F.get(parts, k)) + F.length(F.get(matches, k)))
        ends = let(gaps, lambda g: F.zip_with(running_sums(g), g, lambda a, b: a + b))
        spans = F.zip_with(ends, matches, lambda e, m: F.struct(F.lit(kind).alias("kind"), (e - F.length(m)).alias("start"), e.alias("end")))
        return F.zip_with(spans, values, lambda s, v: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))

    parts, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = let(parts, lambda p: let(matches, lambda m: let(values, lambda v: of(p, m, v))))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>"))


def _high_entropy(value: Column) -> Column:
    """By the value after leading separators: flags, npm's ``_auth=`` and base64 that begins with + or / are judged by the rest."""

    def judged(rest):
        least = F.lit(CLASSES[-1][1])
        for pattern, bits in reversed(CLASSES[:-1]):
            least = F.when(rest.rlike(pattern), F.lit(bits)).otherwise(least)
        changes = F.size(F.regexp_extract_all(rest, F.lit("[a-z][A-Z]"), F.lit(0)))
        allowed = rest.rlike("^[^0-9]+$") & (F.length(rest) >= CHARS_A_CHANGE * changes)
        for pattern in ALLOWED:
            allowed = allowed | rest.rlike(pattern)
        return F.when(allowed, False).otherwise(entropy(rest) >= least)

    return let(F.regexp_replace(value, LEADING, ""), judged)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``secrets``: array of ``kind, start, end`` (code points, end exclusive) by start, then kind.

    Patterns are never suppressed; candidate strings of high entropy are reported unless allow-listed or overlapping a
    pattern's span. A null text is empty and has none; repeated rows are scanned alike; very long texts are scanned whole;
    an empty table stays empty; spans that start at one place (ties) stand in the order of ``KINDS``.
    A column named ``secrets`` of the input's is replaced; columns beginning with ``_kl_`` are not returned.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.withColumns(
        {
            "_kl_assign": F.filter(_found(text, ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= 8),
            "_kl_access": _found(text, ACCESS, "access"),
            "_kl_hex": _found(text, HEX, "hex"),
            "_kl_more": F.filter(_found(text, CANDIDATE, "entropy"), lambda s: _high_entropy(s["value"])),
        }
    )
    known = F.concat("_kl_assign", "_kl_access", "_kl_hex")
    apart = F.filter("_kl_more", lambda s: ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    ordered = F.sort_array(F.transform(F.concat(known, apart), lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    slim = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return base.withColumn("secrets", slim).drop("_kl_assign", "_kl_access", "_kl_hex", "_kl_more")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with its columns: every secret in ``text`` replaced by a mark, and ``n_chars``, where there is one, counted again.

    Spans that touch or overlap (ties) get one mark. A null text stays null, an empty one empty; very long texts are scanned
    whole; repeated rows are treated alike; an empty table stays empty; no column of the input's but these two is changed.
    """

    def joined(spans):
        """Spans that touch or overlap, as one; the last is kept apart while it may still grow."""
        begin = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("end"))

        def add(a, s):
            grown = F.struct(a["done"].alias("done"), a["start"].alias("start"), F.greatest(a["end"], s["end"]).alias("end"))
            closed = F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["end"].alias("end"))))
            return F.when(s["start"] <= a["end"], grown).otherwise(F.struct(closed.alias("done"), s["start"].alias("start"), s["end"].alias("end")))

        last = F.aggregate(spans, begin, add)
        # the first of "done" is the opening one without characters
        return let(last, lambda a: F.concat(F.slice(a["done"], 2, F.lit(2**31 - 1)), F.array(F.struct(a["start"].alias("start"), a["end"].alias("end")))))

    def cut(spans):
        edge = lambda k: F.coalesce(F.get(spans, k)["end"], F.lit(0))
        kept = F.transform(spans, lambda s, k: F.substring(F.col("text"), edge(k - 1) + 1, s["start"] - edge(k - 1)))
        tail = F.substring(F.col("text"), edge(F.size(spans) - 1) + 1, F.length("text"))
        return F.concat(F.array_join(kept, mark), F.lit(mark), tail)

    text = F.when(F.size("secrets") > 0, let(joined(F.col("secrets")), cut)).otherwise(F.col("text"))
    rows, restored = masked(docs, ("text",))
    out = scan_secrets(rows).withColumn("text", text)
    if "n_chars" in docs.columns:
        at = rows.columns[docs.columns.index("n_chars")]
        out = out.withColumn(at, F.when(F.size("secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(at)))
    return restored(out)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        *map(n, KINDS[:3]),
        F.sha2(said(F.filter("secrets", lambda s: s["kind"] != "entropy")).cast("binary"), 256).alias("base_sha256"),
        said(F.col("secrets")).alias("spans"),
    )
