"""Column builders for annotation lines, numbers in text, chunks, prompts and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a number in annotations; a plain cast would also take suffixes such as ``8d``.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(s: Column) -> Column:
    return F.when(s.rlike(NUMBER), F.trim(s).try_cast("double"))


def annotation_interval(line: Column) -> Column:
    """``struct(start_ms, end_ms)`` of a line, null where it has none.

    ``n;a-b`` is in seconds. Otherwise the first two tokens count, as milliseconds if either is over 1000, else as seconds.
    """
    s = F.trim(line)
    ends = F.split(F.get(F.split(s, ";"), F.lit(1)), "-")
    a, b = number(F.get(ends, F.lit(0))), number(F.get(ends, F.lit(1)))
    listed = s.contains(";") & (F.size(ends) == 2) & a.isNotNull() & b.isNotNull()
    tokens = F.split(F.trim(F.regexp_replace(s, r"[,\s]+", " ")), " ")
    c, d = number(F.get(tokens, F.lit(0))), number(F.get(tokens, F.lit(1)))
    unit = F.when((c > 1000) | (d > 1000), 1.0).otherwise(1000.0)
    pair = lambda x, y: F.struct(x.alias("start_ms"), y.alias("end_ms"))
    return F.when(listed, pair(a * 1000, b * 1000)).when(c.isNotNull() & d.isNotNull(), pair(c * unit, d * unit))


def short_number(v: Column) -> Column:
    """Two places, without trailing zeros and point."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.2f", v), "0+$", ""), "\\.$", "")


def extended_line(line: Column, delta: Column) -> Column:
    """``n;a-b`` with b later by ``delta``; any other line unchanged."""
    s = F.trim(line)
    head, rest = F.get(F.split(s, ";", 2), F.lit(0)), F.get(F.split(s, ";", 2), F.lit(1))
    a, b = (number(F.get(F.split(rest, "-", 2), F.lit(i))) for i in (0, 1))
    return F.when(a.isNotNull() & b.isNotNull(), F.concat(head, F.lit(";"), short_number(a), F.lit("-"), short_number(b + delta))).otherwise(line)


def rounded_text(ms: Column) -> Column:
    """Whole number, halves to even."""
    return F.bround(ms, 0).cast("long").cast("string")


def frame_of(ms: Column, fps: Column | float) -> Column:
    return (ms / 1000 * fps).cast("int")


def in_range(intervals: Column, start: Column, end: Column) -> Column:
    return F.filter(intervals, lambda i: (i["start_ms"] >= start) & (i["end_ms"] <= end))


def rate(fraction: Column, default: float = 20.0) -> Column:
    """``num/den`` as a number; ``default`` where it isn't one."""
    parts = F.split(fraction, "/")
    return F.coalesce(F.try_divide(number(F.get(parts, F.lit(0))), number(F.get(parts, F.lit(1)))), F.lit(default))


def seconds(times: Column) -> Column:
    """A list of times in seconds; one with a value over 1000 is in milliseconds."""
    return F.when(F.array_max(times) > 1000, F.transform(times, lambda t: t / 1000)).otherwise(times)


def chunk_starts(length: Column, size: int, overlap: int) -> Column:
    step = size - overlap
    return F.when(length > 0, F.transform(F.sequence(F.lit(0), F.ceil(length / step).cast("int") - 1), lambda k: k * step)).otherwise(F.array().cast("array<int>"))


def chunks(text: Column, size: int = 256, overlap: int = 20) -> Column:
    """Pieces of ``size`` characters, each beginning ``overlap`` before the end of the one before."""
    return F.transform(chunk_starts(F.length(text), size, overlap), lambda s: F.substring(text, s + 1, F.lit(size)))


def filled(template: str, **values: Column) -> Column:
    """A template with ``{#name#}`` replaced."""
    out = F.lit(template)
    for name, v in values.items():
        out = F.replace(out, F.lit("{#" + name + "#}"), v)
    return out


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def hashed_choice(n: int, *key: Column) -> Column:
    """A repeatable choice of 0 .. n-1 by md5 of the joined key."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key]).cast("binary")), 1, 8), 16, 10).cast("long") % n
