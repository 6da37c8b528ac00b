"""Chat formatting by prefix-target expansion: one example for every assistant turn, all earlier turns as context.

Template: ``[SYS] text [/SYS]`` for system, ``[INST] text [/INST]`` for user, ``<s> text </s>`` for assistant and
``[TURN] role [|] text [/TURN]`` for any other role. A control string inside a text gets a backslash after its first
character (one more if it has some), which reading takes away again; so a text can't close or open a turn.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.llm.shared import table

_CONTROL = r"/?SYS\]|/?INST\]|/?TURN\]|\|\]|/?s>"
_OPEN = re.compile(r"\[SYS\] |\[INST\] |<s> |\[TURN\] ")
_NAMED = {"[SYS] ": ("system", " [/SYS]"), "[INST] ": ("user", " [/INST]"), "<s> ": ("assistant", " </s>")}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<])(\\*)({_CONTROL})", r"$1\\$2$3")


def unescape(text: str) -> str:
    return re.sub(rf"([\[<])\\(\\*)({_CONTROL})", r"\1\2\3", text)


def render(role: Column, text: Column) -> Column:
    t = escape(text)
    return (
        F.when(role == "system", F.concat(F.lit("[SYS] "), t, F.lit(" [/SYS]")))
        .when(role == "user", F.concat(F.lit("[INST] "), t, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(F.lit("<s> "), t, F.lit(" </s>")))
        .otherwise(F.concat(F.lit("[TURN] "), escape(role), F.lit(" [|] "), t, F.lit(" [/TURN]")))
    )


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, unescaped."""
    out, at = [], 0
    while at < len(formatted):
        m = _OPEN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn begins at {at}")
        role, close = _NAMED.get(m[0], ("", " [/TURN]"))
        end = formatted.index(close, m.end() - 1 if formatted.startswith(close, m.end() - 1) else m.end())
        body = formatted[m.end() : end]
        if m[0] == "[TURN] ":
            role, _, body = body.partition(" [|] ")
            role = unescape(role)
        out.append((role, unescape(body)))
        at = end + len(close)
    return out


def expand_targets(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, target`` (index of the reply among the turns, null in the last kind), ``text, loss_start, loss_end``.

    One row for each assistant turn: ``text`` holds all turns up to it and only code points ``loss_start`` up to
    ``loss_end`` are trained on. Turns after the last reply, and conversations without one, would be in no example:
    such a conversation gets one more row with all its turns and an empty loss. Null texts and roles count as empty;
    turns of equal number are ordered by role, then text; repeated rows are turns of their own; an empty table gives
    no rows. An example is one value by definition, so a conversation must fit in a cell.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    shown = turns.select(
        "conv_id",
        "role",
        render(F.col("role"), F.col("text")).alias("shown"),
        F.row_number().over(order).alias("k"),
        F.count("*").over(Window.partitionBy("conv_id")).alias("n_turns"),
        F.struct("turn", "role", "text").alias("at"),
    )
    prefix = F.collect_list("shown").over(Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    is_reply = F.col("role") == "assistant"
    whole = shown.select("conv_id", "n_turns", "role", "k", "shown", F.array_join(prefix, "").alias("text"))
    kept = whole.where(is_reply | (F.col("k") == F.col("n_turns")))
    return kept.select(
        "conv_id",
        "n_turns",
        F.when(is_reply, F.col("k") - 1).alias("target"),
        "text",
        # "<s> " before and " </s>" after the reply
        F.when(is_reply, F.length("text") - F.length("shown") + 4).otherwise(F.length("text")).alias("loss_start"),
        F.when(is_reply, F.length("text") - 5).otherwise(F.length("text")).alias("loss_end"),
    )


def _digest(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def read_back(examples: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of every conversation, from its examples' texts.

    Each example is read where it is: only its reply, and from the one that has all turns the digest of them, reach the
    shuffle, so a task never gets a conversation's examples together. Replies are put in the order of their examples' lengths,
    which grow from turn to turn. A null ``conv_id`` is a conversation like others; an empty table gives no rows.
    """

    def read(batches):
        for batch in batches:
            rows = []
            for n, target, text, start, end in zip(*[batch.column(c).to_pylist() for c in range(1, 6)], strict=True):
                turns = read_turns(text) if target is None or target == n - 1 else None
                found = (None, None) if turns is None else (len(turns), _digest("".join(f"{role}\n{t}\n" for role, t in turns)))
                rows.append((len(text), unescape(text[start:end]), *found))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=["conv_id", "chars", "reply", "n_turns", "turns_sha256"])

    key = examples.schema["conv_id"].dataType.simpleString()
    rows = examples.select("conv_id", "n_turns", "target", "text", "loss_start", "loss_end")
    parts = rows.mapInArrow(read, f"conv_id {key}, chars long, reply string, n_turns long, turns_sha256 string")
    replies = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chars", "reply"))), lambda x: x["reply"]), "")
    whole = parts.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), replies.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``formatted_chars`` is the sum over a conversation's formatted examples."""
    trick = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(trick).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text").union(extra)
    return read_back(expand_targets(rows))
