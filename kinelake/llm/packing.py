"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits one sequence. The covering program (fewest configurations that hold
all pieces) is solved by multiplicative weights: lengths not covered yet are dear, and a knapsack dynamic program prices
the best next configuration. Every pricing also gives a bound: no packing needs fewer sequences than the demand's value
by the value of the best configuration. The solution is rounded down; what is left of the histogram is packed best-fit,
longest first. The program is solved for several rates and rounded for several amounts of waste allowed, and the plan of fewest sequences is taken;
best-fit of everything (the program's solution rounded to nothing) is one of them. All this sees only counts of lengths,
so its cost doesn't depend on the number of documents.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelake.llm.shared import masked, partitions, stored, table

CAPACITY, END_ID, SALTS, TOKENIZER = 1024, 2, 64, "byte_bpe_50k"
#: what the program is solved and rounded with: rates of the weights, tokens of waste of a configuration
RATES, SLACKS = (1.0, 4.0), (0, 4, 1024)


# --- the program over the histogram ---


def best_configuration(value: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack by dynamic programming: how often each length is taken for the greatest value. ``value[0]`` is 0."""
    usable = np.flatnonzero(value > 0)
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    ends = np.searchsorted(usable, np.arange(capacity + 1), side="right")
    worth = value[usable]
    for c in range(1, capacity + 1):
        k = ends[c]
        if k:
            total = worth[:k] + best[c - usable[:k]]
            j = int(total.argmax())
            best[c], take[c] = total[j], usable[j]
        if best[c - 1] > best[c]:
            best[c], take[c] = best[c - 1], 0
    out, c = np.zeros(capacity + 1, int), capacity
    while c > 0:
        if take[c]:
            out[take[c]] += 1
            c -= take[c]
        else:
            c -= 1
    return out


def configuration_program(demand: np.ndarray, capacity: int, eta: float, step: float = 0.2, rounds: int = 1500) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Configurations with amounts that cover the demand up to less than a piece of each length, and a bound from below.

    A length's weight falls by ``exp(-eta)`` as its whole demand is covered, against the mean of all; its price is this
    weight by its size (the dual of a program whose sequences can all be filled). Each round takes the dearest
    configuration until a share ``step`` of the demand of one of its lengths, or what is left of it, is covered.
    """
    left, out, sizes, bound = demand.astype(float).copy(), [], np.arange(capacity + 1) / capacity, 0.0
    for _ in range(rounds):
        need = left >= 1
        if not need.any():
            break
        share = np.where(need, left / np.maximum(demand, 1), 0.0)
        mean = (share * demand * sizes).sum() / (demand[need] * sizes[need]).sum()
        price = np.where(need, sizes * np.exp(eta * (share - mean)), 0.0)
        config = best_configuration(price, capacity)
        bound = max(bound, float(price @ demand) / float(price @ config))
        used = np.flatnonzero(config)
        amount = min(float((left[used] / config[used]).min()), max(1.0, step * float((demand[used] / config[used]).min())))
        left[used] -= amount * config[used]
        out.append((config, amount))
    return out, bound


def least_sequences(demand: np.ndarray, capacity: int = CAPACITY) -> int:
    """A bound from below by three prices: the size, one for all pieces, and one by how many pieces of that length fit a sequence."""
    sizes = np.arange(len(demand))
    out = -(-int(demand @ sizes) // capacity)
    for worth in (np.ones(len(demand)), 1 / (capacity // np.maximum(sizes, 1))) if demand.any() else ():
        price = np.where(demand > 0, worth, 0.0)
        out = max(out, math.ceil(float(price @ demand) / float(price @ best_configuration(price, capacity)) - 1e-6))
    return out


def best_fit(demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit, longest first, over counts: equal sequences are kept as one group, so many pieces move at once."""
    groups: dict[tuple[tuple[int, int], ...], int] = {}
    free: list[dict] = [{} for _ in range(capacity + 1)]

    def put(items: tuple, room: int, n: int) -> None:
        free[room][items] = free[room].get(items, 0) + n

    for length in range(capacity, 0, -1):
        left = int(demand[length])
        room = length
        while left and room <= capacity:
            while left and free[room]:
                items, n = next(iter(free[room].items()))
                times = min(room // length, max(1, left // n))
                move = min(n, left // times)
                if move == n:
                    del free[room][items]
                else:
                    free[room][items] = n - move
                grown = (*items, (length, times))
                if room - length * times:
                    put(grown, room - length * times, move)
                else:
                    groups[grown] = groups.get(grown, 0) + move
                left -= move * times
            room += 1
        each = capacity // length
        for times, n in ((each, left // each), (left % each, 1)):
            if times and n:
                if capacity - length * times:
                    put(((length, times),), capacity - length * times, n)
                else:
                    key = ((length, times),)
                    groups[key] = groups.get(key, 0) + n
    for at in free:
        for items, n in at.items():
            groups[items] = groups.get(items, 0) + n
    out = []
    for items, n in groups.items():
        config: dict[int, int] = {}
        for length, times in items:
            config[length] = config.get(length, 0) + times
        out.append((config, n))
    return out


def _rounded(program: list[tuple[np.ndarray, float]], demand: np.ndarray, capacity: int, slack: int) -> list[tuple[dict[int, int], int]]:
    """Amounts rounded down, of configurations that waste at most ``slack``; the rest best-fit."""
    left, out, sizes = demand.astype(np.int64).copy(), [], np.arange(len(demand))
    for config, amount in program:
        used = np.flatnonzero(config)
        if int(config @ sizes) < capacity - slack:
            continue
        n = min(int(amount), int((left[used] // config[used]).min()))
        if n > 0:
            out.append(({int(x): int(config[x]) for x in used}, n))
            left[used] -= n * config[used]
    return out + best_fit(left, capacity)


def plan_with_bound(demand: np.ndarray, capacity: int = CAPACITY, rates=RATES, slacks=SLACKS) -> tuple[list[tuple[dict[int, int], int]], int]:
    """Configurations with whole numbers of sequences that hold exactly the pieces of ``demand`` (a count for each length), and a bound from below.

    The plan of fewest sequences of all rates, roundings and plain best-fit; none is tried after one meets the bound.
    """
    needs = lambda plan: sum(n for _, n in plan)
    best, bound = best_fit(demand.astype(np.int64), capacity), least_sequences(demand, capacity)
    for eta in rates:
        if needs(best) <= bound:
            break
        program, least = configuration_program(demand.astype(float), capacity, eta)
        bound = max(bound, math.ceil(least - 1e-6))
        best = min([best, *(_rounded(program, demand, capacity, slack) for slack in slacks)], key=needs)
    return best, bound


def plan_sequences(demand: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    return plan_with_bound(demand, capacity)[0]


# --- documents ---


def token_encoder(name: str = TOKENIZER):
    """Bytes to ids as the ``tokenizers`` file gives them (``add_special_tokens=False``).

    The same vocabulary has a faster reader; it is used for texts of common letters without special strings, where both
    agree, and the file itself for all others.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = re.compile(r"[\t\n\r -~ -ɏ]*")

    def encode(text: str) -> list[int]:
        if "<|" in text or len(text) > 1 << 20 or not plain.fullmatch(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and the end id; with ``with_ids``, also ``ids``.

    A null or empty text is the end id alone. Only documents of more than ``capacity`` ids are cut, so that all pieces but
    the first are full, however long the text. Repeated rows give their pieces each; an empty table gives none; columns
    other than ``doc_id`` and ``text`` are not looked at.
    """
    import zlib

    def cut(batches):
        encode = token_encoder(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                rows: list[list] = [[], [], [], [], [], []]
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end_id], "<u4")
                    first = len(ids) % capacity or capacity
                    for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                        part = ids[start : first + k * capacity]
                        for column, v in zip(rows, (key, k, start, len(part), zlib.crc32(part.tobytes()), part.tolist() if with_ids else None), strict=True):
                            column.append(v)
                types = (some.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 5 + with_ids
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows[:n], types[:n], strict=True)], names=names[:n])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """All columns of ``pieces`` (one ``length`` of 1 to ``capacity`` each) with ``sequence_id`` and ``offset``.

    Pieces are told apart by their rank among those of equal length, so one common length would be one sort: ranks are
    counted within salted parts and carried on by the parts' counts. There are as many parts of a length as partitions, so
    the driver gets that many counts a length at most. Columns ``sequence_id`` and ``offset`` of the input's are
    replaced, no other name matters. Repeated rows (ties) are packed each; an empty table stays empty.
    """
    salts = salts or max(SALTS, partitions(pieces))
    rows, restored = masked(pieces, ("doc_id", "piece", "length"))
    salted = rows.withColumn("_kl_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = sorted((r["length"], r["_kl_salt"], r["n"]) for r in salted.groupBy("length", "_kl_salt").agg(F.count("*").alias("n")).collect())
    demand, before = np.zeros(capacity + 1, np.int64), np.zeros((capacity + 1, salts), np.int64)
    for length, salt, n in counts:
        before[length, salt] = demand[length]
        demand[length] += n
    # slots: for each length, runs of ranks that stand at one offset of consecutive sequences
    slots: list[tuple[int, int, int, int]] = []
    used, sequence = np.zeros(capacity + 1, np.int64), 0
    for config, n in plan_sequences(demand, capacity):
        offset = 0
        for length, times in sorted(config.items(), reverse=True):
            for _ in range(times):
                slots.append((length, int(used[length]), sequence, offset))
                used[length] += n
                offset += length
        sequence += n
    slots.sort()
    keys = np.array([(length << 44) + first for length, first, _, _ in slots], np.int64)
    firsts, sequences, offsets = (np.array([s[k] for s in slots], np.int64) for k in (1, 2, 3))
    columns = rows.columns
    at = columns.index("length")
    order = Window.partitionBy("length", "_kl_salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_kl_rank", F.row_number().over(order).cast("long") - 1)

    def place(batches):
        for batch in batches:
            length, salt, rank = batch.column(at).to_numpy(), batch.column(len(columns)).to_numpy(), batch.column(len(columns) + 1).to_numpy()
            rank = rank + before[length, salt]
            k = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(sequences[k] + rank - firsts[k]), pa.array(offsets[k])], names=[*columns, "sequence_id", "offset"])

    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return restored(ranked.mapInArrow(place, schema), "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places. They are written once, narrow, in the shared folder."""
    return pack(stored(token_pieces(docs, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves. The ids are written once, in the shared folder."""
    placed = pack(stored(token_pieces(docs, capacity, with_ids=True), "ids"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
