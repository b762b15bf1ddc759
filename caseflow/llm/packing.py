"""Packing by cutting-stock column generation.

A document's ids end with ``end_id``. It is cut into full sequences and one
remainder, so no document of at most ``capacity`` ids is cut at all. Lengths
are counted in classes of ``unit`` ids (rounded up); lengths below ``exact`` are
classes of their own and fill sequences of their own, so that rounding never
costs a short text much. For either kind, a linear program over
patterns (how many pieces of each class one sequence takes) minimises the
number of sequences; a knapsack dynamic program over the duals prices new
patterns until none improves the bound. The rounded-down pattern counts and a
first-fit pass over what is left give every class an ordered list of slots,
and the pieces of a class, ranked over the whole table, take them in order.

Only the class histogram (at most ``exact + capacity / unit`` rows) reaches the
driver, and only the pattern list (of the same order) goes back. Ranks come
from counts per partition and class, so a class that holds a third of all
pieces is still ranked in parallel.

Defined results: a null or empty text is the end id alone; every row is packed
once, repeated rows included; a very long text is encoded whole in its task and
cut; extra columns are left out unless kept; an empty table gives no pieces. The string of a
special token in a text is that token, as the tokenizer has it.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..session import cut_lineage
from .arrow import lists, map_texts, quoted, schema_of, ship
from .tokens import encoder

CAPACITY, UNIT, END_ID = 4096, 16, 2
#: Pieces shorter than this are packed by their exact length.
EXACT = 128


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, text: str = "text", keep: Sequence[str] = ("doc_id",),
               capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids, in the order of the document."""
    def cut(rows, texts):
        ids, at = encoder(tokenizer).encode(texts)
        size = np.diff(at) + 1
        every = np.empty(len(ids) + len(size), dtype="<u4")
        ends = np.cumsum(size)
        last = np.zeros(len(every), dtype=bool)
        last[ends - 1] = True
        every[last], every[~last] = end_id, ids
        n = -(-size // capacity)
        doc = np.repeat(np.arange(len(size)), n)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        start = nth * capacity
        length = np.minimum(capacity, size[doc] - start)
        begin = (ends - size)[doc] + start
        out = {None: doc, "start": start, "length": length, "doc_tokens": size[doc],
               "ids_crc32": [zlib.crc32(every[b:b + x].tobytes()) for b, x in zip(begin.tolist(), length.tolist())]}
        if with_ids:
            out["ids"] = lists(pa.array(every.astype(np.int64)), np.r_[0, np.cumsum(length)])
        return out

    return map_texts(docs, text, keep, "start long, length long, ids_crc32 long, doc_tokens long"
                     + (", ids array<long>" if with_ids else ""), cut)


# ------------------------------------------------------------ the program

def _best_pattern(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern of total size <= room."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        best[w], took[w] = best[w - 1], -1
        fits = np.searchsorted(size, w, "right")
        if fits:
            worth = value[:fits] + best[w - size[:fits]]
            k = int(np.argmax(worth))
            if worth[k] > best[w] + 1e-12:
                best[w], took[w] = worth[k], k
    pattern, w = np.zeros(len(size)), room
    while w > 0:
        if took[w] < 0:
            w -= 1
        else:
            pattern[took[w]] += 1
            w -= size[took[w]]
    return best[room], pattern


def solve(demand: dict[int, int], room: int, gap: float = 1e-3, steps: int = 4000) -> list[tuple[dict[int, int], int]]:
    """Patterns {class: pieces} and how many sequences take each, covering
    ``demand`` (class -> pieces; a class is its size in units)."""
    size = np.array(sorted(c for c, n in demand.items() if n > 0))
    if not len(size):
        return []
    need = np.array([demand[c] for c in size], dtype=float)
    fit = room // size
    basis = np.diag(fit).astype(float)  # columns are patterns
    inverse = np.diag(1.0 / fit)
    for step in range(steps):
        x, dual = inverse @ need, inverse.sum(axis=0)
        worth, column = _best_pattern(np.maximum(dual, 0), size, room)
        if worth <= 1 + 1e-9 or x.sum() * (1 - 1 / worth) <= gap * x.sum():
            break  # dual / worth is feasible: its value bounds the optimum from below
        move = inverse @ column
        can = move > 1e-9
        ratio = np.full(len(size), np.inf)
        ratio[can] = np.maximum(x[can], 0) / move[can]
        out = int(np.argmin(ratio))
        basis[:, out] = column
        inverse[out] /= move[out]
        rest = np.arange(len(size)) != out
        inverse[rest] -= np.outer(move[rest], inverse[out])
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
    count = np.floor(np.maximum(inverse @ need, 0) + 1e-6).astype(int)
    left = np.maximum(need - basis @ count, 0).astype(int)
    plan = [({int(size[i]): int(n) for i, n in enumerate(basis[:, k]) if n}, int(count[k]))
            for k in range(len(size)) if count[k]]
    while left.any():  # first fit, largest first; the same pattern as often as it lasts
        pattern, w = {}, room
        for i in np.argsort(-size):
            n = int(min(left[i], w // size[i]))
            if n:
                pattern[int(size[i])] = n
                w -= n * size[i]
        at = {int(c): i for i, c in enumerate(size)}
        times = min(int(left[at[c]]) // n for c, n in pattern.items())
        for c, n in pattern.items():
            left[at[c]] -= n * times
        plan.append((pattern, times))
    return plan


def slots(plan: list[tuple[dict[int, int], int]], first: int = 0) -> tuple[dict[int, np.ndarray], int]:
    """For each class, rows (slots before, first sequence, pieces a sequence),
    and the number after the last sequence."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    before: dict[int, int] = {}
    for pattern, times in plan:
        for c, n in pattern.items():
            out.setdefault(c, []).append((before.get(c, 0), first, n))
            before[c] = before.get(c, 0) + n * times
        first += times
    return {c: np.array(x, dtype=np.int64) for c, x in out.items()}, first


def plan_slots(histogram: dict[int, int], capacity: int, unit: int, exact: int) -> dict[int, np.ndarray]:
    """Slots of all classes: lengths below ``exact``, and ``exact + units``."""
    long, sequences = slots(solve({c - exact: n for c, n in histogram.items() if c >= exact}, capacity // unit))
    short, _ = slots(solve({c: n for c, n in histogram.items() if c < exact}, capacity), sequences)
    return {**short, **{c + exact: x for c, x in long.items()}}


def pack(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT, exact: int = EXACT) -> DataFrame:
    """The pieces (with a ``length``) and their ``sequence_id`` and ``offset``."""
    spark, columns = pieces.sparkSession, pieces.columns
    size = F.col("length")
    kind = F.when(size < exact, size).otherwise(exact + F.ceil(size / unit)).cast("int")
    table = cut_lineage(pieces.withColumn("__class", kind))
    table = table.withColumn("__part", F.spark_partition_id())
    counts = table.groupBy("__part", "__class").agg(F.count(F.lit(1)).alias("__n"))
    histogram = {r["__class"]: r["n"] for r in table.groupBy("__class").agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = spark.sparkContext.broadcast(plan_slots(histogram, capacity, unit, exact))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(
        Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .select("__part", "__class", "__before")
    stable = [F.col(quoted(c)) for c in columns if c in ("doc_id", "start", "length", "ids_crc32")]
    nth = F.row_number().over(Window.partitionBy("__part", "__class").orderBy(*stable)) - 1
    ranked = table.withColumn("__nth", nth).join(before, ["__part", "__class"])
    ranked = ranked.select(F.struct(*[F.col(quoted(c)) for c in columns]).alias("row"), size.alias("size"),
                           F.col("__class").alias("class"), (F.col("__nth") + F.col("__before")).alias("rank"))
    out = StructType([*ranked.schema.fields, StructField("sequence", schema_of("x long")["x"].dataType)])
    arrow = to_arrow_schema(out)

    def assign(batches):
        for batch in batches:
            kinds, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("class", "rank"))
            sequence = np.empty(len(kinds), dtype=np.int64)
            for c in np.unique(kinds):
                at = kinds == c
                own = sent.value[int(c)]
                k = np.searchsorted(own[:, 0], rank[at], "right") - 1
                sequence[at] = own[k, 1] + (rank[at] - own[k, 0]) // own[k, 2]
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence)], schema=arrow)

    ship(spark)
    within = Window.partitionBy("sequence").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.mapInArrow(assign, out).withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0))) \
        .select(*[F.col("row").getField(c).alias(c) for c in columns if c not in ("sequence_id", "offset")],
                F.col("sequence").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, unit: int = UNIT,
                   **options) -> DataFrame:
    """Cut and pack every row of ``docs``."""
    return pack(cut_pieces(docs, tokenizer, capacity=capacity, **options), capacity, unit)


def pack_report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The columns of ``op8_packing``."""
    return pack_documents(docs, tokenizer).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                  "sequence_id", "offset")
