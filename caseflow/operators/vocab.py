"""One shared vocabulary for all categorical columns (V1) and encoding (V2).

Codes are dense, 1..N, by byte order of the value, so they do not depend on
file order or partitioning. Numbering never runs in a single task: the
distinct values are range-sorted and checkpointed, every value's place inside
its partition comes from ``monotonically_increasing_id`` (partition index in
the upper bits, row index in the lower 33), and per-partition offsets come
from a table with one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..names import as_list, col
from ..session import cut_lineage

_ROW_BITS = 33  # layout of monotonically_increasing_id
# Estimated bytes per vocabulary entry in a broadcast hash relation, on top of the text
# (which is stored twice: as the hash key and in the row).
_ENTRY_OVERHEAD = 64
DEFAULT_BROADCAST_LIMIT = 128 * 1024 * 1024
FREQUENT_PARTS = 1000  # a value with a thousandth of all cells is frequent


def relation_bytes(size: int, text_bytes: int) -> int:
    """Upper estimate of a broadcast hash relation from ``size`` values to codes."""
    return 2 * text_bytes + size * _ENTRY_OVERHEAD


@dataclass
class Vocabulary:
    """``table`` has columns ``value`` (string) and ``code`` (int)."""

    table: DataFrame
    size: int
    text_bytes: int  # UTF-8 bytes of all values

    @property
    def estimated_bytes(self) -> int:
        """Upper estimate of the broadcast hash relation built from ``table``."""
        return relation_bytes(self.size, self.text_bytes)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values over all the columns, compared as text."""
    cols = as_list(columns)
    texts = df.select(*[col(c).cast("string").alias(f"v{i}") for i, c in enumerate(cols)])
    long = texts.unpivot([], [f"v{i}" for i in range(len(cols))], "source", "value")
    return long.where(F.col("value").isNotNull()).select("value").distinct()


def build_vocabulary(df: DataFrame, columns: Sequence[str]) -> Vocabulary:
    """V1: number the distinct values of ``columns`` 1..N in value order."""
    ordered = cut_lineage(distinct_values(df, columns).orderBy("value"))
    mid = F.monotonically_increasing_id()
    placed = ordered.select("value",
                            F.shiftright(mid, _ROW_BITS).alias("part"),
                            mid.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("pos"))
    # One row per partition of the checkpoint: bounded by the partition count.
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                       F.sum(F.octet_length("value")).alias("bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    table = (placed.join(F.broadcast(offsets), "part")
             .select("value", (F.col("offset") + F.col("pos") + 1).cast("int").alias("code")))
    stats = sizes.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    return Vocabulary(table=table, size=int(stats.n or 0), text_bytes=int(stats.bytes or 0))


def _code(value, code):
    """NULL stays NULL; a value missing from the vocabulary becomes 0."""
    return F.when(value.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(code, F.lit(0)))


def encode(df: DataFrame, vocab: Vocabulary, columns: Sequence[str],
           broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """V2: replace each categorical value by its code (int).

    Small vocabulary (checked size): one broadcast hash join per column, no
    shuffle of ``df``. Larger: the rows are written once and numbered, the
    columns become ``(row, value)`` pairs, joined with the vocabulary on
    ``value`` and put back by row number. Both ways give the same rows; no
    user key is needed, so NULL and repeated keys do not matter.
    """
    cols = [c for c in as_list(columns) if c in df.columns]
    if not cols:
        return df
    if vocab.estimated_bytes <= broadcast_limit:
        return _encode_broadcast(df, vocab, cols)
    return _encode_shuffle(df, vocab, cols)


def _encode_broadcast(df: DataFrame, vocab: Vocabulary, cols: list[str]) -> DataFrame:
    out = df
    for i, c in enumerate(cols):
        side = vocab.table.select(F.col("value").alias(f"__v{i}"), F.col("code").alias(f"__c{i}"))
        out = out.join(F.broadcast(side), col(c).cast("string") == F.col(f"__v{i}"), "left")
    index = {c: i for i, c in enumerate(cols)}
    return out.select(*[_code(col(c), F.col(f"__c{index[c]}")).alias(c) if c in index else col(c)
                        for c in df.columns])


def numbered_rows(df: DataFrame) -> DataFrame:
    """``df`` and a number ``__row`` a row, written so that numbers never change."""
    return cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))


def row_codes(numbered: DataFrame, columns: Sequence[str], dictionary: DataFrame,
              tags: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The codes of all cells of ``columns`` by row number: a table of ``__row``
    and one column for each, and the names of these.

    ``dictionary`` is (value, code), or with ``tags`` (column, value, code) where
    a tag names each column's own part of it. All columns go through one join:
    their cells become ``(row, column, value)`` and come back by one exchange on
    the row number. NULL stays NULL, an unknown value is 0.
    """
    names = list(tags) if tags else [f"__e{i}" for i in range(len(columns))]
    keys = ["column", "value"] if tags else ["value"]
    long = (numbered.select("__row", *[col(c).cast("string").alias(n) for c, n in zip(columns, names)])
            .unpivot(["__row"], names, "column", "value").where(F.col("value").isNotNull()))
    # A value that holds a large part of all cells would be one join key: there are at most
    # FREQUENT_PARTS such values, so these few are broadcast and only the others are shuffled.
    counts = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = numbered.count() * len(columns)
    frequent = counts.where(F.col("n") * FREQUENT_PARTS >= total).join(dictionary, keys, "left") \
        .select(*keys, F.coalesce("code", F.lit(0)).alias("code"))
    often = long.join(F.broadcast(frequent), keys).select("__row", "column", "code")
    rare = long.join(F.broadcast(frequent.select(*keys)), keys, "left_anti") \
        .join(dictionary, keys, "left").select("__row", "column", F.coalesce("code", F.lit(0)).alias("code"))
    # back to one row per row number: one conditional max per column (a single hash
    # aggregation with one exchange; ``pivot`` would plan two)
    wide = often.unionByName(rare).groupBy("__row").agg(
        *[F.max(F.when(F.col("column") == n, F.col("code"))).alias(n) for n in names])
    return wide, dict(zip(columns, names))


def _encode_shuffle(df: DataFrame, vocab: Vocabulary, cols: list[str]) -> DataFrame:
    numbered = numbered_rows(df)
    wide, index = row_codes(numbered, cols, vocab.table)
    return numbered.join(wide, "__row", "left").select(
        *[F.col(index[c]).alias(c) if c in index else col(c) for c in df.columns])
