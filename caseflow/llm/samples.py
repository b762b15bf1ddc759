"""Bounded training samples and the held-out rule.

A model learns from a bounded sample of labelled documents: the ``limit`` ids
that hash lowest, so the choice is the same on every run and says nothing of
the order of the table. An id stands for one row, that of the smallest text
hash; a text of more than ``TEXT_BYTES`` is not learned from, and the sample
ends before ``SAMPLE_BYTES`` of text. These bounds are for training alone and
bound what reaches the driver; scoring reads every row and every whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import quoted

#: Bytes of text that a model learns from, together and in one document.
SAMPLE_BYTES, TEXT_BYTES = 32 << 20, 1 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo 4, is 2; false for a null id."""
    return F.coalesce(F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def in_order() -> list[Column]:
    """The order of a sample: ids are unique in it, so it is complete."""
    return [F.xxhash64("id"), F.col("id")]


def texts_of(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text",
             sample_bytes: int = SAMPLE_BYTES, text_bytes: int = TEXT_BYTES) -> DataFrame:
    """(text and the columns of ``chosen``), one row for each of its ids; the
    caller bounds ``chosen``, whose ids are unique and not null."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    texts = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).cast("string").alias("text"))
    one = texts.join(F.broadcast(chosen), "id").where(size <= text_bytes).groupBy(*chosen.columns) \
        .agg(F.min(F.struct(F.xxhash64("text").alias("rk"), "text")).alias("one"))
    rows = cut_lineage(one.select(*chosen.columns, F.col("one.text").alias("text")))
    so_far = F.sum(size).over(Window.orderBy(*in_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = rows.select("id", so_far.alias("total")).where(F.col("total") <= sample_bytes)
    return rows.join(F.broadcast(fits.select("id")), "id")


def labelled(docs: DataFrame, labels: DataFrame, columns: list[str], limit: int, doc_id: str = "doc_id",
             text: str = "text", **bounds: int) -> DataFrame:
    """(id, text, *columns) of the sample. A document labelled twice has its largest
    label; a null id, a null label or a held-out id never enters."""
    rows = labels.select(F.col(quoted(doc_id)).alias("id"), *[F.col(quoted(c)).cast("int").alias(c) for c in columns]) \
        .where(F.col("id").isNotNull() & ~held_out("id"))
    rows = rows.groupBy("id").agg(*[F.max(c).alias(c) for c in columns])
    for c in columns:
        rows = rows.where(F.col(c).isNotNull())
    own = docs.select(F.col(quoted(doc_id)).alias("id"))
    chosen = rows.join(own, "id", "left_semi").orderBy(*in_order()).limit(limit)
    return texts_of(docs, chosen, doc_id, text, **bounds).select("id", "text", *columns)
