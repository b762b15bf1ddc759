"""Feature stages and data splits (M1-M4)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import TRAIN_FRACTION
from ..names import as_list, col, quote
from ..operators.vocab import DEFAULT_BROADCAST_LIMIT, numbered_rows, relation_bytes, row_codes
from ..session import cut_lineage

LABEL = "label"
INDEXED_LABEL = "indexedLabel"
FEATURES = "features"


def _cap(name: str) -> str:
    # upper-case the first character only, keep the rest as it is
    return name[:1].upper() + name[1:]


def indexed_name(name: str) -> str:
    return "indexed" + _cap(name)


def encoded_name(name: str) -> str:
    return "encoded" + _cap(name)


_ROW_BITS = 33  # layout of monotonically_increasing_id


@dataclass(frozen=True)
class IndexedColumn:
    """A column's part of an index: its tag there, how many values, their UTF-8 bytes."""

    tag: str
    size: int
    text_bytes: int


@dataclass
class IndexModel:
    """Fitted M1 over several columns: ``dictionary`` (column, value, code)
    numbers each column's values 1..N by falling frequency. ``indexed<Name>``
    columns count from 0 (most frequent)."""

    dictionary: DataFrame
    columns: dict[str, IndexedColumn]
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT

    def subset(self, columns: Sequence[str]) -> IndexModel:
        """The same index for some of its columns."""
        return IndexModel(self.dictionary, {c: self.columns[c] for c in columns}, self.broadcast_limit)

    def labels(self, column: str) -> list[str]:
        """The values of one column in index order, on the driver: for the label
        (as many as the model has classes)."""
        own = self.dictionary.where(F.col("column") == self.columns[column].tag)
        return [r["value"] for r in own.orderBy("code").collect()]

    def codes(self, df: DataFrame) -> DataFrame:
        """``df`` with every ``indexed<Name>``; NULL where the value is NULL or unseen.

        An index of a checked small size: one broadcast hash join a column.
        A larger one: all columns through one dictionary join (``row_codes``),
        for one written copy of the rows however many columns there are.
        """
        names = {c: indexed_name(c) for c in self.columns}
        kept = [col(c) for c in df.columns if c not in names.values()]
        if sum(relation_bytes(x.size, x.text_bytes) for x in self.columns.values()) <= self.broadcast_limit:
            out, found = df, {}
            for i, (c, about) in enumerate(self.columns.items()):
                side = self.dictionary.where(F.col("column") == about.tag) \
                    .select(F.col("value").alias(f"__v{i}"), F.col("code").alias(f"__c{i}"))
                out = out.join(F.broadcast(side), col(c).cast("string") == F.col(f"__v{i}"), "left")
                found[c] = f"__c{i}"
        else:
            numbered = numbered_rows(df)
            wide, found = row_codes(numbered, list(self.columns), self.dictionary,
                                    [x.tag for x in self.columns.values()])
            out = numbered.join(wide, "__row", "left")
        code = {c: F.when(F.col(x) > 0, F.col(x) - 1).cast("double") for c, x in found.items()}
        return out.select(*kept, *[code[c].alias(n) for c, n in names.items()])

    def known(self, coded: DataFrame) -> DataFrame:
        """Rows of ``codes`` with a known value in each of this index's columns,
        which are marked as nominal for the model stages."""
        about = {indexed_name(c): {"ml_attr": {"type": "nominal", "name": indexed_name(c), "num_vals": x.size}}
                 for c, x in self.columns.items()}
        for name in about:
            coded = coded.where(col(name).isNotNull())
        return coded.select(*[col(c).alias(c, metadata=about[c]) if c in about else col(c) for c in coded.columns])

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``indexed<Name>`` for every column and removes rows with a NULL
        or unseen value in any of them."""
        return self.known(self.codes(df))


@dataclass
class IndexCategories:
    columns: list[str]
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT

    def fit(self, df: DataFrame) -> IndexModel:
        """Per column, its values numbered 1..N by falling frequency, ties by text.

        No value reaches the driver: (column, value) counts are range-sorted and
        checkpointed, a value's number is its place in its partition plus the
        places of its column in the partitions before.
        """
        tags = {f"v{i}": c for i, c in enumerate(self.columns)}
        texts = df.select(*[col(c).cast("string").alias(t) for t, c in tags.items()])
        long = texts.unpivot([], list(tags), "column", "value").where(F.col("value").isNotNull())
        ordered = cut_lineage(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
                              .orderBy("column", F.desc("n"), "value"))
        mid = F.monotonically_increasing_id()
        placed = ordered.select("column", "value", F.shiftright(mid, _ROW_BITS).alias("part"),
                                mid.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("pos"))
        # at most one row per partition and column
        sizes = placed.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"),
                                                     F.sum(F.octet_length("value")).alias("bytes"))
        before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")) \
            .select("column", "part", "offset")
        dictionary = placed.join(F.broadcast(offsets), ["column", "part"]) \
            .select("column", "value", (F.col("offset") + F.col("pos") + 1).cast("int").alias("code"))
        seen = {r["column"]: r for r in sizes.groupBy("column").agg(
            F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).collect()}
        return IndexModel(dictionary, {
            c: IndexedColumn(t, int(seen[t]["n"]), int(seen[t]["bytes"])) if t in seen else IndexedColumn(t, 0, 0)
            for t, c in tags.items()}, self.broadcast_limit)


def index_categories(columns: Sequence[str], broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> IndexCategories:
    """M1: indexer of several columns, outputs ``indexed<Name>``; order by
    frequency descending, ties by text."""
    return IndexCategories(as_list(columns), broadcast_limit)


def one_hot(indexed: Sequence[str]) -> OneHotEncoder:
    """M2: one-hot vectors (last category dropped) for indexed columns."""
    cols = as_list(indexed)
    outs = [encoded_name(c[len("indexed"):]) if c.startswith("indexed") else encoded_name(c) for c in cols]
    return OneHotEncoder(inputCols=cols, outputCols=outs, dropLast=True)


def assemble(columns: Sequence[str]) -> VectorAssembler:
    """M3: the ``features`` vector."""
    return VectorAssembler(inputCols=as_list(columns), outputCol=FEATURES)


NULL_KEY = "<null>"  # text that stands for a NULL key


def key_hash(key: str | Sequence[str]) -> Column:
    """Stable hash of a key, 0 to 2**32 - 1: first 8 hex digits of md5 of its
    text. Same number in any engine with md5, independent of partitioning, so
    a recomputed partition lands in the same part. A NULL key hashes too."""
    texts = [F.coalesce(col(k).cast("string"), F.lit(NULL_KEY)) for k in as_list(key)]
    text = texts[0] if len(texts) == 1 else F.concat_ws("\u0001", *texts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def split_by_key(df: DataFrame, key: str | Sequence[str],
                 train_fraction: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """M4: deterministic train/test split by key hash. Any fraction; every row,
    one with a NULL key too, is in exactly one part."""
    in_train = key_hash(key) < F.lit(train_fraction * 2.0**32)
    return df.where(in_train), df.where(~in_train)


def random_split(df: DataFrame, train_fraction: float = TRAIN_FRACTION,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M4 as in the original (random), with a seed. Deterministic only if the
    input's partitioning and row order are; prefer :func:`split_by_key`."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test
