"""Documents to packed token sequences: five stages, each an operator of
``caseflow.llm`` over all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents, whatever these are called: operators only see
``doc_id`` and ``text``, the other columns travel as one struct, and only
``text`` and ``n_chars`` ever change. Every stage's result is written as Parquet
to the session's shared folder and read again, so a lost executor costs one
stage at most; a stage's input is removed once its result is written.

Defined results, for every stage: a null or empty text stays as it is (it has no
terms, words or windows; packed, it is the end id alone), a null ``doc_id`` is a
document of its own, a very long text is whole in its task, an empty table gives
an empty result. Rows that repeat id and text are one row after
``near_duplicates``, and separate rows in every other stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import decontaminate as decontamination
from caseflow.llm import jaccard, packing, substring
from caseflow.llm import toxicity as toxic
from caseflow.llm.arrow import quoted
from caseflow.session import drop_path, scratch_path

OWN, REST = ("doc_id", "text"), "__rest"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _narrow(docs: DataFrame) -> DataFrame:
    """What an operator sees: id, text, and all else in one column."""
    rest = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in OWN]
    return docs.select(*OWN, F.struct(F.lit(True).alias("row"), *rest).alias(REST))


def _restored(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` from narrow rows, in order and of their types."""
    def column(i: int, c: str) -> Column:
        value = F.col(c) if c in OWN else F.col(REST).getField(f"c{i}")
        return new.get(c, value).cast(docs.schema[c].dataType).alias(c)

    return rows.select(*[column(i, c) for i, c in enumerate(docs.columns)])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; all others stay as they are."""
    judged = toxic.toxicity(_narrow(docs), _table(spark, sf_dir, "labels"), keep=[*OWN, REST])
    return _restored(judged.where(~F.col("rejected")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts stays, that of the smallest id;
    texts without a word all stay."""
    return _restored(jaccard.one_of_each(_narrow(docs)), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document of a smaller id holds go; a document that loses
    all its words goes, one that loses none keeps its text as it is."""
    cut = substring.remove_repeats(_narrow(docs), keep=["doc_id", REST], as_is=True)
    cut = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = {"text": F.col("kept")}
    for i, c in enumerate(docs.columns):
        if c == "n_chars":
            changed[c] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col(REST).getField(f"c{i}"))
    return _restored(cut, docs, **changed)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontamination.decontaminate(_narrow(docs), _table(spark, sf_dir, "benchmark"), keep=[*OWN, REST])
    return _restored(found.where(F.col("n_hit") == 0), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_report(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", pack),
]

#: The first stage is a trained model: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, done = _table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if done:
            drop_path(spark, done)
        done = path
    return docs
