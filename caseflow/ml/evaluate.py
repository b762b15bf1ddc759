"""Scoring metrics (M12, A12, A13): attempts needed, its histogram, accuracy."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..constants import ATTEMPTS_COLUMN
from .features import INDEXED_LABEL

ATTEMPTS = ATTEMPTS_COLUMN


def attempts_needed(scores: Column, label: Column) -> Column:
    """Place of the true class in the scores sorted descending, equal
    scores sharing the best place: ``1 + #{s_j > s_label}``.

    ``scores`` is an array column; wrap an ML vector with
    ``vector_to_array``. Pure JVM expression (no UDF). An out-of-range label
    gives NULL.
    """
    own = F.try_element_at(scores, label.cast("int") + 1)
    above = F.size(F.filter(scores, lambda s: s > own))
    return F.when(own.isNotNull(), (F.lit(1) + above).cast("int"))


def prediction_attempts(predictions: DataFrame, probability_col: str = "probability",
                        label_col: str = INDEXED_LABEL) -> Column:
    dtype = predictions.schema[probability_col].dataType
    scores = F.col(probability_col) if isinstance(dtype, ArrayType) else vector_to_array(F.col(probability_col))
    return attempts_needed(scores, F.col(label_col))


def attempts_histogram(predictions: DataFrame, probability_col: str = "probability",
                       label_col: str = INDEXED_LABEL) -> DataFrame:
    """``(Groups_assigned, count)`` ascending (at most one row per class)."""
    a = predictions.select(prediction_attempts(predictions, probability_col, label_col).alias(ATTEMPTS))
    return a.groupBy(ATTEMPTS).agg(F.count(F.lit(1)).alias("count")).orderBy(ATTEMPTS)


def accuracy_metrics(test: DataFrame, predictions: DataFrame, label_col: str = INDEXED_LABEL) -> DataFrame:
    """One row ``(accuracy, n_scored, n_skipped)``.

    The accuracy is over scored rows, as the original printed it; rows the
    indexers skipped (NULL or unseen categories) are counted next to it.
    """
    hit = (F.col("prediction") == F.col(label_col)).cast("double")
    scored = predictions.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_scored"))
    total = test.agg(F.count(F.lit(1)).alias("n_test"))
    both = scored.unionByName(total, allowMissingColumns=True)
    return both.agg(F.max("accuracy").alias("accuracy"), F.max("n_scored").alias("n_scored"),
                    (F.max("n_test") - F.max("n_scored")).alias("n_skipped"))


def summarise(test: DataFrame, predictions: DataFrame, probability_col: str = "probability",
              label_col: str = INDEXED_LABEL, count_col: str | None = None) -> DataFrame:
    """``(Groups_assigned, hit, count)`` of the scored rows, and one row with
    ``n_test`` only: all that accuracy and histogram need, from one scan. With
    ``count_col`` a row stands for so many."""
    own = F.lit(1).cast("long") if count_col is None else F.col(count_col)
    scored = predictions.select(prediction_attempts(predictions, probability_col, label_col).alias(ATTEMPTS),
                                (F.col("prediction") == F.col(label_col)).alias("hit"), own.alias("own"))
    total = test.agg(F.coalesce(F.sum(own), F.lit(0)).alias("n_test"))
    return scored.groupBy(ATTEMPTS, "hit").agg(F.sum("own").alias("count")) \
        .unionByName(total, allowMissingColumns=True)


def summary_histogram(summary: DataFrame) -> DataFrame:
    """A12 from a summary."""
    return summary.where(F.col("n_test").isNull()).groupBy(ATTEMPTS).agg(F.sum("count").alias("count")) \
        .orderBy(ATTEMPTS)


def summary_metrics(summary: DataFrame) -> DataFrame:
    """A13 from a summary: one row ``(accuracy, n_scored, n_skipped)``."""
    scored = F.coalesce(F.sum("count"), F.lit(0))
    return summary.agg(F.try_divide(F.sum(F.when(F.col("hit"), F.col("count")).otherwise(0)).cast("double"),
                                    F.sum("count").cast("double")).alias("accuracy"),
                       scored.alias("n_scored"), (F.max("n_test") - scored).alias("n_skipped"))
