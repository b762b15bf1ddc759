"""How many distinct groups each entity passed through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import GROUPS_COLUMN
from ..names import col
from .profile import DEFAULT_NULL_TOKENS, is_missing


def groups_per_entity(df: DataFrame, id_col: str, group_col: str,
                      tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """``(id, n_cambios)``: distinct usable groups per entity (A->B->A is 2).
    Entities without a usable group are absent, not 0."""
    missing = is_missing(group_col, tokens, df.schema[group_col].dataType)
    usable = df.select(col(id_col), col(group_col)).where(~missing)
    return usable.groupBy(col(id_col)).agg(F.count_distinct(col(group_col)).alias(GROUPS_COLUMN))


def group_count_histogram(df: DataFrame, id_col: str, group_col: str,
                          tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """``(n_cambios, count)`` ascending: entities per number of groups.

    The distinct count is planned as two hash aggregations with partial
    aggregation on ``(id, group)``, so a hot entity or group is pre-reduced
    in every map task; the histogram itself has one row per count value.
    """
    per_id = groups_per_entity(df, id_col, group_col, tokens)
    return (per_id.groupBy(GROUPS_COLUMN).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(GROUPS_COLUMN))
