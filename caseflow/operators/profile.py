"""Column profiling of an event log.

For every candidate column two figures decide whether it is a usable model
input:

* constancy -- over *open* records, the share of entities whose column holds
  exactly one distinct value (NULL counts as a value);
* null ratio -- over *all* records, the share of rows that are NULL or equal
  to a null token.

Both are computed for all columns at once instead of one job per column.
"One distinct value" is "smallest equals largest" per entity, which needs no
``count(DISTINCT)`` (that would plan an ``Expand`` of k copies of every row).
Values are compared through a 64-bit hash (xxhash64), so every column costs
two fixed-width slots of a hash aggregation: two different values of one
entity are taken as equal if their hashes are (about 2**-64 per pair).
A hash can only make a column look more constant than it is, so ``exact=True``
compares the values themselves (a sort-based aggregation for text) of those
columns alone that the hashes call constant enough to matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..constants import CLOSED_STATUSES, MAX_NULLS, MIN_CONSTANCY, NULL_TOKENS
from ..functions.scalar import tokens_for_type
from ..names import as_list, col, literal, quote

DEFAULT_CLOSED_STATUSES = CLOSED_STATUSES
DEFAULT_NULL_TOKENS = NULL_TOKENS
DEFAULT_MIN_CONSTANCY = MIN_CONSTANCY
DEFAULT_MAX_NULLS = MAX_NULLS


def is_open(status_col: str, closed: Sequence[str], dtype: DataType | None = None) -> Column:
    """True for an open record. NULL status is not open (``<>`` yields NULL).
    Compared as text; ``dtype`` lets closed values that cannot match be skipped."""
    closed = tokens_for_type(closed, dtype)
    if not closed:
        return col(status_col).isNotNull()
    return F.coalesce(~col(status_col).cast("string").isin(closed), F.lit(False))


def is_missing(name: str, tokens: Sequence[str], dtype: DataType | None = None) -> Column:
    """NULL or one of the null tokens. Compared as text, so numeric columns
    keep their values and ANSI casts never fail (Q3)."""
    tokens = tokens_for_type(tokens, dtype)
    c = col(name)
    if not tokens:
        return c.isNull()
    return c.isNull() | F.coalesce(c.cast("string").isin(tokens), F.lit(False))


def open_records(df: DataFrame, status_col: str, closed: Sequence[str] = DEFAULT_CLOSED_STATUSES) -> DataFrame:
    """P5: rows whose status is not a closed one."""
    return df.where(is_open(status_col, closed, df.schema[status_col].dataType))


def profiled_columns(df: DataFrame, id_col: str, skip: Sequence[str] = ()) -> list[str]:
    """Candidate columns: everything except the entity key and skipped columns
    (the event time, typically). Goes by name, never by position."""
    skip = set(as_list(skip)) | {id_col}
    return [c for c in df.columns if c not in skip]


def entity_counts(df: DataFrame, id_col: str, status_col: str,
                  closed: Sequence[str] = DEFAULT_CLOSED_STATUSES) -> DataFrame:
    """A1, A2: rows, distinct entities, distinct entities with an open row.

    One aggregation by entity (a NULL key is one entity, as ``distinct`` has
    it) followed by a global sum; partial aggregation keeps a hot entity from
    reaching one task with all its rows.
    """
    per_id = df.groupBy(col(id_col)).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(is_open(status_col, closed, df.schema[status_col].dataType).cast("int")).alias("any_open"),
    )
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_ids"),
        F.sum("any_open").cast("long").alias("n_open_ids"),
    )


# The per-column aggregates are written as SQL text: one expression per
# aggregate instead of dozens of driver round trips per column.

def _sql_missing(q: str, tokens: Sequence[str], dtype: DataType | None = None) -> str:
    tokens = tokens_for_type(tokens, dtype)
    if not tokens:
        return f"({q} IS NULL)"
    return f"({q} IS NULL OR coalesce(CAST({q} AS STRING) IN ({', '.join(map(literal, tokens))}), false))"


def fingerprint(q: str) -> str:
    """What stands for a value of ``q`` in the hashed comparison."""
    return f"xxhash64({q})"


def _sql_constant_flag(q: str, exact: bool) -> str:
    """Per entity: one distinct value of ``q`` (NULL included). Aggregate
    expression, result 0/1 as bigint. A hash has no NULL (NULL hashes to a
    value of its own), so its smallest and largest are all that is shuffled."""
    if exact:
        return (f"CAST(count({q}) = 0 OR (count({q}) = count(1) AND coalesce(min({q}) = max({q}), false)) AS BIGINT)")
    return f"CAST(min({fingerprint(q)}) = max({fingerprint(q)}) AS BIGINT)"


def _empty(df: DataFrame, schema: str) -> DataFrame:
    """No candidate columns: an empty result with the usual schema."""
    return df.sparkSession.createDataFrame([], schema)


def _rows(cols: list[str], fields) -> str:
    """``inline(array(named_struct(...), ...))`` turning one wide row into one row per column."""
    structs = [f"named_struct({', '.join(f'{literal(k)}, {v}' for k, v in fields(i, c))})"
               for i, c in enumerate(cols)]
    return f"inline(array({', '.join(structs)}))"


def constancy(df: DataFrame, id_col: str, status_col: str,
              closed: Sequence[str] = DEFAULT_CLOSED_STATUSES,
              columns: Sequence[str] | None = None, skip: Sequence[str] = (),
              exact: bool = False, exact_from: float = 0.0) -> DataFrame:
    """A5: ``(column_name, constancy)`` over open records.

    Zero open entities gives NULL (the original produced NaN and kept the
    column; here it is rejected by :func:`select_inputs`).

    With ``exact`` the hashed figures are computed first (one row reaches the
    driver), and the values of the columns that reach ``exact_from`` by them are
    compared themselves. A column below it stays with its hashed figure, which
    its exact one cannot exceed.
    """
    cols = as_list(columns) if columns is not None else profiled_columns(df, id_col, skip)
    if not cols:
        return _empty(df, "column_name string, constancy double")
    needed = [id_col] + [c for c in dict.fromkeys([status_col] + cols) if c != id_col]
    opened = open_records(df.select(*[col(c) for c in needed]), status_col, closed)

    def constant_entities(places: Sequence[int], by_value: bool) -> DataFrame:
        """One row: the open entities, and how many of them hold one value of each column."""
        per_id = opened.groupBy(col(id_col)).agg(
            *[F.expr(_sql_constant_flag(quote(cols[i]), by_value)).alias(f"k{i}") for i in places])
        return per_id.agg(F.count(F.lit(1)).alias("ids"), *[F.sum(f"k{i}").alias(f"k{i}") for i in places])

    totals = constant_entities(range(len(cols)), False)
    if exact:
        hashed = totals.first()
        unsure = [i for i in range(len(cols)) if hashed[f"k{i}"] and hashed[f"k{i}"] / hashed["ids"] >= exact_from]
        if unsure:
            totals = constant_entities(unsure, True).select("ids", *[
                F.col(f"k{i}") if i in unsure else F.lit(hashed[f"k{i}"]).cast("long").alias(f"k{i}")
                for i in range(len(cols))])
    return totals.selectExpr(_rows(cols, lambda i, c: [
        ("column_name", literal(c)),
        ("constancy", f"try_divide(CAST(k{i} AS DOUBLE), CAST(ids AS DOUBLE))")]))


def null_ratio(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """``(column_name, null_ratio)`` over all records; one scan, no shuffle
    beyond merging one partial row per task."""
    cols = as_list(columns)
    if not cols:
        return _empty(df, "column_name string, null_ratio double")
    types = {f.name: f.dataType for f in df.schema.fields}
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.expr(f"count(CASE WHEN {_sql_missing(quote(c), tokens, types.get(c))} THEN 1 END)")
                   .alias(f"m{i}") for i, c in enumerate(cols)])
    return agg.selectExpr(_rows(cols, lambda i, c: [
        ("column_name", literal(c)),
        ("null_ratio", f"try_divide(CAST(m{i} AS DOUBLE), CAST(n AS DOUBLE))")]))


def profile_columns(df: DataFrame, id_col: str, status_col: str,
                    closed: Sequence[str] = DEFAULT_CLOSED_STATUSES,
                    tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
                    skip: Sequence[str] = (), columns: Sequence[str] | None = None,
                    exact: bool = False, exact_from: float = 0.0) -> DataFrame:
    """``(column_name, position, constancy, null_ratio)``.

    Two aggregates: the missing-value counts over all rows leave one row per
    task; the constancy reads the open rows only and shuffles, per entity and
    task, two hashes a column. ``position`` is the 1-based place of the column
    in the input schema.
    """
    cols = as_list(columns) if columns is not None else profiled_columns(df, id_col, skip)
    if not cols:
        return _empty(df, "column_name string, position int, constancy double, null_ratio double")
    position = {c: i + 1 for i, c in enumerate(df.columns)}
    place = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(position.get(c)).cast("int"))])
    same = constancy(df, id_col, status_col, closed, columns=cols, exact=exact, exact_from=exact_from)
    return same.join(F.broadcast(null_ratio(df, cols, tokens)), "column_name") \
        .select("column_name", place[F.col("column_name")].alias("position"),
                F.col("constancy"), "null_ratio")


def select_inputs(profile: DataFrame, labels: Sequence[str],
                  min_constancy: float = DEFAULT_MIN_CONSTANCY,
                  max_nulls: float = DEFAULT_MAX_NULLS) -> DataFrame:
    """``(column_name, position, role)`` of the kept columns.

    A column is an input iff constancy >= ``min_constancy`` and null ratio <=
    ``max_nulls`` (NULL figures fail both tests). Labels are always kept and
    never inputs.
    """
    labels = as_list(labels)
    is_label = F.col("column_name").isin(labels) if labels else F.lit(False)
    passes = (F.col("constancy") >= F.lit(min_constancy)) & (F.col("null_ratio") <= F.lit(max_nulls))
    return (profile
            .where(is_label | F.coalesce(passes, F.lit(False)))
            .select("column_name", "position",
                    F.when(is_label, F.lit("label")).otherwise(F.lit("input")).alias("role")))


def chosen_inputs(selection: DataFrame) -> list[str]:
    """Input names in schema order. The selection has one row per column, so
    collecting it moves schema-sized data only."""
    rows = selection.where(F.col("role") == "input").select("column_name", "position").collect()
    return [r.column_name for r in sorted(rows, key=lambda r: (r.position is None, r.position, r.column_name))]
