"""Table-level cleaning (F1-F4, P10, P12), each as one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..names import as_list, col
from .scalar import first_int, null_if_token, to_int


def nullify_tokens(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Replace null tokens by NULL in every (or the given) column, in a
    single select rather than one ``withColumn`` per column."""
    targets = set(df.columns if columns is None else as_list(columns))
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[null_if_token(col(c), tokens, types[c]).alias(c) if c in targets else col(c)
                       for c in df.columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """P10: drop rows with a NULL (or NaN) in any of the columns."""
    return df.na.drop(how="any", subset=None if columns is None else as_list(columns))


def clean_table(df: DataFrame, tokens: Sequence[str] = (), mixed: Sequence[str] = (),
                numeric: Sequence[str] = (), keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """F1-F3 in one projection.

    * every column: null tokens -> NULL;
    * ``mixed`` (text with a number in it): first digit run as int;
    * ``numeric``: lenient int cast;
    * every other column except ``keep`` (keys) is categorical and becomes text.

    Columns named in ``mixed``/``numeric`` but missing from ``df`` (dropped by
    the column selection) are ignored (Q5). Returns the table and the list of
    categorical columns, in table order.
    """
    present = set(df.columns)
    mixed = [c for c in as_list(mixed) if c in present]
    numeric = [c for c in as_list(numeric) if c in present and c not in mixed]
    keep = [c for c in as_list(keep) if c in present]
    types = {f.name: f.dataType for f in df.schema.fields}
    out, categorical = [], []
    for c in df.columns:
        v = null_if_token(col(c), tokens, types[c])
        if c in keep:
            out.append(col(c))
        elif c in mixed:
            out.append(first_int(v).alias(c))
        elif c in numeric:
            out.append(to_int(v, types[c]).alias(c))
        else:
            out.append(v.cast("string").alias(c))
            categorical.append(c)
    return df.select(*out), categorical
