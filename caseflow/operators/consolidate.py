"""One row per entity: first value of each input, last value of each label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..names import as_list, col


def order_columns(inputs: Sequence[str], labels: Sequence[str]) -> list[str]:
    """Inputs A-Z, then labels A-Z (byte order, case-sensitive)."""
    return sorted(as_list(inputs)) + sorted(as_list(labels))


def _orderable(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (MapType, VariantType))


def consolidate(df: DataFrame, id_col: str, inputs: Sequence[str], labels: Sequence[str],
                order_by: Sequence[str], keep_id: bool = True) -> DataFrame:
    """Reduce the log to one row per entity.

    The first row (smallest ``order_by``) supplies every input, the last row
    supplies every label; NULL values are taken as they are, not skipped. The
    order is a struct, which is never NULL, so a NULL time counts as the
    earliest. Rows that tie on ``order_by`` are ordered by the values asked
    for (inputs A-Z for the first row, labels A-Z for the last), so any
    ``order_by`` gives one result, however the log is partitioned.

    ``min``/``max`` aggregate partially before the shuffle, so a hot entity
    costs one partial row per map task.
    """
    inputs, labels, order_by = as_list(inputs), as_list(labels), as_list(order_by)
    labels = [c for c in labels if c != id_col]
    inputs = [c for c in inputs if c not in labels and c != id_col]
    if not order_by:
        raise ValueError("order_by is required: first/last need an explicit order")
    if not inputs and not labels:
        raise ValueError("nothing to consolidate")
    types = {f.name: f.dataType for f in df.schema.fields}

    def extreme(pick, pick_by, columns: list[str], name: str):
        order = [col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
        ties = [c for c in columns if _orderable(types[c])]
        if ties == columns:  # order and values in one struct: no second buffer
            return pick(F.struct(*order, F.struct(*[col(c).alias(c) for c in columns]).alias("values"))) \
                .getField("values").alias(name)
        order += [col(c).alias(f"t{i}") for i, c in enumerate(ties)]
        return pick_by(F.struct(*[col(c).alias(c) for c in columns]), F.struct(*order)).alias(name)

    columns = order_columns(inputs, labels)
    first, last = columns[:len(inputs)], columns[len(inputs):]
    aggs = [extreme(F.min, F.min_by, first, "__first")] if first else []
    aggs += [extreme(F.max, F.max_by, last, "__last")] if last else []
    grouped = df.groupBy(col(id_col)).agg(*aggs)
    out = [F.col("__first" if c in first else "__last").getField(c).alias(c) for c in columns]
    return grouped.select(*([col(id_col)] if keep_id else []), *out)
