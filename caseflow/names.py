"""Column-name helpers. Every name is quoted, so dots and spaces are safe (Q14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def as_list(value) -> list[str]:
    if value is None:
        return []
    if isinstance(value, str):
        return [value]
    return list(value)


def literal(value) -> str:
    """A Spark SQL literal for a string or number."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)
