"""Column-level cleaning functions (F1-F4). All are built-in expressions, so they
stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

from ..constants import DIGITS_PATTERN
from ..names import as_list

# Fixed value: a whole number, optionally followed by a fraction that is cut
# off, as the lenient string-to-int cast of the original runtime accepted it.
INT_TEXT_PATTERN = r"^([+-]?[0-9]+)([.][0-9]*)?$"

_NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)
# Fixed value: every text form Spark gives a number (``12``, ``-1.5``, ``1.0E10``, ``NaN``, ``Infinity``).
NUMBER_TEXT = re.compile(r"^[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?|NaN|Infinity)$")


def tokens_for_type(tokens: Sequence[str], dtype: DataType | None) -> list[str]:
    """The tokens that can equal the text form of a value of ``dtype``.

    A number, date, timestamp or boolean cast to text has a fixed shape, so
    only tokens of that shape can ever match; for such columns this usually
    leaves none, and the per-row cast to text is not needed at all.
    """
    tokens = as_list(tokens)
    if isinstance(dtype, _NUMERIC):
        return [t for t in tokens if NUMBER_TEXT.match(t)]
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return [t for t in tokens if t[:1].isdigit() or t[:1] in "+-"]
    if isinstance(dtype, BooleanType):
        return [t for t in tokens if t in ("true", "false")]
    return tokens


def null_if_token(c: Column, tokens: Sequence[str], dtype: DataType | None = None) -> Column:
    """the value, or NULL when it equals a null token (compared as text)."""
    tokens = tokens_for_type(tokens, dtype)
    if not tokens:
        return c
    return F.when(~F.coalesce(c.cast("string").isin(tokens), F.lit(False)), c)


def first_int(c: Column) -> Column:
    """first digit run as an int; no digits or overflow -> NULL."""
    return F.regexp_substr(c.cast("string"), F.lit(DIGITS_PATTERN)).try_cast("int")


def to_int(c: Column, dtype: DataType | None = None) -> Column:
    """lenient cast to int.

    Text: optional sign and digits, an optional fraction is truncated
    (``'12.7'`` -> 12); anything else, and values outside the int range, give
    NULL. Numbers: truncated toward zero, NULL outside the int range.
    """
    if isinstance(dtype, _NUMERIC):
        return c.try_cast("int")
    if isinstance(dtype, BooleanType):
        return c.cast("int")
    text = F.trim(c.cast("string"))
    return F.regexp_extract(text, INT_TEXT_PATTERN, 1).try_cast("int")


def to_double(c: Column, dtype: DataType | None = None) -> Column:
    """cast to double; unparsable text gives NULL instead of an error."""
    if isinstance(dtype, (StringType,)) or dtype is None:
        return c.try_cast("double")
    return c.cast(DoubleType())
