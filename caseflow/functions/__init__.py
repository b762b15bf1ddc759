"""Scalar and table cleaning functions."""

from .clean import clean_table, drop_incomplete, nullify_tokens
from .scalar import first_int, null_if_token, to_double, to_int

__all__ = ["clean_table", "drop_incomplete", "nullify_tokens", "first_int", "null_if_token",
           "to_double", "to_int"]
