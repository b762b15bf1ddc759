"""Event-log operators: profile, select, consolidate, vocabulary, histograms."""

from .consolidate import consolidate, order_columns
from .profile import (chosen_inputs, constancy, entity_counts, is_missing, is_open, null_ratio,
                      open_records, profile_columns, profiled_columns, select_inputs)
from .reassign import group_count_histogram, groups_per_entity
from .vocab import Vocabulary, build_vocabulary, distinct_values, encode

__all__ = [
    "consolidate", "order_columns", "chosen_inputs", "constancy", "entity_counts", "is_missing",
    "is_open", "null_ratio", "open_records", "profile_columns", "profiled_columns", "select_inputs",
    "group_count_histogram", "groups_per_entity", "Vocabulary", "build_vocabulary",
    "distinct_values", "encode",
]
