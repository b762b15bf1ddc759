"""End-to-end flows: raw log -> model-ready table (E1), reassignment histogram."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from ..functions.clean import clean_table
from ..operators.consolidate import consolidate
from ..operators.profile import (DEFAULT_MAX_NULLS, DEFAULT_MIN_CONSTANCY, chosen_inputs,
                                 profile_columns, select_inputs)
from ..operators.reassign import group_count_histogram
from ..operators.vocab import DEFAULT_BROADCAST_LIMIT, Vocabulary, build_vocabulary, encode
from ..session import drop_path, scratch_path
from ..sources.io import write_table
from .spec import LogSpec


@dataclass
class PreparedTable:
    profile: DataFrame
    selection: DataFrame
    inputs: list[str]
    categorical: list[str]
    vocabulary: Vocabulary
    table: DataFrame
    scratch: str | None = None

    def close(self) -> None:
        """Remove the consolidated table; ``table`` cannot be read afterwards."""
        if self.scratch:
            drop_path(self.table.sparkSession, self.scratch)
            self.scratch = None


def prepare_model_table(df: DataFrame, spec: LogSpec, min_constancy: float = DEFAULT_MIN_CONSTANCY,
                        max_nulls: float = DEFAULT_MAX_NULLS, inputs: Sequence[str] | None = None,
                        broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                        materialize: bool = True, exact_profile: bool = False,
                        text_order: bool = False) -> PreparedTable:
    """Profile -> select -> consolidate -> clean -> vocabulary -> encode.

    A text column as first ``order_by`` column is refused unless ``text_order``
    is set: times that were not recognised as times would sort by characters.

    Output: one row per entity; the key, the kept inputs A-Z, then the labels
    A-Z, all int. The key is kept (the original dropped it) so a model split
    can hash it.

    The log itself is scanned twice: once by the profile (a single
    aggregation, whose k-row result is kept on the driver; skipped when
    ``inputs`` are given) and once by the consolidation. The consolidated,
    cleaned table -- one row per entity -- is written as Parquet to the shared
    folder (``materialize``; :meth:`PreparedTable.close` removes it) so that the vocabulary and the encoding do not repeat
    the consolidation, and a lost executor does not either.
    """
    if isinstance(df.schema[spec.order_by[0]].dataType, StringType) and not text_order:
        raise ValueError(f"{spec.order_by[0]!r} is text: give a schema or a timestamp format, or set text_order")
    profile = profile_columns(df, spec.id_col, spec.status_col, spec.closed, spec.null_tokens,
                              skip=spec.skip, exact=exact_profile, exact_from=min_constancy)
    if inputs is None:
        # one row per column: keep the result as a local relation so that looking
        # at the profile or the selection later does not scan the log again
        profile = df.sparkSession.createDataFrame(profile.collect(), profile.schema)
    selection = select_inputs(profile, spec.labels, min_constancy, max_nulls)
    chosen = list(inputs) if inputs is not None else chosen_inputs(selection)
    chosen = [c for c in chosen if c not in spec.labels]
    merged = consolidate(df, spec.id_col, chosen, spec.labels, spec.order_by, keep_id=True)
    cleaned, categorical = clean_table(merged, spec.null_tokens, spec.mixed, spec.numeric,
                                       keep=[spec.id_col])
    scratch = scratch_path(df.sparkSession, "consolidated") if materialize else None
    if scratch:
        write_table(cleaned, scratch)
        cleaned = df.sparkSession.read.schema(cleaned.schema).parquet(scratch)
    vocab = build_vocabulary(cleaned, categorical)
    table = encode(cleaned, vocab, categorical, broadcast_limit=broadcast_limit)
    return PreparedTable(profile, selection, chosen, categorical, vocab, table, scratch)


def reassignment_histogram(df: DataFrame, spec: LogSpec, label: str | None = None) -> DataFrame:
    """Entities per number of distinct groups of ``label`` (first label by default)."""
    return group_count_histogram(df, spec.id_col, label or spec.labels[0], spec.null_tokens)
