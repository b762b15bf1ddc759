"""The two steps of the original application as functions and a command line.

``transform``: raw log -> model-ready table (``dataML``) + reassignment
histogram (``n_groups``). ``train``: model-ready table -> accuracy per model
and label + attempts histograms (``n_groups_<MODEL>``).

    python -m caseflow transform --log data.csv --out out/ --id ID --order-by DATE ...
    python -m caseflow train --table out/dataML --out out/ --models LR DT RF NB MP
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..ml.models import KINDS, SHORT, evaluate_labels
from .. import constants as C
from ..operators.profile import DEFAULT_MAX_NULLS, DEFAULT_MIN_CONSTANCY
from ..sources.io import read_encoded, read_event_log, write_report, write_table
from .spec import LogSpec
from .flow import PreparedTable, prepare_model_table, reassignment_histogram

# The original ticket log's layout (defaults only).
DEFAULT_SPEC = LogSpec(
    id_col=C.ID_COLUMN,
    order_by=(C.DATE_COLUMN,),
    status_col=C.STATUS_COLUMN,
    closed=C.CLOSED_STATUSES,
    labels=C.LABEL_COLUMNS,
    null_tokens=C.NULL_TOKENS,
    skip=(C.DATE_COLUMN,),
    mixed=C.MIXED_COLUMNS,
    numeric=C.NUMERIC_COLUMNS,
    not_relevant=C.NOT_RELEVANT_COLUMNS,
)


def transform(log: DataFrame, out_dir: str, spec: LogSpec = DEFAULT_SPEC, fmt: str = "parquet",
              min_constancy: float = DEFAULT_MIN_CONSTANCY, max_nulls: float = DEFAULT_MAX_NULLS,
              mode: str = "errorifexists", exact_profile: bool = False,
              text_order: bool = False) -> PreparedTable:
    """Write ``<out>/dataML`` (one row per entity) and ``<out>/n_groups``."""
    prepared = prepare_model_table(log, spec, min_constancy, max_nulls, exact_profile=exact_profile,
                                   text_order=text_order)
    write_table(prepared.table, f"{out_dir}/{C.MODEL_TABLE}", fmt=fmt, mode=mode)
    write_report(reassignment_histogram(log, spec), f"{out_dir}/{C.GROUPS_REPORT}", mode=mode)
    prepared.close()
    prepared.table = _written(log.sparkSession, f"{out_dir}/{C.MODEL_TABLE}", fmt, prepared.table)
    return prepared


def _written(spark: SparkSession, path: str, fmt: str, table: DataFrame) -> DataFrame:
    """The model-ready table where it was written, with its types."""
    return read_encoded(spark, path, fmt=fmt, schema=table.schema)


def train(table: DataFrame, out_dir: str, spec: LogSpec = DEFAULT_SPEC, kinds: Sequence[str] = KINDS,
          seed: int = 42, mode: str = "errorifexists") -> DataFrame:
    """Fit every model kind for every label; write ``<out>/n_groups_<MODEL>``
    (label suffix when there are several labels); return the metrics."""
    metrics, runs = evaluate_labels(table, spec.labels, kinds, spec.id_col, numeric=spec.numeric,
                                    drop=spec.not_relevant, seed=seed)
    for run in runs:
        suffix = SHORT[run.kind] + ("" if len(spec.labels) == 1 else f"_{run.label}")
        write_report(run.histogram, f"{out_dir}/{C.MODEL_REPORT_PREFIX}{suffix}", mode=mode)
    return metrics


def _spec_from_args(a: argparse.Namespace) -> LogSpec:
    return LogSpec(id_col=a.id, order_by=tuple(a.order_by), status_col=a.status, closed=tuple(a.closed),
                   labels=tuple(a.labels), null_tokens=tuple(a.null_tokens), skip=tuple(a.skip),
                   mixed=tuple(a.mixed), numeric=tuple(a.numeric), not_relevant=tuple(a.not_relevant))


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="caseflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("transform", "train"):
        s = sub.add_parser(name)
        s.add_argument("--out", required=True)
        s.add_argument("--id", default=DEFAULT_SPEC.id_col)
        s.add_argument("--order-by", nargs="+", default=list(DEFAULT_SPEC.order_by))
        s.add_argument("--status", default=DEFAULT_SPEC.status_col)
        s.add_argument("--closed", nargs="*", default=list(DEFAULT_SPEC.closed))
        s.add_argument("--labels", nargs="+", default=list(DEFAULT_SPEC.labels))
        s.add_argument("--null-tokens", nargs="*", default=list(DEFAULT_SPEC.null_tokens))
        s.add_argument("--skip", nargs="*", default=list(DEFAULT_SPEC.skip))
        s.add_argument("--mixed", nargs="*", default=list(DEFAULT_SPEC.mixed))
        s.add_argument("--numeric", nargs="*", default=list(DEFAULT_SPEC.numeric))
        s.add_argument("--not-relevant", nargs="*", default=list(DEFAULT_SPEC.not_relevant))
        s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    t = sub.choices["transform"]
    t.add_argument("--log", required=True)
    t.add_argument("--log-format", default="csv", choices=["csv", "parquet"])
    t.add_argument("--sep", default=";")
    t.add_argument("--schema", help="column names and types, e.g. 'ID int, DATE timestamp'; no inference pass")
    t.add_argument("--timestamp-format", help="how times are written, e.g. 'dd/MM/yyyy HH:mm'")
    t.add_argument("--text-order", action="store_true", help="order by a text column all the same")
    t.add_argument("--min-constancy", type=float, default=DEFAULT_MIN_CONSTANCY)
    t.add_argument("--max-nulls", type=float, default=DEFAULT_MAX_NULLS)
    t.add_argument("--exact-profile", action="store_true",
                   help="compare text values themselves in the profile (sort-based aggregation)")
    r = sub.choices["train"]
    r.add_argument("--table", required=True)
    r.add_argument("--models", nargs="+", default=[SHORT[k] for k in KINDS])
    r.add_argument("--seed", type=int, default=42)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("caseflow").getOrCreate()
    spec = _spec_from_args(a)
    if a.cmd == "transform":
        log = read_event_log(spark, a.log, fmt=a.log_format, sep=a.sep, schema=a.schema,
                             timestamp_format=a.timestamp_format)
        transform(log, a.out, spec, fmt=a.format, min_constancy=a.min_constancy, max_nulls=a.max_nulls,
                  exact_profile=a.exact_profile, text_order=a.text_order)
    else:
        by_short = {v: k for k, v in SHORT.items()}
        kinds = [by_short.get(m, m) for m in a.models]
        train(read_encoded(spark, a.table, fmt=a.format), a.out, spec, kinds, a.seed).show(truncate=False)


if __name__ == "__main__":
    main()
