"""Headline timings. Prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all),
BENCH_REPEAT (default 5), BENCH_QUERIES (comma list, default all). Each query is built and fully executed (noop sink,
no collect to the driver) once as warm-up, then BENCH_REPEAT times; the
median is reported. The comparison variant runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from caseflow.ml.models import KINDS, evaluate_model  # noqa: E402
from caseflow.operators.profile import is_missing, is_open, profiled_columns  # noqa: E402
from caseflow.plans import queries as Q  # noqa: E402
from caseflow.plans.fixtures import TICKETS as S  # noqa: E402
from caseflow.plans.fixtures import tickets  # noqa: E402
from caseflow.session import local_session, scratch_path  # noqa: E402


def profile_per_column_loop(spark, sf):
    """Internal comparison for A7: the one-job-per-figure shape (3k + 3 jobs)."""
    t = tickets(spark, sf)
    t.select("id").distinct().count()
    n = t.count()
    opened = t.where(is_open(S.status_col, S.closed))
    n_open = opened.select("id").distinct().count()
    out = []
    for c in profiled_columns(t, S.id_col, S.skip):
        k = (opened.select("id", c).distinct().groupBy("id").count()
             .where(F.col("count") == 1).count()) / n_open
        m = (t.where(F.col(c).isNull()).count()
             + t.where(is_missing(c, S.null_tokens) & F.col(c).isNotNull()).count()) / n
        out.append((c, k, m))
    return out


def attempts(kind):
    """E3 of one model kind on the written model-ready table."""
    def run(spark, table):
        return evaluate_model(spark.read.parquet(table), S.labels[0], S.labels, kind, S.id_col,
                              numeric=S.numeric, drop=S.not_relevant).histogram
    return run


HEADLINE = {
    "A7_column_profile": Q.q_column_profile,
    "A9_consolidate": Q.q_consolidate_first_last,
    "V1V2_vocab_encode": Q.q_encode,
    "A10_group_histogram": Q.q_group_count_histogram,
    "M12_attempts": Q.q_attempts_histogram,
    "E1_full_flow": Q.q_full_flow,
    **{f"E3_{kind}": attempts(kind) for kind in KINDS},
}
EXTRA = {"A7_loop_variant": profile_per_column_loop}


def run_once(spark, fn, sf):
    t0 = time.perf_counter()
    res = fn(spark, sf)
    if hasattr(res, "write"):
        res.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, shuffle_partitions=max(2 * int(cpus), 8), app_name="caseflow-bench")
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    timings, extra = {}, {}
    written = scratch_path(spark, "bench-e1")
    if not only or any(x.startswith("E3") for x in only):
        Q.q_full_flow(spark, sf).write.parquet(written)
    for name, fn in {**HEADLINE, **EXTRA}.items():
        if only and name not in only:
            continue
        if name in HEADLINE:
            source = written if name.startswith("E3") else sf
            run_once(spark, fn, source)
            times = 1 if name.startswith("E3") else repeat  # a fit runs many jobs; one timed run each
            timings[name] = round(statistics.median(run_once(spark, fn, source) for _ in range(times)), 3)
        else:
            # comparison shape only: one run (its 30 jobs are all warm after the headline queries)
            extra[name] = round(run_once(spark, fn, sf), 3)
    spark.stop()
    sfv = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "comparison": extra, "sf": sfv,
                      "cpus": int(cpus), "repeat": repeat}))


if __name__ == "__main__":
    main()
