"""E1 (log -> model-ready table) against a pure-Python version of the original
algorithm on random small logs."""

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from caseflow.plans.fixtures import LogSpec
from caseflow.plans.flow import prepare_model_table

TOKEN = "tok"
SPEC = LogSpec(id_col="ID", order_by=("seq",), status_col="Status", closed=("C",), labels=("grp",),
               null_tokens=(TOKEN,), skip=("seq",), mixed=("prio",), numeric=("w",))
SCHEMA = "ID int, seq int, Status string, a string, prio string, w string, grp string"
COLS = ["Status", "a", "prio", "w", "grp"]

row = st.tuples(
    st.integers(0, 5),
    st.sampled_from(["O", "O", "C", None]),
    st.sampled_from(["x", "y", TOKEN, None]),
    st.sampled_from(["1-hi", "2-lo", "none", TOKEN, None]),
    st.sampled_from(["3", "4.5", "bad", None]),
    st.sampled_from(["g1", "g2", TOKEN, None]),
)


def brute(rows):
    open_rows = [r for r in rows if r[2] is not None and r[2] not in SPEC.closed]
    open_ids = {r[0] for r in open_rows}
    idx = {c: i + 2 for i, c in enumerate(COLS)}
    inputs = []
    for c in COLS:
        if c in SPEC.labels:
            continue
        vals = defaultdict(set)
        for r in open_rows:
            vals[r[0]].add(r[idx[c]])
        const = sum(1 for v in vals.values() if len(v) == 1) / len(open_ids) if open_ids else None
        nulls = sum(1 for r in rows if r[idx[c]] is None or r[idx[c]] == TOKEN) / len(rows)
        if const is not None and const >= 0.8 and nulls <= 0.5:
            inputs.append(c)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r)
    merged = {}
    for k, rs in by_id.items():
        rs.sort(key=lambda r: r[1])
        rec = {c: rs[0][idx[c]] for c in inputs}
        rec["grp"] = rs[-1][idx["grp"]]
        merged[k] = {c: (None if v == TOKEN else v) for c, v in rec.items()}

    def first_int(v):
        m = re.search(r"[0-9]+", v) if v is not None else None
        return int(m.group(0)) if m else None

    def to_int(v):
        m = re.match(r"^([+-]?[0-9]+)([.][0-9]*)?$", v.strip()) if v is not None else None
        return int(m.group(1)) if m else None

    cats = [c for c in inputs + ["grp"] if c not in ("prio", "w")]
    vocab = sorted({rec[c] for rec in merged.values() for c in cats if rec[c] is not None})
    code = {v: i + 1 for i, v in enumerate(vocab)}
    out = {}
    for k, rec in merged.items():
        enc = {}
        for c, v in rec.items():
            if c == "prio":
                enc[c] = first_int(v)
            elif c == "w":
                enc[c] = to_int(v)
            else:
                enc[c] = None if v is None else code[v]
        out[k] = enc
    return sorted(inputs), out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw=st.lists(row, min_size=1, max_size=30))
def test_full_flow_matches_brute_force(spark, raw):
    rows = [(i, seq, s, a, p, w, g) for seq, (i, s, a, p, w, g) in enumerate(raw)]
    df = spark.createDataFrame(rows, SCHEMA)
    prepared = prepare_model_table(df, SPEC)
    want_inputs, want = brute(rows)
    assert sorted(prepared.inputs) == want_inputs
    got = {r["ID"]: {c: r[c] for c in r.asDict() if c != "ID"} for r in prepared.table.collect()}
    assert prepared.table.columns == ["ID"] + want_inputs + ["grp"]
    assert got == want


def test_queries_join_their_log_once(spark, monkeypatch):
    """The flow reads its log three times: it gets the written one, not the join."""
    from caseflow.plans import queries
    from tests.conftest import SF_SMALL
    seen = []

    def flow(log, spec):
        seen.append(log._jdf.queryExecution().optimizedPlan().toString())
        return prepare_model_table(log, spec)

    monkeypatch.setattr(queries, "prepare_model_table", flow)
    got = queries.q_full_flow(spark, SF_SMALL)
    assert len(seen) == 1 and "Join" not in seen[0]
    want = prepare_model_table(queries.tickets(spark, SF_SMALL), queries.S).table
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
