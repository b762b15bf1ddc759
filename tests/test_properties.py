"""Random small logs against a pure-Python brute force."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from caseflow.operators import consolidate, group_count_histogram, profile_columns

CLOSED = ["C"]
TOKEN = "tok"
SCHEMA = "ID int, seq int, Status string, a string, b int"

row = st.tuples(
    st.one_of(st.none(), st.integers(0, 4)),           # ID, NULL is an entity
    st.sampled_from(["O", "C", None]),                   # status
    st.sampled_from(["x", "y", TOKEN, None]),            # a
    st.one_of(st.none(), st.integers(-2, 2)),            # b
)
logs = st.lists(row, min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(raw):
    return [(i_, seq, s, a, b) for seq, (i_, s, a, b) in enumerate(raw)]


def brute_profile(rows):
    out = {}
    open_rows = [r for r in rows if r[2] is not None and r[2] not in CLOSED]
    ids = {r[0] for r in open_rows}
    for col, idx in (("Status", 2), ("a", 3), ("b", 4)):
        pairs = defaultdict(set)
        for r in open_rows:
            pairs[r[0]].add(r[idx])
        k = sum(1 for v in pairs.values() if len(v) == 1) / len(ids) if ids else None
        m = sum(1 for r in rows if r[idx] is None or str(r[idx]) == TOKEN) / len(rows)
        out[col] = (k, m)
    return out


@SETTINGS
@given(raw=logs)
def test_profile_matches_brute_force(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.column_name: (r.constancy, r.null_ratio)
           for r in profile_columns(df, "ID", "Status", CLOSED, [TOKEN], skip=["seq"]).collect()}
    want = brute_profile(rows)
    for c, (k, m) in want.items():
        assert got[c][1] == m
        assert (got[c][0] is None and k is None) or abs(got[c][0] - k) < 1e-12
        assert k is None or 0.0 <= got[c][0] <= 1.0


@SETTINGS
@given(raw=logs)
def test_consolidate_matches_brute_force(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.ID: (r.a, r.b, r.Status) for r in consolidate(df, "ID", ["a", "b"], ["Status"], ["seq"]).collect()}
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r)
    want = {}
    for k, rs in by_id.items():
        rs.sort(key=lambda r: r[1])
        want[k] = (rs[0][3], rs[0][4], rs[-1][2])
    assert got == want


@SETTINGS
@given(raw=logs)
def test_histogram_matches_brute_force(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in group_count_histogram(df, "ID", "a", [TOKEN]).collect()]
    groups = defaultdict(set)
    for r in rows:
        if r[3] is not None and r[3] != TOKEN:
            groups[r[0]].add(r[3])
    counts = defaultdict(int)
    for g in groups.values():
        counts[len(g)] += 1
    assert got == sorted(counts.items())
