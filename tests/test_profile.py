"""Golden micro-tables for profiling and selection."""

import pytest
from pyspark.sql import functions as F

from caseflow.operators import profile
from caseflow.operators import (chosen_inputs, constancy, entity_counts, null_ratio, open_records,
                                profile_columns, select_inputs)

SCHEMA = "ID int, DATE string, Status string, a string, b int, c string"
CLOSED = ["Resolved  (4)", "Cancelled  (6)"]
TOKEN = "t9jZkpJT4Nc="


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        # ID 1: a constant, b constant, c has NULL and a value
        (1, "d1", "Open", "x", 5, None),
        (1, "d2", "Open", "x", 5, "k"),
        (1, "d3", "Resolved  (4)", "y", 6, "k"),
        # ID 2: a changes on open rows, c all NULL (constant), b token-free
        (2, "d1", "Open", "x", 7, None),
        (2, "d2", "Open", "z", 7, None),
        # ID 3: only closed rows -> not an open entity
        (3, "d1", "Cancelled  (6)", "x", 1, TOKEN),
        # NULL status: neither open nor closed (dropped by the open filter)
        (4, "d1", None, "q", 2, "m"),
        # NULL ID is one entity
        (None, "d1", "Open", TOKEN, 3, "m"),
        (None, "d2", "Open", TOKEN, 3, "m"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def as_dict(df, value):
    return {r.column_name: r[value] for r in df.collect()}


def test_open_records_drops_null_status(log):
    ids = sorted((r.ID for r in open_records(log, "Status", CLOSED).collect()), key=str)
    assert len(ids) == 6 and 4 not in ids and 3 not in ids


def test_entity_counts_null_id_is_an_entity(log):
    r = entity_counts(log, "ID", "Status", CLOSED).first()
    assert (r.n_rows, r.n_ids, r.n_open_ids) == (9, 5, 3)


def test_constancy_null_is_a_value(log):
    k = as_dict(constancy(log, "ID", "Status", CLOSED, skip=["DATE"]), "constancy")
    # open entities: 1, 2, NULL
    assert k["a"] == pytest.approx(2 / 3)      # 1 constant, 2 changes, NULL-ID constant token
    assert k["b"] == pytest.approx(1.0)
    assert k["c"] == pytest.approx(2 / 3)      # 1 has {NULL, k}: not constant; 2 all NULL: constant
    assert k["Status"] == pytest.approx(1.0)


def test_null_ratio_counts_tokens_on_all_rows(log):
    m = as_dict(null_ratio(log, ["a", "b", "c"], [TOKEN]), "null_ratio")
    assert m["a"] == pytest.approx(2 / 9)
    assert m["b"] == 0.0
    assert m["c"] == pytest.approx(4 / 9)      # three NULL + one token


def test_profile_matches_separate_aggregates(log):
    p = profile_columns(log, "ID", "Status", CLOSED, [TOKEN], skip=["DATE"])
    k = as_dict(constancy(log, "ID", "Status", CLOSED, skip=["DATE"]), "constancy")
    m = as_dict(null_ratio(log, ["Status", "a", "b", "c"], [TOKEN]), "null_ratio")
    rows = {r.column_name: r for r in p.collect()}
    assert set(rows) == {"Status", "a", "b", "c"}
    for c, r in rows.items():
        assert r.constancy == pytest.approx(k[c]) and r.null_ratio == pytest.approx(m[c])
        assert 0.0 <= r.constancy <= 1.0 and 0.0 <= r.null_ratio <= 1.0
    assert rows["a"].position == 4


def test_token_in_numeric_column_keeps_values(spark):
    df = spark.createDataFrame([(1, "Open", 10), (1, "Open", 10), (2, "Open", 3)], "ID int, Status string, n int")
    m = as_dict(null_ratio(df, ["n"], [TOKEN]), "null_ratio")
    assert m["n"] == 0.0


def test_thresholds_are_inclusive(spark):
    prof = spark.createDataFrame(
        [("exact", 1, 0.8, 0.5), ("low", 2, 0.7999999, 0.0), ("nully", 3, 1.0, 0.5000001),
         ("lbl", 4, 0.0, 1.0), ("nan", 5, None, 0.0)],
        "column_name string, position int, constancy double, null_ratio double")
    sel = select_inputs(prof, ["lbl"])
    roles = {r.column_name: r.role for r in sel.collect()}
    assert roles == {"exact": "input", "lbl": "label"}
    assert chosen_inputs(sel) == ["exact"]


def test_zero_open_entities_gives_null(spark):
    df = spark.createDataFrame([(1, "Resolved  (4)", "a")], "ID int, Status string, a string")
    k = as_dict(constancy(df, "ID", "Status", CLOSED), "constancy")
    assert k["a"] is None


def test_dotted_names(spark):
    df = spark.createDataFrame([(1, "Open", "v")], "`my.id` int, `St.atus` string, `a.b` string")
    p = profile_columns(df, "my.id", "St.atus", ["x"], [TOKEN])
    assert {r.column_name for r in p.collect()} == {"St.atus", "a.b"}


def test_profile_shuffles_hashes_of_open_rows_only(log):
    """One scan counts missing values without a row shuffle; the other drops closed
    rows before the only exchange by entity, which carries no counters."""
    plan = profile_columns(log, "ID", "Status", CLOSED, [TOKEN], skip=["DATE"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Scan") == 2 and "Expand" not in plan
    assert plan.count("Exchange hashpartitioning(ID") == 1
    after = plan[plan.index("Exchange hashpartitioning(ID"):]
    partial = after[after.index("partial_"):].split("\n")[0]
    assert "partial_min(" in partial and "partial_count" not in partial
    assert "Filter" in after


def test_fingerprint_and_exact_agree(spark):
    rows = [(i % 50, "Open", f"v{(i * 7) % 3 if i % 50 < 20 else 1}", float(i % 2) if i % 50 < 10 else 2.0,
             None if i % 11 == 0 else f"w{i % 50}")
            for i in range(1000)]
    df = spark.createDataFrame(rows, "ID int, Status string, a string, d double, e string")
    fast = {r.column_name: r.constancy for r in profile_columns(df, "ID", "Status", CLOSED, [TOKEN]).collect()}
    slow = {r.column_name: r.constancy for r in
            profile_columns(df, "ID", "Status", CLOSED, [TOKEN], exact=True).collect()}
    assert fast == slow
    plan = profile_columns(df, "ID", "Status", CLOSED, [TOKEN])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_exact_compares_what_the_hashes_call_constant(spark, monkeypatch):
    """With a fingerprint that collides (a text's length), only the values tell
    columns apart, and only columns that reach ``exact_from`` are compared."""
    monkeypatch.setattr(profile, "fingerprint", lambda q: f"coalesce(length(CAST({q} AS STRING)), 0)")
    rows = [(i % 40, "Open", f"v{i % 80 // 40}", "same", "x" * (1 + i % 40 % 3 * (i // 40)) + str(i // 40 % 10),
             None if i % 80 < 40 and i % 4 else "" if i % 4 else "t") for i in range(400)]
    df = spark.createDataFrame(rows, "ID int, Status string, collide string, constant string, varies string, blank string")

    def figures(**options):
        return as_dict(constancy(df, "ID", "Status", CLOSED, **options), "constancy")

    want = {c: sum(len({r[k] for r in rows if r[0] == i}) == 1 for i in range(40)) / 40
            for k, c in enumerate(df.columns) if c != "ID"}
    hashed = figures()
    assert hashed["collide"] == 1.0 and want["collide"] == 0.0 and want["blank"] < hashed["blank"]
    assert figures(exact=True) == want
    assert 0 < hashed["varies"] < 0.8
    part = figures(exact=True, exact_from=0.8)
    assert part == {**want, "varies": hashed["varies"]}
    plan = constancy(df, "ID", "Status", CLOSED, exact=True, exact_from=0.8)._jdf.queryExecution().executedPlan().toString()
    assert "min(varies" not in plan and "min(collide" in plan
    closed = df.withColumn("Status", F.lit(CLOSED[0]))
    assert set(as_dict(constancy(closed, "ID", "Status", CLOSED, exact=True), "constancy").values()) == {None}


def test_no_candidate_columns(spark):
    df = spark.createDataFrame([(1, "Open")], "ID int, Status string")
    p = profile_columns(df, "ID", "Status", CLOSED, [TOKEN], skip=["Status"])
    assert p.count() == 0 and p.columns == ["column_name", "position", "constancy", "null_ratio"]
    assert constancy(df, "ID", "Status", CLOSED, columns=[]).count() == 0
    assert null_ratio(df, [], [TOKEN]).count() == 0
    assert select_inputs(p, ["lbl"]).count() == 0


def test_numeric_status(spark):
    df = spark.createDataFrame([(1, 4), (1, 1), (2, 6), (3, None)], "ID int, Status int")
    assert open_records(df, "Status", ["4", "6"]).count() == 1
    assert open_records(df, "Status", ["Resolved  (4)"]).count() == 3   # text cannot match a number
    r = entity_counts(df, "ID", "Status", ["4", "6"]).first()
    assert (r.n_rows, r.n_ids, r.n_open_ids) == (4, 3, 1)
