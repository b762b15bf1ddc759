"""Consolidation (Q1, Q2), cleaning (F1-F4, Q3, Q4) and the group histogram (Q15)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseflow.functions import clean_table, drop_incomplete, first_int, nullify_tokens, to_int
from caseflow.operators import consolidate, group_count_histogram


def test_first_and_last_with_nulls(spark):
    t = lambda h: dt.datetime(2020, 1, 1, h)
    rows = [(1, t(3), 3, "c", "G3"), (1, t(1), 1, None, "G1"), (1, t(2), 2, "b", "G2"),
            (2, None, 1, "n", "H1"), (2, t(5), 2, "m", None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, seq int, x string, grp string")
    out = {r.id: r for r in consolidate(df, "id", ["x"], ["grp"], ["ts", "seq"]).collect()}
    assert out[1].x is None and out[1].grp == "G3"          # NULL first value is kept
    assert out[2].x == "n" and out[2].grp is None           # NULL time is earliest; NULL last label kept
    assert consolidate(df, "id", ["x"], ["grp"], ["ts", "seq"], keep_id=False).columns == ["x", "grp"]


def test_consolidate_is_invariant_under_row_order(spark):
    base = spark.range(0, 2000).select((F.col("id") % 97).alias("k"), F.col("id").alias("seq"),
                                       (F.col("id") * 7 % 13).cast("string").alias("v"),
                                       (F.col("id") % 5).cast("string").alias("lab"))
    a = consolidate(base, "k", ["v"], ["lab"], ["seq"])
    b = consolidate(base.orderBy(F.rand(7)).repartition(5), "k", ["v"], ["lab"], ["seq"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_output_column_order(spark):
    df = spark.createDataFrame([(1, 1, "a", "b", "L", "M")], "id int, o int, zz string, Aa string, lb string, la string")
    out = consolidate(df, "id", ["zz", "Aa"], ["lb", "la"], ["o"])
    assert out.columns == ["id", "Aa", "zz", "la", "lb"]


@pytest.mark.parametrize("text,expected", [
    ("12", 12), ("12.7", 12), ("-3", -3), ("+4", 4), (" 5 ", 5), ("7.", 7), ("abc", None),
    ("1e2", None), ("5d", None), ("", None), (None, None), ("99999999999", None), ("2147483647", 2147483647),
])
def test_to_int_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(to_int(F.col("s"), df.schema["s"].dataType).alias("v")).first().v == expected


def test_to_int_numbers(spark):
    df = spark.createDataFrame([(12.7,), (-12.7,), (3e10,), (None,)], "d double")
    got = [r.v for r in df.select(to_int(F.col("d"), df.schema["d"].dataType).alias("v")).collect()]
    assert got == [12, -12, None, None]


@pytest.mark.parametrize("text,expected", [
    ("1-URGENT", 1), ("Priority 23 of 4", 23), ("none", None), (None, None), ("x99999999999", None)])
def test_first_int(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(first_int(F.col("s")).alias("v")).first().v == expected


def test_nullify_tokens_on_numeric_and_text(spark):
    df = spark.createDataFrame([(1, "T", 2.5), (2, "x", 3.0)], "n int, s string, d double")
    out = nullify_tokens(df, ["T", "2"]).orderBy("d").collect()
    assert out[0].s is None and out[0].n == 1 and out[1].n is None and out[1].s == "x"


def test_drop_incomplete_counts_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (None, 2.0)], "a int, d double")
    assert drop_incomplete(df).count() == 1


def test_clean_table_roles(spark):
    df = spark.createDataFrame([(1, "3-MED", "12.7", 7, "tok")], "id int, p string, w string, c int, z string")
    out, cats = clean_table(df, ["tok"], mixed=["p", "gone"], numeric=["w"], keep=["id"])
    r = out.first()
    assert (r.id, r.p, r.w, r.c, r.z) == (1, 3, 12, "7", None)
    assert cats == ["c", "z"]


def test_events_histograms_count_every_event_and_user(spark, tmp_path):
    from __spark_entry__ import queries

    rows = [("a", "view", 1.0), ("a", "click", 12.0), ("a", "purchase", 25.0), ("b", "view", 3.0), ("b", "view", 44.0), ("c", "view", None)]
    spark.createDataFrame(rows, "user_id string, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    for name, expected in (("events_group_histogram_all", {3: 1, 2: 1}), ("events_type_histogram", {3: 1, 1: 2})):
        assert {r.n_cambios: r["count"] for r in queries()[name](spark, str(tmp_path)).collect()} == expected


def test_group_histogram_counts_distinct_groups(spark):
    rows = [(1, "A"), (1, "B"), (1, "A"), (2, "A"), (2, None), (3, "tok"), (4, "B"), (4, "C"), (4, "A")]
    df = spark.createDataFrame(rows, "id int, g string")
    h = [tuple(r) for r in group_count_histogram(df, "id", "g", ["tok"]).collect()]
    assert h == [(1, 1), (2, 1), (3, 1)]           # entity 3 has no usable group: absent
    assert sum(c for _, c in h) == 3


def test_numeric_tokens_still_apply(spark):
    df = spark.createDataFrame([(1, 2.5, "a"), (-1, 1e10, "-1")], "n int, d double, s string")
    out = nullify_tokens(df, ["-1", "1.0E10", "zz"]).orderBy("s").collect()
    assert (out[0].n, out[0].d, out[0].s) == (None, None, None)   # row with n=-1, d=1e10, s='-1'
    assert (out[1].n, out[1].d, out[1].s) == (1, 2.5, "a")


def test_non_numeric_token_skips_cast(spark):
    df = spark.createDataFrame([(1, "x")], "n bigint, s string")
    plan = nullify_tokens(df, ["t9jZkpJT4Nc="])._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(n" not in plan


def test_to_double(spark):
    from caseflow.functions import to_double
    df = spark.createDataFrame([("2.5", 3), ("x", None)], "s string, n int")
    out = df.select(to_double(F.col("s"), df.schema["s"].dataType).alias("a"),
                    to_double(F.col("n"), df.schema["n"].dataType).alias("b")).collect()
    assert (out[0].a, out[0].b, out[1].a, out[1].b) == (2.5, 3.0, None, None)


def test_dotted_names_through_flow(spark):
    from caseflow.operators import build_vocabulary, encode
    df = spark.createDataFrame([(1, 1, "a", "2-x", "G"), (1, 2, "b", "3-y", "H"), (2, 1, None, None, "G")],
                               "`e.id` int, `t.s` int, `c.at` string, `p.rio` string, `l.ab` string")
    merged = consolidate(df, "e.id", ["c.at", "p.rio"], ["l.ab"], ["t.s"])
    assert merged.columns == ["e.id", "c.at", "p.rio", "l.ab"]
    cleaned, cats = clean_table(merged, [], mixed=["p.rio"], keep=["e.id"])
    v = build_vocabulary(cleaned, cats)
    out = {r["e.id"]: tuple(r) for r in encode(cleaned, v, cats).collect()}
    assert out == {1: (1, 3, 2, 2), 2: (2, None, None, 1)}   # byte order: G=1, H=2, a=3


def test_tied_times_give_one_result_however_partitioned(spark):
    rows = [(i // 8, 5 if i % 3 else None, f"v{(i * 37) % 11}", f"g{(i * 13) % 7}") for i in range(800)]
    df = spark.createDataFrame(rows, "id int, t int, a string, g string")
    results = {tuple(sorted(map(tuple, consolidate(df.repartition(n), "id", ["a"], ["g"], ["t"]).collect())))
               for n in (1, 3, 8)}
    assert len(results) == 1


def test_map_columns_are_carried(spark):
    df = spark.sql("SELECT 1 AS id, x AS t, map('k', x) AS m, 'g' AS g FROM VALUES (2), (1) AS v(x)")
    assert consolidate(df, "id", ["m"], ["g"], ["t"]).first().m == {"k": 1}
