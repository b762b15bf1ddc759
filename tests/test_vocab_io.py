"""Vocabulary (V1), encoding (V2) and sources/sinks."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from caseflow.operators import build_vocabulary, encode
from caseflow.session import scratch_path
from caseflow.sources import read_encoded, read_event_log, write_report, write_table


@pytest.fixture(scope="module")
def cats(spark):
    rows = [(1, "b", "a", None), (2, "c", "b", "z"), (3, "b", None, "a"), (4, "d", "d", "d")]
    return spark.createDataFrame(rows, "id int, x string, y string, w string")


def test_codes_dense_sorted_shared(cats):
    v = build_vocabulary(cats, ["x", "y", "w"])
    got = sorted((r.value, r.code) for r in v.table.collect())
    assert got == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("z", 5)]
    assert v.size == 5 and v.text_bytes == 5


def test_codes_dense_across_many_partitions(spark):
    df = spark.range(0, 5000).select(F.format_string("v%05d", (F.col("id") * 7919) % 5000).alias("s"))
    v = build_vocabulary(df.repartition(13), ["s"])
    codes = sorted(r.code for r in v.table.collect())
    assert codes == list(range(1, 5001))
    first = v.table.where(F.col("value") == "v00000").first()
    assert first.code == 1


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_encode_broadcast_and_shuffle_paths(spark, cats, limit):
    v = build_vocabulary(cats.where(F.col("id") < 4), ["x", "y", "w"])   # 'd' unseen
    out = {r.id: r for r in encode(cats, v, ["x", "y", "w"], broadcast_limit=limit).collect()}
    assert (out[1].x, out[1].y, out[1].w) == (2, 1, None)               # NULL stays NULL
    assert (out[4].x, out[4].y, out[4].w) == (0, 0, 0)                  # unseen -> 0
    assert out[2].w == 4


def test_encode_is_invertible(spark, cats):
    v = build_vocabulary(cats, ["x", "y", "w"])
    enc = encode(cats, v, ["x"])
    back = enc.join(v.table, enc.x == v.table.code).select("id", F.col("value").alias("x"))
    assert sorted(map(tuple, back.collect())) == sorted((r.id, r.x) for r in cats.collect())


def test_both_paths_give_equal_rows(spark):
    rows = [(None, "b", "x.1"), (None, "c", None), (1, "b", "q"), (1, "d", "b"), (1, "d", "b"), (2, None, None)]
    df = spark.createDataFrame(rows, "id int, `a.b` string, c string").repartition(3)
    v = build_vocabulary(df.where("c is null or c <> 'q'"), ["a.b", "c"])
    small, large = ([tuple(r) for r in encode(df, v, ["a.b", "c"], broadcast_limit=n).collect()] for n in (1 << 30, 0))
    assert sorted(small, key=str) == sorted(large, key=str) and len(small) == 6


def test_frequent_value_is_not_one_join_key(spark):
    df = spark.range(0, 20000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.format_string("v%05d", "id")).alias("s"))
    v = build_vocabulary(df, ["s"])
    out = encode(df, v, ["s"], broadcast_limit=0)
    hot = v.table.where("value = 'hot'").first().code
    assert out.where((F.col("id") % 3 == 0) & (F.col("s") != hot)).count() == 0
    assert out.select("s").distinct().count() == v.size


def test_csv_roundtrip_and_existing_path(spark, cats):
    path = scratch_path(spark, "t-csv")
    write_table(cats, path, fmt="csv", sep=";")
    back = read_event_log(spark, path, sep=";", schema=cats.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cats.collect()))
    with pytest.raises(AnalysisException):
        write_table(cats, path, fmt="csv", sep=";")
    inferred = read_event_log(spark, path, sep=";")
    assert inferred.count() == 4


def test_parquet_table_and_single_file_report(spark, cats):
    path = scratch_path(spark, "t-pq")
    write_table(cats, path)
    assert read_encoded(spark, path).count() == 4
    rep = scratch_path(spark, "t-rep")
    write_report(cats.groupBy("x").count(), rep)
    assert read_encoded(spark, rep, fmt="csv").count() == 3
