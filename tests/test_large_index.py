"""Category index of several columns through one dictionary join, one index a label, scratch folders."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from caseflow.ml import evaluate_labels, features, index_categories, models
from caseflow.operators import vocab

from .conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def counted(monkeypatch, *modules):
    """Calls of cut_lineage of some modules, as they happen."""
    calls = []
    for m in modules:
        def cut(df, own=m.cut_lineage, name=m.__name__):
            calls.append((name, df.columns))
            return own(df)
        monkeypatch.setattr(m, "cut_lineage", cut)
    return calls


@pytest.fixture(scope="module")
def wide(spark):
    """Thousands of values, NULLs, repeated rows, a column with dots, one value in most rows."""
    return spark.range(6000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("a.b"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 1700).cast("string")).alias("c"),
        (F.col("id") % 2).cast("int").alias("d"), F.lit("same").alias("indexed"))


def test_large_index_gives_the_rows_of_the_small_one(spark, wide, monkeypatch):
    columns = ["a.b", "c", "d"]
    known = wide.where("k % 7 > 0")
    small = index_categories(columns).fit(known)
    large = index_categories(columns, broadcast_limit=0).fit(known)
    calls = counted(monkeypatch, vocab, features)
    out = large.transform(wide)
    assert [name for name, _ in calls] == [vocab.__name__], "the rows are written once for all columns"
    assert out.columns == small.transform(wide).columns
    assert out.schema["indexedC"].metadata["ml_attr"]["num_vals"] == large.columns["c"].size
    rows = sorted(map(tuple, out.collect()))
    assert rows == sorted(map(tuple, small.transform(wide).collect())) and 0 < len(rows) < 6000


def test_subset_skips_only_by_its_own_columns(spark, wide):
    index = index_categories(["a.b", "d"], broadcast_limit=0).fit(wide.where("k < 3000"))
    assert index.subset(["d"]).transform(wide).count() == 6000
    assert index.transform(wide).count() < 6000
    assert index.labels("d") == ["0", "1"]


def test_index_of_no_values(spark):
    df = spark.createDataFrame([(1, None)], "k int, v string")
    index = index_categories(["v"], broadcast_limit=0).fit(df)
    assert index.columns["v"].size == 0 and index.transform(df).isEmpty()


def test_one_index_a_label(spark, monkeypatch):
    rows = [(i, i % 3, i % 2, f"L{i % 3}", f"M{i % 2}") for i in range(300)]
    table = spark.createDataFrame(rows, "id int, a int, b int, one string, two string")
    calls = counted(monkeypatch, features, models)
    metrics, runs = evaluate_labels(table, ["one", "two"], ["logistic_regression", "decision_tree", "naive_bayes"], "id")
    assert len(runs) == 6 and metrics.count() == 6
    assert [n for n, _ in calls].count(features.__name__) == 2, "one index checkpoint for each label"


SCRATCH = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
for name in sys.argv[4:]:
    assert entry.queries()[name](spark, sys.argv[3]).count() > 0, name
import os
assert any(files for _, _, files in os.walk(sys.argv[2])), "nothing was written there"
"""


def test_shared_folder_is_empty_after_the_application(tmp_path):
    names = ["full_flow", "csv_roundtrip", "report_roundtrip", "encode_large", "string_index_large", "e1_tree_attempts"]
    subprocess.run([sys.executable, "-c", SCRATCH, REPO, str(tmp_path), SF_SMALL, *names],
                   check=True, timeout=300)
    assert os.listdir(tmp_path) == []
