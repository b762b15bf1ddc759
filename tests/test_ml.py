"""Attempts-needed metric (M12), histogram (A12), accuracy (A13), models."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from caseflow.ml import (KINDS, accuracy_metrics, attempts_histogram, attempts_needed, evaluate_labels,
                         index_categories, split_by_key)


def test_attempts_ties_share_best_place(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3], 2), ([0.4, 0.4, 0.2], 1), ([0.1, 0.1, 0.8], 2),
                                ([0.5, 0.5], 5)], "p array<double>, y int")
    got = [r.a for r in df.select(attempts_needed(F.col("p"), F.col("y")).alias("a")).collect()]
    assert got == [2, 1, 1, None]


def test_attempts_on_vectors_and_histogram(spark):
    df = spark.createDataFrame([(Vectors.dense([0.1, 0.9]), 0.0), (Vectors.dense([0.6, 0.4]), 0.0),
                                (Vectors.dense([0.3, 0.7]), 1.0)], ["probability", "indexedLabel"])
    h = [tuple(r) for r in attempts_histogram(df).collect()]
    assert h == [(1, 2), (2, 1)]


def test_accuracy_counts_skipped(spark):
    test = spark.range(5)
    pred = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (2.0, 2.0)], ["prediction", "indexedLabel"])
    r = accuracy_metrics(test, pred).first()
    assert r.accuracy == pytest.approx(2 / 3) and r.n_scored == 3 and r.n_skipped == 2


def test_indexer_order_and_skip(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), ("c",), (None,)], "v string")
    m = index_categories(["v"]).fit(df)
    assert m.labels("v") == ["a", "c", "b"]          # frequency desc, ties by text
    assert m.transform(df).count() == 5                       # NULL row skipped


def test_split_by_key_is_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    tr, te = split_by_key(df, "k")
    a, b = tr.count(), te.count()
    assert a + b == 2000 and 0.6 < a / 2000 < 0.8
    tr2, _ = split_by_key(df.repartition(7), "k")
    assert sorted(r.k for r in tr.collect()) == sorted(r.k for r in tr2.collect())


@pytest.mark.parametrize("fraction", [0.05, 0.75, 0.95])
def test_split_loses_nothing(spark, fraction):
    df = spark.createDataFrame([(None if i % 10 == 0 else i,) for i in range(4000)], "k long")
    tr, te = split_by_key(df, "k", fraction)
    assert tr.count() + te.count() == 4000
    share = tr.where("k is not null").count() / 3600
    assert abs(share - fraction) < 0.03
    assert 0 in (tr.where("k is null").count(), te.where("k is null").count())


@pytest.fixture(scope="module")
def table(spark):
    # two informative inputs, a constant one, a numeric one, a NULL, an unseen test value
    rows = []
    for i in range(600):
        x = i % 3
        y = (i // 3) % 2
        lab = f"G{x}"
        rows.append((i, x + 1, y + 1, 9, i % 4, lab))
    rows.append((1000, None, 1, 9, 1, "G0"))
    return spark.createDataFrame(rows, "id int, a int, b int, const int, w int, grp string")


def test_all_models_train_and_score(table):
    metrics, runs = evaluate_labels(table, ["grp"], KINDS, "id", numeric=["w"])
    rows = {r.model: r for r in metrics.collect()}
    assert set(rows) == set(KINDS)
    for run in runs:
        r = rows[run.kind]
        hist = run.histogram.collect()
        assert sum(c for _, c in hist) == r.n_scored
        ones = sum(c for a, c in hist if a == 1)
        assert r.accuracy <= ones / r.n_scored + 1e-12
        assert all(1 <= a <= 3 for a, _ in hist)
    assert rows["logistic_regression"].accuracy > 0.9


def test_unseen_category_is_skipped_and_counted(spark):
    from caseflow.ml import score, train_model
    train = spark.createDataFrame([(i, "a" if i % 2 else "b", "L1" if i % 2 else "L0") for i in range(40)],
                                  "k int, c string, label string")
    test = spark.createDataFrame([(100, "a", "L1"), (101, "zz", "L0"), (102, "b", "L0")],
                                 "k int, c string, label string")
    model = train_model(train, "logistic_regression", [], ["c"])
    pred = score(model, test)
    assert sorted(r.k for r in pred.collect()) == [100, 102]
    r = accuracy_metrics(test, pred).first()
    assert (r.n_scored, r.n_skipped, r.accuracy) == (2, 1, 1.0)


def test_held_out_rows_are_scored_by_case(spark, table):
    """Equal held-out rows are one case, with their number; the figures are those of the rows."""
    from caseflow.ml import models
    data = models._label_frame(models.model_frame(table, "grp", ["grp"], key="id").withColumnRenamed("grp", "label"),
                               ["a", "b", "const"], "id", 0.7)
    held_out, cases = data.test.count(), data.cases.collect()
    assert sum(r[models.CASES] for r in cases) == held_out and len(cases) <= 24 < held_out
    data.close()
    for run in evaluate_labels(table, ["grp"], KINDS, "id", numeric=["w"])[1]:
        assert run.histogram.collect() == attempts_histogram(run.predictions).collect()
        metrics = run.metrics.select("accuracy", "n_scored", "n_skipped").first()
        assert metrics == accuracy_metrics(data.test, run.predictions).first()
