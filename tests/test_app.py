"""End-to-end application run on a CSV ticket log with the original column names."""

import random

import pytest

from caseflow.plans.app import DEFAULT_SPEC, main, train, transform
from caseflow.session import scratch_path
from caseflow.sources import read_encoded, read_event_log, write_table


def _log_rows(n_ids=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_ids):
        team = rnd.choice(["gA", "gB", "gC"])
        cat = {"gA": "c1", "gB": "c2", "gC": "c3"}[team]
        urg = rnd.choice(["1-Critical", "2-High", "t9jZkpJT4Nc="])
        steps = rnd.randint(1, 4)
        for s in range(steps):
            last = s == steps - 1
            status = rnd.choice(["Resolved  (4)", "Cancelled  (6)"]) if last else "Assigned (1)"
            grp = team if last else rnd.choice(["gA", "gB", "gC", "t9jZkpJT4Nc="])
            rows.append((i, f"2020-01-01 00:{s:02d}:00", status, cat, urg, urg, urg, 10 * (s + 1), grp,
                         rnd.choice(["x", "y"])))
    return rows


def test_transform_then_train(spark):
    cols = "ID int, DATE string, Status string, Category string, Urgency string, Impact string, " \
           "Priority string, `Priority Weight` int, `Assigned Group` string, Noise string"
    log = spark.createDataFrame(_log_rows(), cols)
    src = scratch_path(spark, "app-log")
    write_table(log, src, fmt="csv", sep=";")
    out = scratch_path(spark, "app-out")
    prepared = transform(read_event_log(spark, src, sep=";"), out, DEFAULT_SPEC)
    assert "Category" in prepared.inputs and "Noise" not in prepared.inputs
    table = read_encoded(spark, f"{out}/dataML")
    assert table.columns[0] == "ID" and table.columns[-1] == "Assigned Group"
    assert table.count() == 300
    hist = read_encoded(spark, f"{out}/n_groups", fmt="csv").collect()
    assert sum(r["count"] for r in hist) == 300
    metrics = {r.model: r for r in train(table, out, DEFAULT_SPEC, kinds=["naive_bayes", "decision_tree"]).collect()}
    assert metrics["decision_tree"].accuracy > 0.9
    assert read_encoded(spark, f"{out}/n_groups_NB", fmt="csv").count() >= 1


def test_command_line(spark):
    cols = "ID int, DATE string, Status string, Category string, Urgency string, Impact string, " \
           "Priority string, `Priority Weight` int, `Assigned Group` string, Noise string"
    src = scratch_path(spark, "cli-log")
    write_table(spark.createDataFrame(_log_rows(120, seed=5), cols), src, fmt="csv", sep=";")
    out = scratch_path(spark, "cli-out")
    main(["transform", "--log", src, "--out", out, "--exact-profile"])
    main(["train", "--table", f"{out}/dataML", "--out", out, "--models", "NB", "DT"])
    assert read_encoded(spark, f"{out}/dataML").count() == 120
    assert read_encoded(spark, f"{out}/n_groups_DT", fmt="csv").count() >= 1


def test_day_first_times(spark):
    """31/12/2016 comes before 02/01/2017 once the format is given; as text it is refused."""
    cols = "ID int, DATE string, Status string, Category string, `Assigned Group` string"
    rows = [(i, d, "Assigned (1)", "c", g) for i in range(20) for d, g in (("31/12/2016", "old"), ("02/01/2017", "new"))]
    src = scratch_path(spark, "day-first")
    write_table(spark.createDataFrame(rows, cols), src, fmt="csv", sep=";")
    with pytest.raises(ValueError, match="text"):
        transform(read_event_log(spark, src), scratch_path(spark, "refused"), DEFAULT_SPEC)
    out = scratch_path(spark, "day-first-out")
    main(["transform", "--log", src, "--out", out, "--timestamp-format", "dd/MM/yyyy",
          "--schema", "ID int, DATE timestamp, Status string, Category string, `Assigned Group` string"])
    log = read_event_log(spark, src, timestamp_format="dd/MM/yyyy")
    prepared = transform(log, scratch_path(spark, "inferred"), DEFAULT_SPEC)
    names = {r.value: r.code for r in prepared.vocabulary.table.collect()}
    assert [r["Assigned Group"] for r in prepared.table.collect()] == [names["new"]] * 20
