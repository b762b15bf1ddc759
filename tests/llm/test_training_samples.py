"""What models learn from: bounded, one row an id, in one order; and how the chain learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm import language, quality, samples, toxicity

GOOD, BAD = "the quiet river runs past old stone houses every morning ", "$$$ ### CLICK *** BUY &&& %%% "
RUDE = "you zarkin brukter spalt "


@pytest.fixture(scope="module")
def heavy(spark):
    """300 usual documents, 5,000 rows of one id, and one text above the bound."""
    usual = spark.range(300).selectExpr(
        "id AS doc_id", f"concat(repeat(CASE WHEN id % 2 = 0 THEN '{GOOD}' ELSE '{BAD}' END, 3 + CAST(id % 5 AS INT)), "
        f"CASE WHEN id % 3 = 0 THEN repeat('{RUDE}', 3) ELSE '' END, id) AS text", "CASE WHEN id % 2 = 0 THEN 'aa' ELSE 'bb' END AS lang")
    copies = spark.range(5000).selectExpr("CAST(1000 AS LONG) AS doc_id", f"concat('{GOOD}', id) AS text", "'aa' AS lang")
    huge = spark.range(1).selectExpr("CAST(1001 AS LONG) AS doc_id", f"repeat('{GOOD}', 40000) AS text", "'aa' AS lang")
    return usual.unionByName(copies).unionByName(huge).selectExpr("*", "1 AS id", "2 AS rk", "3 AS one", "4 AS toxic", "5 AS quality").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.range(1002).selectExpr("id AS doc_id", "CAST(id % 2 = 0 AS INT) AS quality",
                                        "CAST(id % 3 = 0 AND id < 1000 AS INT) AS toxic", "'x' AS text")


def test_a_sample_has_one_row_an_id_and_bounded_bytes(heavy, labels):
    rows = samples.labelled(heavy, labels, ["toxic"], 6000).collect()
    ids = [r.id for r in rows]
    assert len(ids) == len(set(ids)) and 1000 in ids and 1001 not in ids and 200 < len(ids) < 302
    few = samples.labelled(heavy, labels, ["toxic"], 6000, sample_bytes=5000).collect()
    assert 0 < sum(len(r.text) for r in few) <= 5000 and {r.id for r in few} <= set(ids)
    assert len(samples.labelled(heavy, labels, ["toxic"], 7).collect()) == 7
    again = samples.labelled(heavy.repartition(13, "text"), labels.repartition(3), ["toxic"], 50).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, samples.labelled(heavy, labels, ["toxic"], 50).collect()))


def test_models_do_not_depend_on_the_order_of_rows(heavy, labels):
    mixed = heavy.repartition(11, F.hash("text"))
    a, b = (toxicity.train(x, labels) for x in (heavy, mixed))
    assert all((m["terms"] == n["terms"]).all() and m["bias"] == n["bias"] for m, n in zip(a["models"], b["models"]))
    a, b = (quality.train(x, labels) for x in (heavy, mixed))
    assert (a["linear"] == b["linear"]).all() and (a["factors"] == b["factors"]).all()
    a, b = (language.train(x) for x in (heavy, mixed))
    assert a["names"] == b["names"] == ["aa", "bb"] and (a["weights"] == b["weights"]).all()


def test_every_row_is_scored_whole(heavy, labels):
    got = toxicity.toxicity_report(heavy, labels).where("doc_id < 300").collect()
    assert sum(r.rejected == (r.doc_id % 3 == 0) for r in got) > 290
    got = quality.quality_report(heavy, labels)
    assert got.count() == 5301 and got.where("doc_id = 1001").first().predicted == 1
    got = language.language_report(heavy)
    assert got.count() == 5301 and got.where("doc_id = 1001").first().lang_pred == "aa"


def test_many_languages_and_one(spark):
    rows = [(i, f"{chr(97 + i % 20)}{chr(97 + i // 20 % 20)}lo wori{chr(97 + i % 20)} " * 4, f"l{i:03}") for i in range(0, 100)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert 65 < len(model["names"]) < 90 and model["weights"].shape[1] == 1 << language.bits_for(len(model["names"]))
    sizes = [n << language.bits_for(n) for n in (1, 2, 64, 65, 128, 129, 1200)]
    assert max(sizes) <= language.DENSE << language.BITS
    one = spark.createDataFrame([(i, "only words", "xx") for i in range(20)] + [(99, "...", None)], "doc_id long, text string, lang string")
    assert {(r.doc_id == 99, r.lang_pred) for r in language.language_report(one).collect()} == {(False, "xx"), (True, "und")}
    blank = spark.createDataFrame([(i, "12 !", "xx") for i in range(20)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.language_report(blank).collect()} == {"und"}


def test_chain_learns_from_out_of_fold_probabilities():
    """Against a plain version: every fold's probabilities come from models that saw
    neither it nor, for earlier categories, anything but out-of-fold figures."""
    rng = np.random.default_rng(4)
    dense = rng.random((60, 9)) < 0.3
    x = toxicity.Sparse(*np.nonzero(dense), 60, 9)
    y = np.c_[dense[:, 0], dense[:, 0] & dense[:, 1], dense[:, 2] ^ (rng.random(60) < 0.1)].astype(float)
    models, seen = toxicity.fit_chain(x, y, folds=3)
    assert seen.shape == (60, 3) and len(models) == 3
    for c in range(3):
        for f in range(3):
            own = np.arange(60) % 3 == f
            part = toxicity.fit_linear(toxicity.Sparse(*np.nonzero(dense[~own]), int((~own).sum()), 9), seen[~own][:, :c], y[~own, c])
            z = dense[own] @ part["terms"] + seen[own][:, :c] @ part["dense"] + part["bias"]
            assert np.allclose(seen[own, c], 1 / (1 + np.exp(-z)))
        again = toxicity.fit_linear(x, seen[:, :c], y[:, c])
        assert len(models[c]["dense"]) == c and np.allclose(models[c]["terms"], again["terms"])
    given = np.zeros((60, 0))
    for m in models:  # scoring feeds each model's own probabilities to the next
        given = np.c_[given, 1 / (1 + np.exp(-(dense @ m["terms"] + given @ m["dense"] + m["bias"])))]
    assert np.allclose(toxicity.run_chain(models, x), given)
