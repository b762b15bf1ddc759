"""Toxicity by a classifier chain.

The categories form a chain: ``mention`` (an indicative term occurs),
``persistent`` (three or more different ones), ``severe`` (an unusually high
rate of them) and ``toxic``, the label of the table. Each has a logistic
regression over words and word beginnings; each later one also sees the
probabilities of the earlier categories. While training, these probabilities
are out-of-fold: a document's come from models that did not see it. The labels
have one category, so the first three are derived from it: indicative terms
are those far more frequent in toxic training documents.

Training takes at most ``SAMPLE`` labelled documents (and the bytes that
``samples`` allows); scoring reads every text
whole, in place, without a shuffle. The model (``FEATURES`` terms at most) is
broadcast.

Defined results: a null or empty text scores as a text without terms; without
labels of both kinds every probability is 0 and nothing is rejected; repeated
rows score alike, and are one document in training; a very long text is whole in
its task; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import flat
from .arrow import lists, map_texts
from .samples import held_out, in_order, labelled

SAMPLE, FEATURES, FOLDS = 6000, 4096, 3
CATEGORIES = ("mention", "persistent", "severe", "toxic")
PREFIXES = (4, 5, 6)
THRESHOLD = 0.5
#: A term enters if it is this many standard deviations too frequent in toxic texts.
LEAST_DEVIATION = 4.0


def term_hashes(w: flat.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every word and of its beginnings."""
    doc = w.doc()
    docs, terms = [doc], [w.hash]
    for n in PREFIXES:
        long = np.flatnonzero(w.end - w.start > n)
        docs.append(doc[long])
        terms.append(w.part(w.start[long], w.start[long] + n, 40 + n))
    return np.concatenate(docs), np.concatenate(terms)


class Sparse:
    """Rows of binary features, ready for products with a weight vector."""

    def __init__(self, row: np.ndarray, column: np.ndarray, n_rows: int, n_columns: int):
        self.row, self.column, self.n_rows, self.n_columns = row, column, n_rows, n_columns

    def take(self, keep: np.ndarray) -> Sparse:
        number = np.cumsum(keep) - 1
        mine = keep[self.row]
        return Sparse(number[self.row[mine]], self.column[mine], int(keep.sum()), self.n_columns)

    def dot(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weight[self.column], self.n_rows)

    def back(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, residual[self.row], self.n_columns)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(x: Sparse, dense: np.ndarray, y: np.ndarray, steps: int = 200, penalty: float = 0.05) -> dict:
    """Logistic regression by Adam on the full sample, L2-penalised."""
    n = x.n_columns + dense.shape[1] + 1
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    k = x.n_columns
    for t in range(1, steps + 1):
        p = _sigmoid(x.dot(w[:k]) + dense @ w[k:-1] + w[-1])
        r = p - y
        g = np.r_[x.back(r), dense.T @ r, r.sum()]
        g[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return {"terms": w[:k], "dense": w[k:-1], "bias": w[-1]}


def predict(model: dict, x: Sparse, dense: np.ndarray) -> np.ndarray:
    return _sigmoid(x.dot(model["terms"]) + dense @ model["dense"] + model["bias"])


def fit_chain(x: Sparse, y: np.ndarray, folds: int = FOLDS) -> tuple[list[dict], np.ndarray]:
    """One model a category (the columns of ``y``, in order), and the out-of-fold
    probabilities that later models learn from."""
    seen, models = np.zeros((x.n_rows, 0)), []
    fold = np.arange(x.n_rows) % folds
    for c in range(y.shape[1]):
        models.append(fit_linear(x, seen, y[:, c]))
        out = np.zeros(x.n_rows)
        for f in range(folds):
            own = fold == f
            part = fit_linear(x.take(~own), seen[~own], y[~own, c])
            out[own] = predict(part, x.take(own), seen[own])
        seen = np.c_[seen, out]
    return models, seen


def run_chain(models: Sequence[dict], x: Sparse) -> np.ndarray:
    seen = np.zeros((x.n_rows, 0))
    for model in models:
        seen = np.c_[seen, predict(model, x, seen)]
    return seen


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id",
          text: str = "text") -> dict | None:
    """The terms and the chain's models; None if the labels have one value
    only. Terms are counted by Spark; the driver gets ``FEATURES`` of them and
    their places in the sample."""
    def terms(rows, texts):
        w = flat.words(texts)
        doc, h = term_hashes(w)
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        ends = np.r_[0, np.cumsum(np.bincount(doc[new], minlength=len(rows)))]
        return {"n_words": w.counts(), "terms": lists(pa.array(h[new].view(np.int64)), ends)}

    rows = cut_lineage(map_texts(labelled(docs, labels, ["toxic"], sample, doc_id, text), "text", ["id", "toxic"],
                                 "n_words long, terms array<long>", terms))
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if positive in (0, n):
        return None
    base = positive / n
    counted = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term") \
        .agg(F.count(F.lit(1)).alias("total"), F.sum("toxic").alias("toxic"))
    deviation = (F.col("toxic") - F.col("total") * base) / F.sqrt(F.col("total") * (base * (1 - base)))
    chosen = counted.where("total >= 3").withColumn("weight", deviation).where(F.col("weight") > LEAST_DEVIATION) \
        .orderBy(F.desc("weight"), "term").limit(FEATURES).collect()
    known = np.array([r["term"] for r in chosen], dtype=np.int64).view(np.uint64)
    order = np.argsort(known)
    known = known[order]
    told = np.array([r["total"] >= 5 and (r["toxic"] + 0.5) / (r["total"] + 1) > max(0.8, 2 * base) for r in chosen],
                    dtype=bool)[order]

    def places(batches):
        for batch in batches:
            column = batch.column(2)
            value, size = column.flatten().to_numpy().view(np.uint64), np.diff(column.offsets.to_numpy())
            at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
            hit = known[at] == value if len(known) else np.zeros(len(value), dtype=bool)
            ends = np.r_[0, np.cumsum(hit)][np.r_[0, np.cumsum(size)]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(pa.array(at[hit], pa.int32()), ends)],
                                             names=["toxic", "n_words", "places"])

    got = rows.orderBy(*in_order()).select(F.col("toxic").cast("int").alias("toxic"), "n_words", "terms") \
        .mapInArrow(places, "toxic int, n_words long, places array<int>").toArrow().combine_chunks()
    y, n_words = got.column("toxic").to_numpy().astype(float), got.column("n_words").to_numpy()
    column = got.column("places").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    place = column.flatten().to_numpy()
    row = np.repeat(np.arange(len(y)), np.diff(column.offsets.to_numpy()))
    x = Sparse(row, place, len(y), len(known))
    hits = np.bincount(row, told[place], len(y))
    per_word = hits / np.maximum(n_words, 1)
    usual = np.median(per_word[(y > 0) & (hits > 0)]) if ((y > 0) & (hits > 0)).any() else np.inf
    targets = np.c_[hits > 0, (hits >= 3) & (y > 0), (per_word >= usual) & (y > 0) & (hits > 0), y].astype(float)
    return {"terms": known, "models": fit_chain(x, targets)[0]}


def score(docs: DataFrame, model: dict | None, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` with the probabilities of all categories."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows, texts):
        model = sent.value
        if model is None:
            return {f"p_{c}": np.zeros(len(rows)) for c in CATEGORIES}
        w = flat.words(texts)
        index = flat.HashIndex()
        index.add(model["terms"], np.arange(len(model["terms"]), dtype=np.int32))
        doc, h = term_hashes(w)
        place = index.get(h)
        hit = place >= 0
        pair = np.unique(doc[hit] * len(model["terms"]) + place[hit])
        x = Sparse(pair // max(len(model["terms"]), 1), pair % max(len(model["terms"]), 1), len(rows),
                   len(model["terms"]))
        p = run_chain(model["models"], x)
        return {f"p_{c}": p[:, k] for k, c in enumerate(CATEGORIES)}

    return map_texts(docs, text, keep, ", ".join(f"p_{c} double" for c in CATEGORIES), run)


def toxicity(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",), threshold: float = THRESHOLD,
             sample: int = SAMPLE) -> DataFrame:
    """Train on the labels, score every row; ``rejected`` is the decision."""
    return score(docs, train(docs, labels, sample), keep=keep).withColumn("rejected", F.col("p_toxic") >= threshold)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of ``op4_toxicity``."""
    return toxicity(docs, labels).withColumn("held_out", held_out())
