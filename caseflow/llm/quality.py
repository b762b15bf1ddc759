"""Quality classifier: a factorisation machine.

Inputs of a text: its hashed words (each once, weighted so that a text's words
have length one), binned structure statistics (shares of capitals, symbols,
digits, punctuation, repeated words and word triples, line and word lengths)
and binned metadata (its length in bytes). Pairwise interactions have rank
``RANK``; a text is scored in time linear in its inputs by
``sum((sum v x)^2 - sum (v x)^2) / 2``. Labels, language, source and id are
never inputs.

Training takes at most ``SAMPLE`` labelled documents whose id is not held out,
and the bytes that ``samples`` allows (Adam on the whole sample); scoring reads every text whole, in place, without
a shuffle. The model has a fixed size and is broadcast.

Defined results: a null or empty text is scored from its (empty) statistics;
without labels of both kinds every score is the share of label 1, or 0.5;
repeated rows score alike, and are one document in training; a very long text is
whole in its task; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .arrow import lists, map_texts
from .samples import held_out, in_order, labelled

SAMPLE, BITS, RANK = 4000, 16, 8
THRESHOLD = 0.7
#: Bin edges of the shares (of bytes, words or lines) and of the sizes.
SHARES = (0.002, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.55, 0.7, 0.85, 0.95)
SIZES = (1, 2, 3, 4, 5, 6, 7, 8, 10, 14, 20, 40, 80, 200, 500, 1000, 5000)
LENGTHS = (1, 20, 50, 100, 200, 400, 800, 1600, 3200, 6400, 12800, 51200)


def _byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    for lo, hi in ranges:
        table[lo:hi + 1] = 1
    return table


CLASSES = {
    "capitals": _byte_class((0x41, 0x5A)), "digits": _byte_class((0x30, 0x39)), "blanks": _byte_class((0x20, 0x20)),
    "stops": _byte_class((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F)), "commas": _byte_class((0x2C, 0x2C)),
    "bangs": _byte_class((0x21, 0x21)), "symbols": _byte_class((0x23, 0x26), (0x2A, 0x2A), (0x3C, 0x3C), (0x3E, 0x3E)),
    "bars": _byte_class((0x7C, 0x7C)), "high": _byte_class((0x80, 0xFF)), "lines": _byte_class((0x0A, 0x0A)),
}


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, hash), and how many each doc has."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new], np.bincount(doc[new], minlength=n)


def inputs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, input, value) of all texts; inputs below 2**BITS are hashed words,
    the others statistics."""
    n = len(texts)
    w = flat.words(texts, flat.PLAIN)
    doc, counts = w.doc(), w.counts()
    raw, at = flat._buffer(texts)
    raw, at = raw[at[0]:at[-1]], at - at[0]
    size = np.diff(at)
    of_bytes, of_words = np.maximum(size, 1), np.maximum(counts, 1)
    stats: list[tuple[np.ndarray, tuple]] = []
    seen = {}
    for name, table in CLASSES.items():
        total = np.r_[0, np.cumsum(table[raw])]
        seen[name] = total[at[1:]] - total[at[:-1]]
        stats.append((seen[name] / of_bytes, SHARES))
    upper = np.zeros(len(w.hash), dtype=np.int64)
    upper[:] = CLASSES["capitals"][w.raw[w.start]] if len(w.start) else 0
    total = np.r_[0, np.cumsum(upper)]
    stats.append(((total[w.first[1:]] - total[w.first[:-1]]) / of_words, SHARES))
    same = np.zeros(len(w.hash), dtype=np.int64)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
    total = np.r_[0, np.cumsum(same)]
    stats.append(((total[w.first[1:]] - total[w.first[:-1]]) / of_words, SHARES))
    word_doc, word, own = _distinct(doc, w.hash, n)
    stats.append((own / of_words, SHARES))
    three = flat.windows(w.hash, 3)
    ok = flat.window_mask(w.first, 3)
    _, _, triples = _distinct(doc[:len(three)][ok], three[ok], n)
    stats.append((triples / np.maximum(counts - 2, 1), SHARES))
    stats.append(((size - seen["blanks"]) / of_words, SIZES))
    stats.append((counts / (seen["lines"] + 1), SIZES))
    stats.append((size, LENGTHS))
    rows, columns = [word_doc], [(flat.mix(word, 61) >> np.uint64(64 - BITS)).astype(np.int64)]
    values = [1 / np.sqrt(np.maximum(own, 1))[word_doc]]
    base = 1 << BITS
    for value, edges in stats:
        rows.append(np.arange(n))
        columns.append(base + np.searchsorted(edges, value, "right"))
        values.append(np.ones(n))
        base += len(edges) + 1
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


N_INPUTS = (1 << BITS) + len(CLASSES) * (len(SHARES) + 1) + 4 * (len(SHARES) + 1) + 2 * (len(SIZES) + 1) \
    + len(LENGTHS) + 1


def scores(model: dict, row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The linear-time form of the factorisation machine."""
    z = model["bias"] + np.bincount(row, model["linear"][column] * value, n)
    for f in range(RANK):
        vx = model["factors"][f][column] * value
        z += 0.5 * (np.bincount(row, vx, n) ** 2 - np.bincount(row, vx * vx, n))
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, steps: int = 60,
        penalty: float = 0.5, rate: float = 0.05) -> dict:
    """Adam on the logistic loss of the whole sample."""
    own, local = np.unique(column, return_inverse=True)  # inputs that occur
    n, m = len(y), len(own)
    rng = np.random.default_rng(0)
    w = np.concatenate([np.zeros(m + 1), rng.normal(0, 0.05, RANK * m)])
    one, two = np.zeros_like(w), np.zeros_like(w)
    w[m] = np.log((y.sum() + 1) / (n - y.sum() + 1))
    for t in range(1, steps + 1):
        linear, bias, factors = w[:m], w[m], w[m + 1:].reshape(RANK, m)
        z = bias + np.bincount(row, linear[local] * value, n)
        sums = []
        for f in range(RANK):
            vx = factors[f][local] * value
            sums.append(np.bincount(row, vx, n))
            z += 0.5 * (sums[f] ** 2 - np.bincount(row, vx * vx, n))
        r = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        rx = r[row] * value
        g = [np.bincount(local, rx, m) + penalty / n * linear, [r.sum()]]
        for f in range(RANK):
            g.append(np.bincount(local, rx * (sums[f][row] - factors[f][local] * value), m)
                     + penalty / n * factors[f])
        g = np.concatenate(g)
        one, two = 0.9 * one + 0.1 * g, 0.999 * two + 0.001 * g * g
        w = w - rate * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.999**t)) + 1e-9)
    linear, factors = np.zeros(N_INPUTS), np.zeros((RANK, N_INPUTS))
    linear[own], factors[:, own] = w[:m], w[m + 1:].reshape(RANK, m)
    return {"bias": float(w[m]), "linear": linear.astype(np.float32), "factors": factors.astype(np.float32)}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id",
          text: str = "text") -> dict:
    def features(rows, texts):
        row, column, value = inputs(texts)
        order = np.argsort(row, kind="stable")
        ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(rows)))]
        return {"columns": lists(pa.array(column[order].astype(np.int32)), ends),
                "values": lists(pa.array(value[order].astype(np.float32)), ends)}

    rows = map_texts(labelled(docs, labels, ["quality"], sample, doc_id, text), "text", ["id", "quality"],
                     "columns array<int>, values array<float>", features) \
        .orderBy(*in_order()).toArrow().combine_chunks()
    y = rows.column("quality").to_numpy().astype(float) if rows.num_rows else np.empty(0)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        return {"bias": float(np.log(share / (1 - share))), "linear": np.zeros(N_INPUTS, np.float32),
                "factors": np.zeros((RANK, N_INPUTS), np.float32)}
    parts = {c: rows.column(c).combine_chunks() for c in ("columns", "values")}
    parts = {c: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for c, x in parts.items()}
    row = np.repeat(np.arange(len(y)), np.diff(parts["columns"].offsets.to_numpy()))
    return fit(row, parts["columns"].flatten().to_numpy(), parts["values"].flatten().to_numpy().astype(float), y)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
             threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Train on the labels that are not held out; every row's score and class."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def run(rows, texts):
        return {"score": scores(sent.value, *inputs(texts), len(rows))}

    out = map_texts(docs, text, keep, "score double", run)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of ``op5_quality``."""
    return classify(docs, labels).select("doc_id", held_out().alias("held_out"), "score", "predicted")
