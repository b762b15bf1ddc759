"""Language identification by a linear-chain conditional random field.

Words are labelled, not documents: a word's evidence is its lexicon entry, its
prefixes and suffixes of one to three bytes and its byte trigrams, all hashed
into tables of fixed size; learned transitions tie neighbours, so that a short
or ambiguous word follows its context and code-switched text keeps its parts.
Forward-backward gives each word's posterior; a document's language is the one
with the largest sum over all its words, its score that sum's share.

A chain is a line of text, cut every ``CHAIN`` words; all chains of a slice
advance together. Training takes at most ``SAMPLE`` documents with a language
that are not held out, as many of each language (and the bytes that ``samples``
allows; of more than ``SAMPLE`` languages, the most frequent ones), and mixes pieces of different languages into its
chains, so switches are learned. Scoring reads every text whole, in place,
without a shuffle; the model is broadcast. Its tables have ``BITS`` bits of slots up
to ``DENSE`` languages, and half as many whenever there are twice as many, so
its size is bounded for any number of them.

Defined results: a null text, or one without a letter, is ``und`` with score
0; without any labelled row every text is; ties go to the first language by
name; repeated rows score alike, and are one document in training (a document of several
languages has the first by name); with one language learned, every text with a letter has it; a very
long text is whole in its task; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import flat
from .arrow import map_texts, quoted
from .samples import held_out, in_order, texts_of

SAMPLE, BITS, CHAIN, STEPS = 1200, 16, 96, 240
#: So many languages have tables of ``BITS`` bits.
DENSE = 64
#: Parts of a language whose ids are ranked apart first, so that no task ranks a whole one.
PARTS = 16
AFFIXES = (1, 2, 3)
_LETTERS = flat.folded_table()
_LETTERS[0x30:0x3A] = 0


def bits_for(n_languages: int) -> int:
    """Slots of a table, as a power of two: languages times slots is bounded."""
    return max(BITS - max(n_languages - 1, 0).bit_length() + DENSE.bit_length() - 1, 4) if n_languages > DENSE else BITS


class Evidence:
    """Inputs of all words of a slice: ``tables[k]`` holds one slot a word for
    the k-th feature table; trigrams have a slot a byte and a range a word."""

    def __init__(self, texts: pa.Array, bits: int = BITS):
        def _slot(h: np.ndarray) -> np.ndarray:
            return (h >> np.uint64(64 - bits)).astype(np.int64)

        w = self.words = flat.words(texts, _LETTERS)
        self.tables = [_slot(flat.mix(w.hash, 70))]
        for n in AFFIXES:
            end = np.minimum(w.start + n, w.end)
            self.tables.append(_slot(w.part(w.start, end, 71 + n)))
            begin = np.maximum(w.end - n, w.start)
            self.tables.append(_slot(w.part(begin, w.end, 81 + n)))
        b = _LETTERS[w.raw].astype(np.uint64)
        three = b.copy()
        three[1:] += b[:-1] << np.uint64(8)
        three[2:] += b[:-2] << np.uint64(16)
        self.grams = _slot(flat.mix(three, 91))  # ends at its byte
        self.lo = np.minimum(w.start + 2, w.end)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Log-potentials (words, languages); ``weights`` is (tables + 1, slots, languages)."""
        total = np.zeros((len(self.words.start), weights.shape[2]))
        for k, slot in enumerate(self.tables):
            total += weights[k][slot]
        run = np.zeros((len(self.grams) + 1, weights.shape[2]))
        np.cumsum(weights[-1][self.grams], axis=0, out=run[1:])
        return total + run[self.words.end] - run[self.lo]

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and length of every chain."""
        w = self.words
        n = len(w.start)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        line = np.r_[0, np.cumsum(w.raw == 0x0A)][w.start]
        new = np.ones(n, dtype=bool)
        new[1:] = line[1:] != line[:-1]
        first = w.first[:-1]
        new[first[first < n]] = True
        begin = np.flatnonzero(new)
        size = np.diff(np.r_[begin, n])
        pieces = -(-size // CHAIN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(begin, pieces) + nth * CHAIN
        return begin, np.minimum(CHAIN, np.repeat(np.flatnonzero(new) + size, pieces) - begin)


def forward_backward(log: np.ndarray, begin: np.ndarray, size: np.ndarray,
                     move: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of every word, and (if asked for) the expected transitions.
    ``log``: emissions; ``move``: log transition weights. Longest chains first,
    so the chains alive at a step are a prefix."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    e = np.exp(log - log.max(axis=1, keepdims=True))
    a = np.exp(move - move.max())
    forth, back = np.empty_like(e), np.empty_like(e)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(1, longest + 1), "right")  # chains with t + 1 words or more
    for t in range(longest):
        at = begin[:alive[t]] + t
        x = e[at] if t == 0 else (forth[at - 1] @ a) * e[at]
        forth[at] = x / x.sum(axis=1, keepdims=True)
    expected = np.zeros_like(move)
    for t in range(longest - 1, -1, -1):
        at = begin[:alive[t]] + t
        x = np.ones((len(at), e.shape[1]))
        if t + 1 < longest and alive[t + 1]:
            on = at[:alive[t + 1]]
            y = back[on + 1] * e[on + 1]
            x[:len(on)] = y @ a.T
            if pairs:
                from_here = forth[on] / ((forth[on] @ a) * y).sum(axis=1, keepdims=True)
                expected += a * (from_here.T @ y)
        back[at] = x / x.sum(axis=1, keepdims=True)
    post = forth * back
    return post / post.sum(axis=1, keepdims=True), expected


def _mixed(texts: list[str], labels: np.ndarray, rng) -> tuple[list[str], list[np.ndarray]]:
    """Training chains: lines as they are, and lines put together from runs of
    words of different texts; with each word's language."""
    table = str.maketrans({chr(c): " " for c in range(128) if not chr(c).isalpha()})
    words = [t.translate(table).split() for t in texts]
    chains, targets = [], []
    for own, label in zip(words, labels):
        for k in range(0, len(own), CHAIN):
            part = own[k:k + CHAIN]
            chains.append(" ".join(part))
            targets.append(np.full(len(part), label))
    for _ in range(len(texts)):
        parts, target = [], []
        for _ in range(rng.integers(2, 6)):
            i = int(rng.integers(len(words)))
            k = int(rng.integers(max(len(words[i]) - 8, 1)))
            piece = words[i][k:k + int(rng.integers(4, 16))]
            parts += piece
            target += [labels[i]] * len(piece)
        chains.append(" ".join(parts[:CHAIN]))
        targets.append(np.array(target[:CHAIN], dtype=np.int64))
    kept = [k for k, x in enumerate(targets) if len(x)]
    return [chains[k] for k in kept], [targets[k] for k in kept]


def fit(texts: list[str], labels: np.ndarray, n_languages: int, steps: int = STEPS, batch: int = 64,
        rate: float = 0.2) -> dict:
    """Maximum conditional likelihood by AdaGrad over batches of chains."""
    rng = np.random.default_rng(0)
    chains, targets = _mixed(texts, labels, rng)
    n_tables, bits = 2 + 2 * len(AFFIXES), bits_for(n_languages)
    weights = np.zeros((n_tables, 1 << bits, n_languages))
    seen = np.full_like(weights, 1e-6)
    move, moved = np.zeros((n_languages, n_languages)), np.full((n_languages, n_languages), 1e-6)
    for _ in range(steps if chains else 0):
        pick = rng.integers(len(chains), size=min(batch, len(chains)))
        x = Evidence(pa.array([chains[k] for k in pick]), bits)
        gold = np.concatenate([targets[k] for k in pick])
        if len(gold) != len(x.words.start):
            raise ValueError("a training word was cut differently")
        begin, size = x.chains()
        post, pairs = forward_backward(x.emissions(weights), begin, size, move, pairs=True)
        error = post.copy()
        error[np.arange(len(gold)), gold] -= 1
        inside = np.ones(len(gold), dtype=bool)
        inside[begin] = False
        after = np.flatnonzero(inside)
        np.subtract.at(pairs, (gold[after - 1], gold[after]), 1)
        moved += pairs * pairs
        move -= rate * pairs / np.sqrt(moved)
        count = np.maximum(x.words.end - x.lo, 0)
        at = flat.expand(count, x.lo)
        for k in range(n_tables):
            slot, err = (x.tables[k], error) if k < n_tables - 1 else (x.grams[at], np.repeat(error, count, axis=0))
            own, local = np.unique(slot, return_inverse=True)
            g = np.stack([np.bincount(local, err[:, c], len(own)) for c in range(n_languages)], axis=1)
            seen[k][own] += g * g
            weights[k][own] -= rate * g / np.sqrt(seen[k][own]) / n_tables
    return {"weights": weights.astype(np.float32), "move": move}


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE) -> dict | None:
    """The model; None without a labelled row. One pass over the ids and
    languages, one over the texts of the sample."""
    ids = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(lang)).cast("string").alias("lang")) \
        .where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    ids = cut_lineage(ids.groupBy("id").agg(F.min("lang").alias("lang")))
    frequent = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(sample)
    names = sorted(r["lang"] for r in frequent.collect())
    if not names:
        return None
    # so many of each, lowest hashes first: of every part of a language, then of the language
    chosen = ids.join(F.broadcast(frequent.select("lang")), "lang").withColumn("part", F.pmod(F.hash("id"), F.lit(PARTS)))
    for keys in (("lang", "part"), ("lang",)):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*in_order()))
        chosen = chosen.withColumn("nth", nth).where(F.col("nth") <= max(1, sample // len(names)))
    chosen = chosen.select("id", "lang")
    chosen = texts_of(docs.where(F.col(quoted(text)).isNotNull()), chosen, doc_id, text).orderBy(*in_order()).collect()
    if not chosen:
        return None
    number = {x: k for k, x in enumerate(names)}
    texts, labels = [r["text"] for r in chosen], np.array([number[r["lang"]] for r in chosen], dtype=np.int64)
    return {"names": names, **fit(texts, labels, len(names))}


def identify(docs: DataFrame, model: dict | None, text: str = "text", keep: Sequence[str] = ("doc_id",),
             with_words: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score``; ``with_words``
    adds each word's language, as a number into the model's names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows, texts):
        model, n = sent.value, len(rows)
        if model is None:
            names, best, share = ["und"], np.zeros(n, np.int64), np.zeros(n)
            word, first = np.empty(0, np.int64), np.zeros(n + 1, np.int64)
        else:
            x = Evidence(texts, bits_for(len(model["names"])))
            post, _ = forward_backward(x.emissions(model["weights"]), *x.chains(), model["move"])
            first = x.words.first
            total = np.zeros((len(post) + 1, post.shape[1]))
            np.cumsum(post, axis=0, out=total[1:])
            total = total[first[1:]] - total[first[:-1]]
            names = [*model["names"], "und"]
            best, share = total.argmax(axis=1), total.max(axis=1) / np.maximum(np.diff(first), 1)
            word = post.argmax(axis=1)
            raw = x.words.raw
            ascii_letter = np.r_[0, np.cumsum((_LETTERS[raw] > 0) & (raw < 0x80))]
            _, at = flat._buffer(texts)
            at = at - at[0]
            for i in np.flatnonzero(ascii_letter[at[1:]] == ascii_letter[at[:-1]]):
                if not any(c.isalpha() for c in texts[int(i)].as_py() or ""):
                    best[i], share[i] = len(names) - 1, 0.0
        out = {"lang_pred": [names[k] for k in best], "score": np.clip(share, 0, 1)}
        if with_words:
            out["words"] = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(word, pa.int32()))
        return out

    return map_texts(docs, text, keep, "lang_pred string, score double" + (", words array<int>" if with_words else ""),
                     run, chunk_bytes=flat.CHUNK_BYTES // 2)


def language_report(docs: DataFrame) -> DataFrame:
    """The columns of ``op10_language``."""
    out = identify(docs, train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
