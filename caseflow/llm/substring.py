"""Removal of repeated passages by seed and extend.

A window is ``n`` (50) consecutive words of one document. Its seed is the
smallest hash among its ``n - k + 1`` runs of ``k`` words (winnowing), so two
equal windows have the same seed. Documents are joined on the seeds: only a
seed that two different documents hold is followed, which leaves a small part
of the text. Each followed seed is extended to both sides up to the length
threshold, in every way that keeps the seed inside; equal extensions meet in
one aggregation, and where a smaller document holds the same window, the words
are marked. Overlapping marks merge into the maximal repeats (``spans``).

Copies of a whole document are settled first (the smallest id stands for all),
so a large group of copies costs one row each. Seeds and windows are shuffled
as hashes (64 and 96 bits), with map-side combination; the text is shuffled
once, by document, and that exchange serves both text joins. No pair of
documents is ever formed.

Defined results: null and empty texts have no words; a text of fewer than
``n`` words keeps all; a null id is neither smaller nor larger than another, so
such rows keep all and remove nothing; rows that repeat an id do not remove
each other; a window repeated inside one document stays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import flat
from .arrow import lists, map_texts, quoted

N, K = 50, 16


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values, by doubling."""
    width, out = 1, x
    while width < n:
        step = min(width, n - width)
        out = np.minimum(out[:-step], out[step:])
        width += step
    return out


def _seeds(w: flat.Words, n: int, k: int) -> np.ndarray:
    """The seed of every flat window position."""
    grams = flat.windows(w.hash, k, seed=5)
    return _sliding_min(grams, n - k + 1) if len(grams) > n - k else np.empty(0, np.uint64)


def repeated_windows(rows: DataFrame, n: int = N, k: int = K) -> DataFrame:
    """One row (id, rk, whole, at) per document with words to remove: ``whole``
    if it copies a smaller document, else ``at``, where its windows that a
    smaller document holds start for the first time. ``rows`` has id (no null),
    rk (xxhash64 of the text, for repeated ids), text, and what else the caller
    carries (``row``), so that both joins with texts read the same exchange."""

    def seeds(rows, texts):
        w = flat.words(texts, flat.PLAIN)
        own, ok = _seeds(w, n, k), flat.window_mask(w.first, n)
        at = np.flatnonzero(ok)
        doc = w.doc()[at]
        pair = np.stack([doc.astype(np.uint64), own[at]], axis=1)
        keep = np.ones(len(pair), dtype=bool)
        keep[1:] = (pair[1:] != pair[:-1]).any(axis=1)  # runs of one seed are long
        counts = np.bincount(doc[keep], minlength=len(rows))
        a, b = (_digest(w, s) for s in (11, 12))
        return {"words": w.counts(), "digest": pa.array([x.tobytes() + y.tobytes() for x, y in zip(a, b)]),
                "seeds": lists(pa.array(own[at][keep].view(np.int64)), np.r_[0, np.cumsum(counts)])}

    base = map_texts(rows, "text", ["id", "rk"],
                     "words long, digest binary, seeds array<long>", seeds).where(F.col("words") >= n)
    base = cut_lineage(base)
    first = base.groupBy("digest", "words").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")) \
        .where(F.col("copies") > 1).select("digest", "words", "first")
    named = base.join(first, ["digest", "words"], "left")
    own = F.col("first").isNull() | (F.col("first") == F.col("id"))
    seeded = named.where(own).select("id", "rk", F.explode(F.array_distinct("seeds")).alias("seed"))
    shared = seeded.groupBy("seed").agg(F.min("id").alias("lo"), F.max("id").alias("hi")) \
        .where("lo < hi").select("seed")
    followed = seeded.join(shared, "seed").groupBy("id", "rk").agg(F.collect_set("seed").alias("seeds"))

    def extend(rows, texts):
        w = flat.words(texts, flat.PLAIN)
        own, ok = _seeds(w, n, k), flat.window_mask(w.first, n)
        column = rows.column(rows.schema.get_field_index("seeds"))
        followed = np.unique(column.flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
        at = np.flatnonzero(ok)
        at = at[np.isin(own[at], followed)]
        doc, h1 = w.doc()[at], flat.windows(w.hash, n, 21)
        _, once = np.unique(h1[at] ^ flat.mix(doc.astype(np.uint64), 51), return_index=True)
        at, doc = at[once], doc[once]  # a window that a text repeats goes once
        return {None: doc, "h1": pa.array(h1[at].view(np.int64)),
                "h2": pa.array((flat.windows(w.hash, n, 31)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                "at": (at - w.first[doc]).astype(np.int32)}

    around = map_texts(rows.join(followed, ["id", "rk"]), "text", ["id", "rk"],
                       "h1 long, h2 int, at int", extend, aside=["seeds", "row"])
    least = around.groupBy("h1", "h2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")) \
        .where("lo < hi").select("h1", "h2", "lo")
    marked = around.join(least, ["h1", "h2"]).where("lo < id").groupBy("id", "rk") \
        .agg(F.collect_set("at").alias("at")).select("id", "rk", F.lit(False).alias("whole"), "at")
    copies = named.where(~own).select("id", "rk", F.lit(True).alias("whole"),
                                      F.array().cast("array<int>").alias("at"))
    return marked.unionByName(copies).distinct()


def _digest(w: flat.Words, seed: int) -> np.ndarray:
    """A hash of every text's whole word sequence."""
    up, down = flat._WORD_POWERS.get(len(w.hash) + 1)
    total = np.zeros(len(w.hash) + 1, dtype=np.uint64)
    np.cumsum(flat.mix(w.hash, seed) * up[:-1], out=total[1:])
    lo, hi = w.first[:-1], w.first[1:]
    return flat.mix((total[hi] - total[lo]) * down[lo], seed + 1)


def _joined(w: flat.Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, each followed by a space, and each text's offset."""
    start, size = w.start[keep], (w.end - w.start)[keep] + 1
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    out = np.append(w.raw, np.uint8(0x20))[np.minimum(at, len(w.raw))] if len(at) else np.empty(0, np.uint8)
    out[ends - 1] = 0x20
    bounds = np.r_[0, ends]
    return out, bounds[np.r_[0, np.cumsum(keep)][w.first]]


def remove_repeats(docs: DataFrame, n: int = N, k: int = K, doc_id: str = "doc_id", text: str = "text",
                   keep: Sequence[str] = ("doc_id",), as_is: bool = False) -> DataFrame:
    """Every row of ``docs`` (the columns of ``keep``) with ``n_words``,
    ``n_removed``, ``spans`` (removed word ranges) and ``kept``, the words that
    stay, joined by one space; with ``as_is``, a text that loses nothing comes
    back as it was."""
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("rk"),
                       F.col(quoted(text)).cast("string").alias("text"),
                       F.struct(*[F.col(quoted(c)) for c in keep]).alias("row"))
    named = rows.where(F.col("id").isNotNull())
    found = repeated_windows(named, n, k)

    def cut(rows, column):
        w = flat.words(column, flat.PLAIN)
        whole = rows.column(rows.schema.get_field_index("whole")).fill_null(False).to_numpy(zero_copy_only=False)
        gone = rows.column(rows.schema.get_field_index("at"))
        edge = np.zeros(len(w.start) + 1, dtype=np.int64)
        sizes = np.array([len(x) if x.is_valid else 0 for x in gone])
        at = gone.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(w.first[:-1], sizes)
        if len(at):  # every place where a marked window of the same text stands
            own = flat.windows(w.hash, n, 21) ^ flat.mix(w.doc()[:len(w.hash) - n + 1].astype(np.uint64), 51)
            at = np.flatnonzero(np.isin(own, own[at]) & flat.window_mask(w.first, n))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        cover = np.cumsum(edge[:-1]) > 0
        cover |= np.repeat(whole, w.counts())
        out, offset = _joined(w, ~cover)
        data = out.tobytes()
        texts = [data[a:b - 1] if b > a else b"" for a, b in zip(offset[:-1], offset[1:])]
        change = np.flatnonzero(np.diff(np.r_[0, cover.astype(np.int8), 0]))
        spans: list[list[dict]] = [[] for _ in range(len(rows))]
        for s, e in zip(change[::2], change[1::2]):  # a run may go on into the next text
            i = int(np.searchsorted(w.first, s, "right")) - 1
            while s < e:
                if (stop := min(e, w.first[i + 1])) > s:
                    spans[i].append({"start": int(s - w.first[i]), "end": int(stop - w.first[i])})
                s, i = max(s, stop), i + 1
        removed = np.diff(np.r_[0, np.cumsum(cover)][w.first])
        kept = pa.array(texts, pa.binary()).cast(pa.string())
        if as_is:
            kept = pc.if_else(pa.array(removed == 0), column.cast(pa.string()), kept)
        return {"n_words": w.counts(), "n_removed": removed, "spans": spans, "kept": kept}

    joined = named.join(found, ["id", "rk"], "left").unionByName(
        rows.where(F.col("id").isNull()).withColumn("whole", F.lit(None).cast("boolean"))
        .withColumn("at", F.lit(None).cast("array<int>")))
    out = map_texts(joined, "text", ["row"], "n_words long, n_removed long, "
                    "spans array<struct<start:int,end:int>>, kept string", cut, aside=["whole", "at"])
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep
                        if c not in ("n_words", "n_removed", "spans", "kept")],
                      "n_words", "n_removed", "spans", "kept")


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of ``op3_substring_dedup``."""
    return remove_repeats(docs, keep=["doc_id"], **options).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


REPORT_SQL = r"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents),
win AS (SELECT r, doc_id, k, hash(array_to_string(w[k:k + 49], ' ')) AS h
        FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT r, unnest(range(k, k + 50)) AS p FROM win JOIN least USING (h) WHERE lo < doc_id),
kept AS (SELECT r, list(x ORDER BY p) AS w FROM (
           SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) a
         ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(len(d.w) - coalesce(len(kept.w), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept.w, ' '), '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
