"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``n`` consecutive item words (an item of fewer words,
but not none, is one shorter pattern). Patterns of one length are searched
together: a shift table, indexed by the hash of a block of two words, says how
far the window may move without missing a pattern; where the shift is zero, a
bucket chosen by the hash of the last block (and ordered by the hash of the
first) gives the patterns to test, and the words themselves are compared.
Every text is cut into lanes that overlap by a window, and all lanes of a
slice move together, so no position is looked at that the table rules out.

Texts are searched where they are: the only shuffle is that of the item
windows. Windows are numbered, and reach the tasks by broadcast, at most
``patterns_per_pass`` at a time; more windows mean more passes over the texts,
never fewer windows. Which items a window belongs to goes along while these
pairs are known to be few; otherwise texts are found with the numbers of their
windows, and the distinct lists of numbers are joined with the items afterwards,
so that a window that very many items share is one number until then.

Defined results: a null or empty text has no words and is clean; a null item
text has no windows; a null item_id is left out of the item list (its
occurrences still count as hits); repeated rows of either table give repeated
rows, or count once as an item; a very long text is whole in its task; extra input
columns are ignored unless kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import flat
from .arrow import map_texts, quoted

N = 10
#: Broadcast bound: so many patterns (about 150 bytes each) go to a task at once.
PATTERNS_PER_PASS = 200_000
#: So many (window, item) pairs may go along with the windows of all passes.
PAIRS_ALONG = 400_000
LANE = 512
TABLE_BITS = 18
FIELDS = "n_words long, n_hit long, spans array<struct<start:int,end:int>>, numbers array<long>, items array<string>"


def item_windows(items: DataFrame, n: int = N, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (window, item): the words of a window joined by one space."""
    def cut(rows, texts):
        w = flat.words(texts, hashes=False)
        folded = flat.FOLDED[w.raw].tobytes()
        out, at = [], []
        for i in range(len(rows)):
            own = [folded[s:e].decode() for s, e in zip(w.start[w.first[i]:w.first[i + 1]],
                                                        w.end[w.first[i]:w.first[i + 1]])]
            for k in range(max(len(own) - n, 0) + 1 if own else 0):
                out.append(" ".join(own[k:k + n]))
                at.append(i)
        return {None: np.array(at, np.int64), "window": pa.array(out, pa.string())}

    named = items.select(F.col(quoted(item_id)).cast("string").alias("item"), F.col(quoted(text)).alias("text"))
    return map_texts(named, "text", ["item"], "window string", cut).distinct()


class Patterns:
    """Shift table and buckets of all patterns of one length."""

    def __init__(self, texts: list[str], numbers: list[int]):
        self.words = [t.encode().split(b" ") for t in texts]
        self.number = np.array(numbers)
        self.m = len(self.words[0])
        self.block = min(2, self.m)
        w = flat.words(pa.array(texts, pa.string()))
        grid = w.hash.reshape(len(texts), self.m)
        steps = self.m - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, steps, dtype=np.uint8 if steps < 255 else np.int64)
        for j in range(steps):
            np.minimum.at(self.shift, self.slot(self.blocks(grid[:, j:j + self.block])), steps - 1 - j)
        suffix, prefix = self.blocks(grid[:, -self.block:]), self.blocks(grid[:, :self.block])
        key = flat.mix(suffix) ^ prefix
        order = np.argsort(key, kind="stable")
        self.key, self.order = key[order], order
        self.grid = grid

    def blocks(self, grid: np.ndarray) -> np.ndarray:
        return flat.mix(grid[..., 0]) + grid[..., 1] if self.block == 2 else flat.mix(grid[..., 0])

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (flat.mix(block, 3) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, w: flat.Words, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(word position of the occurrence's start, pattern number)."""
        m, first = self.m, w.first
        counts = np.diff(first)
        room = counts - m + 1  # window starts of each text
        lanes = -(-np.maximum(room, 0) // LANE)
        if not lanes.sum():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = np.repeat(first[:-1], lanes) + nth * LANE
        stop = np.minimum(begin + LANE, np.repeat(first[:-1] + np.maximum(room, 0), lanes))
        h = w.hash
        block = flat.mix(h[:-1]) + h[1:] if self.block == 2 else flat.mix(h)
        at, found = begin, []
        tail = m - self.block
        while len(at):
            move = self.shift[self.slot(block[at + tail])].astype(np.int64)
            zero = move == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.concatenate(found)
        key = flat.mix(block[at + tail]) ^ block[at]
        lo, hi = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        n = hi - lo
        at = np.repeat(at, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        which = self.order[np.repeat(lo, n) + nth]
        same = np.ones(len(at), dtype=bool)
        for j in range(m):
            same &= h[at + j] == self.grid[which, j]
        at, which = at[same], which[same]
        sure = [all(folded[s:e] == x for s, e, x in zip(w.start[a:a + m], w.end[a:a + m], self.words[p]))
                for a, p in zip(at.tolist(), which.tolist())]
        at, which = at[sure] if len(at) else at, which[sure] if len(at) else which
        return at, self.number[which]


def _covered(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Merged ranges."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts.tolist(), ends.tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _scan(docs: DataFrame, text: str, keep: Sequence[str], rows: list, more: bool) -> DataFrame:
    """One pass: the windows of ``rows`` (window, number, items); ``more``: add to an earlier pass."""
    rows = sorted(rows, key=lambda r: r["window"])
    names = [r["window"] for r in rows]
    items = [r["items"] or [] for r in rows]
    own = [r["number"] for r in rows]
    by_length: dict[int, list[int]] = {}
    for k, x in enumerate(names):
        by_length.setdefault(x.count(" ") + 1, []).append(k)
    tables = [Patterns([names[k] for k in ks], ks) for ks in by_length.values()]
    sent = docs.sparkSession.sparkContext.broadcast((tables, items, own))

    def run(rows, texts):
        tables, items, own = sent.value
        w = flat.words(texts)
        folded = flat.FOLDED[w.raw].tobytes()
        hits = [t.search(w, folded) for t in tables]
        at = np.concatenate([a for a, _ in hits] or [np.empty(0, np.int64)]).astype(np.int64)
        length = np.concatenate([np.full(len(a), t.m) for t, (a, _) in zip(tables, hits)] or [at]).astype(np.int64)
        number = np.concatenate([p for _, p in hits] or [at]).astype(np.int64)
        doc = np.searchsorted(w.first, at, "right") - 1
        order = np.argsort(doc, kind="stable")
        at, length, number, doc = at[order], length[order], number[order], doc[order]
        edge = np.searchsorted(doc, np.arange(len(rows) + 1))
        before = rows.column(rows.schema.get_field_index("__found")).to_pylist() if more else None
        spans, found, numbers = [], [], []
        for i in range(len(rows)):
            lo, hi = edge[i], edge[i + 1]
            s, e = at[lo:hi] - w.first[i], at[lo:hi] + length[lo:hi] - w.first[i]
            which = set(number[lo:hi].tolist())
            got, known = {x for p in which for x in items[p]}, {own[p] for p in which}
            if before:
                s = np.r_[s, [x["start"] for x in before[i]["spans"]]].astype(np.int64)
                e = np.r_[e, [x["end"] for x in before[i]["spans"]]].astype(np.int64)
                got |= set(before[i]["items"])
                known |= set(before[i]["numbers"])
            spans.append(_covered(s, e) if len(s) else [])
            found.append(sorted(got))
            numbers.append(sorted(known))
        return {"n_words": w.counts(), "n_hit": [sum(e - s for s, e in x) for x in spans],
                "spans": [[{"start": s, "end": e} for s, e in x] for x in spans], "numbers": numbers, "items": found}

    return map_texts(docs, text, keep, FIELDS, run, aside=["__found"] if more else [])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
                  n: int = N, item_id: str = "item_id", item_text: str = "text",
                  patterns_per_pass: int = PATTERNS_PER_PASS, pairs_along: int = PAIRS_ALONG) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``spans`` (merged word ranges that are hit) and
    ``items`` (sorted ids of the items with occurring windows)."""
    pairs = cut_lineage(item_windows(items, n, item_id, item_text))
    windows = cut_lineage(pairs.select("window").distinct().withColumn("number", F.monotonically_increasing_id()))
    along = pairs.count() <= pairs_along
    listed = windows.withColumn("items", F.lit(None).cast("array<string>"))
    if along:
        listed = windows.join(pairs, "window").groupBy("window", "number").agg(F.collect_list("item").alias("items"))
    passes = max(1, -(-windows.count() // patterns_per_pass))
    names = list(dict.fromkeys([*keep, text]))
    out = docs.select(*[F.col(quoted(c)) for c in names])
    for k in range(passes):
        part = listed.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == k).collect()
        if k:
            out = cut_lineage(out)
        out = _scan(out, text, names if k < passes - 1 else list(keep), part, more=k > 0)
        if k < passes - 1:
            out = out.select(*names, F.struct("spans", "numbers", "items").alias("__found"))
    if not along:
        out = _with_items(out, pairs.join(windows, "window").select("number", "item"))
    kept = [quoted(c) for c in keep if c not in ("n_words", "n_hit", "spans", "numbers", "items")]
    return out.select(*kept, "n_words", "n_hit", "spans", "items")


def _with_items(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The items of every row's window numbers: equal lists of numbers are looked
    up once, and rows without a hit stay where they are."""
    hit = F.size("numbers") > 0
    lists = found.where(hit).select("numbers").distinct()
    looked = lists.select("numbers", F.explode("numbers").alias("number")).join(pairs, "number", "left") \
        .groupBy("numbers").agg(F.array_sort(F.collect_set("item")).alias("items"))
    joined = found.where(hit).drop("items").join(looked, "numbers").select(*[quoted(c) for c in found.columns])
    return found.where(~hit).unionByName(joined)


def contamination_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The digest columns of ``op2_decontaminate``."""
    found = decontaminate(docs, items, keep=["doc_id"], **options)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


REPORT_SQL = r"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS win
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM p),
dw AS (SELECT r, k, m, array_to_string(w[k:k + m - 1], ' ') AS win
       FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, lens WHERE len(w) >= m)),
hit AS (SELECT dw.r, dw.k, dw.m, p.item FROM dw JOIN p USING (win, m)),
pos AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS x FROM hit) GROUP BY r),
its AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit,
       CAST(coalesce(len(its.items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(its.items, ','), '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""
