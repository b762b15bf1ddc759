"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-grams; pairs with Jaccard similarity of at least
``threshold`` are wanted. In one run, a set takes each of its shingles with
probability 1 / (threshold * size), decided by a hash of the shingle alone, so
similar sets take the same ones. A bucket is a path of taken shingles: sets
that share a bucket of at most ``SMALL`` sets are compared by brute force, a
larger bucket is split by a second, and then a third shingle. A bucket that
is still large is compared all the same, first within blocks and then what these
left untied across blocks, so no bucket is capped. A pair misses a run with probability at most ``1 - q ** 3``
(q: chance to share a taken shingle); ``runs_for`` repeats runs until the
target recall for a pair right at the threshold. More similar pairs are missed
less.

Brute force compares 64-byte sketches (one-permutation minima) first; what
passes, with a wide margin, is joined into candidate groups, and inside these
every pair is verified on the whole shingle sets. Equal sets are one set with
a weight. The verified links are counted where they are found, never written
out as pairs, and tie the classes together.

Defined results: words are lower-cased (A-Z) runs without ASCII punctuation; a
text of one to four words is one shingle; a null or empty text has no shingle,
no link and a class of its own; repeated rows count as copies; a class without
a non-null id has a null class id; a very long text is whole in its task; extra
columns are left out (``one_of_each`` keeps them); an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import drop_path, scratch_path
from . import flat
from .arrow import bound_batches, map_texts, quoted, schema_of, ship, stored
from .components import components, forget_shuffles

WORDS, THRESHOLD, RECALL, LEVELS = 5, 0.8, 0.9999, 3
#: Sets of a small bucket; of a block of a large one; shingles of a block of texts.
SMALL, BLOCK, BLOCK_SHINGLES = 24, 512, 1_000_000
SKETCH, MARGIN = 64, 0.3


def runs_for(threshold: float = THRESHOLD, recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs that a pair right at the threshold needs, whatever its sizes: both must take
    a shingle, so the larger set's chance 1 / (t * size) counts. A pair of equal sets shares
    2t / (1 + t) of a set, 2 / (1 + t) taken ones on average; the worst pair, a set and a subset
    of t of it, shares t of the larger, so 1 on average and q = 1 - exp(-1)."""
    q = 1 - math.exp(-1)
    return math.ceil(math.log(1 - recall) / math.log(1 - q ** levels))


def shingles(w: flat.Words, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ordered by text, and the offsets."""
    grams, ok = flat.windows(w.hash, n), flat.window_mask(w.first, n)
    at = np.flatnonzero(ok)
    doc, h = w.doc()[at], grams[at]
    counts = w.counts()
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):  # one shingle of all words
        own = np.array([flat.windows(w.hash[w.first[i]:w.first[i + 1]], counts[i], 7)[0] for i in short], np.uint64)
        doc, h = np.r_[doc, short], np.r_[h, own]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(len(counts) + 1))


def _sum_by(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def sketches(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One byte a bin: a print of the smallest hash there, 0 for no hash."""
    n = len(at) - 1
    least = np.full(n * SKETCH, np.uint64(2**64 - 1))
    x = flat.mix(h, 3)
    doc = np.repeat(np.arange(n), np.diff(at))
    np.minimum.at(least, doc * SKETCH + (x >> np.uint64(58)).astype(np.int64), x << np.uint64(6))
    byte = (flat.mix(least, 4) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    byte[least == np.uint64(2**64 - 1)] = 0
    return byte.reshape(n, SKETCH)


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Sketch pairs whose estimated similarity is at least ``least``."""
    same = ((a == b) & (a > 0)).sum(axis=1)
    either = ((a > 0) | (b > 0)).sum(axis=1)
    return same >= least * either


def set_table(docs: DataFrame, doc_id: str, text: str, threshold: float, runs: int) -> DataFrame:
    """One row per document: (id, rk, n, key, sketch, c1, c2, c3): its set's
    size and 128-bit key, and the shingles taken at each level of each run."""
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("rk"),
                       F.col(quoted(text)).cast("string").alias("text"))
    odd = [[(int(flat.mix(np.array([1000 * level + r], np.uint64), 77)[0]) | 1) for r in range(runs)]
           for level in range(LEVELS)]

    def build(rows, texts):
        h, at = shingles(flat.words(texts))
        size = np.diff(at)
        doc = np.repeat(np.arange(len(size)), size)
        limit = np.minimum(2.0**64 / np.maximum(threshold * size, 1.0), 2.0**64 - 4096).astype(np.uint64)[doc]
        out = {"n": size, "sketch": pa.array([x.tobytes() for x in sketches(h, at)], pa.binary()),
               "key": pa.array([x.tobytes() + y.tobytes() for x, y in
                                zip(_sum_by(flat.mix(h, 1), at), _sum_by(flat.mix(h, 2), at))], pa.binary())}
        low = (flat.mix(h, 9) >> np.uint64(32)).astype(np.int64)
        for level in range(LEVELS):
            who, what = [], []
            for r, a in enumerate(odd[level]):
                hit = np.flatnonzero(h * np.uint64(a) < limit)
                who.append(doc[hit])
                what.append(low[hit] | (r << 32))
            who, what = np.concatenate(who), np.concatenate(what)
            order = np.argsort(who, kind="stable")
            ends = np.r_[0, np.cumsum(np.bincount(who, minlength=len(size)))]
            out[f"c{level + 1}"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(what[order]))
        return out

    return map_texts(rows, "text", ["id", "rk"], "n long, key binary, sketch binary, c1 array<long>, "
                     "c2 array<long>, c3 array<long>", build)


class _Tables:
    """Tables written under a name, which go as soon as no later step reads them:
    disks then hold what a step needs, not what all steps made."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        self.paths[name] = scratch_path(self.spark, name)
        rows = stored(rows, self.paths[name])
        forget_shuffles(rows)
        return rows

    def drop(self, *names: str) -> None:
        for name in names:
            drop_path(self.spark, self.paths.pop(name))


def _sized(members: DataFrame) -> DataFrame:
    """Members (bucket, uid, ...) of buckets of two or more sets, with the sizes and smallest
    uids. A set is in a bucket once, so sizes are plain counts, added up before the exchange,
    and the join with them may split a hot bucket."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("uid").alias("least")).where("size > 1")
    return members.join(sizes, "bucket")


def buckets(sets: DataFrame, tables: _Tables) -> DataFrame:
    """Leaf buckets of all runs, (bucket, uid, size, least), of different sets (uid, c1, c2, c3)."""
    leaf, small = ["bucket", "uid", "size", "least"], F.col("size") <= SMALL
    first = tables.put("level1", _sized(sets.select("uid", F.explode("c1").alias("bucket"))))
    own = [F.filter(c, lambda x: F.shiftright(x, 32) == F.shiftright("bucket", 32)).alias(c) for c in ("c2", "c3")]
    large = first.where(~small).select("bucket", "uid").join(sets.select("uid", "c2", "c3"), "uid").select("bucket", "uid", *own)
    deeper = F.xxhash64("bucket", "taken").alias("bucket")
    taken = tables.put("taken2", large.select("bucket", "uid", "c3", F.explode("c2").alias("taken")).select(deeper, "uid", "c3"))
    second = tables.put("level2", _sized(taken))
    tables.drop("taken2")
    taken = second.where(~small).select("bucket", "uid", F.explode("c3").alias("taken"))
    third = _sized(taken.select(deeper, "uid"))
    leaves = tables.put("leaves", first.where(small).select(*leaf).unionByName(second.where(small).select(*leaf))
                        .unionByName(third.select(*leaf)))
    tables.drop("level1", "level2")
    return leaves


def _in_blocks(rows: DataFrame, group: str, blocks, salt: str) -> DataFrame:
    """Rows copied to the block pairs of their group: (part, mine) where part
    names the pair of blocks and ``mine`` the row's own block; a group of one
    block stays as it is."""
    rows = rows.withColumn("__nb", blocks.cast("int")) \
        .withColumn("mine", F.pmod(F.hash(salt), F.col("__nb")))
    return rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__nb") - 1))) \
        .withColumn("lo", F.least("mine", "__other")).withColumn("hi", F.greatest("mine", "__other")) \
        .withColumn("part", F.xxhash64(group, "lo", "hi")) \
        .withColumn("mine", F.when(F.col("lo") == F.col("hi"), 0).otherwise(F.when(F.col("mine") == F.col("lo"), 1)
                                                                          .otherwise(2))) \
        .drop("__nb", "__other", "lo", "hi")


def _by_group(batches, column: str):
    """Whole groups of a partition that is sorted by ``column``, some together."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        keys = held.column(column).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _tied(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each of n nodes' component, for edges a - b."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _run_pairs(group: np.ndarray, side: np.ndarray):
    """All (i, j) with i < j of one group, as arrays by distance; pairs of the
    same side (1 or 2) of a block pair are left to that block's own part."""
    at = np.arange(len(group))
    d = 1
    while len(at):
        at = at[at + d < len(group)]
        at = at[group[at] == group[at + d]]
        if len(at):
            ok = (side[at] == 0) | (side[at] != side[at + d])
            yield at[ok], at[ok] + d
        d += 1


def _alike_edges(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) that tie sets of a part whose sketches agree; rows: (part, mine, uid)."""
    rows = rows.join(sets.select("uid", "sketch"), "uid").select("part", "mine", "uid", "sketch")
    schema = schema_of("a long, b long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for rows in _by_group(batches, "part"):
            group, side = rows.column("part").to_numpy(), rows.column("mine").to_numpy()
            marks = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            start = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
            first = np.repeat(start, np.diff(np.r_[start, len(group)]))
            close = _alike(marks, marks[first], threshold - MARGIN)  # tied by the first of their part
            a, b = [first[close]], [np.flatnonzero(close)]
            for i, j in _run_pairs(group, side):
                open_ = ~(close[i] & close[j])
                i, j = i[open_], j[open_]
                ok = _alike(marks[i], marks[j], threshold - MARGIN)
                a.append(i[ok])
                b.append(j[ok])
            root = _tied(len(group), np.concatenate(a), np.concatenate(b))
            away = np.flatnonzero(root != np.arange(len(root)))
            uid = rows.column("uid").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(uid[root[away]]), pa.array(uid[away])], schema=arrow)

    # by uid within a part: buckets of one group then tie to the same few smallest sets
    return rows.repartition("part").sortWithinPartitions("part", "uid").mapInArrow(run, schema).distinct()


def candidate_groups(leaves: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(v, root): the groups that sets with like sketches in a common leaf bucket form.

    Only what is tied matters here, not each pair. So every block of a large bucket is
    compared within itself first, and with the bucket's smallest set, to which like ones
    tie whatever their block. Two sets of different blocks that are tied by then, in
    this bucket or another, need no comparison; in a bucket that is not one group yet,
    all sets outside its largest group (strays) meet all sets, in pairs of blocks."""
    nb = F.ceil(F.col("size") / BLOCK).cast("long")
    own = F.when(F.col("uid") == F.col("least"), F.sequence(F.lit(0).cast("long"), nb - 1)) \
        .otherwise(F.array(F.pmod(F.xxhash64("uid"), nb)))
    rows = leaves.select("uid", "bucket", F.explode(own).alias("block"), F.lit(0).alias("mine")) \
        .withColumn("part", F.xxhash64("bucket", "block"))
    edges = stored(_alike_edges(rows, sets, threshold))
    near = components(edges)
    wide = leaves.where(nb > 1).join(near.withColumnRenamed("v", "uid"), "uid", "left") \
        .withColumn("root", F.coalesce("root", "uid"))
    wide = stored(wide)
    kinds = wide.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket") \
        .agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    kinds = stored(kinds.where("kinds > 1").select("bucket", F.col("most.root").alias("main"), F.col("most.n").alias("n_main"),
                                                   (F.col("all") - F.col("most.n")).alias("n_stray")))
    if kinds.isEmpty():
        return near
    wide = wide.join(kinds, "bucket").select("bucket", "uid", "n_main", "n_stray", (F.col("root") != F.col("main")).alias("stray"))
    blocks = {c: F.ceil(F.col(c) / BLOCK).cast("long") for c in ("n_main", "n_stray")}
    strays = _in_blocks(wide.where("stray"), "bucket", blocks["n_stray"], "uid").select("uid", "part", "mine")

    def across(rows: DataFrame, mine: int, ours: str, theirs: str) -> DataFrame:
        rows = rows.withColumn(ours, F.pmod(F.xxhash64("uid", "bucket"), blocks[ours])) \
            .withColumn(theirs, F.explode(F.sequence(F.lit(0).cast("long"), blocks[theirs] - 1)))
        return rows.select("uid", F.xxhash64("bucket", "n_main", "n_stray", F.lit("across")).alias("part"),
                           F.lit(mine).alias("mine"))

    rows = strays.unionByName(across(wide.where("stray"), 1, "n_stray", "n_main")) \
        .unionByName(across(wide.where("not stray"), 2, "n_main", "n_stray"))
    return components(edges.unionByName(_alike_edges(rows, sets, threshold)))


def verified(docs: DataFrame, groups: DataFrame, doc_id: str, text: str, threshold: float) -> DataFrame:
    """Exact comparison inside candidate groups (root, key, id, rk, weight, n):
    rows (key, other, sets, docs): link counts, and edges where ``other`` is set."""
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("rk"),
                       F.col(quoted(text)).cast("string").alias("text"))
    named = groups.withColumnsRenamed({"id": "__id", "rk": "__rk"})
    rows = rows.join(named, (F.col("rk") == F.col("__rk")) & F.col("id").eqNullSafe(F.col("__id"))) \
        .select("root", "key", "weight", "total", "text")
    last = [None]

    def cut(rows, texts):
        keys = rows.column(rows.schema.get_field_index("key")).to_pylist()
        # the join's rows come by id and text: those that repeat both follow one another and go on once
        new = [k for k, x in enumerate(keys) if x != (keys[k - 1] if k else last[0])]
        last[0] = keys[-1]
        h, at = shingles(flat.words(texts.take(pa.array(new, pa.int64()))))
        return {None: np.array(new, np.int64),
                "hashes": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))}

    sets = map_texts(rows, "text", ["root", "key", "weight", "total"], "hashes array<long>", cut)
    parts = _in_blocks(sets, "root", F.ceil(F.col("total") / BLOCK_SHINGLES), "key") \
        .select("part", "mine", "key", "weight", "hashes")
    schema = schema_of("key binary, other binary, sets long, docs long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for some in _by_group(batches, "part"):
            edge = np.flatnonzero(np.diff(some.column("part").to_numpy())) + 1
            for lo, hi in zip(np.r_[0, edge], np.r_[edge, some.num_rows]):
                yield from compare(some.slice(lo, hi - lo).combine_chunks())

    def compare(rows):
        once = {k: i for i, k in enumerate(rows.column("key").to_pylist())}  # where the join was split or unordered
        if len(once) < rows.num_rows:
            rows = rows.take(pa.array(sorted(once.values()))).combine_chunks()
        side, weight = rows.column("mine").to_numpy(), rows.column("weight").to_numpy()
        column = rows.column("hashes").chunk(0)
        values, size = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
        order = np.argsort(size, kind="stable")
        at = np.r_[0, np.cumsum(size)]
        values = values[flat.expand(size[order], at[:-1][order])]
        _, token = np.unique(values, return_inverse=True)
        size, side, weight = size[order], side[order], weight[order]
        at = np.r_[0, np.cumsum(size)]
        seen = np.zeros(int(token.max()) + 1 if len(token) else 1, dtype=np.int32)
        sets, total = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        a, b = [], []
        for i in range(len(size) - 1):
            last = int(np.searchsorted(size, size[i] / threshold + 1e-9, "right"))  # larger sets cannot reach it
            if last <= i + 1:
                continue
            seen[token[at[i]:at[i + 1]]] = 1
            common = np.add.reduceat(seen[token[at[i + 1]:at[last]]], at[i + 1:last] - at[i + 1])
            seen[token[at[i]:at[i + 1]]] = 0
            j = np.arange(i + 1, last)
            ok = common >= threshold * (size[i] + size[j] - common) - 1e-9
            ok &= (side[j] == 0) | (side[j] != side[i])
            j = j[ok]
            sets[i] += len(j)
            total[i] += weight[j].sum()
            sets[j] += 1
            total[j] += weight[i]
            a.append(np.full(len(j), i))
            b.append(j)
        keys = rows.column("key").take(pa.array(order))
        keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
        linked = np.flatnonzero(sets)
        if not len(linked):
            return
        root = _tied(len(size), np.concatenate(a), np.concatenate(b))
        away = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([keys.take(pa.array(linked)), keys.take(pa.array(away))]).cast(pa.binary()),
             pa.concat_arrays([pa.nulls(len(linked), pa.binary()), keys.take(pa.array(root[away])).cast(pa.binary())]),
             pa.array(np.r_[sets[linked], np.zeros(len(away), np.int64)]),
             pa.array(np.r_[total[linked], np.zeros(len(away), np.int64)])], schema=arrow)

    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    return parts.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


def similarity_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                       recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: (doc_id, rk, n_shingles, class_key, copy_id,
    class_id, n_links). ``class_key`` names the class (null without shingles),
    ``copy_id``: smallest id with the same set; ``class_id``: smallest
    id of the class that links tie together; ``n_links``: other documents with
    similarity >= threshold, copies included. ``rk`` is xxhash64 of the text."""
    base = set_table(docs, doc_id, text, threshold, runs_for(threshold, recall))
    tables = _Tables(docs.sparkSession)
    wide = tables.put("base", base.withColumn("uid", F.monotonically_increasing_id()))
    full = wide.where("n > 0")
    copies = tables.put("copies", full.groupBy("key").agg(F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("weight"),
                                                           F.min_by(F.struct("uid", "id", "rk", "n"), "uid").alias("one")))
    sets = tables.put("sets", full.join(copies.select("one.uid"), "uid", "left_semi").select("uid", "sketch", "c1", "c2", "c3"))
    base = tables.put("rows", wide.select("id", "rk", "n", "key", "uid"))
    tables.drop("base")
    leaves = buckets(sets, tables)
    prints = tables.put("prints", sets.select("uid", "sketch"))
    tables.drop("sets")
    near = candidate_groups(leaves, prints, threshold)
    tables.drop("leaves", "prints")
    grouped = near.join(copies, near["v"] == copies["one.uid"])
    totals = grouped.groupBy("root").agg(F.sum("one.n").alias("total"))
    grouped = grouped.join(totals, "root").select("root", "key", "weight", "total", "one.id", "one.rk")
    found = tables.put("found", verified(docs, grouped, doc_id, text, threshold))
    counts = found.where(F.col("other").isNull()).groupBy("key").agg(F.sum("docs").alias("links"))
    tied = components(found.where(F.col("other").isNotNull()).select(F.col("key").alias("a"), F.col("other").alias("b")))
    own = copies.select("key", "copy_id", "weight").join(counts, "key", "left") \
        .join(tied.select(F.col("v").alias("key"), "root"), "key", "left") \
        .withColumn("root", F.coalesce("root", "key"))
    least = own.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    own = own.join(least, "root").select("key", "root", "copy_id", "class_id",
                                         (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = base.select("id", "rk", "n", F.when(F.col("n") > 0, F.col("key")).alias("key")).join(own, "key", "left")
    alone = F.col("key").isNull()
    return linked.select(F.col("id").alias(doc_id), "rk", F.col("n").alias("n_shingles"),
                         F.col("root").alias("class_key"),
                         F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
                         F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                         F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id; texts
    without a shingle all stay. Rows that repeat id and text are one."""
    classes = similarity_classes(docs, doc_id, text, **options)
    first = classes.where(F.col("class_key").isNotNull()).groupBy("class_key") \
        .agg(F.min(F.struct(F.col(quoted(doc_id)).isNull().alias("last"), F.col(quoted(doc_id)).alias("id"),
                            F.col("rk"))).alias("one")).select("one.id", "one.rk")
    alone = classes.where(F.col("class_key").isNull()).select(F.col(quoted(doc_id)).alias("id"), "rk")
    def named(rows: DataFrame) -> DataFrame:
        """Plain keys: the join and the removal of repeated rows then share one exchange."""
        return rows.withColumn("none", F.col("id").isNull()).withColumn("id", F.coalesce(F.col("id").cast("string"), F.lit("")))

    keys = ["id", "none", "rk"]
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
                       F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("rk"))
    kept = named(rows).join(named(first.unionByName(alone.distinct())), keys, "left_semi").dropDuplicates(keys)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def join_report(docs: DataFrame) -> DataFrame:
    """The columns of ``op1_ngram_jaccard``."""
    return similarity_classes(docs).select("doc_id", "class_id", "copy_id", "n_links", "n_shingles")
