"""Hard negatives by exact integer scores from a residue-number-system GEMM.

Components become ``floor(scale * x)``. A block of anchors is multiplied with a
block of rows once for every small prime: residues are centred, so that a run of
``DEPTH`` products stays below 2**24 and a float32 product is exact. Centred
mixed-radix digits (Chinese remaindering after Garner) give the signed scores
back. How many primes are needed comes from the largest squared norm of the
whole table (Cauchy and Schwarz).

Two passes over the same blocks: the first leaves every anchor's best rows of
its own label (positives), the second the best rows of another label inside
the window below each positive's score. A block pair holds at most about
``ROWS`` rows and ``ANCHORS`` anchors, whatever the table's size; rows are dealt
by a hash of the whole row, so no label, id or vector makes a block large. A
block pair sends on its best few rows an anchor; Spark's windows merge these.

Defined results: rows with a null id, label or vector, or with a component that
is null or not finite, take no part; a shorter vector counts as filled with
zeros; copies of a row (id, label, components after flooring) count once; rows that share
an id and differ otherwise stay apart, and never are one another's positives;
ties go to the smaller id; an anchor without positives, or a positive without
negatives, gives no row; an empty table gives an empty result. Scores that a
64-bit integer cannot hold raise an OverflowError.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .arrow import quoted, schema_of, ship

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative scores between these hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Rows and anchors of a block pair, and anchors of a tile inside it.
ROWS, ANCHORS, TILE = 4096, 4096, 128
#: Products that one float32 sum may hold, and the largest prime for that.
DEPTH = 64
PRIMES = [p for p in range(1023, 900, -2) if all(p % k for k in range(3, 33, 2))]


def primes_for(bound: int) -> list[int]:
    """The fewest primes whose product tells all integers of [-bound, bound] apart."""
    out: list[int] = []
    while math.prod(out) <= 2 * bound:
        out.append(PRIMES[len(out)])
    return out


def residues(q: np.ndarray, prime: int) -> np.ndarray:
    """Centred residues as float32."""
    r = np.mod(q, prime)
    return (r - prime * (r > prime // 2)).astype(np.float32)


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed ``A @ B.T`` (int64) from the residue matrices of A and B."""
    digits: list[np.ndarray] = []
    out, weight = None, 1
    for k, prime in enumerate(primes):
        total = np.zeros((len(a[k]), len(b[k])), dtype=np.int64)
        for d in range(0, a[k].shape[1], DEPTH):
            total += (a[k][:, d:d + DEPTH] @ b[k][:, d:d + DEPTH].T).astype(np.int64)
        total %= prime
        for digit, before in zip(digits, primes):  # the next mixed-radix digit
            total = (total - digit) * pow(before, -1, prime) % prime
        total -= prime * (total > prime // 2)
        digits.append(total)
        step = total * np.int64(weight) if weight < 2**62 else (total.astype(np.uint64) * np.uint64(weight % 2**64)).astype(np.int64)
        out = step if out is None else out + step
        weight *= prime
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers, filled up with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(column.offsets.to_numpy())
    if (size == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < size[:, None]] = values
    return out


class Block:
    """Rows of one side of a block pair, ordered by id, with residue matrices."""

    def __init__(self, table: pa.Table, width: int, primes: list[int]):
        order = np.lexsort([table.column(c).to_numpy() for c in ("tag", "id")])
        self.table = table.take(pa.array(order)).combine_chunks()
        self.id, self.tag, self.label = (self.column(c).to_numpy() for c in ("id", "tag", "label"))
        q = _matrix(self.column("q"), width)
        self.residues = [residues(q, p) for p in primes]

    def column(self, name: str) -> pa.Array:
        column = self.table.column(name)
        return column.chunk(0) if column.num_chunks else pa.array([], column.type)

    def __len__(self) -> int:
        return len(self.id)


def _positives(anchors: Block, rows: Block, scores: np.ndarray, lo: int, keep: int):
    """(anchor, row, score) of the best rows of each anchor's label in this tile."""
    own = slice(lo, lo + len(scores))
    fits = (anchors.label[own][:, None] == rows.label) & (anchors.id[own][:, None] != rows.id)
    a, r = np.nonzero(fits)
    s = scores[a, r]
    order = np.lexsort([r, -s, a])  # rows are ordered by id: ties go to the smaller one
    a, r, s = a[order], r[order], s[order]
    best = np.arange(len(a)) - np.searchsorted(a, a) < keep
    return a[best] + lo, r[best], s[best]


def _negatives(anchors: Block, rows: Block, scores: np.ndarray, lo: int, keep: int, low: int, high: int):
    """(anchor, which positive, row, score) of the best rows of another label
    inside the window of every positive."""
    own = slice(lo, lo + len(scores))
    lists = anchors.column("positives").slice(lo, len(scores))
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    at, score = flat.field("nth").to_numpy(), flat.field("score").to_numpy()
    owner = np.repeat(np.arange(len(scores)), n)
    # percentages as exact integer bounds: low * p <= 100 * s <= high * p
    floor, top = -((-low * score) // 100), high * score // 100
    least, most = np.full(len(scores), np.iinfo(np.int64).max), np.full(len(scores), np.iinfo(np.int64).min)
    np.minimum.at(least, owner, floor)
    np.maximum.at(most, owner, top)
    fits = (anchors.label[own][:, None] != rows.label) & (scores >= least[:, None]) & (scores <= most[:, None])
    a, r = np.nonzero(fits)
    s = scores[a, r]
    order = np.lexsort([r, -s, a])
    a, r, s = a[order], r[order], s[order]
    begin = np.searchsorted(a, np.arange(len(scores) + 1))
    out = [[], [], [], []]
    for o, k, f, t in zip(owner.tolist(), at.tolist(), floor.tolist(), top.tolist()):
        mine = -s[begin[o]:begin[o + 1]]
        first = np.searchsorted(mine, -t, "left")
        last = min(int(np.searchsorted(mine, -f, "right")), first + keep)
        if last > first:
            hit = np.arange(begin[o] + first, begin[o] + last)
            for to, x in zip(out, (np.full(len(hit), o + lo), np.full(len(hit), k), r[hit], s[hit])):
                to.append(x)
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]


def _vectors(df: DataFrame, vec_id: str, vector: str, label: str | Column, scale: int) -> DataFrame:
    """(id, label, x): the rows that take part, components still as double."""
    x = F.col(quoted(vector)).cast("array<double>")
    kind = F.col(quoted(label)) if isinstance(label, str) else label
    rows = df.select(F.col(quoted(vec_id)).cast("long").alias("id"), kind.cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite) \
        .select("id", "label", F.transform("x", lambda v: v * F.lit(float(scale))).alias("x"))


def mine(df: DataFrame, anchor: Callable[[Column], Column], vec_id: str = "vec_id", vector: str = "embedding",
         label: str | Column = "label", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """For every row whose id satisfies ``anchor``: its best ``positives`` rows of
    the same label, and for each of these the best ``negatives`` rows of another
    label that score ``low`` to ``high`` hundredths of it."""
    spark = df.sparkSession
    rows = _vectors(df, vec_id, vector, label, scale)
    size = F.aggregate("x", F.lit(0.0), lambda s, v: s + F.pow(F.ceil(F.abs(v)).cast("double"), F.lit(2.0)))
    about = rows.agg(F.max(size).alias("norm"), F.max(F.size("x")).alias("width")).first()
    bound = math.ceil((about["norm"] or 0.0) * (1 + 1e-9)) + 1
    if 2 * max(low, high, 100) * bound >= 2**63:
        raise OverflowError(f"scores up to {bound} do not fit into 64 bits")
    primes, width = primes_for(bound), about["width"] or 0
    q = F.transform("x", lambda v: F.floor(v).cast("int")).alias("q")
    rows = rows.select("id", "label", q).distinct().withColumn("tag", F.xxhash64("label", "q"))
    rows = cut_lineage(rows)
    wanted = anchor(F.col("id"))
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count(F.when(wanted, 1))).first()
    row_blocks, anchor_blocks = max(1, -(-n // ROWS)), max(1, -(-n_anchors // ANCHORS))

    def dealt(table: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        """Every row in its own block, once for each block of the other side."""
        home = F.pmod(F.xxhash64(F.lit(7), "id", "tag"), F.lit(blocks)).cast("int").alias(own)
        return table.select("*", home, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    right = dealt(rows.toDF(*rows.columns), "rb", row_blocks, "ab", anchor_blocks)  # new columns: it meets its own anchors

    def blocks(anchors: DataFrame, fields: str, tile) -> DataFrame:
        out = schema_of(fields)
        arrow = to_arrow_schema(out)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):
                return arrow.empty_table()
            a, b = Block(left, width, primes), Block(right, width, primes)
            found = []
            for lo in range(0, len(a), TILE):
                part = [x[lo:lo + TILE] for x in a.residues]
                found.append(tile(a, b, products(part, b.residues, primes), lo))
            at, *rest = (np.concatenate(x) for x in zip(*found))
            row, score = rest[-2:]
            columns = [a.id[at], a.tag[at], *rest[:-2], b.id[row], b.tag[row], score]
            return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        left = dealt(anchors, "ab", anchor_blocks, "rb", row_blocks)
        return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInArrow(run, out)

    def best(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other", "other_tag")
        return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)

    ship(spark)
    anchors = rows.where(wanted)
    near = best(blocks(anchors, "id long, tag long, other long, other_tag long, score long",
                       lambda a, b, s, lo: _positives(a, b, s, lo, positives)), ["id", "tag"], positives)
    near = cut_lineage(near)  # read twice below
    lists = near.groupBy("id", "tag").agg(F.collect_list(F.struct("nth", "score")).alias("positives"))
    far = best(blocks(anchors.join(lists, ["id", "tag"]),
                      "id long, tag long, positive int, other long, other_tag long, score long",
                      lambda a, b, s, lo: _negatives(a, b, s, lo, negatives, low, high)),
               ["id", "tag", "positive"], negatives)
    pairs = near.select("id", "tag", F.col("nth").alias("positive"), F.col("other").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return far.join(pairs, ["id", "tag", "positive"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("nth").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives_report(embeddings: DataFrame) -> DataFrame:
    """The columns of ``op11_hard_negatives``: anchors are the ids divisible by
    100, an id divisible by 7 has the next label of ten."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(embeddings, lambda i: i % 100 == 0, label=label)


REPORT_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), s AS (
  SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a, v b WHERE a.id % 100 = 0
), p AS (
  SELECT anchor, other AS positive, score FROM s WHERE same AND anchor <> other
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
), n AS (
  SELECT p.anchor, p.positive, s.other AS negative, p.score AS ps, s.score AS ns,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS k
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor AS anchor_id, positive AS positive_id, k::INTEGER AS rank, negative AS negative_id,
       ps AS positive_score, ns AS negative_score
FROM n WHERE k <= 5
"""
