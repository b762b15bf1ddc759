"""Connected components of an edge table, by smallest labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path
from .arrow import stored


def forget_shuffles(df: DataFrame) -> None:
    """Shuffle files of steps that nothing refers to any more go when the driver's
    JVM collects its garbage. After a step was written to the checkpoint folder
    this asks for it, so that disks need not hold the files of all steps at once."""
    df.sparkSession.sparkContext._jvm.System.gc()


def _starred(down: DataFrame, least: DataFrame) -> DataFrame:
    """Edges that tie the same components as ``down`` (v, u), u below v: ``least`` has each
    v's smallest u, to which v and all its u are tied. Where many vertices share their few
    smallest neighbours, few edges a vertex are left, however many there were."""
    return down.join(least, "v").select(F.col("u").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("v").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of ``edges`` (columns a, b): root is the smallest
    vertex of v's component. Edges are thinned out once (``_starred``). Every round
    takes the smallest label around each vertex and then the label's own label, so
    long chains halve; each round is written to the shared folder, and the one before
    it removed. A label only ever falls, so rounds end by themselves. Only counts
    reach the driver."""
    spark = edges.sparkSession
    whole, ends, sides = (scratch_path(spark, name) for name in ("edges", "least", "edges"))
    down = stored(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v != u").distinct(), whole)
    # written, so that the join may split a vertex of many edges
    least = stored(down.groupBy("v").agg(F.min("u").alias("m")), ends)
    few = _starred(down, least)
    both = stored(few.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
        few.select(F.col("b").alias("v"), F.col("a").alias("u"))).where("v != u").distinct(), sides)
    for path in (whole, ends):
        drop_path(spark, path)
    path = scratch_path(spark, "labels")
    labels = stored(both.groupBy("v").agg(F.min("u").alias("m"))
                    .select("v", F.least("v", "m").alias("root")), path)
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), F.col("root").alias("r")), "u") \
            .groupBy("v").agg(F.min("r").alias("r"))
        step = labels.join(near, "v").select("v", F.col("root").alias("old"), F.least("root", "r").alias("root"))
        far = labels.select(F.col("v").alias("root"), F.col("root").alias("far"))
        step = step.join(far, "root", "left").select(
            "v", "old", F.least("root", F.coalesce("far", "root")).alias("root"))
        last, path = path, scratch_path(spark, "labels")
        step = stored(step, path)
        drop_path(spark, last)
        labels = step.select("v", "root")
        if step.where("root != old").isEmpty():
            drop_path(spark, sides)
            forget_shuffles(step)
            return labels
