"""A hot entity holding a third of all rows: results stay exact, and every
per-entity aggregation pre-aggregates before its shuffle."""

import pytest
from pyspark.sql import functions as F

from caseflow.operators import consolidate, group_count_histogram, profile_columns


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30000
    df = spark.range(0, n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 5 == 0, F.lit("closed")).otherwise(F.lit("open")).alias("st"),
        (F.col("id") % 4).cast("string").alias("g"),
        F.lit("same").alias("c"),
    )
    return df


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan: str) -> bool:
    lines = plan.split("\n")
    ex = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    return any("partial_" in line for line in lines[ex + 1:])


def test_hot_entity_profile(skewed):
    p = profile_columns(skewed, "k", "st", ["closed"], [], skip=["seq"])
    rows = {r.column_name: r for r in p.collect()}
    assert rows["c"].constancy == 1.0
    assert rows["g"].constancy == 0.0       # every entity has several g values among open rows
    assert _partial_before_exchange(_plan(p))


def test_hot_entity_consolidate_and_histogram(skewed):
    c = consolidate(skewed, "k", ["g"], ["st"], ["seq"])
    hot = c.where("k = 0").first()
    assert (hot.g, hot.st) == ("0", "open")      # seq 0 first; last seq of k=0 is 29997 -> % 5 != 0
    assert _partial_before_exchange(_plan(c))
    brute = {r.k: r for r in skewed.groupBy("k").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).collect()}
    assert c.count() == len(brute)
    h = group_count_histogram(skewed, "k", "g", [])
    assert sum(r["count"] for r in h.collect()) == len(brute)


def test_hot_entity_through_the_join(spark, tmp_path):
    """Broadcast joins off, no forced skew handling: the aggregation does not reuse the
    join's clustering by key (which would keep the adaptive skew join from splitting a
    hot key), it pre-aggregates the join's output before an exchange of its own."""
    from caseflow.plans.fixtures import TICKETS, tickets

    n = 60000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).cast("long")
    lines = spark.range(0, n, numPartitions=8).select(
        key.alias("l_orderkey"), F.expr("date_add(DATE'2020-01-01', CAST(id % 900 AS INT))").alias("l_shipdate"),
        F.lit("O").alias("l_linestatus"), F.lit("A").alias("l_returnflag"), F.col("id").cast("double").alias("l_quantity"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(0, 2001).selectExpr("id AS o_orderkey", "'1-URGENT' AS o_orderpriority", "'O' AS o_orderstatus") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        c = consolidate(tickets(spark, str(tmp_path)), "id", ["l_quantity"], ["grp"], TICKETS.order_by)
        rows = c.collect()
        plan = _plan(c)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan.split("== Initial Plan ==")[0]
    above = final[:final.index("SortMergeJoin")]
    assert "Exchange hashpartitioning(id" in above
    assert "partial_" in above[above.index("Exchange hashpartitioning(id"):]
    assert len(rows) == lines.select("l_orderkey").distinct().count()
