"""Stand-ins for the ticket log, derived from the driver's tables.

``tickets`` is lineitem joined with orders: one order is one entity, its
lines are the events. Both tables grow with the scale factor, so every query
built on it does too. ``id`` is computed from the join key: a sort-merge join (large
tables) leaves its output clustered by the key, and aggregations that reused
that would meet a hot entity in one task. So the adaptive skew join may split
a hot key, and the per-entity aggregations pre-aggregate before an exchange of
their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .spec import LogSpec


# Fixed values of the stand-in (see FIXTURES.md).
TICKETS = LogSpec(
    id_col="id",
    order_by=("ts", "l_linenumber", "l_partkey", "l_suppkey"),
    status_col="status",
    closed=("F",),
    labels=("grp",),
    null_tokens=("4-NOT SPECIFIED",),
    skip=("ts",),
    mixed=("priority",),
    numeric=("l_quantity",),
    not_relevant=("priority",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.greatest("l_orderkey", "o_orderkey").alias("id"),  # equal keys; see above
        F.col("l_shipdate").alias("ts"),
        F.col("l_linestatus").alias("status"),
        F.col("l_returnflag").alias("grp"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("ostatus"),
        "l_quantity", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") <= 3, F.col("l_linenumber").cast("string")).alias("sparse"),
    )


# The same view in DuckDB SQL, for the oracles.
TICKETS_SQL = """
SELECT l_orderkey AS id, l_shipdate AS ts, l_linestatus AS status, l_returnflag AS grp,
       o_orderpriority AS priority, o_orderstatus AS ostatus, l_quantity, l_linenumber,
       l_partkey, l_suppkey,
       CASE WHEN l_linenumber > 3 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS sparse
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
