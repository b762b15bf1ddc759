"""Registered queries over the driver's tables and their DuckDB oracles.

Every query reads the given parquet tables (through the ``tickets`` stand-in
or directly) over their whole extent. Ratios are rounded to 6 places on both
sides; every computed column has the same alias in Spark and in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import drop_incomplete, nullify_tokens
from ..functions.scalar import first_int, to_double, to_int
from ..ml.evaluate import ATTEMPTS, attempts_histogram, attempts_needed, prediction_attempts
from ..ml.features import INDEXED_LABEL, index_categories, split_by_key
from ..ml.models import KINDS, evaluate_labels, evaluate_model, score, train_model
from ..operators.consolidate import consolidate
from ..operators.profile import (constancy, entity_counts, null_ratio, open_records, profile_columns,
                                 profiled_columns, select_inputs)
from ..operators.reassign import group_count_histogram
from ..operators.vocab import build_vocabulary, encode
from ..session import drop_path, scratch_path
from ..sources.io import read_encoded, read_event_log, write_report, write_table
from .fixtures import TICKETS, TICKETS_SQL, table, tickets
from .flow import prepare_model_table

S = TICKETS
# Columns used by the consolidation and cleaning checks (fixed choice, includes
# the NULL-bearing ``sparse`` so that NULL first values are exercised).
CONSOLIDATE_INPUTS = ("ostatus", "priority", "sparse", "status", "l_quantity")
CATEGORICAL = ("status", "grp", "priority", "ostatus")


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- queries

def q_open_records(spark: SparkSession, sf: str) -> DataFrame:
    return open_records(tickets(spark, sf), S.status_col, S.closed)


def q_distinct_entities(spark: SparkSession, sf: str) -> DataFrame:
    return entity_counts(tickets(spark, sf), S.id_col, S.status_col, S.closed)


def q_column_constancy(spark: SparkSession, sf: str) -> DataFrame:
    t = tickets(spark, sf)
    return _round(constancy(t, S.id_col, S.status_col, S.closed, skip=S.skip), "constancy")


def q_column_null_ratio(spark: SparkSession, sf: str) -> DataFrame:
    t = tickets(spark, sf)
    return _round(null_ratio(t, profiled_columns(t, S.id_col, S.skip), S.null_tokens), "null_ratio")


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile_columns(tickets(spark, sf), S.id_col, S.status_col, S.closed, S.null_tokens, skip=S.skip)


def q_column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_profile(spark, sf), "constancy", "null_ratio")


def q_column_profile_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Constancy by the values themselves wherever the hashes see a constant entity."""
    profile = profile_columns(tickets(spark, sf), S.id_col, S.status_col, S.closed, S.null_tokens, skip=S.skip, exact=True)
    return _round(profile, "constancy", "null_ratio")


def q_selected_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return select_inputs(_profile(spark, sf), S.labels)


def q_consolidate_first_last(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate(tickets(spark, sf), S.id_col, CONSOLIDATE_INPUTS, S.labels, S.order_by)


def q_consolidate_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered by the time alone, on which rows of an order tie."""
    t = tickets(spark, sf).withColumn("ts", F.date_trunc("year", "ts"))
    return consolidate(t, S.id_col, CONSOLIDATE_INPUTS, S.labels, ["ts"])


def q_nullify_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return nullify_tokens(tickets(spark, sf), S.null_tokens)


def q_drop_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return drop_incomplete(nullify_tokens(tickets(spark, sf), S.null_tokens))


def q_first_int(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderpriority", first_int(F.col("o_orderpriority")).alias("priority_num"))


def q_to_int(spark: SparkSession, sf: str) -> DataFrame:
    t = tickets(spark, sf)
    types = {f.name: f.dataType for f in t.schema.fields}
    return t.select("id", "l_linenumber",
                    to_int(F.col("sparse"), types["sparse"]).alias("sparse_int"),
                    to_int(F.col("l_quantity"), types["l_quantity"]).alias("quantity_int"),
                    to_int(F.col("priority"), types["priority"]).alias("priority_int"))


def _tickets_clean(spark: SparkSession, sf: str) -> DataFrame:
    return nullify_tokens(tickets(spark, sf), S.null_tokens)


def q_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return build_vocabulary(_tickets_clean(spark, sf), CATEGORICAL).table


def q_encode(spark: SparkSession, sf: str) -> DataFrame:
    t = _tickets_clean(spark, sf)
    vocab = build_vocabulary(t, CATEGORICAL)
    return encode(t, vocab, CATEGORICAL).select("id", "l_linenumber", *CATEGORICAL)


# A vocabulary of thousands of values over rows with NULL and repeated keys.
LARGE = ("customer", "day", "ostatus")


def _large(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "nullif(o_custkey % 50, 0) AS id", "concat('c', o_custkey) AS customer",
        "nullif(CAST(CAST(o_orderdate AS DATE) AS STRING), '1995-01-01') AS day", "o_orderstatus AS ostatus")


def q_vocabulary_large(spark: SparkSession, sf: str) -> DataFrame:
    return build_vocabulary(_large(spark, sf).repartition(16), LARGE).table


def q_encode_large(spark: SparkSession, sf: str) -> DataFrame:
    """The shuffle path: no vocabulary is small enough for a limit of 0; one value in eight is unknown."""
    t = _large(spark, sf)
    known = build_vocabulary(t.where(F.col("customer").substr(-1, 1) != "7"), LARGE)
    return encode(t, known, LARGE, broadcast_limit=0)


def q_group_count_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return group_count_histogram(tickets(spark, sf), S.id_col, S.labels[0], S.null_tokens)


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    t = tickets(spark, sf)
    path = scratch_path(spark, "csv-roundtrip")
    write_table(t, path, fmt="csv", sep=";")
    return read_event_log(spark, path, fmt="csv", sep=";", schema=t.schema)


def _model_table(spark: SparkSession, sf: str) -> DataFrame:
    """The model-ready table. The flow reads the log three times, so the join that
    stands for it is made once and written; the written log goes when the flow is done."""
    log, path = tickets(spark, sf), scratch_path(spark, "tickets")
    write_table(log, path)
    table = prepare_model_table(spark.read.schema(log.schema).parquet(path), S).table
    drop_path(spark, path)
    return table


def q_full_flow(spark: SparkSession, sf: str) -> DataFrame:
    return _model_table(spark, sf)


# ------------------------------------------------------------ ML queries

def _embedding_attempts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", attempts_needed(F.col("embedding"), F.col("label")).alias(ATTEMPTS))


def q_attempts_needed(spark: SparkSession, sf: str) -> DataFrame:
    return _embedding_attempts(spark, sf)


def q_attempts_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return attempts_histogram(table(spark, sf, "embeddings"), "embedding", "label")


def q_split_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Two fractions over keys of which some are NULL; a row is in one part only."""
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderkey, o_orderkey DIV 97 * 97) AS k")
    train, test = split_by_key(o, "k")
    more, rest = split_by_key(o, "k", 0.95)
    flag = [x.select("o_orderkey", "k", F.lit(n).alias("part")) for x, n in
            ((train, "train"), (test, "test"), (more, "train95"), (rest, "test95"))]
    return flag[0].unionByName(flag[1]).unionByName(flag[2]).unionByName(flag[3])


STRING_INDEX_COLS = ("ostatus", "priority", "sparse", "status", "grp")


def q_string_index(spark: SparkSession, sf: str) -> DataFrame:
    merged = consolidate(tickets(spark, sf), S.id_col, CONSOLIDATE_INPUTS, S.labels, S.order_by)
    model = index_categories(STRING_INDEX_COLS).fit(merged)
    out = model.transform(merged)
    return out.select("id", *[c for c in out.columns if c.startswith("indexed")])


def q_string_index_large(spark: SparkSession, sf: str) -> DataFrame:
    """The one-join path: no index is small enough for a limit of 0; one customer in eight is unseen."""
    t = _large(spark, sf)
    model = index_categories(LARGE, broadcast_limit=0).fit(t.where(F.col("customer").substr(-1, 1) != "7"))
    return model.transform(t).drop(*LARGE)


def _nb_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    (F.col("o_custkey") % 7).cast("string").alias("cust7"),
                    F.col("o_orderpriority").alias("label"))


def q_naive_bayes_score(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_by_key(_nb_orders(spark, sf), "o_orderkey")
    model = train_model(train, "naive_bayes", [], ["o_orderstatus", "cust7"])
    pred = score(model, test)
    return pred.select("o_orderkey", INDEXED_LABEL, "prediction",
                       prediction_attempts(pred).alias(ATTEMPTS))


def q_naive_bayes_metrics(spark: SparkSession, sf: str) -> DataFrame:
    frame = _nb_orders(spark, sf)
    ev = evaluate_model(frame, "label", ["label"], "naive_bayes", "o_orderkey")
    return ev.metrics.withColumn("accuracy", F.round("accuracy", 6))


def _attempts_query(kind: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ev = evaluate_model(_model_table(spark, sf), S.labels[0], S.labels, kind, S.id_col,
                            numeric=S.numeric, drop=S.not_relevant)
        return ev.histogram
    run.__name__ = f"q_{kind}_attempts"
    return run


# Labels that the inputs determine: a right model scores every held-out row at the first attempt.
SEPARABLE_LABELS = ("band", "side")
SEPARABLE_KINDS = tuple(k for k in KINDS if k != "naive_bayes")


def _separable(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "CAST(o_custkey % 7 AS INT) AS seven", "CAST(o_custkey % 3 AS INT) AS three",
        "CASE WHEN o_custkey % 7 < 2 THEN 1 WHEN o_custkey % 7 < 5 THEN 2 ELSE 3 END AS band",
        "CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 2 END AS side")


def _separable_query(kind: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return evaluate_model(_separable(spark, sf), "band", SEPARABLE_LABELS, kind, "id").histogram
    run.__name__ = f"q_{kind}_separable"
    return run


def q_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics, _ = evaluate_labels(_separable(spark, sf), SEPARABLE_LABELS, SEPARABLE_KINDS, "id")
    return metrics


def q_saturated_logreg(spark: SparkSession, sf: str) -> DataFrame:
    """One categorical input: the fitted probabilities are the class shares of
    each of its values. Two classes with the same count differ by rounding
    only, so probabilities closer than half a row count as equal."""
    t = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("label"))
    ev = evaluate_model(t, "label", ["label"], "logistic_regression", "o_orderkey")
    half = 0.5 / split_by_key(t, "o_orderkey")[0].count()
    p = vector_to_array(F.col("probability"))
    own = F.element_at(p, F.col(INDEXED_LABEL).cast("int") + 1)
    attempts = (F.size(F.filter(p, lambda x: x > own + half)) + 1).alias(ATTEMPTS)
    return ev.predictions.select(attempts).groupBy(ATTEMPTS).agg(F.count(F.lit(1)).alias("count")).orderBy(ATTEMPTS)


def q_tree_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A tree over few cells predicts each cell's most frequent training label."""
    ev = evaluate_model(_model_table(spark, sf), S.labels[0], S.labels, "decision_tree", S.id_col,
                        numeric=S.numeric, drop=S.not_relevant)
    names = F.array(*[F.lit(x) for x in ev.model.label_values])
    return ev.predictions.select("id", "label", F.element_at(names, F.col("prediction").cast("int") + 1)
                                 .cast("int").alias("predicted"))


def q_e1_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics, _ = evaluate_labels(_model_table(spark, sf), S.labels, KINDS, S.id_col,
                                 numeric=S.numeric, drop=S.not_relevant)
    return metrics


def q_e1_scored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the models cannot change: held-out rows that are scored, skipped, and in the histogram."""
    _, runs = evaluate_labels(_model_table(spark, sf), S.labels, KINDS, S.id_col, numeric=S.numeric,
                              drop=S.not_relevant)
    rows = [x for run in runs for x in (
        run.metrics.select("label_name", "model", "n_scored", "n_skipped"),
        run.histogram.agg(F.sum("count").alias("n_counted"))
        .select(F.lit(run.label).alias("label_name"), F.lit(run.kind).alias("model"), "n_counted"))]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return both.groupBy("label_name", "model").agg(*[F.max(c).alias(c) for c in ("n_scored", "n_skipped", "n_counted")])


def q_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """S1 without a schema: types and day-first times are inferred."""
    day_first = "dd/MM/yyyy HH:mm:ss"
    path = scratch_path(spark, "csv-inferred")
    write_table(tickets(spark, sf).withColumn("ts", F.date_format("ts", day_first)), path, fmt="csv", sep=";")
    log = read_event_log(spark, path, timestamp_format=day_first)
    types = {f.name: f.dataType.simpleString() for f in log.schema.fields}
    return log.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).select(
        "id", "ts", "l_linenumber", "l_quantity", "sparse", "priority",
        *[F.lit(types[c].replace("timestamp_ntz", "timestamp")).alias(f"{c}_type")
          for c in ("id", "ts", "l_quantity", "sparse", "priority")])


def q_encoded_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The encoded table written as CSV and read back with its own types."""
    path = scratch_path(spark, "encoded")
    write_table(q_encode(spark, sf), path, fmt="csv")
    return read_encoded(spark, path, fmt="csv")


def q_report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The histogram as a one-file report."""
    path = scratch_path(spark, "report")
    write_report(q_group_count_histogram(spark, sf), path)
    return read_encoded(spark, path, fmt="csv")


def q_to_double(spark: SparkSession, sf: str) -> DataFrame:
    t = tickets(spark, sf)
    types = {f.name: f.dataType for f in t.schema.fields}
    return t.select("id", "l_linenumber", *[to_double(F.col(c), types[c]).alias(f"{c}_double")
                                           for c in ("sparse", "priority", "l_quantity", "l_partkey")])


QUERIES = {
    "open_records": q_open_records,
    "distinct_entities": q_distinct_entities,
    "column_constancy": q_column_constancy,
    "column_null_ratio": q_column_null_ratio,
    "column_profile": q_column_profile,
    "column_profile_exact": q_column_profile_exact,
    "selected_inputs": q_selected_inputs,
    "consolidate_first_last": q_consolidate_first_last,
    "consolidate_by_time": q_consolidate_by_time,
    "nullify_tokens": q_nullify_tokens,
    "drop_incomplete": q_drop_incomplete,
    "first_int": q_first_int,
    "to_int": q_to_int,
    "vocabulary": q_vocabulary,
    "encode": q_encode,
    "vocabulary_large": q_vocabulary_large,
    "encode_large": q_encode_large,
    "group_count_histogram": q_group_count_histogram,
    "csv_roundtrip": q_csv_roundtrip,
    "full_flow": q_full_flow,
    "attempts_needed": q_attempts_needed,
    "attempts_histogram": q_attempts_histogram,
    "split_by_key": q_split_by_key,
    "string_index": q_string_index,
    "string_index_large": q_string_index_large,
    "naive_bayes_score": q_naive_bayes_score,
    "naive_bayes_metrics": q_naive_bayes_metrics,
    "logreg_attempts": _separable_query("logistic_regression"),
    "tree_attempts": _separable_query("decision_tree"),
    "forest_attempts": _separable_query("random_forest"),
    "mlp_attempts": _separable_query("multilayer_perceptron"),
    "naive_bayes_attempts": _attempts_query("naive_bayes"),
    "saturated_logreg_attempts": q_saturated_logreg,
    "tree_predictions": q_tree_predictions,
    "e1_logreg_attempts": _attempts_query("logistic_regression"),
    "e1_tree_attempts": _attempts_query("decision_tree"),
    "e1_forest_attempts": _attempts_query("random_forest"),
    "e1_mlp_attempts": _attempts_query("multilayer_perceptron"),
    "e1_model_metrics": q_e1_model_metrics,
    "e1_scored_counts": q_e1_scored_counts,
    "csv_inferred": q_csv_inferred,
    "encoded_roundtrip": q_encoded_roundtrip,
    "report_roundtrip": q_report_roundtrip,
    "to_double": q_to_double,
    "model_metrics": q_model_metrics,
}


# ---------------------------------------------------------------- oracles

T = f"WITH tickets AS ({TICKETS_SQL})"
PROFILED = ("status", "grp", "priority", "ostatus", "l_quantity", "l_linenumber", "l_partkey",
            "l_suppkey", "sparse")
POSITION = {c: i for i, c in enumerate(("id", "ts") + PROFILED, start=1)}
TOKEN = "'4-NOT SPECIFIED'"


def _missing_sql(c: str) -> str:
    return f"({c} IS NULL OR CAST({c} AS VARCHAR) = {TOKEN})"


def _rounded(expr: str, rnd: bool) -> str:
    return f"round({expr}, 6)" if rnd else expr


def _constancy_sql(c: str, rnd: bool = True) -> str:
    # distinct-pairs form, independent of the flag form used in Spark
    ratio = (f"CAST((SELECT count(*) FROM (SELECT id FROM (SELECT DISTINCT id, {c} FROM o) "
             f"GROUP BY id HAVING count(*) = 1)) AS DOUBLE) / (SELECT count(*) FROM (SELECT DISTINCT id FROM o))")
    return f"SELECT '{c}' AS column_name, {_rounded(ratio, rnd)} AS constancy"


def _null_ratio_sql(c: str, rnd: bool = True) -> str:
    ratio = f"CAST(count(*) FILTER (WHERE {_missing_sql(c)}) AS DOUBLE) / count(*)"
    return f"SELECT '{c}' AS column_name, {_rounded(ratio, rnd)} AS null_ratio FROM tickets"


CONSTANCY_SQL = (f"{T}, o AS (SELECT * FROM tickets WHERE status NOT IN ('F'))\n"
                 + "\nUNION ALL\n".join(_constancy_sql(c) for c in PROFILED))
NULL_RATIO_SQL = f"{T}\n" + "\nUNION ALL\n".join(_null_ratio_sql(c) for c in PROFILED)
PROFILE_SQL = (f"{T}, o AS (SELECT * FROM tickets WHERE status NOT IN ('F')),\n"
               f"k AS ({' UNION ALL '.join(_constancy_sql(c) for c in PROFILED)}),\n"
               f"m AS ({' UNION ALL '.join(_null_ratio_sql(c) for c in PROFILED)}),\n"
               f"p AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{c}{chr(39)}, {POSITION[c]})' for c in PROFILED)})"
               f" v(column_name, position))\n"
               "SELECT k.column_name, CAST(p.position AS INTEGER) AS position, k.constancy, m.null_ratio "
               "FROM k JOIN m USING (column_name) JOIN p USING (column_name)")


SELECTED_SQL = (f"{T}, o AS (SELECT * FROM tickets WHERE status NOT IN ('F')),\n"
                f"k AS ({' UNION ALL '.join(_constancy_sql(c, rnd=False) for c in PROFILED)}),\n"
                f"m AS ({' UNION ALL '.join(_null_ratio_sql(c, rnd=False) for c in PROFILED)}),\n"
                f"p AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{c}{chr(39)}, {POSITION[c]})' for c in PROFILED)})"
                f" v(column_name, position))\n"
                "SELECT k.column_name, CAST(p.position AS INTEGER) AS position,\n"
                "  CASE WHEN k.column_name IN ('grp') THEN 'label' ELSE 'input' END AS role\n"
                "FROM k JOIN m USING (column_name) JOIN p USING (column_name)\n"
                "WHERE k.column_name IN ('grp') OR (k.constancy >= 0.8 AND m.null_ratio <= 0.5)")

_ORDER = "ts NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST"
_ORDER_DESC = "ts DESC NULLS LAST, l_linenumber DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST"

CONSOLIDATE_SQL = f"""{T},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_ORDER}) AS rf,
               row_number() OVER (PARTITION BY id ORDER BY {_ORDER_DESC}) AS rl FROM tickets)
SELECT f.id, f.l_quantity, f.ostatus, f.priority, f.sparse, f.status, l.grp
FROM (SELECT * FROM r WHERE rf = 1) f JOIN (SELECT * FROM r WHERE rl = 1) l ON f.id = l.id"""

_TIES = ", ".join(f"{c} NULLS FIRST" for c in sorted(CONSOLIDATE_INPUTS))
CONSOLIDATE_BY_TIME_SQL = f"""{T},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY year(ts) NULLS FIRST, {_TIES}) AS rf,
               row_number() OVER (PARTITION BY id ORDER BY year(ts) DESC NULLS LAST, grp DESC NULLS LAST) AS rl
      FROM tickets)
SELECT f.id, f.l_quantity, f.ostatus, f.priority, f.sparse, f.status, l.grp
FROM (SELECT * FROM r WHERE rf = 1) f JOIN (SELECT * FROM r WHERE rl = 1) l ON f.id = l.id"""

ALL_TICKET_COLS = ("id", "ts", "status", "grp", "priority", "ostatus", "l_quantity", "l_linenumber",
                   "l_partkey", "l_suppkey", "sparse")


def _nullified_select() -> str:
    return ", ".join(f"CASE WHEN CAST({c} AS VARCHAR) = {TOKEN} THEN NULL ELSE {c} END AS {c}"
                     for c in ALL_TICKET_COLS)


NULLIFY_SQL = f"{T}\nSELECT {_nullified_select()} FROM tickets"
DROP_INCOMPLETE_SQL = (f"{T}, n AS (SELECT {_nullified_select()} FROM tickets)\n"
                       f"SELECT * FROM n WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ALL_TICKET_COLS)}"
                       " AND NOT isnan(l_quantity)")

FIRST_INT_SQL = ("SELECT o_orderkey, o_orderpriority, "
                 "TRY_CAST(NULLIF(regexp_extract(o_orderpriority, '[0-9]+'), '') AS INTEGER) AS priority_num "
                 "FROM orders")


def _to_int_text_sql(c: str) -> str:
    return (f"TRY_CAST(NULLIF(regexp_extract(trim(CAST({c} AS VARCHAR)), "
            f"'^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') AS INTEGER)")


TO_INT_SQL = (f"{T}\nSELECT id, l_linenumber, {_to_int_text_sql('sparse')} AS sparse_int, "
              "TRY_CAST(trunc(l_quantity) AS INTEGER) AS quantity_int, "
              f"{_to_int_text_sql('priority')} AS priority_int FROM tickets")

_VOCAB_CTE = (f"{T}, n AS (SELECT {_nullified_select()} FROM tickets),\n"
              "vals AS (SELECT DISTINCT v AS value FROM ("
              + " UNION ALL ".join(f"SELECT CAST({c} AS VARCHAR) AS v FROM n" for c in CATEGORICAL)
              + ") WHERE v IS NOT NULL),\n"
              "vocab AS (SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS code FROM vals)")
VOCAB_SQL = _VOCAB_CTE + "\nSELECT value, code FROM vocab"
ENCODE_SQL = (_VOCAB_CTE + "\nSELECT n.id, n.l_linenumber, "
              + ", ".join(f"CASE WHEN n.{c} IS NULL THEN NULL ELSE coalesce(v_{c}.code, 0) END AS {c}"
                          for c in CATEGORICAL)
              + " FROM n "
              + " ".join(f"LEFT JOIN vocab v_{c} ON CAST(n.{c} AS VARCHAR) = v_{c}.value" for c in CATEGORICAL))

_LARGE_SQL = """l AS (SELECT nullif(o_custkey % 50, 0) AS id, 'c' || o_custkey AS customer,
  nullif(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '1995-01-01') AS day, o_orderstatus AS ostatus FROM orders)"""


def _large_vocab(source: str) -> str:
    return ("v AS (SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS code FROM ("
            + " UNION ".join(f"SELECT {c} AS value FROM {source}" for c in LARGE) + ") WHERE value IS NOT NULL)")


LARGE_VOCAB_SQL = f"WITH {_LARGE_SQL}, {_large_vocab('l')}\nSELECT value, code FROM v"
LARGE_ENCODE_SQL = (f"WITH {_LARGE_SQL}, known AS (SELECT * FROM l WHERE right(customer, 1) <> '7'), {_large_vocab('known')}\n"
                    "SELECT l.id, " + ", ".join(
                        f"CASE WHEN l.{c} IS NULL THEN NULL ELSE coalesce(v_{c}.code, 0) END AS {c}" for c in LARGE)
                    + " FROM l " + " ".join(f"LEFT JOIN v v_{c} ON l.{c} = v_{c}.value" for c in LARGE))

HISTOGRAM_SQL = f"""{T}
SELECT n_cambios, count(*) AS count FROM (
  SELECT id, count(DISTINCT grp) AS n_cambios FROM tickets
  WHERE grp IS NOT NULL AND grp <> {TOKEN} GROUP BY id) g
GROUP BY n_cambios ORDER BY n_cambios"""

# Verdict of the profile at sf0.01 (FIXTURES.md): inputs ostatus, priority,
# status; label grp. priority is a mixed text/number column; the shared
# vocabulary covers ostatus, status, grp.
FULL_FLOW_SQL = f"""{T},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_ORDER}) AS rf,
               row_number() OVER (PARTITION BY id ORDER BY {_ORDER_DESC}) AS rl FROM tickets),
c AS (SELECT f.id,
             CASE WHEN f.ostatus = {TOKEN} THEN NULL ELSE f.ostatus END AS ostatus,
             TRY_CAST(NULLIF(regexp_extract(CASE WHEN f.priority = {TOKEN} THEN NULL ELSE f.priority END,
                      '[0-9]+'), '') AS INTEGER) AS priority,
             CASE WHEN f.status = {TOKEN} THEN NULL ELSE f.status END AS status,
             CASE WHEN l.grp = {TOKEN} THEN NULL ELSE l.grp END AS grp
      FROM (SELECT * FROM r WHERE rf = 1) f JOIN (SELECT * FROM r WHERE rl = 1) l ON f.id = l.id),
vals AS (SELECT DISTINCT v AS value FROM (SELECT ostatus AS v FROM c UNION ALL SELECT status FROM c
         UNION ALL SELECT grp FROM c) WHERE v IS NOT NULL),
vocab AS (SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS code FROM vals)
SELECT c.id,
       CASE WHEN c.ostatus IS NULL THEN NULL ELSE coalesce(a.code, 0) END AS ostatus,
       c.priority,
       CASE WHEN c.status IS NULL THEN NULL ELSE coalesce(b.code, 0) END AS status,
       CASE WHEN c.grp IS NULL THEN NULL ELSE coalesce(g.code, 0) END AS grp
FROM c LEFT JOIN vocab a ON c.ostatus = a.value LEFT JOIN vocab b ON c.status = b.value
       LEFT JOIN vocab g ON c.grp = g.value"""

ATTEMPTS_SQL = ("SELECT vec_id, label, CAST(1 + len(list_filter(embedding, lambda x: x > embedding[label + 1]))"
                " AS INTEGER) AS Groups_assigned FROM embeddings")
_KEY_HASH = "CAST('0x' || substr(md5(coalesce(CAST({k} AS VARCHAR), '<null>')), 1, 8) AS BIGINT)"


def _in_train(k: str, fraction: float = 0.7) -> str:
    return f"{_KEY_HASH.format(k=k)} < {fraction} * 4294967296"


def _rank_sql(c: str, src: str) -> str:
    return (f"ix_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE)"
            f" AS idx FROM {src} WHERE {c} IS NOT NULL GROUP BY {c})")


STRING_INDEX_SQL = (CONSOLIDATE_SQL.replace("\nSELECT f.id,", ",\nc AS (SELECT f.id,", 1)
                    + "),\n" + ",\n".join(_rank_sql(c, "c") for c in STRING_INDEX_COLS)
                    + "\nSELECT c.id, " + ", ".join(f"ix_{c}.idx AS indexed{c[:1].upper()}{c[1:]}"
                                                    for c in STRING_INDEX_COLS)
                    + " FROM c " + " ".join(f"JOIN ix_{c} ON c.{c} = ix_{c}.v" for c in STRING_INDEX_COLS))

STRING_INDEX_LARGE_SQL = (
    f"WITH {_LARGE_SQL}, known AS (SELECT * FROM l WHERE right(customer, 1) <> '7'),\n"
    + ",\n".join(_rank_sql(c, "known") for c in LARGE)
    + "\nSELECT l.id, " + ", ".join(f"ix_{c}.idx AS indexed{c[:1].upper()}{c[1:]}" for c in LARGE)
    + " FROM l " + " ".join(f"JOIN ix_{c} ON l.{c} = ix_{c}.v" for c in LARGE))

# Multinomial naive Bayes on one-hot inputs in closed form (smoothing 1):
#   pi_y = ln(n_y + 1) - ln(N + C);  theta_yj = ln(n_yj + 1) - ln(sum_j n_yj + F)
# with F the one-hot width (last category dropped). Prediction = best score,
# ties to the lower class; attempts = 1 + classes scoring strictly higher.
def _naive_bayes_sql(source: str, key: str) -> str:
    """Scores of the held-out part; ``source`` yields the key ``k``, two
    categorical features ``s`` and ``c`` (in feature order) and the label ``y``."""
    return f"""WITH o AS (
  SELECT k, CAST(s AS VARCHAR) AS s, CAST(c AS VARCHAR) AS c, CAST(y AS VARCHAR) AS y,
         {_in_train("k")} AS in_train FROM ({source}) src),
tr AS (SELECT * FROM o WHERE in_train), te AS (SELECT * FROM o WHERE NOT in_train),
six AS (SELECT s AS v, row_number() OVER (ORDER BY count(*) DESC, s) - 1 AS idx FROM tr GROUP BY s),
cix AS (SELECT c AS v, row_number() OVER (ORDER BY count(*) DESC, c) - 1 AS idx FROM tr GROUP BY c),
yix AS (SELECT y AS v, row_number() OVER (ORDER BY count(*) DESC, y) - 1 AS idx FROM tr GROUP BY y),
dims AS (SELECT (SELECT count(*) FROM six) AS ns, (SELECT count(*) FROM cix) AS nc,
                (SELECT count(*) FROM yix) AS ny),
feat AS (  -- one-hot position of each training row's features
  SELECT yix.idx AS y, CASE WHEN six.idx < dims.ns - 1 THEN six.idx END AS fs,
         CASE WHEN cix.idx < dims.nc - 1 THEN dims.ns - 1 + cix.idx END AS fc
  FROM tr JOIN six ON tr.s = six.v JOIN cix ON tr.c = cix.v JOIN yix ON tr.y = yix.v, dims),
ncls AS (SELECT y, count(*) AS n FROM feat GROUP BY y),
pri AS (SELECT y, ln(n + 1) - ln((SELECT sum(n) FROM ncls) + (SELECT ny FROM dims)) AS pi FROM ncls),
hits AS (SELECT y, f, count(*) AS n FROM (SELECT y, fs AS f FROM feat UNION ALL SELECT y, fc FROM feat)
         WHERE f IS NOT NULL GROUP BY y, f),
tot AS (SELECT ncls.y, coalesce(sum(hits.n), 0) AS t FROM ncls LEFT JOIN hits ON ncls.y = hits.y GROUP BY ncls.y),
-- class x feature grid (C x F rows) and row x class scores (C per test row)
grid AS (SELECT tot.y, f.f, ln(coalesce(hits.n, 0) + 1) - ln(tot.t + (SELECT ns + nc - 2 FROM dims)) AS theta
         FROM tot CROSS JOIN (SELECT range AS f FROM range((SELECT ns + nc - 2 FROM dims))) f
         LEFT JOIN hits ON hits.y = tot.y AND hits.f = f.f),
tx AS (SELECT te.k, yix.idx AS ytrue,
              CASE WHEN six.idx < dims.ns - 1 THEN six.idx END AS fs,
              CASE WHEN cix.idx < dims.nc - 1 THEN dims.ns - 1 + cix.idx END AS fc
       FROM te JOIN six ON te.s = six.v JOIN cix ON te.c = cix.v JOIN yix ON te.y = yix.v, dims),
sc AS (SELECT tx.k, tx.ytrue, pri.y,
              (coalesce(gs.theta, 0) + coalesce(gc.theta, 0)) + pri.pi AS score
       FROM tx CROSS JOIN pri
       LEFT JOIN grid gs ON gs.y = pri.y AND gs.f = tx.fs
       LEFT JOIN grid gc ON gc.y = pri.y AND gc.f = tx.fc),
best AS (SELECT k, y AS yhat FROM (
           SELECT k, y, row_number() OVER (PARTITION BY k ORDER BY score DESC, y) AS r FROM sc)
         WHERE r = 1),
own AS (SELECT k, score AS s0 FROM sc WHERE y = ytrue)
SELECT sc.k AS {key}, CAST(any_value(sc.ytrue) AS DOUBLE) AS indexedLabel,
       CAST(any_value(best.yhat) AS DOUBLE) AS prediction,
       CAST(1 + count(*) FILTER (WHERE sc.score > own.s0) AS INTEGER) AS Groups_assigned
FROM sc JOIN own USING (k) JOIN best USING (k)
GROUP BY sc.k"""


NAIVE_BAYES_SQL = _naive_bayes_sql(
    "SELECT o_orderkey AS k, o_orderstatus AS s, o_custkey % 7 AS c, o_orderpriority AS y FROM orders",
    "o_orderkey")
# The same model on the E1 output: label grp; priority is not relevant (dropped);
# ostatus and status are the categorical inputs; rows with a NULL are dropped.
TICKET_NB_SQL = _naive_bayes_sql(
    f"SELECT id AS k, ostatus AS s, status AS c, grp AS y FROM ({FULL_FLOW_SQL}) ff "
    "WHERE id IS NOT NULL AND ostatus IS NOT NULL AND status IS NOT NULL AND grp IS NOT NULL", "id")

_HELD_OUT = f"(SELECT count(*) FROM orders WHERE NOT ({_in_train('o_orderkey')}))"
SEPARABLE_SQL = f"SELECT CAST(1 AS INTEGER) AS Groups_assigned, {_HELD_OUT} AS count"
SEPARABLE_METRICS_SQL = ("SELECT label_name, model, CAST(1 AS DOUBLE) AS accuracy, " + _HELD_OUT + " AS n_scored, "
                         "CAST(0 AS BIGINT) AS n_skipped FROM (VALUES "
                         + ", ".join(f"('{x}')" for x in SEPARABLE_LABELS) + ") l(label_name), (VALUES "
                         + ", ".join(f"('{k}')" for k in SEPARABLE_KINDS) + ") m(model)")
# rank of the true class's training count within the row's cell, ties sharing the best place
SATURATED_SQL = f"""WITH o AS (SELECT o_orderstatus AS s, o_orderpriority AS y, {_in_train('o_orderkey')} AS tr FROM orders),
n AS (SELECT s, y, count(*) AS n FROM o WHERE tr GROUP BY s, y),
te AS (SELECT o.s, o.y, coalesce(n.n, 0) AS n FROM o LEFT JOIN n USING (s, y) WHERE NOT tr
       AND o.s IN (SELECT s FROM n) AND o.y IN (SELECT y FROM n))
SELECT Groups_assigned, count(*) AS count FROM (
  SELECT CAST(1 + (SELECT count(*) FROM n WHERE n.s = te.s AND n.n > te.n) AS INTEGER) AS Groups_assigned FROM te) a
GROUP BY Groups_assigned ORDER BY Groups_assigned"""
TREE_SQL = f"""WITH e AS (SELECT *, {_in_train('id')} AS tr FROM ({FULL_FLOW_SQL}) ff
           WHERE ostatus IS NOT NULL AND status IS NOT NULL AND grp IS NOT NULL),
tot AS (SELECT grp, count(*) AS total FROM e WHERE tr GROUP BY grp),
best AS (SELECT ostatus, status, grp AS predicted FROM (  -- equal counts: the label that is more frequent overall
           SELECT ostatus, status, grp, row_number() OVER (PARTITION BY ostatus, status
                  ORDER BY count(*) DESC, any_value(total) DESC, CAST(grp AS VARCHAR)) AS r
           FROM e JOIN tot USING (grp) WHERE tr GROUP BY ostatus, status, grp) WHERE r = 1)
SELECT e.id, e.grp AS label, best.predicted FROM e JOIN best USING (ostatus, status) WHERE NOT e.tr"""

# Rows with an unseen value are skipped; one-valued inputs only count where they are not one-hot encoded (Q11).
_SEEN = {c: f"{c} IN (SELECT {c} FROM tr)" for c in ("ostatus", "status", "grp")}
_SEEN_OR_CONSTANT = {c: f"({_SEEN[c]} OR (SELECT count(DISTINCT {c}) FROM tr) = 1)" for c in ("ostatus", "status")}
_SCORED_IF = {
    **dict.fromkeys(("logistic_regression", "naive_bayes"), [*_SEEN_OR_CONSTANT.values(), _SEEN["grp"]]),
    **dict.fromkeys(("decision_tree", "random_forest"), [_SEEN["grp"]]),
    "multilayer_perceptron": list(_SEEN.values())}
SCORED_COUNTS_SQL = f"""WITH e AS (SELECT *, {_in_train('id')} AS t FROM ({FULL_FLOW_SQL}) ff
           WHERE ostatus IS NOT NULL AND status IS NOT NULL AND grp IS NOT NULL),
tr AS (SELECT * FROM e WHERE t), te AS (SELECT * FROM e WHERE NOT t)
SELECT 'grp' AS label_name, model, n_scored, (SELECT count(*) FROM te) - n_scored AS n_skipped, n_scored AS n_counted
FROM (""" + " UNION ALL ".join(
    f"SELECT '{k}' AS model, (SELECT count(*) FROM te WHERE {' AND '.join(c)}) AS n_scored" for k, c in _SCORED_IF.items()) + ") m"
CSV_INFERRED_SQL = (f"{T}\nSELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, l_linenumber, l_quantity, "
                    "CAST(sparse AS INTEGER) AS sparse, priority, 'int' AS id_type, 'timestamp' AS ts_type, "
                    "'double' AS l_quantity_type, 'int' AS sparse_type, 'string' AS priority_type FROM tickets")


def _to_double_sql(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE) AS {c}_double"


TO_DOUBLE_SQL = f"{T}\nSELECT id, l_linenumber, {', '.join(_to_double_sql(c) for c in ('sparse', 'priority', 'l_quantity', 'l_partkey'))} FROM tickets"

ORACLES = {
    "logreg_attempts": SEPARABLE_SQL,
    "tree_attempts": SEPARABLE_SQL,
    "forest_attempts": SEPARABLE_SQL,
    "mlp_attempts": SEPARABLE_SQL,
    "model_metrics": SEPARABLE_METRICS_SQL,
    "saturated_logreg_attempts": SATURATED_SQL,
    "tree_predictions": TREE_SQL,
    "e1_scored_counts": SCORED_COUNTS_SQL,
    "csv_inferred": CSV_INFERRED_SQL,
    "encoded_roundtrip": ENCODE_SQL,
    "report_roundtrip": HISTOGRAM_SQL,
    "to_double": TO_DOUBLE_SQL,
    "open_records": f"{T}\nSELECT * FROM tickets WHERE status NOT IN ('F')",
    "distinct_entities": f"""{T}
SELECT count(*) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT id FROM tickets)) AS n_ids,
       (SELECT count(*) FROM (SELECT DISTINCT id FROM tickets WHERE status NOT IN ('F'))) AS n_open_ids
FROM tickets""",
    "column_constancy": CONSTANCY_SQL,
    "column_null_ratio": NULL_RATIO_SQL,
    "column_profile": PROFILE_SQL,
    "column_profile_exact": PROFILE_SQL,
    "selected_inputs": SELECTED_SQL,
    "consolidate_first_last": CONSOLIDATE_SQL,
    "consolidate_by_time": CONSOLIDATE_BY_TIME_SQL,
    "nullify_tokens": NULLIFY_SQL,
    "drop_incomplete": DROP_INCOMPLETE_SQL,
    "first_int": FIRST_INT_SQL,
    "to_int": TO_INT_SQL,
    "vocabulary": VOCAB_SQL,
    "encode": ENCODE_SQL,
    "vocabulary_large": LARGE_VOCAB_SQL,
    "encode_large": LARGE_ENCODE_SQL,
    "group_count_histogram": HISTOGRAM_SQL,
    "csv_roundtrip": f"{T}\nSELECT * FROM tickets",
    "full_flow": FULL_FLOW_SQL,
    "attempts_needed": ATTEMPTS_SQL,
    "attempts_histogram": (f"SELECT Groups_assigned, count(*) AS count FROM ({ATTEMPTS_SQL}) a "
                           "GROUP BY Groups_assigned ORDER BY Groups_assigned"),
    "split_by_key": f"""WITH o AS (SELECT o_orderkey, nullif(o_orderkey, o_orderkey // 97 * 97) AS k FROM orders)
SELECT o_orderkey, k, CASE WHEN {_in_train('k')} THEN 'train' ELSE 'test' END AS part FROM o
UNION ALL SELECT o_orderkey, k, CASE WHEN {_in_train('k', 0.95)} THEN 'train95' ELSE 'test95' END FROM o""",
    "string_index": STRING_INDEX_SQL,
    "string_index_large": STRING_INDEX_LARGE_SQL,
    "naive_bayes_score": NAIVE_BAYES_SQL,
    "naive_bayes_attempts": (f"SELECT Groups_assigned, count(*) AS count FROM ({TICKET_NB_SQL}) nb "
                             "GROUP BY Groups_assigned ORDER BY Groups_assigned"),
    "naive_bayes_metrics": f"""SELECT 'label' AS label_name, 'naive_bayes' AS model,
       round(avg(CASE WHEN prediction = indexedLabel THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6)
         AS accuracy,
       count(*) AS n_scored,
       (SELECT count(*) FROM orders WHERE NOT ({_in_train("o_orderkey")})) - count(*) AS n_skipped
FROM ({NAIVE_BAYES_SQL}) scored""",
}
