"""Readers and writers for event logs, encoded tables and reports.

Parquet is the default format; the ``;``-separated header CSV of the original
ticket log stays supported. At scale, pass ``schema=``: schema inference is an
extra full pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_event_log(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";",
                   schema: StructType | str | None = None, header: bool = True,
                   timestamp_format: str | None = None) -> DataFrame:
    """Read the raw event log (header CSV with ``;`` by default, or parquet).

    ``timestamp_format`` (a Spark pattern such as ``dd/MM/yyyy HH:mm``) says how
    times and dates are written; without it only ISO forms are recognised, and
    any other time stays text, which :func:`prepare_model_table` refuses as an
    order. With ``schema`` there is no inference pass over the log.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt != "parquet":
        reader = reader.option("header", header).option("sep", sep)
        if schema is None:
            reader = reader.option("inferSchema", True)
        if timestamp_format:
            reader = reader.option("timestampFormat", timestamp_format)
            if not set(timestamp_format) & set("HhKkmsS"):  # with a time of day, a column read as dates would lose it
                reader = reader.option("dateFormat", timestamp_format)
    return reader.format(fmt).load(path)


def read_encoded(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: StructType | str | None = None) -> DataFrame:
    """Read a model-ready table written by :func:`write_table`."""
    if fmt == "csv":
        return read_event_log(spark, path, fmt="csv", sep=",", schema=schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                sep: str = ",") -> None:
    """S3: write a table in parallel (one file per partition).

    The default mode refuses to overwrite an existing path, as the original
    application did; NULL becomes an empty CSV field.
    """
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("sep", sep)
    writer.save(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write a small, already aggregated report as a single file.

    Only for results whose size is bounded by construction (histograms with
    one row per count value); large tables go through :func:`write_table`.
    """
    writer = df.coalesce(1).write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
