"""One way to run a numpy function over the texts of a DataFrame.

``map_texts`` hands whole texts to ``fn`` in slices of about a megabyte and
returns the kept input columns with the computed ones. Input columns that are
not kept are left out, and a computed column replaces a kept one of its name,
so extra columns with clashing names do no harm. An empty table gives an empty
result with the same columns.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..session import scratch_path
from .flat import CHUNK_BYTES, chunks

TEXT = "__text"


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df``, written once as a table in the shared folder and read again, so a
    lost executor does not repeat what made it. Unlike a checkpoint it is computed
    once, not twice, and later steps read only the columns they use; unlike one, it
    keeps neither partitions nor order."""
    path = path or scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the tasks this package, once per application: a driver that found
    it through its own path says nothing of the executors' path."""
    context = spark.sparkContext
    if getattr(context, "_caseflow_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="caseflow-"), "caseflow_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._caseflow_shipped = True


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's defaults, which are made for short
    rows: a task holds a few megabytes of text at once, not 64. A setting that
    somebody changed stays as it is."""
    for key, default, ours in (("maxRecordsPerBatch", "10000", "500"), ("maxBytesPerBatch", "67108864b", "2m")):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, None) == default:
            spark.conf.set(key, ours)


def map_texts(df: DataFrame, text: str, keep: Sequence[str], fields: str,
              fn: Callable[[pa.RecordBatch, pa.Array], dict | None], chunk_bytes: int = CHUNK_BYTES,
              aside: Sequence[str] = ()) -> DataFrame:
    """``fn(rows, texts)`` returns a dict of columns as long as ``rows``, or with
    the key ``None`` -> row indices, which repeat or leave out kept columns.
    Columns named in ``aside`` are there for ``fn`` and go no further."""
    added = schema_of(fields)
    kept = [c for c in keep if c not in added.names]
    source = df.select(*[F.col(quoted(c)) for c in dict.fromkeys([*kept, *aside])], F.col(quoted(text)).cast("string").alias(TEXT))
    out = StructType([StructField(c, source.schema[c].dataType, True) for c in kept] + list(added.fields))
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            for rows in chunks(batch, TEXT, chunk_bytes):
                got = fn(rows, rows.column(rows.schema.get_field_index(TEXT)))
                if got is None:
                    continue
                at = got.pop(None, None)
                columns = [rows.column(rows.schema.get_field_index(c)).cast(arrow.field(c).type) for c in kept]
                if at is not None:  # only what goes on is repeated, never the text
                    columns = [c.take(pa.array(at)) for c in columns]
                columns += [v if isinstance(v, pa.Array) and v.type == arrow.field(c).type
                            else v.cast(arrow.field(c).type) if isinstance(v, pa.Array)
                            else pa.array(v, arrow.field(c).type) for c, v in ((f.name, got[f.name]) for f in added)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    ship(df.sparkSession)
    bound_batches(df.sparkSession)
    return source.mapInArrow(run, out)


def lists(values: pa.Array, offsets) -> pa.Array:
    """A list column from flat values and offsets (one more than rows)."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
