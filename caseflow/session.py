"""Session helpers: a tuned local session for tests/bench and checkpoint handling.

The library never creates its own session inside an operator; it only reads
settings from the session it is given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "caseflow") -> SparkSession:
    """A local session for tests and the bench (not used on a cluster).

    Shuffle partitions default to the core count; AQE stays on so that
    partition coalescing and skew-join splitting happen at run time.
    """
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL = ("file:", "/")
_ENDING: set[tuple[str, str]] = set()


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Make the folder, and remove it with all it holds when the application's
    JVM ends, on whatever store it is."""
    sc = spark.sparkContext
    if (sc.applicationId, path) in _ENDING:
        return
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(sc._jsc.hadoopConfiguration())
    store.mkdirs(place)
    store.deleteOnExit(place)
    _ENDING.add((sc.applicationId, path))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    A cluster names a shared folder in ``spark.checkpoint.dir`` (a mounted
    shared file system counts; the name says which folder is shared). Only on
    a local master with nothing configured (tests) is a fresh temporary folder
    set. On any other master a folder that this process made up, or one below
    the machine's temporary folder that no setting names, is an error: it does
    not survive the loss of an executor.

    The folder of an application (Spark makes a new one below the named folder)
    holds nothing that outlives it, so it goes when the application ends.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    if current:
        own = current.split(":", 1)[-1].replace("//", "/")
        if not local and not configured and current.startswith(_LOCAL) and own.startswith(tempfile.gettempdir()):
            raise RuntimeError(f"the checkpoint folder {current} is local to one machine; "
                               "name a shared folder in spark.checkpoint.dir")
        remove_at_end(spark, current)
        return current
    if configured:
        sc.setCheckpointDir(configured)
        remove_at_end(spark, sc.getCheckpointDir())
        return sc.getCheckpointDir()
    if not local:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    own = tempfile.mkdtemp(prefix="caseflow-ckpt-")
    sc.setCheckpointDir(own)
    remove_at_end(spark, own)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables; it
    goes with that folder when the application ends, or earlier by :func:`drop_path`."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("no checkpoint folder")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that :func:`scratch_path` named."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (eager, reliable).

    Used where later steps depend on the physical layout of ``df`` (partition
    ids, in-partition order), which must not change if a lost executor forces
    a recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
