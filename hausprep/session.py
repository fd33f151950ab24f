"""Session construction and the shared scratch location.

Library code never creates its own session; callers pass one in.  The
helpers here are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "hausprep",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session tuned for the operators in this package.

    AQE stays on so shuffle partitions coalesce at runtime and skewed
    sort-merge joins are split; the UI is off (no server is opened).
    """
    master = master or os.environ.get("HAUSPREP_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HAUSPREP_DRIVER_MEMORY", "4g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_parquet_with(spark: SparkSession, path: str, settings: dict[str, str]) -> DataFrame:
    """A Parquet table, for a job with settings of its own; the others are the session's.

    The session keeps its settings, by which other threads may be reading files, and no second Python session is made,
    which would take over ``RDD.toDF``."""
    beside = spark._jsparkSession.newSession()
    for key, value in (spark.conf.getAll | settings).items():
        if beside.conf().isModifiable(key) or not key.startswith("spark."):
            beside.conf().set(key, value)
    return DataFrame(beside.read().parquet(path), spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session.  When nothing is configured, a local master
    (tests) gets a fresh temporary folder; any other master raises, as a
    machine-local folder would scatter the data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="hausprep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Paths handed out within the innermost scope of this thread's context.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end, also after a failure, what is written to the checkpoint folder within.

    For a whole job that leaves its result elsewhere: a frame that still reads a materialised table must be
    used or written before the end.  A scope within another one deletes only what it wrote itself."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get() or []
        _SCOPE.reset(token)
        jvm = spark.sparkContext._jvm
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize_observed(df: DataFrame, metrics: list, name: str = "stage"):
    """:func:`materialize` that also computes aggregate ``metrics`` while
    writing (``DataFrame.observe``): no extra pass over the data.  Returns
    ``(frame, metrics row)``.  Observed metrics merge each partition's
    successful attempt once, so retries do not double-count."""
    from pyspark.sql import Observation

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}_metrics")
    df.observe(obs, *metrics).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), obs.get


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing the frame as a Parquet table in the shared
    checkpoint folder and reading it back.

    Used where a frame is read by more than one job (for example the
    deduplicated listings feed the column fingerprint, the vocabulary and
    the final projection).  Compared with ``DataFrame.checkpoint`` the input
    is computed once (a reliable RDD checkpoint recomputes it to write the
    files), and later jobs get column pruning and filter pushdown.  The
    files live in the cluster's shared folder, so they survive executor
    loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
