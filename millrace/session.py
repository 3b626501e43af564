"""Session helpers: a tuned local session and the shared folder for staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes per core from which on Spark reads a table of several files by all cores.
READ_ALONE = 4 << 20

_local_dirs: dict[str, str] = {}


def local_session(cores: int = 8, app: str = "millrace") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        # small tables in several files, so that all cores take part in reading them
        .config("spark.sql.files.maxRecordsPerFile", "75000")
        # call sites of every column expression are costly to record and not used here
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master gets a temporary folder when the setting is absent: on a
    cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = sc.applicationId
    if app_id not in _local_dirs:
        _local_dirs[app_id] = tempfile.mkdtemp(prefix="millrace-")
    return _local_dirs[app_id]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return "/".join(
        [shared_dir(spark).rstrip("/"), spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}"]
    )


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and unlike a checkpoint keeps
    column pruning, filter pushdown and size statistics for the readers.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores: a table of few bytes is read by few tasks, however much
    work its rows are. A larger table in several files is read by all cores as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * READ_ALONE and len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
