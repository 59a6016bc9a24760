"""Session settings and lineage cutting shared by the jobs."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. A cluster session may set its own; none of
# the operators reads them, they only steer how Spark executes the plans.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot model, category or code is split at run time, also when the split
    # costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _private_folder(application: str) -> str:
    """A folder of this process, for sessions on one machine; it goes with the process."""
    folder = os.path.join(tempfile.gettempdir(), f"skuweave-{application}-{os.getpid()}")
    os.makedirs(folder, mode=0o700)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, from ``spark.checkpoint.dir`` or the context.

    Where neither names one, a session on one machine gets a private folder; on
    several machines that would lose rows, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    return _private_folder(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark).rstrip('/')}/skuweave-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from its files.

    What follows survives the loss of executors without recomputing ``df``, reads
    only the columns it needs, and Spark knows the real size when it plans joins.
    The files stay until the folder is cleared, as with checkpoints. ``options`` are
    the writer's; readers hold a file's rows together, so large rows ask for few in each.
    """
    path = new_folder(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Partition by key into the session's number of shuffle partitions.

    For small rows that each expand into much work: a fixed number keeps Spark from
    merging the partitions by their size.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(partitions, spark.sparkContext.defaultParallelism), key)


def together(*steps: Callable[[], object]) -> list:
    """Run steps that each start a Spark job side by side; the cluster shares them out."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [running.result() for running in [pool.submit(step) for step in steps]]
