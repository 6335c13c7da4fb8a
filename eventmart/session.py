"""Session helpers: the settings the library relies on, and where checkpoints go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# State outside the heap; a commit uploads the changes of its batch, not whole snapshots.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Batches handed to Python are bounded in bytes as well as in rows: texts may be long.
ARROW = {"spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024)}


def build_session(master: str | None = None, app_name: str = "eventmart", **conf) -> SparkSession:
    """A session with the settings below; keyword options override, `.` written as `__`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE_STORE,
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: epoch arithmetic on wall-clock times assumes a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in {**STATE_STORE, **ARROW}.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and written tables, removed when the application ends.

    Lies under `spark.checkpoint.dir`, the folder all machines of the cluster share. Where that is unset,
    one machine alone, as in local tests, takes a temporary folder of its own; a cluster cannot.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="run-")
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return folder


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table written to the shared folder: computed once, safe from lost executors.

    For results that are small next to their inputs and are used more than once.
    """
    path = f"{shared_folder(frame.sparkSession, name)}/data"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Start a streaming query with a state layout fit for where it runs.

    The number of shuffle partitions is fixed with a query's first batch, and each costs a commit per
    batch. On a cluster the session's setting holds; on one machine there are no more than cores.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(key, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
