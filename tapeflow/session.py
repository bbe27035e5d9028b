"""Session set-up and durable intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str, master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the operators rely on.

    The shuffle partition count is left to the caller or the cluster: adaptive execution
    merges small partitions in batch jobs, and a streaming query keeps the number of its
    first start.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        # Window tables written with nanosecond times are read as numbers and converted.
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or the checkpoint
    directory already set on the context. Only a session without executors of its own may fall back to a
    temporary folder."""
    context = spark.sparkContext
    known = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if known is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        known = tempfile.mkdtemp(prefix="tapeflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(known)
    return known


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def durable(df: DataFrame, temporary: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. ``temporary=False`` keeps it beyond :func:`temporary_tables`.

    Cuts the lineage in a way that survives lost executors, fixes values such as partition
    numbers, and gives later joins the true size of the table. Being parquet, later reads
    still prune columns and push filters.
    """
    spark = df.sparkSession
    path = f"{durable_dir(spark).rstrip('/')}/tapeflow/{uuid.uuid4().hex}"
    if temporary and (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that :func:`durable` writes inside the block when it ends, for jobs that
    run again and again. Results must be written before that."""
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            files, target = _files(spark, path)
            files.delete(target, True)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of a folder; none where there is no folder."""
    files, target = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file."""
    files, target = _files(spark, path)
    files.create(target, True).close()


def delete_siblings(spark: SparkSession, path: str, but: tuple[str, ...] = ()) -> None:
    """Delete the other folders of a partition column, ``.../name=1`` and so on for a path ``.../name=2``, but those
    with the given names."""
    files, target = _files(spark, path)
    prefix = target.getName().partition("=")[0] + "="
    for status in files.listStatus(target.getParent()):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix) and name not in (target.getName(), *but):
            files.delete(status.getPath(), True)
