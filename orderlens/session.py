"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# AQE sizes the shuffles and splits skewed join partitions at run time. Forcing the skew
# split accepts one extra shuffle where a hot key would otherwise sit in a single task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# Shuffles begin with so many times the session's partitions, and AQE merges the small ones: a task's share, and with it
# the memory of its sorts and aggregates, stays near the advisory size when the input grows.
FINER_SHUFFLES = 10
# For tables dealt out by a key. Every task that writes such a table makes a file in each bucket.
BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 256


def build_session(app_name: str = "orderlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if not spark.conf.get(INITIAL_PARTITIONS, None):
        spark.conf.set(INITIAL_PARTITIONS, FINER_SHUFFLES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """SQL settings for the block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_removed(spark: SparkSession):
    """Shuffle files of what is written in the block go once it is written, not when the driver collects its garbage.

    For writes, which plan anew: a DataFrame collected twice would have to run its stages again.
    """
    return settings(spark, {SHUFFLE_CLEANUP: "true"})


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only for a local session that names none."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="orderlens-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)
_named: dict[str, list[str]] = {}  # names of tables dealt out by a key, by folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the current workspace, or else the shared folder."""
    folder = _workspace.get() or shared_dir(spark).rstrip("/")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for everything that the block stores or checkpoints, removed at the block's end.

    DataFrames made inside read these tables, so use or write them before the block ends. Without a workspace stored
    tables stay below the shared folder.
    """
    base, context = shared_dir(spark).rstrip("/"), spark.sparkContext
    folder = f"{base}/workspace-{uuid.uuid4().hex}"
    token = _workspace.set(folder)
    context.setCheckpointDir(f"{folder}/checkpoints")
    try:
        yield folder
    finally:
        _workspace.reset(token)
        for table in _named.pop(folder, []):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(path(folder), True)
        if _workspace.get():
            context.setCheckpointDir(f"{_workspace.get()}/checkpoints")
            return
        context.setCheckpointDir(base)
        made = path(context.getCheckpointDir())  # an empty folder that Spark makes at once
        if made.getParent() and not files.listStatus(made):
            files.delete(made, False)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table, written when called, for plans that read it several times."""
    return stored_at(df, shared_path(df.sparkSession, name))


def finished(spark: SparkSession, name: str, make: Callable[[], DataFrame], key: str | None = None) -> DataFrame:
    """What ``make`` returns as a table, written when called; tables stored on the way to it are removed.

    With ``key``, a column or a struct of columns, the files are dealt out by its hash: what groups, numbers or joins the
    rows by it reads them without a shuffle. Columns in files take a fraction of the space that shuffled rows do. There
    is a bucket for every ``BUCKET_BYTES`` that are read, at most ``MOST_BUCKETS``. The table's name goes with the workspace.
    """
    path = shared_path(spark, name)
    with workspace(spark):
        made = make()
        return _dealt(made, path, key) if key else stored_at(made, path)


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``stored`` under a path that a workspace of less life does not remove."""
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _dealt(df: DataFrame, path: str, key: str) -> DataFrame:
    spark = df.sparkSession
    buckets = min(MOST_BUCKETS, max(spark.sparkContext.defaultParallelism, 1 + _bytes_read(df) // BUCKET_BYTES))
    folder, name = path.rsplit("/", 1)
    table = name.replace("-", "_")
    kind = df.schema[key].dataType
    parts = kind.names if isinstance(kind, StructType) else []  # the struct keeps them
    # A writer for each bucket, so that rows are not sorted by bucket, which would spill.
    with shuffles_removed(spark), settings(spark, {OPEN_WRITERS: str(buckets + 1)}):
        df.drop(*parts).write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    _named.setdefault(folder, []).append(table)
    return spark.table(table).select(*[F.col(f"{key}.{c}") if c in parts else F.col(c) for c in df.columns])


def _bytes_read(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads."""
    spark = df.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)) for file in df.inputFiles()]
    return sum(path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen() for path in paths)
