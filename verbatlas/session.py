"""Session helpers: the shared scratch folder and the size limits for broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table (bytes of float64 cells) that may be sent to every task at once.
# Anything above it is worked off in blocks of this size, with the same result.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "verbatlas", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    It is the one named in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one machine, may fall back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by the whole cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verbatlas-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables of the block when it ends.

    Whatever is built on them must have been written by then, as in
    ``with scratch_scope(spark): build_index(...).save(path)``.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each job of the block when it ends, instead of when the driver collects its garbage."""
    with conf(spark, SHUFFLE_CLEANUP_KEY, "true"):
        yield


@contextmanager
def conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set ``key`` for the jobs of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def broadcast_if_small(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Hint a broadcast only if the counted rows fit the limit; ``df`` should be cheap to count.

    Without the hint the join is left to Spark, which shuffles both sides if it must.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_LIMIT_BYTES else df


def spread(scan: DataFrame) -> DataFrame:
    """Give a small table to all cores before work that is dear per row.

    ``scan`` is a plain read. One with as many input splits as the session has cores
    stays as it is, so a large table is never shuffled for this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    The copy cuts the lineage, survives lost executors, and later reads of it can
    prune columns and push filters, which a checkpointed RDD cannot.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialised(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like ``materialise``, for a table that only the jobs of the block read; it is deleted when the block ends."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        _delete(df.sparkSession, path)
