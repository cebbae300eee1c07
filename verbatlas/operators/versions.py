"""Tables in folders per part that are changed by writing new folders beside the old ones.

A change writes ``<table>/table_version=<n>/<part>=<value>/`` for the parts it touches, and last a small file that names
the parts it removes and, where given, the batch it belongs to. A version without that file does not exist for
a reader, so a job or a driver that dies at any point leaves the table as it was, and the same change can
simply be made again. Of each part the latest version counts. Old folders stay until `vacuum` deletes them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_DONE = "_done"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders in ``path`` that start with ``prefix``."""
    _, files, folder = _files(spark, path)
    if not files.exists(folder):
        return []
    return [name for s in files.listStatus(folder) if s.isDirectory() and (name := s.getPath().getName()).startswith(prefix)]


def versions(spark: SparkSession, path: str) -> dict[int, dict]:
    """What each finished version of a table says about itself."""
    out = {}
    for name in _folders(spark, path, "table_version="):
        jvm, files, done = _files(spark, f"{path}/{name}/{_DONE}")
        if files.exists(done):
            stream = files.open(done)
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            out[int(name.split("=")[1])] = json.loads(text)
    return out


def batches(spark: SparkSession, path: str) -> set[str]:
    """The batches that have been written to a table."""
    return {v["batch"] for v in versions(spark, path).values() if v.get("batch") is not None}


def write_version(
    df: DataFrame,
    path: str,
    part: str,
    sort: Sequence[str],
    *,
    gone: Sequence = (),
    replace: bool = False,
    batch: str | None = None,
    in_order: bool = False,
) -> int:
    """Write the parts that occur in ``df`` as a new version, sorted by part and ``sort``.

    ``gone`` names parts that have lost their last row; ``replace`` says that only the parts written now
    remain. ``in_order`` says that the rows are range-partitioned that way already. The number of the
    version is returned.
    """
    spark = df.sparkSession
    # An unfinished version is overwritten by the next one, which gets its number.
    number = max(versions(spark, path), default=-1) + 1
    ordered = df if in_order else df.repartitionByRange(part, *sort)
    ordered = ordered.sortWithinPartitions(part, *sort)
    # Nothing counts before the small file below, so tasks may move their files to the folders themselves; by the
    # first algorithm the driver would move those of all parts, one after the other.
    writer = ordered.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.partitionBy(part).parquet(f"{path}/table_version={number}")
    jvm, files, done = _files(spark, f"{path}/table_version={number}/{_DONE}")
    text = json.dumps({"gone": [str(g) for g in gone], "replace": replace, "batch": batch})
    stream = files.create(done, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return number


def _live(spark: SparkSession, path: str, part: str) -> dict[str, str]:
    """The folder that counts for each part."""
    live: dict[str, str] = {}
    for number, about in sorted(versions(spark, path).items()):
        if about["replace"]:
            live = {}
        for name in _folders(spark, f"{path}/table_version={number}", f"{part}="):
            live[name] = f"{path}/table_version={number}/{name}"
        for value in about["gone"]:
            live.pop(f"{part}={value}", None)
    return live


def read_latest(spark: SparkSession, path: str, part: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The table as it stands; ``schema`` includes the column of the part and is needed for a table without rows."""
    folders = sorted(_live(spark, path, part).values())
    if not folders:
        if schema is None:
            raise FileNotFoundError(f"no rows and no schema at {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", path).parquet(*folders).drop("table_version")


def vacuum(spark: SparkSession, path: str, part: str) -> int:
    """Delete the folders that no longer count, but none that a running write may need; how many."""
    live, count = set(_live(spark, path, part).values()), 0
    for number in versions(spark, path):
        for name in _folders(spark, f"{path}/table_version={number}", f"{part}="):
            if f"{path}/table_version={number}/{name}" not in live:
                _, files, folder = _files(spark, f"{path}/table_version={number}/{name}")
                count += bool(files.delete(folder, True))
    return count
