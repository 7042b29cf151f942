"""Tables in the folder that all executors share: lineage is cut there, and what follows survives lost executors."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache
def _own_dir(_application: str) -> str:
    return f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = file_system(spark, path)
    return system.exists(target)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; nothing happens where there is none."""
    system, target = file_system(spark, path)
    system.delete(target, True)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of this machine for a local master, and an error for a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    return (found or _own_dir(spark.sparkContext.applicationId)).rstrip("/")


_made: set[str] = set()


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder. Results read such tables lazily, so they are deleted when the application ends."""
    base = f"{shared_dir(spark)}/corpusloom/{spark.sparkContext.applicationId}"
    if base not in _made:
        system, target = file_system(spark, base)
        system.mkdirs(target)
        system.deleteOnExit(target)
        _made.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, read as often as needed."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
