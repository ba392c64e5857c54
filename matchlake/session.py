"""What the library needs from the Spark session it is given."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that the cluster shares among executors.

    The folder is the one named in ``spark.checkpoint.dir``.  Only a local
    session, where driver and executors are one process, may go without it.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="matchlake-")
    return f"{base.rstrip('/')}/matchlake/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run in here delete their shuffle files as soon as their query ends."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, wherever it is."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path, or at least one match of a glob, exists."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return [status.getPath().toString() for status in found or []]


def any_file(spark: SparkSession, folder: str, pattern: str) -> bool:
    """True if a file below the folder has a name that matches the glob pattern."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    wanted = jvm.org.apache.hadoop.fs.GlobFilter(pattern)
    files = fs.listFiles(root, True)
    while files.hasNext():
        if wanted.accept(files.next().getPath()):
            return True
    return False
