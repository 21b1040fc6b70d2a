"""Small file-system helpers over the Hadoop FileSystem of the session.

Works for any path scheme the cluster supports (file:, hdfs:, s3a:, ...).
Only metadata (directory names, marker files) passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` ([] when it does not exist)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, True))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwrites)."""
    fs, p = _fs_and_path(spark, path)
    fs.create(p, True).close()


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst`` (atomic for directories on HDFS and local disks).

    An existing ``dst`` is an error: Hadoop would move ``src`` inside it.
    """
    fs, s = _fs_and_path(spark, src)
    _, d = _fs_and_path(spark, dst)
    if fs.exists(d):
        raise FileExistsError(f"{dst} exists; {src} was left in place")
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"could not rename {src} to {dst}")


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, relative to the pattern's literal prefix (one listing call)."""
    fs, p = _fs_and_path(spark, pattern)
    found = fs.globStatus(p)
    return sorted(str(st.getPath().toString()) for st in found) if found is not None else []


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)
