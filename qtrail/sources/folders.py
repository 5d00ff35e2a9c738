"""Folders of any file system Spark reads, by Hadoop's own interface: names
and moves only, no file is opened."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str):
    """``(path, its file system)``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = folder(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    p, fs = folder(spark, pattern)
    return sorted(f.getPath().toString() for f in fs.globStatus(p) or [])


def delete(spark: SparkSession, paths) -> int:
    """Deletes exactly these folders (no prefix matching); returns how many there were."""
    removed = 0
    for path in paths:
        p, fs = folder(spark, path)
        removed += bool(fs.exists(p) and fs.delete(p, True))
    return removed


def move(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder to a path that does not exist yet."""
    p, fs = folder(spark, source)
    q, _ = folder(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")


def partition_values(path: str, keys) -> tuple[str, ...] | None:
    """Values of ``keys`` in a path of ``key=value`` folders, unescaped."""
    from urllib.parse import unquote
    found = dict(re.findall(r"([^/=]+)=([^/]*)", path))
    return tuple(unquote(found[k]) for k in keys) if all(k in found for k in keys) else None
