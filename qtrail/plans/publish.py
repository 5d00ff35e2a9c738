"""A build is written whole to a folder of its own and shown to
readers only then.

``write_version`` writes the rows to ``<root>/_version/<run>`` (a name that
Spark's listing passes over); its partition folders are the exact list of what
was built. Then either

* ``publish_to_table`` switches the LOCATION of each catalog partition to the
  new folder, drops the partitions that are no longer built and removes the
  old folders afterwards: a reader of the table sees a partition's old rows
  or its new ones, whole; or
* ``publish_to_folders``, for readers by path, moves the partition folders to
  ``<root>/region=r/day=d`` one by one, each old one aside first.

A job that fails before publishing leaves all old rows as they were; one that
fails within leaves each partition old or new, and running it again ends it.
What reaches the driver are folder names: regions times days (times workgroups).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from qtrail.sources import folders as FS

VERSIONS = "_version"


def new_run() -> str:
    """A name that sorts by time."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_folder(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/{VERSIONS}/{run}"


def partition_folder(root: str, keys, values) -> str:
    from urllib.parse import quote
    return "/".join([root.rstrip("/"), *(f"{k}={quote(v, safe=' -_.!~()$&+,;@|<>')}" for k, v in zip(keys, values))])


def write_version(df: DataFrame, root: str, keys, fmt: str = "parquet", run: str | None = None, **options) -> str:
    """Write ``df`` to a version folder of its own; returns the folder. The
    REBALANCE hint gathers the rows of a partition in few files of even size
    and splits a large partition over several tasks."""
    target = version_folder(root, run or new_run())
    (df.hint("rebalance", *keys).write.mode("error").options(**options).partitionBy(*keys).format(fmt).save(target))
    return target


def built_partitions(spark: SparkSession, version: str, keys) -> dict[tuple[str, ...], str]:
    """Partition values of a version (or of a root) and their folders."""
    found = FS.matching(spark, "/".join([version, *(f"{k}=*" for k in keys)]))
    return {v: path for path in found if (v := FS.partition_values(path, keys)) is not None}


# -- readers by path ---------------------------------------------------------
def publish_to_folders(spark: SparkSession, version: str, root: str, keys, stale: Iterable[tuple[str, ...]] = ()) -> None:
    """Move the partitions of ``version`` into ``root`` and remove ``stale``
    ones; then remove the version folder, the old partitions within it."""
    aside = f"{version}/_old"

    def put_aside(values) -> None:
        old = partition_folder(root, keys, values)
        if FS.exists(spark, old):
            FS.move(spark, old, partition_folder(aside, keys, values))

    for values, path in built_partitions(spark, version, keys).items():
        put_aside(values)
        FS.move(spark, path, partition_folder(root, keys, values))
    for values in stale:
        put_aside(values)
    FS.delete(spark, [version])


def remove_unpublished(spark: SparkSession, root: str) -> int:
    """Remove the versions that jobs left behind under a root read by path;
    returns how many. Not while a job writes there."""
    return FS.delete(spark, FS.matching(spark, f"{root.rstrip('/')}/{VERSIONS}/*"))


# -- readers of a catalog table ----------------------------------------------
def _spec(keys, values) -> str:
    return "PARTITION (" + ", ".join(f"{k}='{_text(v)}'" for k, v in zip(keys, values)) + ")"


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def registered(spark: SparkSession, table: str, keys) -> set[tuple[str, ...]]:
    """Partitions the catalog knows."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {v for r in rows if (v := FS.partition_values(r["partition"], keys)) is not None}


def location(spark: SparkSession, table: str, keys, values) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {table} {_spec(keys, values)}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)


def register(spark: SparkSession, table: str, keys, places: dict[tuple[str, ...], str]) -> None:
    """Point the catalog at these folders, and at no others for their partitions."""
    known = registered(spark, table, keys)
    fresh = [f"{_spec(keys, v)} LOCATION '{_text(p)}'" for v, p in sorted(places.items()) if v not in known]
    for at in range(0, len(fresh), 100):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(fresh[at:at + 100])}")
    for values in sorted(known & set(places)):
        spark.sql(f"ALTER TABLE {table} {_spec(keys, values)} SET LOCATION '{_text(places[values])}'")


def unregister(spark: SparkSession, table: str, keys, partitions) -> None:
    specs = ", ".join(_spec(keys, v) for v in sorted(partitions))
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def publish_to_table(spark: SparkSession, version: str, table: str, keys, stale: Iterable[tuple[str, ...]] = (),
                     keep_old: bool = False) -> None:
    """Switch ``table`` to the partitions of ``version`` and drop ``stale``
    ones. Old folders go last (``keep_old`` leaves them to readers that are
    still at work; ``remove_unreferenced`` takes them later)."""
    places = built_partitions(spark, version, keys)
    known = registered(spark, table, keys)
    stale = [v for v in stale if v in known]
    old = [location(spark, table, keys, v) for v in sorted((set(places) | set(stale)) & known)]
    register(spark, table, keys, places)
    unregister(spark, table, keys, stale)
    spark.sql(f"REFRESH TABLE {table}")
    if not keep_old:
        FS.delete(spark, [p for p in old if p])


def remove_unreferenced(spark: SparkSession, table: str, root: str, keys) -> int:
    """Remove version folders' partitions that no partition of ``table``
    points at; returns how many. Not while a job writes there."""
    used = {_plain(location(spark, table, keys, v)) for v in registered(spark, table, keys)}
    found = FS.matching(spark, "/".join([root.rstrip("/"), VERSIONS, "*", *(f"{k}=*" for k in keys)]))
    return FS.delete(spark, [p for p in found if _plain(p) not in used])


def _plain(path: str | None) -> str:
    """A path without the empty authority that some listings add."""
    return (path or "").replace("file:///", "file:/").rstrip("/")
