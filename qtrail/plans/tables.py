"""The catalog side (S9-S13, S17, U2): the four tables, made or made anew from
one configuration, checked by planning a query on them, and told of the
partitions there are. Catalog statements are plain Spark SQL; partition names
come from folder or catalog names, so no data file is opened."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.functions.calendar import day_back
from qtrail.plans import publish as PUB
from qtrail.schemas import EVENT_PARTITIONS, EVENTS, HISTORY, HISTORY_PARTITIONS, STAGING
from qtrail.sources import folders as FS
from qtrail.sources import trail as TRAIL

KINDS = ("cloud_trail", "history", "events_staging", "events")
TRAIL_PARTITIONS = ("region", "year", "month", "day")


@dataclass(frozen=True)
class TableSet:
    """Database, base folder, and for each kind of table its name (default:
    the kind) and folder (default: the kind, under the base folder)."""
    db: str = "default"
    root: str = ""
    names: dict[str, str] = field(default_factory=dict)
    folders: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if unknown := (set(self.names) | set(self.folders)) - set(KINDS):
            raise ValueError(f"unknown tables {sorted(unknown)}; there are {KINDS}")

    def name(self, kind: str) -> str:
        return f"`{self.db}`.`{self.names.get(kind, kind)}`"

    def folder(self, kind: str) -> str:
        place = self.folders.get(kind, kind)
        return place.rstrip("/") if "/" in place else f"{self.root.rstrip('/')}/{place}"

    @property
    def trail_files(self) -> str:
        """The files behind ``cloud_trail``, which is a view of their records."""
        return f"`{self.db}`.`{self.names.get('cloud_trail', 'cloud_trail')}_files`"


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# -- tables ------------------------------------------------------------------
def create_table(spark: SparkSession, tables: TableSet, kind: str) -> None:
    """Create one table anew over its folder; the data stays."""
    name, place = tables.name(kind), tables.folder(kind)
    if kind == "cloud_trail":
        files = tables.trail_files
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {files}")
        parts = ", ".join(f"`{p}` string" for p in TRAIL_PARTITIONS)
        keys = ", ".join(TRAIL_PARTITIONS)
        spark.sql(f"CREATE TABLE {files} (value string, {parts}) USING text OPTIONS (wholetext 'true') "
                  f"PARTITIONED BY ({keys}) LOCATION '{place}'")
        spark.sql(f"CREATE VIEW {name} AS SELECT r.*, {keys} FROM (SELECT explode({TRAIL.RECORDS_SQL}) AS r, {keys} FROM ("
                  f"SELECT explode({TRAIL.USED_SQL}) AS text, {keys} FROM ("
                  f"SELECT *, {TRAIL.PARTS_SQL} AS parts FROM {files})))")
        return
    schema, fmt, keys = {"history": (HISTORY, "json", HISTORY_PARTITIONS), "events": (EVENTS, "parquet", EVENT_PARTITIONS),
                         "events_staging": (STAGING, "parquet", EVENT_PARTITIONS)}[kind]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING {fmt} PARTITIONED BY ({', '.join(keys)}) LOCATION '{place}'")


def init_tables(spark: SparkSession, tables: TableSet, regions: Iterable[str] = (), days_back: int = 14,
                force: bool = False) -> bool:
    """Make the database and all four tables if any cannot be planned, or
    in any case when ``force``d; then register the history, and the events of
    the last ``days_back`` days of ``regions`` (all days there are if no
    region is given). Returns True when tables were made."""
    if not force and tables_exist(spark, [tables.name(k) for k in KINDS]):
        return False
    place = f" LOCATION '{tables.root}'" if tables.root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{tables.db}`{place}")
    for kind in KINDS:
        create_table(spark, tables, kind)
    repair_history(spark, tables)
    repair_events(spark, tables, days_back, regions)
    return True


def tables_exist(spark: SparkSession, names: Iterable[str]) -> bool:
    """True only if one query over all tables can be planned."""
    query = " UNION ALL ".join(f"(SELECT 1 FROM {n} LIMIT 1)" for n in names)
    return not query or _planned(spark, query)


def _planned(spark: SparkSession, query: str) -> bool:
    text = spark.sql(f"EXPLAIN {query}").first()[0]
    return "Physical Plan" in text and "Error occurred during query planning" not in text


def tables_report(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """``table, planned, location, folder_exists`` of each table, from the
    catalog and folder names alone. A view has no location."""
    rows = []
    for n in names:
        planned = _planned(spark, f"SELECT 1 FROM {n} LIMIT 1")
        place = None
        if planned:
            described = spark.sql(f"DESCRIBE FORMATTED {n}").collect()
            place = next((r["data_type"] for r in described if r["col_name"] == "Location"), None)
        rows.append((n, planned, place or None, FS.exists(spark, place) if place else None))
    return spark.createDataFrame(rows, "table string, planned boolean, location string, folder_exists boolean")


# -- partitions --------------------------------------------------------------
def repair_history(spark: SparkSession, tables: TableSet) -> None:
    """Register every history partition there is, drop those gone."""
    if FS.exists(spark, tables.folder("history")):
        spark.sql(f"MSCK REPAIR TABLE {tables.name('history')} SYNC PARTITIONS")


def event_places(spark: SparkSession, root: str) -> dict[tuple[str, ...], str]:
    """Folder of each (region, day) of the events: of the newest version that
    was written whole, else the plain partition folder."""
    out = PUB.built_partitions(spark, root, EVENT_PARTITIONS)
    for done in FS.matching(spark, f"{root}/{PUB.VERSIONS}/*/_SUCCESS"):  # names sort by time
        out |= PUB.built_partitions(spark, done.removesuffix("/_SUCCESS"), EVENT_PARTITIONS)
    return out


def repair_events(spark: SparkSession, tables: TableSet, days_back: int | None = None,
                  regions: Iterable[str] = (), as_of: date | None = None) -> int:
    """Register the events of the ``days_back`` days before ``as_of``
    (default today) of ``regions``; None or no region: of all there are.
    Returns how many."""
    wanted, days = set(regions), days_back and {day_back(i, as_of) for i in range(1, days_back + 1)}
    places = {v: p for v, p in event_places(spark, tables.folder("events")).items()
              if not wanted or (v[0] in wanted and (not days or v[1] in days))}
    PUB.register(spark, tables.name("events"), EVENT_PARTITIONS, places)
    return len(places)


def add_trail_partitions(spark: SparkSession, tables: TableSet, days: Iterable[str], regions: Iterable[str]) -> int:
    """Register the delivery folders ``<root>/<region>/YYYY/MM/DD`` of
    these days and regions that exist, each by its explicit location, without
    listing the trail. Returns how many."""
    root, places = tables.folder("cloud_trail"), {}
    for r in regions:
        for d in days:
            path = f"{root}/{r}/{d[:4]}/{d[5:7]}/{d[8:10]}"
            if FS.exists(spark, path):
                places[(r, d[:4], d[5:7], d[8:10])] = path
    PUB.register(spark, tables.trail_files, TRAIL_PARTITIONS, places)
    return len(places)


def drop_partitions(spark: SparkSession, table: str, pairs) -> None:
    """S8 for a catalog table: drop (region, day) partitions (the registration
    alone: the tables are external)."""
    PUB.unregister(spark, table, EVENT_PARTITIONS, pairs)


def delete_partition_dirs(spark: SparkSession, root: str, pairs) -> int:
    """S8 for a table by path: exactly the ``region=r/day=d`` folders."""
    return FS.delete(spark, [PUB.partition_folder(root, EVENT_PARTITIONS, p) for p in pairs])


# -- newest day --------------------------------------------------------------
_DAY = re.compile(r"/day=(\d{4}-\d{2}-\d{2})$")


def latest_partition(spark: SparkSession, root: str) -> str | None:
    """The largest ``day=`` among the folder names right under ``root``,
    or, if there is none, one level below."""
    for pattern in ("day=*", "*/day=*"):
        days = [m.group(1) for p in FS.matching(spark, f"{root.rstrip('/')}/{pattern}") if (m := _DAY.search(p))]
        if days:
            return max(days)
    return None


def latest_registered(spark: SparkSession, table: str) -> DataFrame:
    """S17 for a catalog table: ``latest_day`` from its partition names."""
    return spark.sql(f"SHOW PARTITIONS {table}").agg(
        F.max(F.nullif(F.regexp_extract("partition", r"(?:^|/)day=(\d{4}-\d{2}-\d{2})(?:/|$)", 1), F.lit(""))).alias("latest_day"))
