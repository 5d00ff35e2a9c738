"""Build the enriched, classified events for a day range in ONE job.

sources -> enrich (pass 1 + pass 2 from one full outer join) -> staging, written
once with the tables its texts name (S7) -> tiers of the tables named -> write-back -> a version folder of its own, published whole (``plans/publish.py``) as exactly
the (region, day) partitions built. All regions and days run together; the
driver handles only names of (region, day) partitions, of which those of the
range that turned out empty are taken away, so a re-run leaves exactly what
the inputs say.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qtrail.config import BACKFILL_DAYS_ON_RECREATE, AuditConfig
from qtrail.functions.calendar import day_back, days_between, yesterday
from qtrail.operators import classify as CL
from qtrail.operators import enrich as EN
from qtrail.operators import reports as R
from qtrail.plans import publish as PUB
from qtrail.schemas import EVENT_COLUMNS, EVENT_PARTITIONS, STAGING
from qtrail.session import scratch_path
from qtrail.sources import folders as FS
from qtrail.sources.events import read_events


@dataclass(frozen=True)
class EventsRun:
    from_day: str
    to_day: str
    events: int
    classified: int


def staged(staging: DataFrame, folder: str | None = None) -> DataFrame:
    """The enriched rows, written once (default: under the checkpoint
    folder) and read back, for classification reads them three times. A column
    ``_named`` (``classify.named_tables``) is kept beside them."""
    spark = staging.sparkSession
    folder = folder or scratch_path(spark, "staging")
    staging.write.mode("error").parquet(folder)
    named = [f for f in staging.schema.fields if f.name == "_named"]
    return spark.read.schema(StructType([*STAGING.fields, *named])).parquet(folder)


def build_events(trail: DataFrame, history: DataFrame, tiers: DataFrame, cfg: AuditConfig = AuditConfig(),
                 days=None, regions=None, staging_folder: str | None = None) -> DataFrame:
    """The events of the given days/regions as a DataFrame; looks for heavy
    ids and writes the staging."""
    regions = regions or (list(cfg.regions) or None)
    heavy = EN.heavy_keys(trail, history, cfg, days, regions)
    rows = EN.staging(trail, history, cfg, days, regions, heavy).withColumn("_named", CL.named_tables(cfg))
    return CL.classify(staged(rows, staging_folder), tiers, cfg)


def run_range(spark: SparkSession, trail: DataFrame, history: DataFrame, tiers: DataFrame,
              events_root: str, from_day: str, to_day: str,
              cfg: AuditConfig = AuditConfig(), table: str | None = None, keep_old: bool = False) -> EventsRun:
    """Rebuild every (region, day) in [from_day, to_day] and replace them in
    the events at ``events_root``: by moving folders, or, with ``table``, by
    switching the locations of that catalog table's partitions. Idempotent:
    re-running gives the same table. A build that fails changes nothing."""
    days = days_between(from_day, to_day)  # raises on a reversed range
    regions = list(cfg.regions) or None
    run = PUB.new_run()
    staging = PUB.version_folder(events_root, f"{run}-staging")
    out = build_events(trail, history, tiers, cfg, days, regions, staging)
    version = PUB.write_version(out.select(*EVENT_COLUMNS), events_root, EVENT_PARTITIONS, run=run)
    FS.delete(spark, [staging])
    built = set(PUB.built_partitions(spark, version, EVENT_PARTITIONS))
    present = (PUB.registered(spark, table, EVENT_PARTITIONS) if table
               else set(PUB.built_partitions(spark, events_root.rstrip("/"), EVENT_PARTITIONS)))
    wanted = set(days)
    stale = {p for p in present - built if p[1] in wanted and (not regions or p[0] in regions)}
    if stale and not regions:
        # Only regions that the inputs speak for are cleared; inputs that are
        # there but hold nothing clear the requested days of every region.
        spoken = {r["region"] for r in trail.select("region").union(history.select("region")).distinct().collect()}
        stale = {p for p in stale if not spoken or p[0] in spoken}
    if table:
        PUB.publish_to_table(spark, version, table, EVENT_PARTITIONS, sorted(stale), keep_old)
        events = spark.table(table)
    else:
        PUB.publish_to_folders(spark, version, events_root, EVENT_PARTITIONS, sorted(stale))
        events = read_events(spark, events_root, days)
    row = (events.where(F.col("day").isin(*days))
           .agg(F.count(F.lit(1)).alias("n"), F.count("classification_tier").alias("c")).first())
    return EventsRun(from_day, to_day, int(row["n"]), int(row["c"]))


def range_for(force_recreate: bool, day: str | None = None) -> tuple[str, str]:
    """The day range of one run: a forced re-creation backfills the last
    14 days up to yesterday (the given day is ignored then); otherwise the
    given day, default yesterday (UTC)."""
    if force_recreate:
        return day_back(BACKFILL_DAYS_ON_RECREATE), yesterday()
    d = day or yesterday()
    return d, d


def run_report(spark: SparkSession, events_root: str, from_day: str, to_day: str) -> DataFrame:
    """One-row summary read back from the table."""
    return R.events_run_report(read_events(spark, events_root), from_day, to_day)
