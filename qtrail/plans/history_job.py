"""Build history for any set of days over every workgroup in one job and
publish it as gzip JSON lines per region/day/workgroup (S4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from qtrail.operators.ingest import history_rows, history_run_report
from qtrail.plans import publish as PUB
from qtrail.schemas import HISTORY_FILE, HISTORY_PARTITIONS
from qtrail.sources.history import read_history


def build_history(executions: DataFrame, history_root: str, days=None, workgroups_filter: str = "",
                  workgroup: str | None = None, force: bool = False, regions=None,
                  workgroups: DataFrame | None = None) -> DataFrame:
    """Write the history partitions, then report from what was written.

    The rows are written whole before any partition is replaced. ``force``
    then also takes away the partitions of the named days (of ``workgroup``
    alone, if given) in ``regions``, default those of the executions, that the
    dump holds nothing for; without it they stay. ``workgroups`` is the listing
    for the report."""
    spark = executions.sparkSession
    if force and not days:
        raise ValueError("force clears named days: give days")
    rows = history_rows(executions, days, workgroups_filter, workgroup)
    if regions:
        rows = rows.where(rows["region"].isin(*regions))
    columns = [f.name for f in HISTORY_FILE.fields] + list(HISTORY_PARTITIONS)
    version = PUB.write_version(rows.select(*columns), history_root, HISTORY_PARTITIONS, "json", compression="gzip")
    stale = set()
    if force:
        named = set(regions or [r["region"] for r in executions.select("region").distinct().collect()])
        present = set(PUB.built_partitions(spark, history_root.rstrip("/"), HISTORY_PARTITIONS))
        stale = {p for p in present if p[0] in named and p[1] in set(days) and workgroup in (None, p[2])}
        stale -= set(PUB.built_partitions(spark, version, HISTORY_PARTITIONS))
    PUB.publish_to_folders(spark, version, history_root, HISTORY_PARTITIONS, sorted(stale))
    return history_run_report(read_history(spark, history_root, days, regions), days, workgroups)
