"""Grants ``(principal, catalog, db, tbl, privileges)``: from a landed listing
of permissions, or kept as a plain table. ``*`` as ``tbl`` (or as ``db`` and
``tbl``) grants every table below; a NULL catalog is the default one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.config import WILDCARD
from qtrail.schemas import GRANTS, PERMISSION_DUMP


def grants_from_permission_dump(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed permission on a table, database or whole catalog;
    entries for other resources are left out."""
    p = (spark.read.schema(PERMISSION_DUMP).option("multiLine", True).json(path)
         .select(F.explode("PrincipalResourcePermissions").alias("p")).select("p.*"))
    table = F.coalesce("Resource.Table", "Resource.TableWithColumns")
    whole = F.lit(WILDCARD)
    on_table, on_db = table.isNotNull(), F.col("Resource.Database").isNotNull()
    return (p.where(on_table | on_db | F.col("Resource.Catalog").isNotNull())
            .select(F.col("Principal.DataLakePrincipalIdentifier").alias("principal"),
                    F.lit(None).cast("string").alias("catalog"),
                    F.when(on_table, table["DatabaseName"]).when(on_db, F.col("Resource.Database.Name")).otherwise(whole).alias("db"),
                    F.coalesce(F.when(on_table, table["Name"]), whole).alias("tbl"),
                    F.array_join(F.array_sort("Permissions"), ",").alias("privileges")))


def grants_from_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, CSV with a header, or JSON lines, by the path's extension."""
    end = path.rstrip("/")
    r = spark.read.schema(GRANTS)
    if end.endswith(".csv"):
        return r.option("header", True).csv(path)
    return r.json(path) if end.endswith((".json", ".jsonl")) else r.parquet(path)
