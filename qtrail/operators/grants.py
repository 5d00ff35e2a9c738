"""Permissions beside actual usage: which grants no query of a range needed.

A query uses each table that its text names, on behalf of each identity it
ran under. Usage is aggregated to one row per (principal, table) map-side,
and only then expanded to the levels a grant may stand at: the table, all
tables of its database, all of its catalog. Grants meet usage by plain
equality, so the wildcard needs no theta join, and a principal with most of
the queries costs one row per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qtrail import config as C
from qtrail.config import AuditConfig

# A table name: up to three parts, each bare, back-quoted or double-quoted.
NAME_PART = r'(?:`[^`]+`|"[^"]+"|[\w$]+)'
QUALIFIED_REF_PATTERN = (r"(?iU)\b(?:FROM|JOIN|INTO|UPDATE|TABLE)\s+" + NAME_PART
                         + r"(?:\s*\.\s*" + NAME_PART + r"){0,2}")
ASSUMED_ROLE = r"^(arn:[^:]*):sts::([^:]*):assumed-role/([^/]+)/.*$"


def qualified_refs(query) -> Column:
    """array<struct<catalog, db, tbl>> in lower case, without quotes; ``db``
    and ``catalog`` are NULL where the text gives none."""
    q = F.coalesce(F.col(query) if isinstance(query, str) else query, F.lit(""))

    def split(m: Column) -> Column:
        # The keyword goes, the name's parts stay.
        name = F.regexp_replace(m, r"^\w+\s+", "")
        parts = F.transform(F.regexp_extract_all(name, F.lit(NAME_PART), F.lit(0)),
                            lambda x: F.lower(F.regexp_replace(x, '[`"]', "")))
        at = lambda i: F.get(parts, F.size(parts) - i)  # noqa: E731 -- from the end
        return F.named_struct(F.lit("catalog"), at(3), F.lit("db"), at(2), F.lit("tbl"), at(1))

    return F.transform(F.regexp_extract_all(q, F.lit(QUALIFIED_REF_PATTERN), F.lit(0)), split)


def principals() -> Column:
    """Names a grant may give the identity of an event: its source identity,
    its ARN, the role behind an assumed-role session, its directory user."""
    arn = F.col("user_identity_arn")
    role = F.when(arn.rlike(ASSUMED_ROLE), F.regexp_replace(arn, ASSUMED_ROLE, "$1:iam::$2:role/$3"))
    return F.array_distinct(F.array_compact(F.array(
        F.col("source_identity"), arn, role, F.col("on_behalf_of_user_id"))))


def table_usage(events: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """``principal, catalog, db, tbl, uses, last_day`` of the events: a text
    that names a table twice uses it once."""
    database = F.lower(F.coalesce(F.nullif(F.col("database"), F.lit("")), F.lit(cfg.audit_db)))
    refs = events.select(F.explode(principals()).alias("principal"), "day", database.alias("_db"),
                         F.array_distinct(qualified_refs("query")).alias("_refs"))
    each = refs.select("principal", "day", "_db", F.explode("_refs").alias("r"))
    return each.groupBy("principal", F.coalesce("r.catalog", F.lit(C.DEFAULT_CATALOG)).alias("catalog"),
                        F.coalesce("r.db", "_db").alias("db"), F.col("r.tbl").alias("tbl")).agg(
        F.count(F.lit(1)).alias("uses"), F.max("day").alias("last_day"))


def usage_levels(usage: DataFrame) -> DataFrame:
    """Usage by every (catalog, db, tbl) a grant that covers it may name."""
    any_ = F.lit(C.WILDCARD)
    level = F.explode(F.array(F.struct("db", "tbl"), F.struct("db", any_.alias("tbl")),
                              F.struct(any_.alias("db"), any_.alias("tbl"))))
    return (usage.withColumn("_l", level)
            .groupBy("principal", "catalog", F.col("_l.db").alias("db"), F.col("_l.tbl").alias("tbl"))
            .agg(F.sum("uses").alias("uses"), F.max("last_day").alias("last_day")))


_KEYS = ("principal", "catalog", "db", "tbl")


def _keyed(grants: DataFrame) -> DataFrame:
    return grants.withColumns({
        "_principal": F.col("principal"), "_catalog": F.lower(F.coalesce("catalog", F.lit(C.DEFAULT_CATALOG))),
        "_db": F.lower("db"), "_tbl": F.lower("tbl")})


def _by_key(usage: DataFrame) -> DataFrame:
    return usage.select(*[F.col(k).alias(f"_{k}") for k in _KEYS], "uses", "last_day")


def grant_usage(grants: DataFrame, events: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Every grant with how often and when last the events needed it (0 and
    NULL if never). A wildcard grant is needed by any table below it."""
    used = _by_key(usage_levels(table_usage(events, cfg)))
    out = _keyed(grants).join(used, [f"_{k}" for k in _KEYS], "left")
    return out.select(*grants.columns, F.coalesce("uses", F.lit(0)).cast("long").alias("uses"), "last_day")


def unused_grants(grants: DataFrame, events: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Grants that no query of the events needed: an anti join on equal keys."""
    used = _by_key(usage_levels(table_usage(events, cfg))).drop("uses", "last_day")
    return _keyed(grants).join(used, [f"_{k}" for k in _KEYS], "left_anti").select(*grants.columns)
