"""Classification: table references (X1), tier lookup (J3), most sensitive
tier per query (A13), write-back onto every row of that query (J4), and the
per-tier counts (A14).

Plan shape: the wide rows are never exploded, sorted or gathered by key. A
row's own tier depends only on the set of tables its text names, and there are
few such sets: they are aggregated, looked up once each, and joined back. Ids
whose rows differ in tier come from a narrow aggregate; only those are joined
to the rows again (see ``classify``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qtrail.config import AuditConfig
from qtrail.functions import columns as X
from qtrail.functions.tablerefs import table_refs as table_refs_col
from qtrail.schemas import EVENT_COLUMNS


def table_refs(events: DataFrame, cfg: AuditConfig = AuditConfig(), keys=("day", "query_id"),
               distinct: bool = True) -> DataFrame:
    """X1 as a job: one row per (key..., db, tbl) a query's text references,
    with the database resolved (row's database, then the audit database).
    ``distinct=False`` skips the de-duplicating shuffle where the consumer is
    an idempotent aggregate such as ``min``."""
    fallback = F.coalesce(F.nullif(F.col("database"), F.lit("")), F.lit(cfg.audit_db))
    refs = (events.where(F.col("query").isNotNull())
            .select(*keys, fallback.alias("_dbf"), F.explode(table_refs_col("query")).alias("r")))
    out = refs.select(*keys, F.coalesce(F.col("r.db"), F.col("_dbf")).alias("db"),
                      F.col("r.tbl").alias("tbl"))
    return out.distinct() if distinct else out


def _normalised_tiers(tiers: DataFrame, cfg: AuditConfig) -> DataFrame:
    """One tier per (db, tbl): a repeated key (or two names that fold together
    when matching case-insensitively) keeps its most sensitive tier."""
    t = tiers.select("db", "tbl", "tier").where(F.col("tier").isNotNull())
    if cfg.tiers_case_insensitive:
        t = t.select(F.lower("db").alias("db"), F.lower("tbl").alias("tbl"), "tier")
    return t.groupBy("db", "tbl").agg(F.min("tier").alias("tier"))


def tier_lookup(refs: DataFrame, tiers: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Join of references with the tier map on (db, tbl) -> ``tier``;
    references without a tier fall out. One plan at every size: Spark
    broadcasts the map where its measured bytes are under the session's
    threshold, and else splits the tasks of a hot table (AQE skew join)."""
    if cfg.tiers_case_insensitive:
        refs = refs.withColumn("db", F.lower("db")).withColumn("tbl", F.lower("tbl"))
    return refs.join(_normalised_tiers(tiers, cfg), ["db", "tbl"])


def best_tiers(events: DataFrame, tiers: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Smallest tier (string order, as the audit defines it) per (day, query_id)."""
    hits = tier_lookup(table_refs(events, cfg, distinct=False), tiers, cfg)
    return hits.groupBy("day", "query_id").agg(F.min("tier").alias("classification_tier"))


def named_tables(cfg: AuditConfig = AuditConfig()) -> Column:
    """The set of (db, tbl) a row's text names, resolved and in one order, so
    that texts over the same tables have the same value."""
    fallback = F.coalesce(F.nullif(F.col("database"), F.lit("")), F.lit(cfg.audit_db))
    return F.array_sort(F.array_distinct(F.transform(table_refs_col("query"), lambda r: F.named_struct(
        F.lit("db"), F.coalesce(r["db"], fallback), F.lit("tbl"), r["tbl"]))))


def set_tiers(rows: DataFrame, tiers: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """``_named, _own``: the smallest tier of each set of tables that has one."""
    sets = rows.where(F.size("_named") > 0).select("_named").distinct()
    each = sets.select("_named", F.inline("_named"))
    return tier_lookup(each, tiers, cfg).groupBy("_named").agg(F.min("tier").alias("_own"))


def classify(staging: DataFrame, tiers: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Staging rows + ``classification_tier``; every row sharing a
    (day, query_id) gets the smallest tier any of those rows' texts reach.

    Three reads of ``staging``, so give it written (``events_job.staged``,
    with the tables named in ``_named``, so that texts are searched once), not
    as the plan of the joins: (1) the sets of tables its texts name, a
    distinct that collapses in each task; (2) ids and own tiers alone, to
    find the (day, query_id) whose rows differ, also pre-aggregated, so an id
    with half of all rows costs each task one row; (3) the wide rows, joined
    to the tiers of the sets and to those few ids. Both joins keep the left
    side's rows, so Spark broadcasts the small side by its measured size, and
    beyond that splits a hot key's rows over tasks (AQE). NULL query ids
    never share a tier (an id test never matches NULL) and get none."""
    rows = staging if "_named" in staging.columns else staging.withColumn("_named", named_tables(cfg))
    own = set_tiers(rows, tiers, cfg)
    mine = F.when(F.col("query_id").isNotNull(), F.col("_own")).alias("_own")
    ids = rows.where(F.col("query_id").isNotNull()).select("day", "query_id", "_named").join(own, "_named", "left")
    differ = (F.min("_own") != F.max("_own")) | ((F.count("_own") > 0) & (F.count("_own") < F.count(F.lit(1))))
    mixed = (ids.groupBy("day", "query_id").agg(F.min("_own").alias("_best"), differ.alias("_differ"))
             .where("_differ").select(F.col("day").alias("_bday"), F.col("query_id").alias("_bqid"), "_best"))
    tagged = rows.join(own, "_named", "left").select(*staging.columns, mine)
    out = tagged.join(mixed, (F.col("day") == F.col("_bday")) & (F.col("query_id") == F.col("_bqid")), "left")
    return out.withColumn("classification_tier", F.coalesce("_best", "_own")).select(*EVENT_COLUMNS)


def tier_counts(staging: DataFrame, tiers: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """How many staged records were classified, by the record's own best
    tier. It depends only on the set of tables a record names, so records are
    first collapsed to those sets with a count (map-side combined); no text is
    shuffled."""
    sets = (staging.where(F.col("query").isNotNull()).select(named_tables(cfg).alias("_named"))
            .where(F.size("_named") > 0).groupBy("_named").agg(F.count(F.lit(1)).alias("n")))
    per_set = (tier_lookup(sets.select("_named", "n", F.inline("_named")), tiers, cfg)
               .groupBy("_named", "n").agg(F.min("tier").alias("classification_tier")))
    return per_set.groupBy("classification_tier").agg(F.sum("n").alias("classified"))
