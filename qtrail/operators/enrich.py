"""Trail x history enrichment: pass 1 (J1), history-only pass 2 (J2), union.

In a build both passes come out of ONE shuffle: a full outer equi-join of
trail start records and history rows on (region, day, query_id). Pass 2 alone
(``history_only``) is an anti join on those three columns.

* a row with a trail side is a pass-1 row (trail LEFT JOIN history); the
  exclude-self, workgroup and text-present filters apply to it;
* a row with only a history side is a history row that no start record of the
  same region/day claims -- exactly the anti-join of pass 2. It is kept when
  its text is present and the workgroup filter passes.

Compared with a left join followed by a separate anti join this reads and
shuffles each input once. NULL query ids are given non-matching random keys
before the shuffle (SQL equality never matches NULL) so that a flood of
failed starts cannot pile into one reducer; the keys hash the row's own
columns, so a recomputed task routes every row the same way.

Repeated ids (a replayed trail) can put a large share of the rows on one key,
and a full outer join cannot be split at run time. ``heavy_keys`` finds such
keys beforehand with a bounded frequency sketch; in the same join, the rows of
their larger side are then dealt over ``splits`` numbers and those of the other
side copied to each, which keeps every pair and adds none (see ``joined``).

``strict_not_in`` reproduces the null-aware ``NOT IN`` of the original pass 2
for every (region, day): a start record with a NULL id in that region/day
empties pass 2 there, and a NULL history id survives only where the day has
no start records at all. The per-(region, day) flags are a tiny aggregate
(one row per region-day); adaptive execution broadcasts it at run time once
its real size is known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qtrail.config import AuditConfig
from qtrail.functions import columns as X
from qtrail.functions import predicates as P
from qtrail.schemas import STAGING_COLUMNS


def trail_starts(trail: DataFrame, days=None, regions=None, keep_null_arn: bool = False) -> DataFrame:
    """F1 + F3: start-query records of the service, JSON fields parsed once.
    The request text is parsed only for records pass 1 can keep: the
    pipeline's own records only need their (region, day, id) for pass 2."""
    cond = P.all_of(P.start_query_only(), P.in_days(days), P.in_regions(regions))
    return trail.where(cond).select(
        "region", "day",
        X.trail_query_id().alias("query_id"),
        F.col("eventTime").alias("event_time_text"),
        *[F.col(path).alias(name) for name, path in X.IDENTITY_FIELDS.items()],
        F.col("userAgent").alias("user_agent"),
        F.col("sourceIPAddress").alias("source_ip"),
        F.when(P.exclude_self("userIdentity.arn", keep_null_arn), X.trail_request()).alias("_req"),
    ).select(
        "*",
        F.col("_req.queryString").alias("query_string"),
        F.col("_req.queryExecutionContext.database").alias("database"),
        F.col("_req.workGroup").alias("workgroup"),
    ).drop("_req")


def history_rows(history: DataFrame, days=None, regions=None) -> DataFrame:
    cond = P.all_of(P.in_days(days), P.in_regions(regions))
    return history.where(cond).select(
        "region", "day", "query_id", "query", "data_scanned", "status",
        "state_change_reason", "submission_time", "workgroup")


def _strict_flags(starts: DataFrame) -> DataFrame:
    """One row per (region, day) having start records: does any carry a NULL id?"""
    return starts.groupBy("region", "day").agg(
        F.max(F.col("query_id").isNull().cast("int")).alias("_null_ids"))


def _strict_history(history: DataFrame, starts: DataFrame) -> DataFrame:
    """``history`` with ``_may_stand_alone``: what NOT IN leaves of it."""
    alone = F.col("_null_ids").isNull() | ((F.col("_null_ids") == 0) & F.col("query_id").isNotNull())
    return (history.join(_strict_flags(starts), ["region", "day"], "left")
            .withColumn("_may_stand_alone", alone).drop("_null_ids"))


# At most so many keys are joined apart: any other has a smaller share of its
# side's rows than one in HEAVY_KEYS, or than the sketch's error.
HEAVY_KEYS = 64
SKETCHED_KEYS = 10_000
MOST_SPLITS = 1024


@dataclass(frozen=True)
class HeavyKeys:
    """Keys whose trail rows, or whose history rows, are dealt over ``splits``
    numbers. No key is in both."""
    trail: tuple[str, ...] = ()
    history: tuple[str, ...] = ()
    splits: int = 1


def _whole_key() -> Column:
    return F.concat_ws("\u0000", "region", "day", "query_id")


def heavy_keys(trail: DataFrame, history: DataFrame, cfg: AuditConfig = AuditConfig(), days=None,
               regions=None) -> HeavyKeys:
    """Keys with over ``cfg.heavy_rows`` rows on one side. One narrow pass
    over the ids of both inputs; each task keeps a sketch of
    ``SKETCHED_KEYS`` counters, and ``HEAVY_KEYS`` keys reach the driver. A
    key returned does occur on that side; a count is good to a few
    ten-thousandths of the rows, which only matters to what is split."""
    if not cfg.heavy_rows:
        return HeavyKeys()
    starts = (trail.where(P.all_of(P.start_query_only(), P.in_days(days), P.in_regions(regions)))
              .select("region", "day", X.trail_query_id().alias("query_id")))
    rows = history.where(P.all_of(P.in_days(days), P.in_regions(regions))).select("region", "day", "query_id")

    ids = starts.withColumn("_side", F.lit("t")).unionByName(rows.withColumn("_side", F.lit("h")))
    top = F.expr(f"approx_top_k(_key, {HEAVY_KEYS}, {SKETCHED_KEYS})")
    found = (ids.where(F.col("query_id").isNotNull()).select("_side", _whole_key().alias("_key"))
             .groupBy("_side").agg(top.alias("top")).collect())
    heaviest = {r["_side"]: {x["item"]: x["count"] for x in r["top"] if x["count"] > cfg.heavy_rows} for r in found}
    t, h = heaviest.get("t", {}), heaviest.get("h", {})
    most = max([*t.values(), *h.values()], default=0)
    return HeavyKeys(tuple(k for k in t if t[k] >= h.get(k, 0)), tuple(k for k in h if h[k] > t.get(k, 0)),
                     min(MOST_SPLITS, max(2, -(-most // cfg.heavy_rows))) if most else 1)


def _dealt(rows: DataFrame, split: tuple[str, ...], copied: tuple[str, ...], splits: int) -> DataFrame:
    """``rows`` with ``_split``: rows of ``split`` keys in turn 0 to
    ``splits`` - 1 (by their place in the input, which a retried task finds
    again), rows of ``copied`` keys once for each, all others 0; ``_copied``
    marks the copies."""
    key = _whole_key()
    copy = key.isin(*copied) if copied else F.lit(False)
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(splits)).cast("int") if split else F.lit(0)
    numbers = F.when(F.coalesce(copy, F.lit(False)), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(
        F.array(F.when(key.isin(*split), F.col("_turn")).otherwise(F.lit(0)) if split else F.lit(0)))
    return (rows.withColumn("_turn", turn)
            .withColumns({"_copied": F.coalesce(copy, F.lit(False)), "_split": F.explode(numbers)}).drop("_turn"))


def joined(trail: DataFrame, history: DataFrame, cfg: AuditConfig = AuditConfig(),
           days=None, regions=None, heavy: HeavyKeys = HeavyKeys()) -> DataFrame:
    """Full outer join of starts and history; columns in staging order plus a
    boolean ``from_trail`` (True = pass 1, False = history-only pass 2).

    With ``heavy`` keys the join is on the split number as well. A key whose
    trail rows are split occurs in the trail, so its history rows, copied to
    each split, are claimed: copies that meet no trail row in their split are
    no history-only rows and go. A key whose history rows are split occurs in
    the history, so a copied trail row has its history rows elsewhere: copies
    that meet none go. Every pair meets in exactly one split."""
    s = trail_starts(trail, days, regions, cfg.keep_null_arn)
    h = history_rows(history, days, regions)
    if cfg.strict_not_in:
        h = _strict_history(h, s)
    s = s.withColumn("_k", X.null_safe_join_key("query_id", "s", s.columns))
    h = h.withColumn("_k", X.null_safe_join_key("query_id", "h", h.columns))
    split = bool(heavy.trail or heavy.history)
    if split:
        s = _dealt(s, heavy.trail, heavy.history, heavy.splits)
        h = _dealt(h, heavy.history, heavy.trail, heavy.splits)
    s, h = s.alias("s"), h.alias("h")
    same = [F.col(f"s.{c}") == F.col(f"h.{c}") for c in ("region", "day", "_k", *(["_split"] if split else []))]
    j = s.join(h, same, "full_outer")
    if split:
        alone = F.col("h._k").isNull() & F.col("s._copied") | F.col("s._k").isNull() & F.col("h._copied")
        j = j.where(~F.coalesce(alone, F.lit(False)))

    t = F.col("s._k").isNotNull()  # the row has a trail side -> pass 1

    def trail_or(trail_col: str, hist: Column | None) -> Column:
        return F.when(t, F.col(f"s.{trail_col}")).otherwise(hist if hist is not None else X.null_string())

    text = F.when(t, X.query_text("h.query", "s.query_string")).otherwise(F.col("h.query"))
    scanned = X.bytes_or_zero("h.data_scanned")
    keep1 = P.all_of(t, P.exclude_self("s.user_identity_arn", cfg.keep_null_arn),
                     P.workgroup_contains("s.workgroup", cfg.wg_filter), text.isNotNull())
    keep2 = P.all_of(~t, F.col("h.query").isNotNull(), F.col("h._may_stand_alone") if cfg.strict_not_in else None,
                     P.workgroup_contains("h.workgroup", cfg.wg_filter))
    cols = {
        "query_id": trail_or("query_id", F.col("h.query_id")),
        "event_time": X.event_time(trail_or("event_time_text", F.col("h.submission_time"))),
        "source_identity": trail_or("source_identity", None),
        "on_behalf_of_user_id": trail_or("on_behalf_of_user_id", None),
        "user_identity_type": trail_or("user_identity_type", None),
        "user_identity_principal": trail_or("user_identity_principal", None),
        "user_identity_arn": trail_or("user_identity_arn", None),
        "source_ip": trail_or("source_ip", None),
        "user_agent": trail_or("user_agent", None),
        "workgroup": trail_or("workgroup", F.col("h.workgroup")),
        "query": text,
        "database": trail_or("database", None),
        "status": F.col("h.status"),
        "state_change_reason": F.col("h.state_change_reason"),
        "data_scanned": scanned,
        "cost": X.cost(scanned, cfg.rate),
        "region": trail_or("region", F.col("h.region")),
        "day": trail_or("day", F.col("h.day")),
    }
    return j.where(keep1 | keep2).select(*[cols[c].alias(c) for c in STAGING_COLUMNS],
                                         t.alias("from_trail"))


def staging(trail: DataFrame, history: DataFrame, cfg: AuditConfig = AuditConfig(),
            days=None, regions=None, heavy: HeavyKeys = HeavyKeys()) -> DataFrame:
    """Pass 1 UNION ALL pass 2, in declared column order."""
    return joined(trail, history, cfg, days, regions, heavy).drop("from_trail")


def pass1(trail: DataFrame, history: DataFrame, cfg: AuditConfig = AuditConfig(),
          days=None, regions=None) -> DataFrame:
    """J1 alone: trail start records with their history, if any."""
    return joined(trail, history, cfg, days, regions).where("from_trail").drop("from_trail")


def history_only(trail: DataFrame, history: DataFrame, cfg: AuditConfig = AuditConfig(),
                 days=None, regions=None) -> DataFrame:
    """J2 alone: history rows without a start record in the same region/day.
    An anti join: of the start records only (region, day, query_id) is read
    and shuffled. NULL ids match nothing, so those of the starts are left out
    and those of the history get row-hash keys."""
    starts = (trail.where(P.all_of(P.start_query_only(), P.in_days(days), P.in_regions(regions)))
              .select("region", "day", X.trail_query_id().alias("query_id")))
    h = history_rows(history, days, regions)
    if cfg.strict_not_in:
        h = _strict_history(h, starts).where("_may_stand_alone").drop("_may_stand_alone")
    h = h.where(P.all_of(F.col("query").isNotNull(), P.workgroup_contains("workgroup", cfg.wg_filter)))
    h = h.withColumn("_k", X.null_safe_join_key("query_id", "h", h.columns))
    claimed = starts.where(F.col("query_id").isNotNull()).withColumnRenamed("query_id", "_k")
    scanned = X.bytes_or_zero("data_scanned")
    cols = {"event_time": X.event_time("submission_time"), "data_scanned": scanned,
            "cost": X.cost(scanned, cfg.rate)}
    cols |= {c: F.col(c) for c in ("query_id", "workgroup", "query", "status", "state_change_reason",
                                   "region", "day")}
    return (h.join(claimed, ["region", "day", "_k"], "left_anti")
            .select(*[cols.get(c, X.null_string()).alias(c) for c in STAGING_COLUMNS]))
