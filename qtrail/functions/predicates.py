"""Filter predicates (F1-F12) as ``Column`` objects; composed, never string-built."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from qtrail import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1
def start_query_only(source="eventSource", name="eventName") -> Column:
    return (_c(source) == F.lit(C.QUERY_SERVICE_SOURCE)) & _c(name).isin(*C.START_EVENT_NAMES)


# F2 -- NOT LIKE '%marker%' for each of the pipeline's own roles. A NULL ARN
# makes the predicate NULL, which drops the row (faithful default).
def exclude_self(arn="userIdentity.arn", keep_null_arn: bool = False) -> Column:
    conds = [~_c(arn).contains(m) for m in C.SELF_ROLE_MARKERS]
    p = reduce(lambda a, b: a & b, conds)
    return (p | _c(arn).isNull()) if keep_null_arn else p


# F3 -- literal partition values; lets Spark prune partitions.
def in_days(days, day="day") -> Column | None:
    days = list(days or [])
    return _c(day).isin(*days) if days else None


def in_regions(regions, region="region") -> Column | None:
    regions = list(regions or [])
    return _c(region).isin(*regions) if regions else None


def day_between(from_day: str, to_day: str, day="day") -> Column:
    return _c(day).between(F.lit(from_day), F.lit(to_day))


# F4 -- case-insensitive plain substring (no wildcard characters).
def workgroup_contains(wg, needle: str) -> Column | None:
    needle = (needle or "").strip().lower()
    return F.lower(_c(wg)).contains(needle) if needle else None


# F5 / F11
def present(x) -> Column:
    return _c(x).isNotNull()


# F6
def terminal_state(state="Status.State") -> Column:
    return _c(state).isin(*C.TERMINAL_STATES)


# F9 -- DATE(day) >= as_of - n (as_of injected, never the wall clock).
def last_n_days(as_of: str, n: int = 7, day="day") -> Column:
    return F.to_date(_c(day)) >= F.date_sub(F.to_date(F.lit(as_of)), n)


# F10 -- ``x <> ''``: NULL is dropped as well.
def non_empty(x) -> Column:
    return _c(x) != F.lit("")


def all_of(*preds) -> Column:
    ps = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, ps) if ps else F.lit(True)


def contains_text(needle: str | None, query="query") -> Column | None:
    text = (needle or "").strip().lower()
    return F.lower(_c(query)).contains(text) if text else None


# F8 -- the report search: day range + optional exact user / workgroup /
# status + optional case-insensitive text search, all conjunctive.
def search_filter(from_day: str, to_day: str, user: str | None = None,
                  workgroup: str | None = None, status: str | None = None,
                  query_contains: str | None = None) -> Column:
    return all_of(
        day_between(from_day, to_day),
        (F.col("source_identity") == F.lit(user)) if user else None,
        (F.col("workgroup") == F.lit(workgroup)) if workgroup else None,
        (F.col("status") == F.lit(status)) if status else None,
        contains_text(query_contains),
    )
