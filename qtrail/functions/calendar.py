"""Day arithmetic (UTC calendar days as 'YYYY-MM-DD' strings)."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _parse(day: str) -> date:
    return datetime.strptime(day, "%Y-%m-%d").date()


def day_back(n: int, as_of: date | None = None) -> str:
    today = as_of or datetime.now(timezone.utc).date()
    return str(today - timedelta(days=n))


def yesterday(as_of: date | None = None) -> str:
    return day_back(1, as_of)


def days_between(from_day: str, to_day: str) -> list[str]:
    """Inclusive list of days; a reversed range is an error (never loops)."""
    a, b = _parse(from_day), _parse(to_day)
    if a > b:
        raise ValueError(f"from_day {from_day} is after to_day {to_day}")
    return [str(a + timedelta(days=i)) for i in range((b - a).days + 1)]


def day_range_start(from_day: str, n: int) -> str:
    """The day ``n`` days before ``from_day``."""
    return str(_parse(from_day) - timedelta(days=n))


def day_range_df(spark: SparkSession, from_day: str, to_day: str) -> DataFrame:
    """The inclusive range as a one-column DataFrame (``sequence`` + ``explode``)."""
    _parse(from_day), _parse(to_day)
    seq = F.sequence(F.to_date(F.lit(from_day)), F.to_date(F.lit(to_day)), F.expr("interval 1 day"))
    return (spark.range(1).select(F.explode(seq).alias("d"))
            .select(F.date_format("d", "yyyy-MM-dd").alias("day")))
