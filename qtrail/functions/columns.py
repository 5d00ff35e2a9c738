"""Projection expressions (P1-P16). Each returns a ``Column``; none is a UDF."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail import config as C
from qtrail.schemas import COST_TYPE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P1 -- scalar fields of the JSON text kept in the trail record.
def json_field(json_col, path: str) -> Column:
    return F.get_json_object(_c(json_col), path)


def trail_query_id(resp="responseElements") -> Column:
    return json_field(resp, C.JSON_QUERY_ID)


def trail_query_string(req="requestParameters") -> Column:
    return json_field(req, C.JSON_QUERY_STRING)


def trail_workgroup(req="requestParameters") -> Column:
    return json_field(req, C.JSON_WORKGROUP)


def trail_database(req="requestParameters") -> Column:
    return json_field(req, C.JSON_DATABASE)


# The three request fields in one parse of the JSON text (instead of three
# ``get_json_object`` scans). A non-scalar value read as STRING keeps its
# JSON text, like ``get_json_object``; malformed text gives NULL fields.
REQUEST_FIELDS = T.StructType([
    T.StructField("queryString", T.StringType()),
    T.StructField("queryExecutionContext", T.StructType([T.StructField("database", T.StringType())])),
    T.StructField("workGroup", T.StringType()),
])


def trail_request(req="requestParameters") -> Column:
    return F.from_json(_c(req), REQUEST_FIELDS)


# P2 -- identity navigation; an absent level yields NULL.
IDENTITY_FIELDS = {
    "source_identity": "userIdentity.sessionContext.sourceIdentity",
    "on_behalf_of_user_id": "userIdentity.onBehalfOf.userId",
    "user_identity_type": "userIdentity.type",
    "user_identity_principal": "userIdentity.principalId",
    "user_identity_arn": "userIdentity.arn",
}


# P3 -- history text first, redacted trail text counts as missing.
def query_text(history_query, trail_text) -> Column:
    return F.coalesce(_c(history_query), F.nullif(_c(trail_text), F.lit(C.REDACTED_QUERY_TEXT)))


# P4
def bytes_or_zero(x) -> Column:
    return F.coalesce(_c(x), F.lit(0).cast(T.LongType()))


# P5 -- exact decimal arithmetic: bytes / 2^40 * rate, as DECIMAL(12,8).
# An amount that does not fit raises under ANSI mode instead of turning NULL.
def cost(bytes_col, rate: Decimal | str = C.DEFAULT_COST_PER_TB) -> Column:
    tb = _c(bytes_col).cast(T.DecimalType(20, 0)) / F.lit(Decimal(C.BYTES_PER_TB))
    return (tb * F.lit(Decimal(str(rate)))).cast(COST_TYPE)


# P6 -- ISO-8601 text -> zone-less timestamp keeping the written wall time;
# unparsable or empty text gives NULL instead of failing the job.
def event_time(iso_text) -> Column:
    return _c(iso_text).try_cast(T.TimestampNTZType())


# P7
def null_string() -> Column:
    return F.lit(None).cast(T.StringType())


# P8 -- year / month / day-of-month parts of a 'YYYY-MM-DD' day string.
def day_parts(day) -> tuple[Column, Column, Column]:
    d = _c(day)
    return F.substring(d, 1, 4), F.substring(d, 6, 2), F.substring(d, 9, 2)


# Service dumps hold ISO text or epoch seconds; the latter become ISO text in UTC.
def iso_time(x) -> Column:
    t = _c(x)
    seconds = t.try_cast(T.DecimalType(20, 6))
    epoch = F.timestamp_micros((seconds * 1000000).cast(T.LongType()))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), epoch.cast(T.TimestampNTZType()))
    return F.when(t.rlike(r"^\d{9,11}(\.\d+)?$"), F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).otherwise(t)


# P10 -- the day an execution belongs to: submission, else completion.
def execution_day(submitted, completed) -> Column:
    ts = F.coalesce(event_time(iso_time(submitted)), event_time(iso_time(completed)))
    return F.date_format(ts, "yyyy-MM-dd")


# P11
def query_preview(q="query", n: int = C.QUERY_PREVIEW_CHARS) -> Column:
    return F.substring(_c(q), 1, n)


# P12 -- unit columns. Division happens in DECIMAL so the rounding is exact.
def _scaled(bytes_col, divisor: int, digits: int, precision: int = 18) -> Column:
    v = _c(bytes_col).cast(T.DecimalType(20, 0)) / F.lit(Decimal(divisor))
    return F.round(v, digits).cast(T.DecimalType(precision, digits))


def mib(bytes_col, digits: int = 2) -> Column:
    return _scaled(bytes_col, C.BYTES_PER_MIB, digits)


def gib(bytes_col, digits: int = 3) -> Column:
    return _scaled(bytes_col, C.BYTES_PER_GIB, digits)


def decimal_gb(bytes_col, digits: int = 2) -> Column:
    return _scaled(bytes_col, C.BYTES_PER_DECIMAL_GB, digits)


def money(x, digits: int) -> Column:
    return F.round(_c(x), digits).cast(T.DecimalType(18, digits))


# P13
def money_text(cost_col="cost") -> Column:
    return F.concat(F.lit("$"), _c(cost_col).cast(T.StringType()))


# P15
def user_name() -> Column:
    return F.coalesce(F.col("source_identity"), F.col("user_identity_type"))


# P16
def status_or_unknown(s="status") -> Column:
    return F.coalesce(_c(s), F.lit(C.UNKNOWN_STATUS))


def null_safe_join_key(key, side: str, salt_cols) -> Column:
    """Join key whose NULLs are replaced by a string that can never equal a
    real id (prefix NUL + side tag) built from a hash of the row's own
    columns. SQL equality never matches NULL anyway, so results are
    unchanged; what changes is that NULL-id rows spread over all reducers
    instead of piling into one. The salt is a pure function of the row, so a
    recomputed task (lost executor) routes every row exactly as before."""
    cols = [F.col(c) if isinstance(c, str) else c for c in salt_cols]
    salt = F.concat(F.lit("\u0000" + side), F.xxhash64(*cols).cast(T.StringType()))
    return F.coalesce(_c(key), salt)
