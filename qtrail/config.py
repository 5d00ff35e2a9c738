"""Job configuration and the fixed values the audit semantics depend on."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match the
# audited service's conventions; they are not tuning knobs.
# ---------------------------------------------------------------------------
QUERY_SERVICE_SOURCE = "athena.amazonaws.com"
START_EVENT_NAMES = ("StartQueryExecution",)
SELF_ROLE_MARKERS = ("AthenaEventsLambda", "AthenaHistoryLambda")
REDACTED_QUERY_TEXT = "***OMITTED***"
BYTES_PER_TB = 1099511627776  # 2**40
BYTES_PER_GIB = 1073741824  # 2**30
BYTES_PER_MIB = 1048576  # 2**20
BYTES_PER_DECIMAL_GB = 1000000000
DEFAULT_COST_PER_TB = "5.00"
TERMINAL_STATES = ("SUCCEEDED", "FAILED", "CANCELLED")
UNKNOWN_STATUS = "UNKNOWN"
DEFAULT_AUDIT_DB = "default"
BACKFILL_DAYS_ON_RECREATE = 14
JSON_QUERY_ID = "$.queryExecutionId"
JSON_QUERY_STRING = "$.queryString"
JSON_WORKGROUP = "$.workGroup"
JSON_DATABASE = "$.queryExecutionContext.database"
# Table references follow FROM / JOIN / INTO, optionally back-quoted and
# optionally qualified by one dot; case-insensitive, Unicode word characters.
TABLE_REF_PATTERN = r"(?iU)\b(?:FROM|JOIN|INTO)\s+`?(\w+)`?(?:\s*\.\s*`?(\w+)`?)?"
# Report defaults.
SEARCH_DEFAULT_LIMIT = 200
QUERY_PREVIEW_CHARS = 300
TOP_USERS_BY_COST = 30
TOP_USER_STATUS = 50
TOP_ADHOC = 50
TOP_USERS_BY_SCAN = 100
LATEST_EVENTS = 20
# Monitoring defaults.
BASELINE_DAYS = 14  # trailing calendar days a user's day is compared with
BASELINE_LEAST_DAYS = 7
ANOMALY_Z = 3.0
SKETCH_LOG2 = 12  # registers of a distinct-count sketch, as a power of two
SKETCH_MARGIN = 0.2  # an estimate this far under a threshold is still counted exactly
SHARED_AGENTS = 2
SHARED_IPS = 40
# Grants.
DEFAULT_CATALOG = "awsdatacatalog"  # the catalog of names without one, lower case
WILDCARD = "*"


@dataclass(frozen=True)
class AuditConfig:
    """Knobs of one audit deployment.

    ``audit_db`` is the fallback database for unqualified table names when the
    event carries none. ``workgroups_filter`` is a case-insensitive substring
    (empty = all). ``strict_not_in`` reproduces the null-aware NOT IN of the
    history-only pass per (region, day); the default is the stated intent
    (plain anti join). ``keep_null_arn`` keeps trail rows whose ARN is NULL.
    """

    audit_db: str = DEFAULT_AUDIT_DB
    cost_per_tb: Decimal = Decimal(DEFAULT_COST_PER_TB)
    workgroups_filter: str = ""
    regions: tuple[str, ...] = ()
    strict_not_in: bool = False
    keep_null_arn: bool = False
    tiers_case_insensitive: bool = False
    # A (region, day, query_id) with more rows than this on one side is joined
    # by split rows; 0 looks for none.
    heavy_rows: int = 500_000

    @property
    def wg_filter(self) -> str:
        return (self.workgroups_filter or "").strip().lower()

    @property
    def rate(self) -> Decimal:
        return Decimal(str(self.cost_per_tb))
