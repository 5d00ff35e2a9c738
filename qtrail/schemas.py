"""Declared schemas. Input JSON keys keep their raw spelling because Spark's
JSON reader matches field names case-sensitively."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# One audit-trail record (an element of the file's ``Records`` array).
TRAIL_RECORD = T.StructType([
    T.StructField("userIdentity", T.StructType([
        T.StructField("type", S),
        T.StructField("principalId", S),
        T.StructField("arn", S),
        T.StructField("accountId", S),
        T.StructField("invokedBy", S),
        T.StructField("accessKeyId", S),
        T.StructField("userName", S),
        T.StructField("sessionContext", T.StructType([T.StructField("sourceIdentity", S)])),
        T.StructField("onBehalfOf", T.StructType([T.StructField("userId", S)])),
    ])),
    T.StructField("eventTime", S),
    T.StructField("eventSource", S),
    T.StructField("eventName", S),
    T.StructField("sourceIPAddress", S),
    T.StructField("userAgent", S),
    # Nested objects read as STRING come back as their JSON text.
    T.StructField("requestParameters", S),
    T.StructField("responseElements", S),
])

TRAIL_FILE = T.StructType([T.StructField("Records", T.ArrayType(TRAIL_RECORD))])

# Trail rows as the enrichment consumes them: record fields + partition values.
TRAIL = T.StructType(TRAIL_RECORD.fields + [
    T.StructField("region", S),
    T.StructField("day", S),
])

# Query-history JSON lines (file columns); partitions region/day/workgroup.
HISTORY_FILE = T.StructType([
    T.StructField("query_id", S),
    T.StructField("query", S),
    T.StructField("data_scanned", T.LongType()),
    T.StructField("status", S),
    T.StructField("state_change_reason", S),
    T.StructField("submission_time", S),
])
HISTORY_PARTITIONS = ("region", "day", "workgroup")
HISTORY = T.StructType(HISTORY_FILE.fields + [T.StructField(c, S) for c in HISTORY_PARTITIONS])

# Raw query-execution records as landed from the service (input of ingest).
EXECUTION = T.StructType([
    T.StructField("QueryExecutionId", S),
    T.StructField("Query", S),
    T.StructField("WorkGroup", S),
    T.StructField("Statistics", T.StructType([T.StructField("DataScannedInBytes", T.LongType())])),
    T.StructField("Status", T.StructType([
        T.StructField("State", S),
        T.StructField("StateChangeReason", S),
        T.StructField("SubmissionDateTime", S),
        T.StructField("CompletionDateTime", S),
    ])),
])

COST_TYPE = T.DecimalType(12, 8)

# Enriched event table, column order as declared (data columns, then partitions).
EVENT_DATA_COLUMNS = (
    "query_id", "event_time", "source_identity", "on_behalf_of_user_id",
    "user_identity_type", "user_identity_principal", "user_identity_arn",
    "source_ip", "user_agent", "workgroup", "query", "database", "status",
    "state_change_reason", "data_scanned", "cost",
)
EVENT_PARTITIONS = ("region", "day")
STAGING_COLUMNS = EVENT_DATA_COLUMNS + EVENT_PARTITIONS
EVENT_COLUMNS = EVENT_DATA_COLUMNS + ("classification_tier",) + EVENT_PARTITIONS

_EVENT_TYPES = {
    "event_time": T.TimestampNTZType(),
    "data_scanned": T.LongType(),
    "cost": COST_TYPE,
}
EVENTS = T.StructType([T.StructField(c, _EVENT_TYPES.get(c, S)) for c in EVENT_COLUMNS])
STAGING = T.StructType([f for f in EVENTS.fields if f.name != "classification_tier"])

TIERS = T.StructType([T.StructField("db", S), T.StructField("tbl", S), T.StructField("tier", S)])

# Tag-search dump (input of the tier source): one table per element.
TAG_SEARCH = T.StructType([
    T.StructField("TableList", T.ArrayType(T.StructType([
        T.StructField("Table", T.StructType([
            T.StructField("DatabaseName", S),
            T.StructField("Name", S),
        ])),
        T.StructField("LFTagsOnTable", T.ArrayType(T.StructType([
            T.StructField("TagKey", S),
            T.StructField("TagValues", T.ArrayType(S)),
        ]))),
    ]))),
])
TIER_TAG_KEY = "classification_tier"

GRANTS = T.StructType([T.StructField(c, S) for c in ("principal", "catalog", "db", "tbl", "privileges")])

# Listing of permissions (input of the grants source).
_TABLE_RESOURCE = T.StructType([T.StructField("DatabaseName", S), T.StructField("Name", S)])
PERMISSION_DUMP = T.StructType([
    T.StructField("PrincipalResourcePermissions", T.ArrayType(T.StructType([
        T.StructField("Principal", T.StructType([T.StructField("DataLakePrincipalIdentifier", S)])),
        T.StructField("Resource", T.StructType([
            T.StructField("Catalog", T.MapType(S, S)),
            T.StructField("Database", T.StructType([T.StructField("Name", S)])),
            T.StructField("Table", _TABLE_RESOURCE),
            T.StructField("TableWithColumns", _TABLE_RESOURCE),
        ])),
        T.StructField("Permissions", T.ArrayType(S)),
    ]))),
])
