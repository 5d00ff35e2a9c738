"""Small inputs of our own making and builders for
hand-made trail / history rows."""

from __future__ import annotations

import gzip
import json
import os

from qtrail.config import QUERY_SERVICE_SOURCE
from qtrail.schemas import HISTORY, TRAIL

GOLDEN_QID = "0b9d5f3e-7a61-4c1f-8a55-2f6c1d9e7a01"
GOLDEN_QID2 = "0b9d5f3e-7a61-4c1f-8a55-2f6c1d9e7a02"

GOLDEN_RECORD = {
    "eventTime": "2022-11-03T21:05:40Z",
    "eventSource": QUERY_SERVICE_SOURCE,
    "eventName": "StartQueryExecution",
    "userIdentity": {"type": "AssumedRole", "principalId": "AUDITED:maria", "userName": "maria",
                     "arn": "arn:x:sts::555:assumed-role/analyst/maria", "accountId": "555"},
    "sourceIPAddress": "10.20.30.40",
    "userAgent": "jdbc/3.0",
    "requestParameters": {"workGroup": "analysts", "queryString": "INSERT INTO mart.visits SELECT * FROM raw.visits",
                          "queryExecutionContext": {"database": "mart"}},
    "responseElements": {"queryExecutionId": GOLDEN_QID},
    "eventVersion": "1.0",  # fields outside the declared schema are ignored
}

GOLDEN_HISTORY = [
    {"query_id": GOLDEN_QID, "query": "SELECT * FROM raw.visits", "data_scanned": 4096, "workgroup": "primary"},
    {"query_id": GOLDEN_QID2, "query": "SELECT 2", "data_scanned": 512, "workgroup": "primary"},
]


def write_trail_file(root: str, region: str, day: str, records, name: str = "data.json") -> str:
    y, m, d = day.split("-")
    folder = os.path.join(root, region, y, m, d)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(json.dumps({"Records": list(records)}))
    return path


def write_history_file(root: str, region: str, day: str, workgroup: str, lines) -> str:
    folder = os.path.join(root, f"region={region}", f"day={day}", f"workgroup={workgroup}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "data.json.gz")
    with gzip.open(path, "wt") as f:
        for line in lines:
            f.write(line if isinstance(line, str) else json.dumps(line))
            f.write("\n")
    return path


def trail_row(qid, region="us-east-1", day="2024-01-02", arn="arn:u1", source=QUERY_SERVICE_SOURCE,
              name="StartQueryExecution", text="SELECT 1", database="db", workgroup="primary",
              source_identity="alice", event_time=None, with_response=True):
    req = json.dumps({"queryString": text, "queryExecutionContext": {"database": database},
                      "workGroup": workgroup})
    resp = json.dumps({"queryExecutionId": qid}) if with_response else None
    ident = ("IAMUser", "P-" + str(qid), arn, "1", None, "AK", "u", (source_identity,), (None,))
    return (ident, event_time or f"{day}T10:00:00Z", source, name, "1.1.1.1", "agent", req, resp, region, day)


def history_row(qid, query="SELECT 1", scanned=100, status="SUCCEEDED", region="us-east-1",
                day="2024-01-02", workgroup="primary", submitted=None):
    return (qid, query, scanned, status, "", submitted if submitted is not None else f"{day}T10:00:00Z",
            region, day, workgroup)


def trail_df(spark, rows):
    return spark.createDataFrame(rows, TRAIL)


def history_df(spark, rows):
    return spark.createDataFrame(rows, HISTORY)
