"""Unused grants: wildcards, catalogs, quoting and role sessions."""

import json

import pytest

from qtrail.operators import grants as G
from qtrail.schemas import GRANTS
from qtrail.sources.grants import grants_from_permission_dump, grants_from_table

ROLE = "arn:aws:iam::1:role/analyst"
SESSION = "arn:aws:sts::1:assumed-role/analyst/maria"

TEXTS = [
    ("SELECT * FROM a.b", [(None, "a", "b")]),
    ("select * from\n\tA . B join `c-d`.`e f` x", [(None, "a", "b"), (None, "c-d", "e f")]),
    ('SELECT * FROM "lake"."raw"."clicks"', [("lake", "raw", "clicks")]),
    ("insert into t select 1 from cat.db.t2", [(None, None, "t"), ("cat", "db", "t2")]),
    ("UPDATE x.y SET z = 1", [(None, "x", "y")]),
    ("", []),
    (None, []),
    ("SELECT 1", []),
]


@pytest.mark.parametrize("text,want", TEXTS)
def test_qualified_refs(spark, text, want):
    [r] = spark.createDataFrame([(text,)], "q string").select(G.qualified_refs("q").alias("r")).collect()
    assert [(x.catalog, x.db, x.tbl) for x in r.r] == want


def uses(spark, rows):
    cols = "source_identity string, user_identity_arn string, on_behalf_of_user_id string, query string, database string, day string"
    return spark.createDataFrame(rows, cols)


def granted(spark, rows):
    return spark.createDataFrame([(*r, "SELECT") for r in rows], GRANTS)


def test_a_grant_is_used_at_any_level_that_covers_the_table(spark):
    events = uses(spark, [("maria", SESSION, None, "SELECT * FROM Sales.Orders JOIN lake.raw.clicks", "x", "2024-01-01"),
                          ("maria", SESSION, "dir-1", "SELECT * FROM people", "HR", "2024-01-03"),
                          ("pedro", None, None, "SELECT * FROM people", "", "2024-01-02"),
                          (None, None, None, "SELECT * FROM finance.ledger", "", "2024-01-02")])
    used = [("maria", None, "sales", "orders"), ("maria", None, "SALES", "*"), ("maria", None, "*", "*"),
            (ROLE, "AwsDataCatalog", "hr", "people"), (SESSION, "lake", "raw", "*"), (ROLE, "LAKE", "*", "*"),
            ("dir-1", None, "hr", "people"), ("pedro", None, "default", "people")]
    idle = [("maria", None, "raw", "clicks"), ("maria", "lake", "sales", "orders"), ("pedro", None, "sales", "*"),
            ("dir-1", None, "sales", "*"), ("pedro", None, "finance", "ledger"), ("nobody", None, "*", "*"),
            (None, None, "sales", "orders"), ("maria", None, None, None), ("dir-1", "lake", "*", "*")]
    grants = granted(spark, used + idle + idle[:1])
    left = sorted((r[:4] for r in G.unused_grants(grants, events).collect()), key=repr)
    assert left == sorted(idle + idle[:1], key=repr)
    got = {tuple(r[:4]): (r.uses, r.last_day) for r in G.grant_usage(grants, events).collect()}
    assert got[("maria", None, "*", "*")] == (2, "2024-01-03")
    assert got[(ROLE, "LAKE", "*", "*")] == (1, "2024-01-01")
    assert got[("nobody", None, "*", "*")] == (0, None)
    assert G.unused_grants(grants.limit(0), events).count() == 0
    assert G.unused_grants(grants, events.limit(0)).count() == len(used + idle) + 1


def test_plan_is_an_equi_anti_join_with_partial_sums(spark):
    events = uses(spark, [("maria", None, None, "SELECT * FROM a.b", "x", "2024-01-01")])
    plan = G.unused_grants(granted(spark, [("maria", None, "a", "b")]), events)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan and "Python" not in plan


def test_hot_principal_has_one_row_per_table(spark):
    events = uses(spark, [("hot" if n % 2 else f"u{n}", None, None, f"SELECT * FROM db.t{n % 3}", "x", f"2024-01-{1 + n % 9:02d}")
                          for n in range(600)])
    usage = G.table_usage(events)
    assert usage.where("principal = 'hot'").count() == 3
    assert usage.where("principal = 'hot'").agg({"uses": "sum"}).first()[0] == 300


def test_sources(spark, tmp_path):
    dump = {"PrincipalResourcePermissions": [
        {"Principal": {"DataLakePrincipalIdentifier": ROLE}, "Resource": {"Table": {"DatabaseName": "a", "Name": "b"}},
         "Permissions": ["SELECT", "DESCRIBE"]},
        {"Principal": {"DataLakePrincipalIdentifier": "p"}, "Resource": {"Table": {"DatabaseName": "a", "TableWildcard": {}}},
         "Permissions": ["ALL"]},
        {"Principal": {"DataLakePrincipalIdentifier": "p"}, "Resource": {"TableWithColumns": {"DatabaseName": "a", "Name": "c"}},
         "Permissions": ["SELECT"]},
        {"Principal": {"DataLakePrincipalIdentifier": "p"}, "Resource": {"Database": {"Name": "d"}}, "Permissions": ["ALL"]},
        {"Principal": {"DataLakePrincipalIdentifier": "p"}, "Resource": {"Catalog": {}}, "Permissions": ["ALL"]},
        {"Principal": {"DataLakePrincipalIdentifier": "p"}, "Resource": {"DataLocation": {"ResourceArn": "x"}}, "Permissions": []}]}
    path = tmp_path / "dump.json"
    path.write_text(json.dumps(dump, indent=1))
    got = sorted(tuple(r) for r in grants_from_permission_dump(spark, str(path)).collect())
    assert got == sorted([(ROLE, None, "a", "b", "DESCRIBE,SELECT"), ("p", None, "a", "*", "ALL"), ("p", None, "a", "c", "SELECT"),
                          ("p", None, "d", "*", "ALL"), ("p", None, "*", "*", "ALL")])
    csv = tmp_path / "grants.csv"
    csv.write_text("principal,catalog,db,tbl,privileges\nmaria,,a,*,SELECT\n")
    assert [tuple(r) for r in grants_from_table(spark, str(csv)).collect()] == [("maria", None, "a", "*", "SELECT")]
    lines = tmp_path / "grants.json"
    lines.write_text('{"principal":"maria","db":"a","tbl":"*"}\n')
    assert [tuple(r) for r in grants_from_table(spark, str(lines)).collect()] == [("maria", None, "a", "*", None)]
