"""The Spark extraction agrees with the documented cases and with a
Python ``re`` statement of the same rule on generated texts."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from qtrail.config import TABLE_REF_PATTERN
from qtrail.functions.tablerefs import table_refs

CASES = [
    ("SELECT 1 FROM a.b JOIN `c`.`d` x ON 1=1", {("a", "b"), ("c", "d")}),
    ("insert into T select * from (select 1) z", {(None, "T")}),
    ("select * from cat.db.t", {("cat", "db")}),
    ('select * from "db"."t"', set()),
    ("select extract(year from d) from a, b", {(None, "d"), (None, "a")}),
    ("select * from été.tâble", {("été", "tâble")}),
    ("from `my-db`.`t`", {(None, "my")}),
    ("", set()),
    (None, set()),
]

_PY = re.compile(TABLE_REF_PATTERN.replace("(?iU)", ""), re.IGNORECASE)


def py_refs(q):
    if not q:
        return set()
    return {(m.group(1), m.group(2)) if m.group(2) else (None, m.group(1)) for m in _PY.finditer(q)}


def spark_refs(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, q string")
    out = {i: set() for i in range(len(texts))}
    for r in df.select("i", table_refs("q").alias("r")).collect():
        out[r.i] = {(x.db, x.tbl) for x in r.r}
    return [out[i] for i in range(len(texts))]


def test_documented_cases(spark):
    got = spark_refs(spark, [q for q, _ in CASES])
    for (q, want), g in zip(CASES, got):
        assert g == want, q
        assert py_refs(q) == want, q


_words = st.sampled_from(["FROM", "from", "JOIN", "Into", "select", "a", "b_1", "`x`", ".", " . ", "db",
                          "t", ",", "(", ")", "tbl2", "été", "-", "\n", "  ", "FROMX", "xfrom"])


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_words, min_size=1, max_size=12).map(" ".join), min_size=1, max_size=20))
def test_matches_python_regex(spark, texts):
    assert spark_refs(spark, texts) == [py_refs(t) for t in texts]
