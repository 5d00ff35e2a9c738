"""Table names after FROM / JOIN / INTO in SQL text, as native regex
functions (no Python UDF). The full text is scanned once for whole matches;
each (short) match is then re-read with the same pattern for its two groups,
which yields exactly the groups of the original match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qtrail.config import TABLE_REF_PATTERN


def table_refs(query_col) -> Column:
    """array<struct<db: string, tbl: string>>. ``db`` is NULL for an
    unqualified name; an empty / NULL text gives an empty array."""
    q = F.coalesce(F.col(query_col) if isinstance(query_col, str) else query_col, F.lit(""))
    pat = F.lit(TABLE_REF_PATTERN)
    matches = F.regexp_extract_all(q, pat, 0)

    def pair(m):
        a, b = F.regexp_extract(m, TABLE_REF_PATTERN, 1), F.regexp_extract(m, TABLE_REF_PATTERN, 2)
        # Unmatched second group is '': then the first group is the table.
        return F.struct(F.when(b == "", F.lit(None)).otherwise(a).alias("db"),
                        F.when(b == "", a).otherwise(b).alias("tbl"))
    return F.transform(matches, pair)
