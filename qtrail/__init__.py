"""qtrail: a Spark-native audit of who queries what in a data lake.

Audit-trail start records and query-history records are joined into one
enriched event per query, each event is labelled with the most sensitive
tier among the tables its SQL text names, and the result is written as a
region/day partitioned Parquet table that reports read back as DataFrames.
Everything is expressed with the DataFrame / SQL API so Catalyst plans it.
"""

from qtrail.config import AuditConfig

__all__ = ["AuditConfig"]
__version__ = "0.1.0"
