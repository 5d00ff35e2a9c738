"""Column expressions (projections), predicates, calendar helpers and the
table-reference extractor — all built from JVM-side ``pyspark.sql.functions``."""
