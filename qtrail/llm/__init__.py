"""Operators for large-scale training-data pipelines. Nothing else in the
library imports this subpackage; ``__spark_entry__`` adds its queries when it
is present. Each module states its method, its scale plan and its defined
result for nulls, empties, ties and repeats."""
