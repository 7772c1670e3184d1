"""Transaction batch validation as Spark jobs.

Rows are DataFrame expressions, whole-file rules are aggregations and
size-checked lookups, and every sink is one distributed write.
"""

__version__ = "0.1.0"
