"""wareshift: warehouse migration, reconciliation, query-log and reporting
operators written as plain PySpark DataFrame transformations.

Every operator is a function ``DataFrame(s) -> DataFrame`` built from
built-in ``pyspark.sql.functions`` so Catalyst can push filters and
projections into the scans and keep the work in whole-stage codegen.
"""

__all__ = ["session"]
