"""Registered queries on the driver tables (see ``registry``)."""

from wareshift.plans import changes, logs, migrate, reports, statements  # noqa: F401
from wareshift.plans.registry import COVERS, ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL", "COVERS"]
