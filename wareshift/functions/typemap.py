"""Target type mapping (R9-R11) as ``when`` chains over columns.

The bucket limits and type names are fixed values of the target database.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# String length buckets of the target database, in order.
# varchar limits 50, 255, 2000, 16383; text limit 65535; longtext above.
LENGTH_BUCKETS = (50, 255, 2000, 16383, 65535)
LONGTEXT_LENGTH = 4294967295

# Source type -> target type for the non-string types.
SIMPLE_TYPES = {
    "bigint": "bigint",
    "int": "int",
    "tinyint": "tinyint",
    "double": "double",
    "timestamp": "datetime",
    "boolean": "boolean",
}


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def length_bucket(length) -> Column:
    """Smallest bucket that holds ``length``."""
    n = _c(length)
    expr = F.lit(LONGTEXT_LENGTH).cast("bigint")
    for limit in reversed(LENGTH_BUCKETS):
        expr = F.when(n <= limit, F.lit(limit).cast("bigint")).otherwise(expr)
    return expr


def map_type(src_type, length) -> Column:
    """Target column type; null for a type outside the closed list
    (pair it with :func:`type_error`)."""
    t = F.lower(F.trim(_c(src_type)))
    b = length_bucket(length)
    string_type = (
        F.when(b <= 16383, F.concat(F.lit("varchar("), b.cast("string"), F.lit(") character set utf8mb4")))
        .when(b <= 65535, F.concat(F.lit("text("), b.cast("string"), F.lit(") character set utf8mb4")))
        .otherwise(F.lit("longtext character set utf8mb4"))
    )
    expr = F.when(t == "string", string_type)
    for src, dst in SIMPLE_TYPES.items():
        expr = expr.when(t == src, F.lit(dst))
    return expr.when(t.startswith("decimal"), t)


def type_error(src_type) -> Column:
    t = F.lower(F.trim(_c(src_type)))
    known = t.isin("string", *SIMPLE_TYPES) | t.startswith("decimal")
    return F.when(~known, F.concat(F.lit("unprocessed type "), t))


def map_default(target_type, default_value) -> Column:
    """Varchar default quoted; datetime '0' -> "1970-01-01", other
    datetime defaults dropped; text defaults dropped; rest unchanged."""
    tt = _c(target_type)
    dv = F.coalesce(_c(default_value), F.lit(""))
    return (
        F.when(tt.startswith("varchar") & (dv != ""), F.concat(F.lit('"'), dv, F.lit('"')))
        .when(tt == "datetime", F.when(dv == "0", F.lit('"1970-01-01"')).otherwise(F.lit("")))
        .when(tt.startswith("text"), F.lit(""))
        .otherwise(dv)
    )
