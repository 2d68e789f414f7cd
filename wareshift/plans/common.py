"""Shared parameters and derived frames of the registered queries.

Conventions so Spark and the DuckDB oracle give identical values:
money is summed as ``decimal(15,2)`` (exact, order-independent); counts
and lengths are cast to bigint; dates are ``date``; timestamps stay
``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareshift.sources.tables import Tables

# Report date standing in for now() so results are stable.
AS_OF = dt.date(1998, 8, 15)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def ntz(value: dt.date | dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (compares with the NTZ columns of the test
    tables without a cast on the column, so the filter reaches the scan)."""
    if isinstance(value, dt.datetime):
        s = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, dt.date):
        s = value.strftime("%Y-%m-%d 00:00:00")
    else:
        s = value
    return F.expr(f"TIMESTAMP_NTZ '{s}'")


def dec(c, scale: int = 2) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(f"decimal(15,{scale})")


def add_months(d: dt.date, n: int) -> dt.date:
    m = d.month - 1 + n
    return dt.date(d.year + m // 12, m % 12 + 1, 1)


def stat_cycle(as_of: dt.date = AS_OF) -> dict[str, dt.date]:
    """Calendar row of the last complete month before ``as_of``."""
    this_month = as_of.replace(day=1)
    last_start = add_months(this_month, -1)
    last_end = this_month - dt.timedelta(days=1)
    q_start = dt.date(last_start.year, 3 * ((last_start.month - 1) // 3) + 1, 1)
    return {
        "month_start": last_start,
        "month_end": last_end,
        "next_month_start": this_month,
        "quarter_start": q_start,
        "year_start": dt.date(last_start.year, 1, 1),
        "prior_year_start": dt.date(last_start.year - 1, 1, 1),
        "prior_month_start": add_months(last_start, -12),
        "prior_month_next": add_months(this_month, -12),
    }


def sql_date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"
