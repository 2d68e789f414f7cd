"""Scalar column functions (F1-F17, D11) built only from built-in
``pyspark.sql.functions`` so they stay inside whole-stage codegen.

The session runs with ANSI on: plain casts raise on junk, so every lenient
conversion here goes through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 two-argument isnull(a, b) / ifnull(a, b) of the source dialect.
def ifnull(a: ColLike, b: ColLike | object) -> Column:
    return F.coalesce(_c(a), b if isinstance(b, Column) else F.lit(b))


# F2 nullvalue(x): one-argument null test.
def nullvalue(x: ColLike) -> Column:
    return _c(x).isNull()


# F6 / F7 lenient numeric casts: junk -> null instead of an error.
def lenient_double(x: ColLike) -> Column:
    return _c(x).try_cast("double")


def lenient_bigint(x: ColLike) -> Column:
    return _c(x).try_cast("bigint")


# D11 lenient timestamp.  A plain try_cast accepts five-digit years
# (e.g. 133406-03-22), which later breaks consumers; the guard admits only
# year-month-day with a four-digit year and an optional time part.
DATE_GUARD = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( [0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?$"


def lenient_timestamp(x: ColLike) -> Column:
    s = F.trim(_c(x))
    return F.when(s.rlike(DATE_GUARD), s.try_cast("timestamp_ntz"))


def is_junk_timestamp(x: ColLike) -> Column:
    """True when a non-null raw value fails to parse (the quarantine test)."""
    return _c(x).isNotNull() & lenient_timestamp(x).isNull()


# F14 timestamp rounded to the whole second, half away from zero in epoch
# terms (so an exact half second before 1970 rounds to the earlier second).
def round_to_second(ts: ColLike) -> Column:
    t = _c(ts)
    whole = F.date_trunc("second", t)
    frac_us = F.extract(F.lit("SECOND"), t) * 1000000 % 1000000
    up = F.when(F.year(t) >= 1970, frac_us >= 500000).otherwise(frac_us > 500000)
    return F.when(up, whole + F.expr("INTERVAL 1 SECOND")).otherwise(whole).cast("timestamp_ntz")


# F15 date from year/month (day 1).
def month_date(year: ColLike, month: ColLike) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))


# F16 date digits key yyyyMMdd.
def date_key(d: ColLike) -> Column:
    return F.date_format(_c(d), "yyyyMMdd")


# F17 previous / next month start with year wrap.
def month_start(d: ColLike) -> Column:
    return F.trunc(_c(d).cast("date"), "month")


def prev_month_start(d: ColLike) -> Column:
    return F.add_months(month_start(d), -1)


def next_month_start(d: ColLike) -> Column:
    return F.add_months(month_start(d), 1)


def quarter_of_month(month: ColLike) -> Column:
    """ceiling(month / 3) as an int (a computed join key, J11)."""
    return F.ceil(_c(month) / F.lit(3)).cast("int")


def money(x: ColLike, scale: int = 2, precision: int = 15) -> Column:
    """Exact fixed-point measure: sums of decimals do not depend on order."""
    return _c(x).cast(f"decimal({precision},{scale})")
