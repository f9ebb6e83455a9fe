"""Date arithmetic. ``as_of`` defaults to today; pass a date for repeatable output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace import fixed_values as fixed

AsOf = Column | dt.date | str | None


def as_of_date(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.to_date(F.lit(as_of))


def age_years(dob: Column, as_of: AsOf = None) -> Column:
    """Completed years between ``dob`` and ``as_of`` (bigint, NULL in NULL out)."""
    return F.floor(F.months_between(as_of_date(as_of), dob) / 12)


def tenure_days(joined: Column, as_of: AsOf = None) -> Column:
    return F.datediff(as_of_date(as_of), joined)


def out_of_range(dob: Column, as_of: AsOf = None, earliest: str = fixed.EARLIEST_DOB) -> Column:
    """True before ``earliest`` or after ``as_of``; NULL for a NULL date."""
    return (dob < F.to_date(F.lit(earliest))) | (dob > as_of_date(as_of))


def date_parts(col: Column, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_year": F.year(col),
        f"{prefix}_month": F.month(col),
        f"{prefix}_day": F.dayofmonth(col),
    }
