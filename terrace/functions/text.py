"""Text clean-up as native Column expressions (no Python UDF)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace import fixed_values as fixed


def upper_columns(names: Iterable[str]) -> dict[str, Column]:
    """Column map for ``withColumns`` that upper-cases each named column."""
    return {n: F.upper(n) for n in names}


def map_values(col: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Searched CASE: mapped value, else ``default`` (NULL included)."""
    branches = reduce(lambda acc, kv: acc.when(col == kv[0], F.lit(kv[1])), mapping.items(), F)
    return branches.otherwise(F.lit(default))


def blank_to(col: Column, default: str) -> Column:
    """NULL or blank becomes ``default``; other values stay untrimmed."""
    return F.when(col.isNull() | (F.trim(col) == ""), F.lit(default)).otherwise(col)


def clean_phone(col: Column) -> Column:
    """Keep digits and plus signs only."""
    return F.regexp_replace(F.trim(col), fixed.PHONE_NOISE, "")


def is_uk_phone(col: Column) -> Column:
    return col.rlike(fixed.PHONE_UK)


def is_valid_email(col: Column) -> Column:
    """Strict check; NULL stays NULL."""
    return col.rlike(fixed.EMAIL_STRICT)


def email_predicate(name: str = "email", *, strict: bool = False) -> str:
    """SQL predicate for a quality rule on an e-mail column.

    The loose form accepts any character before the top-level domain.
    """
    pattern = fixed.EMAIL_STRICT if strict else fixed.EMAIL_LOOSE
    return f"{name} IS NOT NULL AND {name} RLIKE '{pattern}'"
