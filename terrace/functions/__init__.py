from terrace.functions.dates import age_years, date_parts, out_of_range, tenure_days
from terrace.functions.text import (
    blank_to,
    clean_phone,
    email_predicate,
    is_uk_phone,
    is_valid_email,
    map_values,
    upper_columns,
)

__all__ = [
    "age_years",
    "blank_to",
    "clean_phone",
    "date_parts",
    "email_predicate",
    "is_uk_phone",
    "is_valid_email",
    "map_values",
    "out_of_range",
    "tenure_days",
    "upper_columns",
]
