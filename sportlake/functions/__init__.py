from .scalars import (
    age_floor,
    age_rounded,
    as_percent,
    fix_label,
    is_positive,
    iso_date,
    match_day,
    ratio,
)

__all__ = [
    "age_floor",
    "age_rounded",
    "as_percent",
    "fix_label",
    "is_positive",
    "iso_date",
    "match_day",
    "ratio",
]
