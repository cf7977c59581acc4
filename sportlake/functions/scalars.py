"""Column functions. All of them are built-in expressions, no UDF among them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import codes


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 for a zero denominator or missing counts."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def iso_date(text: Column | str) -> Column:
    """Date of a ``yyyy-MM-dd`` text, null when it cannot be read."""
    return F.try_to_date(text, "yyyy-MM-dd")


def match_day(text: Column | str) -> Column:
    """Date of a text such as ``August 12, 2017 at 1:30:00 PM``, null when unreadable."""
    return F.try_to_date(F.trim(F.substring_index(text, " at ", 1)), "MMMM d, yyyy")


def age_rounded(birth: Column | str, on: Column | str) -> Column:
    """Age in years, days / 365 rounded. Used when a player is rated.

    365 is odd, so no day count falls on one half and the rounding mode is irrelevant.
    """
    return F.round(F.datediff(on, birth) / codes.YEAR_DAYS).cast("int")


def age_floor(birth: Column | str, on: Column | str) -> Column:
    """Age in whole years, days / 365 rounded down. Used when a request names a date."""
    return F.floor(F.datediff(on, birth) / codes.YEAR_DAYS).cast("int")


def as_percent(share: Column) -> Column:
    """Share as a whole percentage, cut and not rounded."""
    return (share * 100).cast("int")


def is_positive(text: Column | str) -> Column:
    """Whether a text holds an integer above 0; unreadable text does not."""
    return F.coalesce(_integer(text) > 0, F.lit(False))


def _integer(text: Column | str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.trim(column).try_cast("int")


def fix_label(label: Column | str) -> Column:
    """Match label with known misspellings of team names put right."""
    fixed = F.col(label) if isinstance(label, str) else label
    for wrong, right in codes.LABEL_ALIASES.items():
        fixed = F.replace(fixed, F.lit(wrong), F.lit(right))
    return fixed
