"""Date expressions. Times are zone-less (TIMESTAMP_NTZ) throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONE = r"\d[T ]\d{1,2}.*(Z|[+-]\d{2}:?\d{2})$"
_COMPACT = r"^\d{8}$"


def day(col: Column) -> Column:
    """The calendar day, whatever the time of day."""
    return F.to_date(col)


def week_start(col: Column) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", col).cast("date")


def days_spanned(first: Column, last: Column) -> Column:
    """Calendar days from first to last, both included."""
    return F.datediff(day(last), day(first)) + 1


def short_day(col: Column) -> Column:
    """'Jan 5'."""
    return F.date_format(col, "MMM d")


def long_day(col: Column) -> Column:
    """'Jan 5, 2015'."""
    return F.date_format(col, "MMM d, yyyy")


def parse_iso(col: Column) -> Column:
    """ISO 8601 text to a zone-less timestamp; null where it is no such date."""
    compact = F.concat_ws(
        "-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2)
    )
    # The pattern is for a line, behind which a line break of two characters may stand.
    return F.when(
        F.octet_length(col).between(8, 11) & col.rlike(_COMPACT), compact.try_cast("timestamp_ntz")
    ).otherwise(col.try_cast("timestamp_ntz"))


def has_zone(col: Column) -> Column:
    """True for times with 'Z' or an offset, which a zone-less type would drop."""
    # The sign stands among the last six characters, or before a line break behind them.
    sign = col.contains("Z") | col.contains("+") | F.contains(F.right(col, F.lit(8)), F.lit("-"))
    return sign & col.rlike(_ZONE)
