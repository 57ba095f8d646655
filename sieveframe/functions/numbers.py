"""Exact sums, the two rounding rules, safe ratios and number formats.

Two roundings exist side by side. Half-even (``half_even``) is what array
libraries and ``printf``-style formats do; half-up is SQL's ``round`` and is
simply ``F.round``. Each operator names the one it needs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimals that a sum keeps of amounts that are no whole hundredths.
FINE_SCALE = 18
# Up to here every whole hundredth has a double of its own.
_WHOLE_CENTS = 9e13


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum of a column that does not depend on the order of the rows.

    Whole numbers and decimals are exact already. Doubles are summed as the decimals
    that they print as. Amounts of whole hundredths, which money is, go to a long,
    which runs as fast as summing doubles; only others are cast to decimals with
    FINE_SCALE places, row by row. NaN is a missing value. Infinite amounts, and
    totals of more digits than a decimal holds, raise under ANSI mode.
    """
    if not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.sum(name)
    amount = nan_to_null(F.col(name).cast("double"))
    cents = F.rint(amount * F.lit(100.0))
    whole = (cents / F.lit(100.0) == amount) & (F.abs(amount) < F.lit(_WHOLE_CENTS))
    wide = f"decimal(38,{FINE_SCALE})"
    total = F.sum(F.when(whole, cents.cast("bigint"))).cast("decimal(20,0)")
    total = (total * F.lit(Decimal("0.01"))).cast(wide)
    fine = F.sum(F.when(~whole, amount.cast(wide)))
    return F.coalesce(total + fine, total, fine)


def nan_to_null(col: Column) -> Column:
    """NaN stands for a missing number, too."""
    return F.nullif(col, F.lit(float("nan")))


def present(col: Column, kind: T.DataType) -> Column:
    """The column with its missing values as null: for fractional types NaN is one."""
    fractional = isinstance(kind, (T.DoubleType, T.FloatType))
    return nan_to_null(col) if fractional else col


def exact_mean(df: DataFrame, name: str) -> Column:
    """Exact sum over the number of present values, as a double."""
    there = present(F.col(name), df.schema[name].dataType)
    return ratio(exact_sum(df, name), F.count(there))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double; null where the bottom is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column) -> Column:
    """100 * top / bottom, multiplying first."""
    return F.try_divide(F.lit(100.0) * top.cast("double"), bottom.cast("double"))


def rate(flag: Column) -> Column:
    """Share of true values among the present ones."""
    return F.avg(flag.cast("int"))


def half_even(col: Column, digits: int = 0) -> Column:
    """Round a double half to even."""
    if digits == 0:
        return F.rint(col)
    power = F.lit(float(10**digits))
    return F.rint(col * power) / power


def to_bigint(col: Column) -> Column:
    """Nearest whole number, half to even (a plain cast would cut decimals off)."""
    return F.bround(col, 0).cast("bigint")


def fixed(col: Column, digits: int) -> Column:
    """12.34 -> '12.3': fixed decimals, no grouping, half to even."""
    return _format(col, _pattern("0", digits))


def grouped(col: Column, digits: int = 0) -> Column:
    """1234567 -> '1,234,567'."""
    return _format(col, _pattern("#,##0", digits))


def signed(col: Column, digits: int) -> Column:
    """0.04 -> '+0.0', -1.25 -> '-1.2'."""
    body = _pattern("0", digits)
    return _format(col, f"+{body};-{body}")


def as_percent(share: Column, digits: int) -> Column:
    """0.6051 -> '60.5%'."""
    return F.concat(fixed(share * 100, digits), F.lit("%"))


def dollars(col: Column) -> Column:
    """64067.3 -> '$64,067'."""
    return F.concat(F.lit("$"), grouped(col))


def big_dollars(col: Column) -> Column:
    """52761940 -> '$52.8M'; below a million like ``dollars``."""
    millions = F.concat(F.lit("$"), grouped(col / F.lit(1e6), 1), F.lit("M"))
    return F.when(col >= F.lit(1e6), millions).otherwise(dollars(col))


def plain(col: Column) -> Column:
    """A double as text the way Python prints it: 14773770.0, 1e+16, 1e-05.

    Spark's own text has an exponent from ten million on, and below a thousandth. Only
    such numbers are looked at again, in a function of their own, so that the code for
    a table of many amounts stays short enough for the JVM to compile.
    """
    text = col.cast("string")
    again = F.get(F.transform(F.array(col), _without_exponent), 0)
    return F.when(~text.contains("E"), text).otherwise(again)


def _without_exponent(col: Column) -> Column:
    text, size = col.cast("string"), F.abs(col)
    long = F.regexp_replace(col.cast("decimal(38,20)").cast("string"), "0+$", "")
    whole = F.when(long.endswith("."), F.concat(long, F.lit("0"))).otherwise(long)
    short = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "E+$1")
    exponent = F.lower(F.regexp_replace(short, r"([+-])(\d)$", r"$1\0$2"))
    middle = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    return F.when(middle, whole).otherwise(exponent)


def _format(col: Column, pattern: str) -> Column:
    # The Python wrapper of format_number takes only a digit count.
    return F.call_function("format_number", col, F.lit(pattern))


def _pattern(whole: str, digits: int) -> str:
    return whole if digits == 0 else f"{whole}.{'0' * digits}"
