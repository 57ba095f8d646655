"""Text expressions and the naming rule for columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes, taken from its own definition.
# They all lie below U+3001, so the scan is complete.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# The words that count as yes and no, compared in upper case.
YES_WORDS = ("YES", "Y")
NO_WORDS = ("NO", "N")


def strip_blank(col: Column) -> Column:
    """Trim all Unicode whitespace at both ends; a cell with nothing left is null.

    btrim with a character set checks only the ends of each value, so unlike a
    regular expression its cost does not grow with the text. Even that is left out
    for what begins and ends with a visible ASCII character, as most cells do.
    """
    trimmed = F.nullif(F.btrim(col, F.lit(WHITESPACE)), F.lit(""))
    return F.when(_visible(col) & _visible(F.substring(col, -1, 1)), col).otherwise(trimmed)


def _visible(col: Column) -> Column:
    """Whether the first byte is that of a visible ASCII character; text is compared by bytes."""
    return (col >= F.lit("!")) & (col < F.lit("\x7f"))


def is_yes_no(col: Column) -> Column:
    """Whether a cell is such a word; others are hardly ever upper-cased."""
    short = F.octet_length(col) <= 12  # three characters in UTF-8
    # Nothing but these letters becomes one of them alone in upper case.
    begins = reduce(Column.__or__, (F.startswith(col, F.lit(c)) for c in "YyNn"))
    return short & begins & F.upper(col).isin(*YES_WORDS, *NO_WORDS)


def yes_no(col: Column) -> Column:
    """YES/Y to true, NO/N to false, anything else (and null) to null."""
    word = F.upper(col)
    return F.when(word.isin(*YES_WORDS), True).when(word.isin(*NO_WORDS), False)


def snake_name(name: str) -> str:
    """'unit price (net)' -> 'unit_price_net', 'shipToCity' -> 'ship_to_city'."""
    runs = re.findall("[0-9a-zA-Z]+", name)
    return "_".join(re.sub("([a-z0-9])([A-Z])", r"\1_\2", run) for run in runs).lower()


def sentence(*parts: Column | str) -> Column:
    """Columns and literal text put together; null if a column is null."""
    return F.concat(
        *(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts)
    )
