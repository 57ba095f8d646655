"""Cleaning steps for any table.

Whether a column is empty or holds only yes/no words is known only after
looking at the whole of it. ``clean`` therefore examines all columns in one
aggregate and then applies everything in one lazy select.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveframe.functions.numbers import present
from sieveframe.functions.text import is_yes_no, snake_name, strip_blank, yes_no


# What a cell can show about its column; the bits of all cells are or-ed.
FILLED, OTHER = 1, 2


@dataclass(frozen=True)
class Verdict:
    """What one look at the whole table settled."""

    empty: frozenset[str]
    flags: frozenset[str]


def rename_snake_case(df: DataFrame) -> DataFrame:
    """Columns in snake_case; two names that become equal are an error."""
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(snake_name(name), []).append(name)
    clash = {new: old for new, old in sources.items() if len(old) > 1}
    if clash:
        raise ValueError(f"columns that get the same name: {clash}")
    return df.toDF(*sources)


def strip_text(df: DataFrame) -> DataFrame:
    """Trim every text column; blank cells become null."""
    text = _text_columns(df)
    return df.select(
        *(
            strip_blank(_col(c)).alias(c) if c in text else _col(c)
            for c in df.columns
        )
    )


def fill_missing(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Replace nulls and NaN per column; names that the table lacks are ignored."""
    out = []
    for field in df.schema:
        col = _col(field.name)
        if field.name in fills:
            value = F.lit(fills[field.name])
            kind = field.dataType
            target = T.StringType() if isinstance(kind, T.NullType) else kind
            held = present(col, kind).cast(target)
            col = F.coalesce(held, value.cast(target)).alias(field.name)
        out.append(col)
    return df.select(*out)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without any value, NaN included (one aggregate over all)."""
    return _drop(df, examine(df, flags=False))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of identical rows; nulls equal each other."""
    return df.dropDuplicates() if df.columns else df


def convert_yes_no(df: DataFrame) -> DataFrame:
    """Text columns with only YES/Y/NO/N (any case) become booleans."""
    return _flag(df, examine(df))


def replace_values(
    df: DataFrame, fixes: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Exact-match replacements per column: {'make': {'Suburu': 'Subaru'}}."""
    for name in fixes.keys() & set(df.columns):
        df = df.replace(dict(fixes[name]), subset=[name])
    return df


def clean(df: DataFrame, fills: Mapping[str, object] | None = None) -> DataFrame:
    """All steps: rename, trim, fill, drop empty columns, dedupe, yes/no.

    Filling comes before dropping so that a filled column stays. The look at
    the data comes before removing duplicates: copies change neither which
    columns are empty nor which values occur.
    """
    ready = prepare(df, fills)
    return finish(ready, examine(ready))


def prepare(df: DataFrame, fills: Mapping[str, object] | None = None) -> DataFrame:
    """The steps of ``clean`` that need no look at the data."""
    return fill_missing(strip_text(rename_snake_case(df)), fills or {})


def finish(df: DataFrame, verdict: Verdict) -> DataFrame:
    """The steps of ``clean`` that follow from the look at the data."""
    return _flag(drop_duplicates(_drop(df, verdict)), verdict)


def examine(df: DataFrame, flags: bool = True) -> Verdict:
    """One pass: which columns are empty, which hold only yes/no words."""
    text = _text_columns(df) if flags else []
    looks = [
        look(present(_col(f.name), f.dataType), f.name in text).alias(f"_{i}")
        for i, f in enumerate(df.schema)
    ]
    bits = seen(df.select(F.lit(0).alias("_none"), *looks))
    return verdict(dict(zip(df.columns, bits[1:])), text)


def look(cell: Column, text: bool) -> Column:
    """What one cell shows about its column, as bits."""
    word = F.when(is_yes_no(cell), FILLED) if text else F.when(F.lit(True), FILLED)
    return F.when(cell.isNull(), 0).otherwise(word.otherwise(FILLED | OTHER))


def seen(looks: DataFrame) -> list[int]:
    """The bits that occur in each column: one small aggregate per column."""
    return list(looks.agg(*(F.bit_or(c).alias(c) for c in looks.columns)).first())


def verdict(bits: Mapping[str, int | None], text: Iterable[str]) -> Verdict:
    """The decisions; a table without rows has only empty columns."""
    filled = {c for c, found in bits.items() if (found or 0) & FILLED}
    return Verdict(
        empty=frozenset(bits) - filled,
        flags=frozenset(c for c in text if c in filled and not bits[c] & OTHER),
    )


def _drop(df: DataFrame, verdict: Verdict) -> DataFrame:
    return df.select(*(_col(c) for c in df.columns if c not in verdict.empty))


def _flag(df: DataFrame, verdict: Verdict) -> DataFrame:
    return df.select(
        *(
            yes_no(_col(c)).alias(c) if c in verdict.flags else _col(c)
            for c in df.columns
        )
    )


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _col(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
