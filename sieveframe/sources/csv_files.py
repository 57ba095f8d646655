"""CSV ingest with explicit rules for missing values, types and dates.

Everything is read as text. One aggregate then looks at all cells of all
columns and settles the types, and one lazy select applies them. Callers who
know the types pass ``types`` and skip that look.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveframe.functions.dates import has_zone, parse_iso
from sieveframe.functions.text import snake_name, strip_blank
from sieveframe.operators import cleaning

# The only cells that mean "missing". "NA" or "None" are text.
MISSING = ("?", "")
# The spellings that make a column boolean.
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")

# Fixed patterns: what counts as a number. '12d' or 'NaN' stay text.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_MAX_UNSIGNED = 2**64 - 1
_BROKEN = "broken_line"

# What a cell can show about the type of its column. A look gives one of these
# bits, and the bits of all cells are or-ed: one small aggregate per column.
_NULL, _FLAG, _INT, _NEGATIVE, _UNSIGNED, _OVER, _FLOAT, _TEXT = (
    1 << i for i in range(8)
)
_DATE, _NO_DATE, _ZONED = _INT, _TEXT, _OVER
# Patterns come first: a cast that fails raises and catches an error for every
# cell of text, which costs about ten times as much as a pattern. Before the patterns
# goes a look at the first byte: no number begins with a letter but inf does.
_TYPE_LOOK = f"""
CASE WHEN cell IS NULL THEN {_NULL}
     WHEN cell >= 'A' AND NOT (startswith(cell, 'i') OR startswith(cell, 'I')) THEN
       CASE WHEN cell IN {TRUE_WORDS + FALSE_WORDS} THEN {_FLAG} ELSE {_TEXT} END
     WHEN cell RLIKE r'{_WHOLE}' THEN
       CASE WHEN try_cast(cell AS BIGINT) >= 0 THEN {_INT}
            WHEN try_cast(cell AS BIGINT) < 0 THEN {_INT | _NEGATIVE}
            WHEN try_cast(cell AS DECIMAL(38, 0)) BETWEEN 0 AND {_MAX_UNSIGNED}
              THEN {_UNSIGNED}
            ELSE {_OVER} END
     WHEN cell RLIKE r'{_NUMBER}' THEN {_FLOAT}
     WHEN cell IN {TRUE_WORDS + FALSE_WORDS} THEN {_FLAG}
     ELSE {_TEXT} END
"""
# What a line can show about the file.
_OPEN_QUOTE, _LONG = 1, 2
LOOKS_AT_ONCE = 8


def load_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """One CSV file (or folder of parts) with a header, typed.

    ``types`` maps column names to Spark types and replaces the inference; a
    cell that does not fit its declared type raises when read, and so does a line
    that breaks off inside quotes or has more cells than the header. ``multi_line``
    allows line breaks inside quotes, at the price that a file is one task.
    """
    names, raw = read_text_cells(spark, path, multi_line)
    if types is None:
        types = _types_of(names, _seen(raw, names, path)[0])
    else:
        raw = raw.filter(_whole_line(len(names), path))
    return _typed(raw, names, types)


def load_inbox(spark: SparkSession, folder: str, **options) -> dict[str, DataFrame]:
    """Every *.csv file of a folder by file name, in name order.

    Each file is a table of its own and needs its own look at the data; the
    looks run side by side.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select("path")
    )
    paths = sorted(row.path for row in listing.collect())
    with ThreadPoolExecutor(LOOKS_AT_ONCE) as pool:
        loaded = pool.map(lambda path: load_csv(spark, _literal(path), **options), paths)
        return {PurePosixPath(p).stem: df for p, df in zip(paths, loaded)}


def _literal(path: str) -> str:
    """The path with the characters escaped that would make it a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def load_clean(
    spark: SparkSession,
    path: str,
    fills: Mapping[str, object] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Same result as ``clean(load_csv(path), fills)`` with one look at the file.

    The types and the cleaning decisions come from the same aggregate, so the
    file is parsed twice (look, use) and not three times.
    """
    fills = fills or {}
    names, raw = read_text_cells(spark, path, multi_line)

    ready = strip_blank(F.col("cell"))
    for i, name in enumerate(names):
        fill = fills.get(snake_name(name))
        if fill is not None:
            ready = F.coalesce(ready, F.when(F.col("at") == i, str(fill)))
    bits, filled = _seen(raw, names, path, ready)
    types = _types_of(names, bits)
    text = [c for c in names if types[c] == "string"]
    found = cleaning.verdict(dict(zip(names, filled)), text)
    verdict = cleaning.Verdict(
        empty=frozenset(map(snake_name, found.empty)),
        flags=frozenset(map(snake_name, found.flags)),
    )
    table = cleaning.prepare(_typed(raw, names, types), fills)
    return cleaning.finish(table, verdict)


def read_text_cells(
    spark: SparkSession, path: str, multi_line: bool = False
) -> tuple[list[str], DataFrame]:
    """The column names, and all cells as text with the missing ones null.

    The cells are in columns cell0, cell1, ..., since names in a header may be
    missing or repeat. A further column holds the lines with too few or too
    many cells. All parts of a folder must have the same header.
    """
    reader = spark.read.options(
        escape='"',
        multiLine=multi_line,
        columnNameOfCorruptRecord=_BROKEN,
        # Lines can only be checked whole.
        columnPruning=False,
    )
    first = reader.csv(path).first()
    if first is None:
        raise ValueError(f"{path}: no header")
    names = _unique_names(first)
    cells = [f"cell{i}" for i in range(len(names))]
    # Spark warns about every file whose header differs from the schema, so it
    # gets the header's own names unless they cannot be column names.
    usable = len({str(n).lower() for n in first}) == len(first) and all(first)
    schema = T.StructType()
    for name in [*(first if usable else cells), _BROKEN]:
        schema.add(name, T.StringType())
    raw = reader.schema(schema).csv(path, header=True, enforceSchema=not usable)
    if not usable and len(raw.inputFiles()) > 1:
        raise ValueError(f"{path}: parts need a header of different, non-empty names")
    raw = raw.toDF(*cells, _BROKEN)
    present = (F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in cells)
    return names, raw.select(*present, F.col(_BROKEN))


def _unique_names(header: Iterable[str | None]) -> list[str]:
    """A missing name says its place; a repeated one gets a number."""
    names: list[str] = []
    for i, name in enumerate(header):
        base = (name or f"Unnamed: {i}").removeprefix("\ufeff")
        copies = (f"{base}.{n}" if n else base for n in itertools.count())
        names.append(next(c for c in copies if c not in names))
    return names


def is_date_name(name: str) -> bool:
    return "date" in name.lower()


def _type_looks(names: list[str]) -> list[Column]:
    """The look that each column's own cell gets."""
    return [_type_look(is_date_name(name), f"cell{i}") for i, name in enumerate(names)]


def _type_look(date: bool, cell: str) -> Column:
    return _date_look(F.col(cell)) if date else F.expr(_TYPE_LOOK.replace("cell", cell))


def _date_look(cell: Column) -> Column:
    return (
        F.when(cell.isNull(), _NULL)
        .when(parse_iso(cell).isNull(), _NO_DATE)
        .when(has_zone(cell), _ZONED)
        .otherwise(_DATE)
    )


def _line_look(width: int, line: Column) -> Column:
    """Whether a broken line ends inside quotes or has more cells than the header."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(",")))
    return (
        F.when(line.isNull(), 0)
        .when(bare.contains('"'), _OPEN_QUOTE)
        .when(commas >= width, _LONG)
        .otherwise(0)
    )


def _whole_line(width: int, path: str) -> Column:
    """True; a line that cannot be read whole stops the job."""
    line = F.concat(F.lit(f"{path}: this line is not as wide as the header: "), F.col(_BROKEN))
    return F.when(_line_look(width, F.col(_BROKEN)) == 0, True).otherwise(F.raise_error(line).cast("boolean"))


def _seen(
    raw: DataFrame, names: list[str], path: str, ready: Column | None = None
) -> tuple[list[int | None], list[int | None]]:
    """For each column the bits of its type over all lines; broken lines raise.

    And what its cells show for cleaning, if ``ready`` says what becomes of ``cell`` in
    the column number ``at``. Every cell is a row of its own here, so there is one look
    however many columns there are: one for each of them makes a method that the JVM
    finds too long to compile, and interprets.
    """
    width, at, cell = len(names), F.col("at"), F.col("cell")
    every = F.array(*(_cell(i) for i in range(width)), F.col(_BROKEN))
    cells = raw.select(F.posexplode(every).alias("at", "cell"))
    look = F.when(at == width, _line_look(width, cell))
    dates = [i for i, name in enumerate(names) if is_date_name(name)]
    if dates:
        look = look.when(at.isin(dates), _type_look(True, "cell"))
    measures = [F.bit_or("type").alias("type")]
    if ready is not None:
        # A column of its own, so that each cell is prepared once for its look.
        cells = cells.withColumn("ready", ready)
        measures.append(F.bit_or(cleaning.look(F.col("ready"), True)).alias("filled"))
    looks = cells.withColumn("type", look.otherwise(_type_look(False, "cell")))
    found = {r["at"]: r for r in looks.groupBy("at").agg(*measures).collect()}
    lines = found[width]["type"] if found else 0
    if lines & _OPEN_QUOTE:
        raise ValueError(f"{path}: lines end inside quotes; use multi_line=True")
    if lines & _LONG:
        raise ValueError(f"{path}: lines have more cells than the header")
    if not found:
        return [None] * width, [None] * width
    types = [found[i]["type"] for i in range(width)]
    return types, [found[i]["filled"] if ready is not None else None for i in range(width)]


def _types_of(names: list[str], bits: list[int | None]) -> dict[str, str]:
    return {
        name: _date_type(name, found or 0) if is_date_name(name) else _type(found or 0)
        for name, found in zip(names, bits)
    }


def _type(bits: int) -> str:
    values = bits & ~_NULL
    if values == 0:
        return "string"
    if bits == _FLAG:
        return "boolean"
    if values & ~(_INT | _NEGATIVE) == 0:
        return "bigint"
    if values & ~(_INT | _UNSIGNED) == 0:
        return "decimal(20,0)"
    return "double" if values & ~(_INT | _NEGATIVE | _FLOAT) == 0 else "string"


def _date_type(name: str, bits: int) -> str:
    if bits & _NO_DATE:
        raise ValueError(f"{name}: some values are not ISO 8601 dates")
    if bits & _ZONED:
        raise ValueError(f"{name}: some times carry a zone, which would be lost")
    return "timestamp_ntz"


def _typed(raw: DataFrame, names: list[str], types: Mapping[str, str]) -> DataFrame:
    out = []
    for i, name in enumerate(names):
        cell = _cell(i)
        kind = types.get(name, "string")
        if kind == "timestamp_ntz":
            parsed = parse_iso(cell)
            wrong = F.raise_error(F.concat(F.lit(f"{name} is no date without a zone: "), cell))
            good = parsed.isNotNull() & ~has_zone(cell)
            cell = F.when(cell.isNull() | good, parsed).otherwise(
                wrong.cast("timestamp_ntz")
            )
        elif kind == "boolean":
            cell = F.when(cell.isin(*TRUE_WORDS), True).when(
                cell.isin(*FALSE_WORDS), False
            )
        elif kind != "string":
            cell = cell.cast(kind)
        out.append(cell.alias(name))
    return raw.select(*out)


def _cell(i: int) -> Column:
    return F.col(f"cell{i}")
