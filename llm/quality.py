"""Quality rules from repetition coverage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from llm import text as T

# Published limits, in percent of a text's word characters that lie in
# n-grams found before in the text, by n; in lines equal to an earlier one; and
# symbols in percent of words.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20
SYMBOL_LIMIT = 10
MIN_WORDS = 10
MAX_REPEAT = 20
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in NGRAM_LIMITS)
    + ", base_failed boolean, kept boolean"
)
NAMES = [part.split()[0] for part in COLUMNS.split(", ")]


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of each row of a slice, and the verdict."""
    rows = len(offsets) - 1
    w = T.words(data, offsets)
    n_words = np.bincount(w.row, minlength=rows)
    letters = ~T.is_space(data) & ((data & 0xC0) != 0x80)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(letters, out=sums[1:])
    length = sums[w.ends] - sums[w.starts]
    word_chars = sums[offsets[1:]] - sums[offsets[:-1]]
    out = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": T.per_row(_SYMBOL[data], offsets),
    }

    # Lines: a \n belongs to no line, and a row's end closes its last one.
    breaks = data == 0x0A
    first = np.union1d(offsets[:-1], np.flatnonzero(breaks) + 1)
    first = first[first < len(data)]
    row = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(data)), offsets[row + 1])
    last = last - ((last > first) & breaks[np.maximum(last - 1, 0)])
    chars = sums[last] - sums[first]
    full = chars > 0
    first, last, row, chars = first[full], last[full], row[full], chars[full]
    key = _by_row(T.rolling_bytes(data).of(first, last), row)
    _, again = T.repeated(key)
    out["n_dup_lines"] = np.bincount(row[again], minlength=rows)
    out["dup_line_chars"] = _total(chars[again], row[again], rows)

    rolling = T.Rolling(w.hash, T.WORD_BASES[0])
    candidates = None
    for n in NGRAM_LIMITS:
        hashes = rolling.fixed(n)
        at = np.arange(len(hashes)) if candidates is None else candidates
        at = at[at < len(hashes)]
        at = at[w.row[at] == w.row[at + n - 1]]
        every, later = T.repeated(_by_row(hashes[at], w.row[at]))
        hit = at[every]
        inside = T.covered(at[later], n, len(w.row))
        out[f"dup_chars_{n}"] = _total(length[inside], w.row[inside], rows)
        if n == 5:
            found = T.covered(hit, n, len(w.row))
            out["n_repeat_words"] = np.bincount(w.row[found], minlength=rows)
        # A longer n-gram is found twice only if both its ends are.
        flags = np.zeros(len(w.row) + 1, bool)
        flags[hit] = True
        candidates = hit[flags[hit + 1]]

    failed = (n_words < MIN_WORDS) | (
        100 * out["n_repeat_words"] > MAX_REPEAT * n_words
    )
    bad = failed | (100 * out["dup_line_chars"] > LINE_LIMIT * word_chars)
    bad |= 100 * out["n_symbols"] > SYMBOL_LIMIT * n_words
    for n, limit in NGRAM_LIMITS.items():
        bad |= 100 * out[f"dup_chars_{n}"] > limit * word_chars
    return out | {"base_failed": failed, "kept": ~bad}


def _by_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    return T.mix(hashes + T.mix(row.astype(np.uint64)))


def _total(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, values, rows).astype(np.int64)


def with_quality(docs: DataFrame, column: str = "text") -> DataFrame:
    """Each row with its repetition figures and the verdict ``kept``.

    A text that is null or empty has no words and is not kept. Rows do not see each
    other, so repeated rows, ties and an empty table need no rule. Columns of the
    input that have a figure's name are replaced by it.
    """
    own = [f for f in docs.schema.fields if f.name.lower() not in NAMES]
    kept = docs.select(*(f"`{f.name}`" for f in own))
    schema = StructType(list(own))
    for part in COLUMNS.split(", "):
        schema = schema.add(*part.split())
    mine = [f.name for f in own]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, column):
            found = measure(part.data, part.offsets)
            figures = [pa.array(found[n]) for n in NAMES]
            yield pa.RecordBatch.from_arrays(
                [*part.rows.columns, *figures], names=[*mine, *NAMES]
            )

    return kept.mapInArrow(work, schema)
