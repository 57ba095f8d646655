"""Substring dedup over words: windows that recur anywhere are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import superkmers as S
from llm import text as T

WINDOW = 35
MER = 5
# A run of MER words is hot if it is there once in so many rows, or more often.
HOT = 100
HOT_MERS = 1 << 17  # that are looked out for, at most: the most frequent ones
_NONE = np.zeros(0, np.int64)


def _mers(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of MER words that stay in their row."""
    hashes = T.Rolling(w.hash, T.WORD_BASES[1]).fixed(MER)
    inside = w.row[: len(hashes)] == w.row[MER - 1 :] if len(hashes) else _NONE
    places = np.flatnonzero(inside)
    return places, hashes[places]


def hot_mers(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Hashes of the runs of words that are in more than 1 of HOT rows, and bytes of text.

    A slice reports those in over 1 of 2 * HOT of its rows, with their counts: what
    is that common overall is so in some slices, and loses less than half its count
    by those that do not report it. Their sum picks the hashes, HOT_MERS at most,
    whatever the size of the table or of its texts. Only speed depends on them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, limit=4 * T.SLICE):
            w = T.words(part.data, part.offsets)
            places, hashes = _mers(w)
            # Once a row: the first of equal (row, hash) counts.
            seen = T.mix(hashes + T.mix(w.row[places].astype(np.uint64)))
            _, lead = np.unique(seen, return_index=True)
            found, counts = np.unique(hashes[lead], return_counts=True)
            rows = part.rows.num_rows
            often = (counts * 2 * HOT > rows) & (counts > 1)
            yield S.counted_rows(found[often], counts[often], len(part.data))

    counts = S.summed(docs.select("text").mapInArrow(work, S.COUNTED))
    least = F.lit(docs.count() / (2 * HOT))
    hot, _ = S.most_frequent(counts, F.col("n") > least, HOT_MERS)
    return np.sort(hot), S.text_bytes(counts)


def _finder(hot: np.ndarray):
    def find(data: np.ndarray, offsets: np.ndarray) -> S.Found:
        w = T.words(data, offsets)
        # Words joined by one space; the first of a row has none before it.
        size = w.ends - w.starts
        where = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size + 1, out=where[1:])
        keep = ~T.is_space(data)
        out = np.full(where[-1], 0x20, np.uint8)
        at = np.flatnonzero(keep)
        shift = np.repeat(where[:-1] - w.starts, size)
        out[at + shift] = data[at]
        begin, end = where[:-1], where[:-1] + size

        bounds = np.searchsorted(w.row, np.arange(len(offsets)), "left")
        places, values = _mers(w)
        order = T.mix(values) >> np.uint64(1)
        if len(hot):
            # Hot ones come last: a window takes one only if it has nothing else.
            i = np.minimum(np.searchsorted(hot, values), len(hot) - 1)
            order |= (hot[i] == values).astype(np.uint64) << np.uint64(63)
        r = S.runs(places, order, w.row[places], bounds, WINDOW - MER + 1, WINDOW)
        stop = r.last + WINDOW
        content = T.Rolling(w.hash, T.WORD_BASES[0]).of(r.first, stop)
        content ^= T.mix(r.hash)
        return S.Found(
            out, r, begin[r.first], end[stop - 1], content, r.first - bounds[r.row]
        )

    return find


def recurring(p: S.Packed) -> tuple[np.ndarray, np.ndarray]:
    """Sorts a bucket's windows, each as two 64-bit hashes, and counts equal ones."""
    offsets = np.zeros(len(p.lengths) + 1, np.int64)
    np.cumsum(p.lengths, out=offsets[1:])
    held, i = [], 0
    while i < len(p.lengths):
        j = int(np.searchsorted(offsets, offsets[i] + T.SLICE, "right")) - 1
        j = max(i + 1, min(j, len(p.lengths)))
        w = T.words(p.data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        one = T.Rolling(w.hash, T.WORD_BASES[0]).fixed(WINDOW)
        two = T.Rolling(w.hash, T.WORD_BASES[1]).fixed(WINDOW)
        at = np.flatnonzero(w.row[: len(one)] == w.row[WINDOW - 1 :]) if len(one) else _NONE
        row = w.row[at]
        first = np.searchsorted(w.row, np.arange(j - i), "left")
        held.append((one[at], two[at], row + i, at - first[row]))
        i = j
    one, two, string, place = (np.concatenate(x) for x in zip(*held))
    hit = counted(one, two, p.weight[string])
    return string[hit], place[hit]


def counted(one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Flags of the pairs (one, two) whose weights add up to 2 or more."""
    if not len(one):
        return np.zeros(0, bool)
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    total = np.bincount(group, weight[order])
    out = np.empty(len(one), bool)
    out[order] = total[group] >= 2
    return out


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a key, and (owner, key, a, b) of words a to b that recur."""
    keyed = S.with_row_key(docs)
    hot, size = hot_mers(keyed)
    buckets = S.buckets_for(size)
    packed = S.pack(keyed, _finder(hot), WINDOW, buckets)
    return keyed, S.spans(packed, recurring, WINDOW, buckets)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text of every row.

    Words covered by a run of WINDOW words that starts anywhere else are removed; what
    is left is joined by one space. A null text counts as empty. A null doc_id is a
    row like others. Equal rows are copies of each other, so both lose such runs.
    Other columns of the input are not looked at. An empty table gives no rows.
    """
    keyed, found = repeated_spans(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            w = T.words(part.data, part.offsets, hashed=False)
            bounds = np.searchsorted(w.row, np.arange(part.rows.num_rows + 1), "left")
            gone = S.removed(part.rows.column("spans"), bounds)
            body = part.data.tobytes()
            starts, ends = w.starts.tolist(), w.ends.tolist()
            texts = []
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                stay = (np.flatnonzero(~gone[i:j]) + i).tolist()
                texts.append(b" ".join([body[starts[k] : ends[k]] for k in stay]))
            lost = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(gone, out=lost[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    part.rows.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array(lost[bounds[1:]] - lost[bounds[:-1]]),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return S.with_spans(keyed, found).mapInArrow(
        work,
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string",
    )
