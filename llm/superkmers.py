"""Runs of windows that share a minimiser, packed and sent to one bucket.

A window is a fixed number of places. Each place carries a hash of the m values that
begin there. The leftmost smallest hash in a window is its minimiser; equal windows
have equal ones, so they meet in the bucket of that hash. Consecutive windows with the
same minimiser make one super-k-mer, which travels as one string.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import text as T
from sieveframe.sources.scratch import settle

PACKED = 12 << 20  # bytes of text whose super-k-mers are packed together
BUCKET_TEXT = 4 << 20  # bytes of text whose strings make a bucket, about
BUCKETS_A_TASK = 8
LEVEL = 6  # of compression
_READ = pa.Codec("zstd")
ROW_KEY = "row_key"


class Runs(NamedTuple):
    """Super-k-mers: minimiser hash, first and last window start, row, place number."""

    hash: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    place: np.ndarray


def runs(
    places: np.ndarray,
    values: np.ndarray,
    row: np.ndarray,
    offsets: np.ndarray,
    reach: int,
    width: int,
) -> Runs:
    """The super-k-mers of rows; row r has the positions offsets[r] to offsets[r + 1].

    ``places`` hold the positions that can be a minimiser, in order, ``values`` their
    hashes. A window that begins at s sees places s to s + reach - 1 and is ``width``
    positions wide. A place is the minimiser of the windows that see it, no smaller
    place, and no equal place before it.
    """
    if not len(places):
        none = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint64), none, none, none, none)
    first = np.maximum(places - reach + 1, offsets[row])
    last = np.minimum(places, offsets[row + 1] - width)
    n = len(places)
    left = np.flatnonzero(last >= first)
    step = 1
    while len(left):
        other = left - step
        ok = other >= 0
        left, other = left[ok], other[ok]
        near = places[other] >= first[left]
        left, other = left[near], other[near]
        stops = values[other] <= values[left]
        first[left[stops]] = places[other[stops]] + 1
        left = left[~stops]
        step += 1
    right = np.flatnonzero(last >= first)
    step = 1
    while len(right):
        other = right + step
        ok = other < n
        right, other = right[ok], other[ok]
        near = places[other] < last[right] + reach
        right, other = right[near], other[near]
        stops = values[other] < values[right]
        last[right[stops]] = places[other[stops]] - reach
        right = right[~stops]
        step += 1
    some = np.flatnonzero(last >= first)
    return Runs(values[some], first[some], last[some], row[some], some)


class Packed(NamedTuple):
    """Strings of one bucket: bytes, lengths, minimisers, weights; and who owns them.

    A weight of 2 stands for a string that was there twice or more in its batch;
    its owners already know that all its windows recur, so start is -1.
    """

    data: np.ndarray
    lengths: np.ndarray
    minimiser: np.ndarray
    weight: np.ndarray
    owner: np.ndarray
    key: np.ndarray
    start: np.ndarray


_FIELDS = ("i8", "u8", "i8", "i8", "i8", "i8")


def _freeze(p: Packed, codec: pa.Codec) -> bytes:
    head = np.array([len(p.lengths), len(p.data)], np.int64)
    parts = [head, *(np.asarray(x, t) for x, t in zip(p[1:], _FIELDS))]
    raw = b"".join([*(x.tobytes() for x in parts), bytes(p.data)])
    return len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)


def _thaw(blob: bytes) -> Packed:
    size = int.from_bytes(blob[:8], "little")
    raw = _READ.decompress(blob[8:], size, asbytes=True)
    n, body = np.frombuffer(raw, np.int64, 2)
    at, columns = 16, []
    for kind in _FIELDS:
        columns.append(np.frombuffer(raw, kind, n, at))
        at += 8 * int(n)
    return Packed(np.frombuffer(raw, np.uint8, body, at), *columns)


class Found(NamedTuple):
    """What a batch of rows gives: canonical bytes, runs, and each run's byte range."""

    data: np.ndarray
    runs: Runs
    begin: np.ndarray
    end: np.ndarray
    content: np.ndarray
    start: np.ndarray


PACKED_SCHEMA = "bucket int, packed binary, owner long, key long, a long, b long"
SPAN_SCHEMA = "owner long, key long, a long, b long"


def pack(
    docs: DataFrame,
    find: Callable[[np.ndarray, np.ndarray], Found],
    width: int,
    buckets: int,
    with_minimiser: bool = False,
    level: int = LEVEL,
) -> DataFrame:
    """Strings by bucket, and at once the spans of strings that recur in their batch.

    Rows without ``packed`` are such spans; they pass through the buckets unchanged,
    dealt by owner.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, limit=PACKED):
            ids = part.rows.column("doc_id").cast(pa.int64())
            owner = np.asarray(ids.fill_null(0), np.int64)
            key = np.asarray(part.rows.column(ROW_KEY), np.int64)
            strings = []
            at = 0
            # Hashing takes smaller pieces than packing.
            while at < part.rows.num_rows:
                to = int(np.searchsorted(part.offsets, part.offsets[at] + T.SLICE, "right"))
                to = max(at + 1, min(to - 1, part.rows.num_rows))
                lo, hi = part.offsets[at], part.offsets[to]
                got = find(part.data[lo:hi], part.offsets[at : to + 1] - lo)
                body = got.data.tobytes()
                text = [body[i:j] for i, j in zip(got.begin.tolist(), got.end.tolist())]
                r = got.runs
                strings.append((text, got, owner[at:to][r.row], key[at:to][r.row]))
                at = to
            yield from _deal(strings, width, buckets, with_minimiser, level)

    return docs.mapInArrow(work, PACKED_SCHEMA)


def _deal(
    strings: list, width: int, buckets: int, with_minimiser: bool, level: int
) -> Iterator[pa.RecordBatch]:
    text = [t for part in strings for t in part[0]]
    if not text:
        return
    gather = lambda f: np.concatenate([f(part) for part in strings])
    content = gather(lambda p: p[1].content)
    minimiser = gather(lambda p: p[1].runs.hash)
    start = gather(lambda p: p[1].start)
    windows = gather(lambda p: p[1].runs.last - p[1].runs.first)
    owner, key = gather(lambda p: p[2]), gather(lambda p: p[3])
    order = np.argsort(content, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = content[order][1:] != content[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    if many.any():
        yield _spans(
            owner[many], key[many], start[many], start[many] + windows[many] + width,
            bucket=_dealt(owner[many], key[many], buckets),
        )
    lead = np.zeros(len(order), bool)
    lead[order[new]] = True
    one = np.flatnonzero(lead)
    bucket = (T.mix(minimiser[one] ^ np.uint64(7)) % np.uint64(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    one, bucket = one[by], bucket[by]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cuts[1:], len(one))
    names, blobs, held = [], [], 0
    codec = pa.Codec("zstd", compression_level=level)
    for i, j in zip(cuts.tolist(), ends.tolist()):
        of = one[i:j]
        mine = [text[k] for k in of.tolist()]
        blob = _freeze(
            Packed(
                np.frombuffer(b"".join(mine), np.uint8),
                np.fromiter(map(len, mine), np.int64, len(mine)),
                minimiser[of] if with_minimiser else np.zeros(len(of), np.uint64),
                1 + many[of],
                np.where(many[of], -1, owner[of]),
                key[of],
                np.where(many[of], -1, start[of]),
            ),
            codec,
        )
        names.append(bucket[i])
        blobs.append(blob)
        held += len(blob)
        if held > 16 << 20:
            yield _blobs(names, blobs)
            names, blobs, held = [], [], 0
    if names:
        yield _blobs(names, blobs)


def _dealt(owner: np.ndarray, key: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each row; copies of a text share the key, so the owner counts too."""
    both = T.mix(owner.view(np.uint64)) ^ key.view(np.uint64)
    return (T.mix(both) % np.uint64(buckets)).astype(np.int32)


def _blobs(buckets: list, blobs: list) -> pa.RecordBatch:
    none = pa.nulls(len(blobs), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary()), *[none] * 4],
        names=["bucket", "packed", "owner", "key", "a", "b"],
    )


def _spans(owner, key, a, b, bucket=None) -> pa.RecordBatch:
    columns = {"owner": owner, "key": key, "a": a, "b": b}
    arrays = [pa.array(np.asarray(x, np.int64)) for x in columns.values()]
    if bucket is None:
        return pa.RecordBatch.from_arrays(arrays, names=list(columns))
    packed = pa.nulls(len(bucket), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), packed, *arrays], names=["bucket", "packed", *columns]
    )


def join_packed(parts: list[Packed]) -> Packed:
    return Packed(*(np.concatenate(column) for column in zip(*parts)))


def spans(
    packed: DataFrame,
    recurring: Callable[[Packed], tuple[np.ndarray, np.ndarray]],
    width: int,
    buckets: int,
) -> DataFrame:
    """The spans of all windows that start more than once.

    ``recurring`` takes a bucket and gives string number and place of each such window.
    Buckets come one after the other, so a task holds one of them.
    """

    def answer(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        p = join_packed([_thaw(x) for x in blobs])
        string, place = recurring(p)
        ask = p.start[string] >= 0
        string, place = string[ask], place[ask]
        if not len(string):
            return
        # Windows that follow each other make one span.
        new = np.ones(len(string), bool)
        new[1:] = (string[1:] != string[:-1]) | (place[1:] > place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(string)) - 1
        own = string[first]
        yield _spans(
            p.owner[own], p.key[own],
            p.start[own] + place[first], p.start[own] + place[last] + width,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            known = pc.is_null(batch.column("packed"))
            yield batch.filter(known).select(["owner", "key", "a", "b"])
            rest = batch.filter(pc.invert(known))
            for b, blob in zip(rest.column("bucket").to_pylist(), rest.column("packed")):
                if b != bucket and held:
                    yield from answer(held)
                    held = []
                bucket = b
                held.append(blob.as_py())
        if held:
            yield from answer(held)

    tasks = -(-buckets // BUCKETS_A_TASK)
    placed = packed.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket")
    return placed.mapInArrow(work, SPAN_SCHEMA)


def with_row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and a 64-bit hash that tells rows of one doc_id apart, or of none."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        "text",
        F.xxhash64("text", doc_id.isNull()).alias(ROW_KEY),
    )


def with_spans(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """Each row with its list of spans, null without any.

    Equal rows share their spans, each of which all of them report; one is kept.
    """
    lists = found.groupBy("owner", "key").agg(
        F.collect_set(F.struct("a", "b")).alias("spans")
    )
    same = (F.coalesce(F.col("doc_id"), F.lit(0)) == F.col("owner")) & (
        F.col(ROW_KEY) == F.col("key")
    )
    return keyed.join(lists, same, "left").select("doc_id", "text", "spans")


def removed(spans_: pa.ListArray, offsets: np.ndarray) -> np.ndarray:
    """Flags over the positions of all rows; row r has offsets[r] to offsets[r + 1]."""
    step = np.zeros(offsets[-1] + 1, np.int32)
    sizes = pc.fill_null(pc.list_value_length(spans_), 0)
    flat = spans_.flatten()
    if len(flat):
        base = np.repeat(offsets[:-1], np.asarray(sizes, np.int64))
        np.add.at(step, base + np.asarray(flat.field("a"), np.int64), 1)
        np.add.at(step, base + np.asarray(flat.field("b"), np.int64), -1)
    return np.cumsum(step[:-1]) > 0


COUNTED = "gram long, n long"


def counted_rows(grams: np.ndarray, counts: np.ndarray, size: int) -> pa.RecordBatch:
    """Hashes with their counts, and as a row without a hash the bytes looked at."""
    names = np.append(grams.view(np.int64), 0)
    none = np.zeros(len(names), bool)
    none[-1] = True
    numbers = np.append(counts.astype(np.int64), size)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, mask=none), pa.array(numbers)], names=["gram", "n"]
    )


def summed(counts: DataFrame) -> DataFrame:
    return settle(counts.groupBy("gram").agg(F.sum("n").alias("n")), "frequent-runs")


def text_bytes(counts: DataFrame) -> int:
    found = counts.filter("gram IS NULL").first()
    return found["n"] if found else 0


def most_frequent(counts: DataFrame, often: Column, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that are there often with their counts, ``most`` at most."""
    got = (
        counts.filter("gram IS NOT NULL").filter(often)
        .orderBy(F.desc("n"), "gram").limit(most).toArrow()
    )
    grams = np.asarray(got.column("gram"), np.int64).view(np.uint64)
    return grams, np.asarray(got.column("n"), np.int64)


def buckets_for(size: int) -> int:
    """How many buckets this many bytes of text fill, whatever the session's settings."""
    return BUCKETS_A_TASK * max(1, -(-size // (BUCKET_TEXT * BUCKETS_A_TASK)))
