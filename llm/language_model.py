"""Interpolated modified Kneser-Ney n-grams, counted in Spark, looked up in mapped files.

Words are 64-bit hashes. An n-gram of any length from two words on belongs to the shard of
its last word but one; where that word is hot, its n-grams are dealt to several shards by
their last word. An n-gram and its suffixes are therefore in one shard, which counts all
orders at once. Contexts of a hot word and single words are put together in a second step.
Each shard is one file of sorted hashes with figures for n-grams and one for words, in the
shared folder. Workers map the files and search in them. How many shards there are follows
from the number of tokens.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from sieveframe.sources.scratch import scratch_folder, settle

ORDER = 3  # words of the longest n-grams
# Marks that no word hashes to but by chance.
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)
COUNTED = 20 << 20  # bytes of text whose n-grams are counted together
HOT = 1000  # a word may be hot from one in so many tokens on
SHARD_TOKENS = 4 << 20  # of the text, for each shard; a fourth of it is a part of a hot word
LEAST_SHARDS = 8
MAPPED = 64  # files that a worker has open at a time
HELD = 256 << 20  # bytes of files that a worker holds which it can't map
_BOTH = np.uint64(T.WORD_BASES[0])


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return T.mix(T.mix(first) * _BOTH + second)


def _key(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for the words of each n-gram."""
    out = columns[0]
    for column in columns[1:]:
        out = _pair(out, column)
    return out


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (T.mix(hashes ^ _BOTH) % np.uint64(shards)).astype(np.int32)


@dataclass
class Hot:
    """Sorted hashes of the words whose n-grams are dealt to several parts, and how many."""

    words: np.ndarray
    parts: np.ndarray

    def parts_of(self, words: np.ndarray) -> np.ndarray:
        """1 for a word that is not hot."""
        if not len(self.words):
            return np.ones(len(words), np.uint64)
        i = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[i] == words, self.parts[i], np.uint64(1))

    def shard(self, before: np.ndarray, last: np.ndarray, shards: int) -> np.ndarray:
        """The shard of n-grams by their last two words."""
        parts = self.parts_of(before)
        key = before.copy()
        several = parts > 1
        part = T.mix(last[several]) % parts[several]
        key[several] = _pair(before[several], part)
        return _shard(key, shards)


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Row, hash and place in the row of each token: a row's words and END."""
    rows = len(offsets) - 1
    w = T.words(T.lower(data), offsets)
    count = np.bincount(w.row, minlength=rows)
    ends = np.cumsum(count + 1) - 1
    out = np.full(len(w.row) + rows, END)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = w.hash
    place = np.arange(len(out)) - np.repeat(ends - count, count + 1)
    return np.repeat(np.arange(rows), count + 1), out, place


def ngrams(token: np.ndarray, place: np.ndarray, order: int, start) -> list[np.ndarray]:
    """The words of the n-gram that ends at each token; ``start`` before a row's first."""
    out = [token]
    for back in range(1, order):
        column = np.full_like(token, start)
        at = np.flatnonzero(place >= back)
        column[at] = token[at - back]
        out.insert(0, column)
    return out


def _distinct(ids: list[np.ndarray], size: int, **more):
    """Distinct n-grams of numbers below ``size``, by the last word but one first."""
    bits = max(1, int(size).bit_length())
    order = [ids[-2], *ids[:-2], ids[-1]]
    key, used, steps = order[0].astype(np.int64), bits, []
    for column in order[1:]:
        if used + bits > 63:
            # No room: the n-grams so far are numbered.
            seen, key = np.unique(key, return_inverse=True)
            steps.append(seen)
            used = int(len(seen)).bit_length()
        else:
            steps.append(None)
        key = key << bits | column
        used += bits
    key, *rest = np.unique(key, **more)
    columns = []
    for seen in reversed(steps):
        columns.append(key & ((1 << bits) - 1))
        key = key >> bits
        if seen is not None:
            key = seen[key]
    columns.append(key)
    before, *first, last = reversed(columns)
    return [*first, before, last], *rest


def _compress(parts: list[np.ndarray], head: tuple[int, ...]) -> bytes:
    raw = b"".join(np.ascontiguousarray(p).tobytes() for p in parts)
    return np.array([*head, len(raw)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _raw(blob: bytes, head: int) -> tuple[list[int], bytes]:
    *figures, size = np.frombuffer(blob, np.int64, head + 1).tolist()
    return figures, pa.decompress(blob[8 * (head + 1) :], size, "zstd", asbytes=True)


def _freeze(*columns: np.ndarray) -> bytes:
    return _compress(list(columns), (len(columns[0]),))


def _thaw(blob: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    (n,), raw = _raw(blob, 1)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _planes(x: np.ndarray) -> np.ndarray:
    """First bytes of all numbers, then their second bytes: small numbers pack well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T


def _freeze_ngrams(words: np.ndarray, ids: list[np.ndarray], counts: np.ndarray) -> bytes:
    """The hashes that occur once, sorted; n-grams as numbers of these."""
    used = np.unique(np.concatenate(ids))
    kind = np.dtype("u2" if len(used) <= 1 << 16 else "u4")
    hashes = words[used]
    columns = [np.searchsorted(used, c).astype(kind) for c in ids]
    columns[-2] = np.diff(columns[-2], prepend=kind.type(0))
    parts = [np.diff(hashes, prepend=np.uint64(0)), *columns, counts.astype(np.uint32)]
    return _compress([_planes(p) for p in parts], (len(counts), len(used), len(ids)))


def _thaw_ngrams(blob: bytes) -> list[np.ndarray]:
    """The columns of hashes, then the counts."""
    (n, used, order), raw = _raw(blob, 3)
    kind = "u2" if used <= 1 << 16 else "u4"
    at = 0

    def read(kind: str, n: int) -> np.ndarray:
        nonlocal at
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        at += n * width
        return np.ascontiguousarray(planes.T).view(kind).reshape(n)

    hashes = np.cumsum(read("u8", used), dtype=np.uint64)
    columns = [read(kind, n) for _ in range(order)]
    columns[-2] = np.cumsum(columns[-2], dtype=kind)
    return [*(hashes[c] for c in columns), read("u4", n)]


_NGRAMS = 0  # kinds of rows
_FILE, _CONTEXT, _WORD = -1, 2, 1  # a context of n - 1 words has the kind n
_CONTEXT_COLUMNS = ("u8", "u8", "u4", "u4", "u4")
_WORD_COLUMNS = ("u8", "u8", "u8")
_ROWS = "shard int, kind int, blob binary, path string, figures array<long>"


def _blob_rows(shards: list, kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shards, pa.int32()), pa.array([kind] * len(blobs), pa.int32()),
            pa.array(blobs, pa.binary()), pa.nulls(len(blobs), pa.string()),
            pa.nulls(len(blobs), pa.list_(pa.int64())),
        ],
        names=["shard", "kind", "blob", "path", "figures"],
    )


def _file_row(shard: int, path: str, figures: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()), pa.array([_FILE], pa.int32()),
            pa.nulls(1, pa.binary()), pa.array([path]),
            pa.array([figures], pa.list_(pa.int64())),
        ],
        names=["shard", "kind", "blob", "path", "figures"],
    )


def _by_shard(shard: np.ndarray, kind: int, freeze, *columns: np.ndarray):
    """One compressed row for each shard; columns stay in order."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    names, blobs = [], []
    for i, j in zip(cuts.tolist(), np.append(cuts[1:], len(shard)).tolist()):
        at = order[i:j]
        names.append(shard[i])
        blobs.append(freeze(*(c[at] for c in columns)))
    if names:
        yield _blob_rows(names, kind, blobs)


def hot_words(docs: DataFrame) -> tuple[Hot, int]:
    """The words that fill more than a part of a shard, and the number of all tokens.

    A slice reports words of 1 in 2 * HOT of its tokens or more, so a word of 1 in HOT
    loses less than half its count; at most 2 * HOT words come back. They decide how
    n-grams are dealt, not what is counted.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            _, token, place = tokens(part.data, part.offsets)
            found, counts = np.unique(token, return_counts=True)
            # START stands before a row as END does behind it.
            found[found == END] = START
            often = counts * 2 * HOT >= len(token)
            word = np.append(found[often].view(np.int64), 0)
            n = np.append(counts[often], 0).astype(np.int64)
            size = np.append(np.zeros(len(n) - 1, np.int64), len(token))
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(n), pa.array(size)], names=["word", "n", "size"]
            )

    got = (
        docs.select("text")
        .mapInArrow(work, "word long, n long, size long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    )
    got = settle(got, "frequent-words")
    total = got.agg(F.sum("size")).first()[0] or 0
    part = max(1, SHARD_TOKENS // 4)
    hot = got.filter(F.col("n") * 2 * HOT >= total).filter(F.col("n") > part)
    rows = sorted((r["word"] % 2**64, -(-r["n"] // part)) for r in hot.collect())
    words, parts = (np.array([r[i] for r in rows], np.uint64) for i in (0, 1))
    return Hot(words, parts), int(total)


def _count(docs: DataFrame, hot: Hot, shards: int, order: int) -> DataFrame:
    """Counts of the longest n-grams of each batch, by shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in T.slices(batches):
            held.append(tokens(part.data, part.offsets)[1:])
            size += len(part.data)
            if size >= COUNTED:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        token, place = (np.concatenate(x) for x in zip(*held))
        held.clear()
        words, ids = np.unique(np.append(token, START), return_inverse=True)
        ids = ngrams(ids[:-1].astype(np.int32), place, order, ids[-1])
        ids, counts = _distinct(ids, len(words), return_counts=True)
        shard = hot.shard(words[ids[-2]], words[ids[-1]], shards)

        def freeze(counts: np.ndarray, *ids: np.ndarray) -> bytes:
            return _freeze_ngrams(words, list(ids), counts)

        yield from _by_shard(shard, _NGRAMS, freeze, counts, *ids)

    return docs.select("text").mapInArrow(work, _ROWS)


def _section(keys: np.ndarray, values: list[np.ndarray], exact: bool = False) -> list[np.ndarray]:
    """Sorted keys and figures of each as arrays to write, all of whole 8 bytes.

    Keys are found by their first bits, about 32 of them in a bin, and 32 more bits, so
    one that is not there is taken for another with a chance below 1e-8; with ``exact``
    all 64 bits are kept. Figures are rows of a list: the first 255 rows by a byte,
    others in a list of exceptions. The first row is that of a count of one.
    """
    n = len(keys)
    bits = max(1, n.bit_length() - 5)
    bins = (keys >> np.uint64(64 - bits)).astype(np.int64)
    index = np.zeros((1 << bits) + 1, np.uint32)
    index[1:] = np.cumsum(np.bincount(bins, minlength=1 << bits))
    rest = keys if exact else (keys >> np.uint64(32 - bits)).astype(np.uint32)
    one = np.array([1, 1, 0, 0, 0, 0][: len(values)])
    rare = np.zeros(n, bool)
    for v, x in zip(values, one):
        rare |= v != x
    rare = np.flatnonzero(rare)
    rows = [v[rare] for v in values]
    _, lead, group, often = np.unique(
        _key([r.astype(np.uint64) for r in rows]),
        return_index=True, return_inverse=True, return_counts=True,
    )
    by = np.argsort(-often, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(1, len(by) + 1)
    code = rank[group]
    listed = np.stack([np.append(x, r[lead[by]]).astype(np.int64) for x, r in zip(one, rows)])
    codes = np.zeros(n, np.uint8)
    codes[rare] = np.minimum(code, 255)
    odd = code >= 255
    head = np.array([n, bits, listed.shape[1], int(odd.sum()), int(exact), len(values)], np.int64)
    odd_at, odd_code = rare[odd].astype(np.uint32), code[odd].astype(np.uint32)
    return [_whole(x) for x in (head, listed, index, rest, odd_at, odd_code, codes)]


def _whole(x: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(x).reshape(-1).view(np.uint8)
    return np.append(raw, np.zeros(-len(raw) % 8, np.uint8))


class Section:
    """A section of a file as views of its block."""

    def __init__(self, block: np.ndarray, at: int) -> None:
        self.at = at

        def read(n: int, kind: str) -> np.ndarray:
            size = n * np.dtype(kind).itemsize
            out = block[self.at : self.at + size].view(kind)
            self.at += size + -size % 8
            return out

        self.n, self.bits, listed, odd, self.exact, self.width = read(6, "i8").tolist()
        self.listed = read(listed * self.width, "i8").reshape(self.width, listed)
        self.index = read((1 << self.bits) + 1, "u4")
        self.rest = read(self.n, "u8" if self.exact else "u4")
        self.odd_at, self.odd_code = read(odd, "u4"), read(odd, "u4")
        self.codes = read(self.n, "u1")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The figures of each key, 0 where it is not there."""
        out = np.zeros((self.width, len(keys)))
        if not self.n or not len(keys):
            return out
        bins = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        low, high = self.index[bins].astype(np.int64), self.index[bins + 1].astype(np.int64)
        rest = keys if self.exact else (keys >> np.uint64(32 - self.bits)).astype(np.uint32)
        for _ in range(int((high - low).max()).bit_length()):
            middle = (low + high) >> 1
            less = (low < high) & (self.rest[np.minimum(middle, self.n - 1)] < rest)
            low = np.where(less, middle + 1, low)
            high = np.where(less, high, middle)
        at = np.minimum(low, self.n - 1)
        hit = np.flatnonzero((self.rest[at] == rest) & (low < self.index[bins + 1]))
        at = at[hit]
        code = self.codes[at].astype(np.int64)
        odd = np.flatnonzero(code == 255)
        if len(odd):
            code[odd] = self.odd_code[np.searchsorted(self.odd_at, at[odd])]
        out[:, hit] = self.listed[:, code]
        return out


def _write(folder: str, name: str, sections: list[list[np.ndarray]]) -> str:
    """Sections one after the other in one file of the shared folder; returns its path."""
    system, base = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(path) as out:
        for section in sections:
            for column in section:
                out.write(column.tobytes())
    return path


def _mapped(folder: str, path: str) -> tuple[list[Section], int]:
    """The sections of such a file as views of one block, and bytes that it takes here.

    A file on a mounted disk is mapped once. One elsewhere is read into memory; nothing
    is copied to a local disk.
    """
    system, _ = pyarrow.fs.FileSystem.from_uri(folder)
    if isinstance(system, pyarrow.fs.LocalFileSystem):
        block, size = np.memmap(path, np.uint8, "r"), 0
    else:
        with system.open_input_file(path) as source:
            block = np.frombuffer(source.read_buffer(), np.uint8)
        size = len(block)
    out, at = [], 0
    while at < len(block):
        out.append(Section(block, at))
        at = out[-1].at
    return out, size


def _merge(keys: np.ndarray, *values: np.ndarray):
    """Sorted distinct keys, the place of one row of each, and sums of the values."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = held[1:] != held[:-1]
    lead = np.flatnonzero(new)
    if not len(lead):
        return held, order, [np.zeros(0, np.int64) for _ in values]
    sums = [np.add.reduceat(v[order].astype(np.int64), lead) for v in values]
    return held[lead], order[lead], sums


def _of_counts(counts: np.ndarray) -> list[int]:
    """How many there are, and how many of 1, 2, 3 and 4."""
    return [len(counts), *(int((counts == i).sum()) for i in (1, 2, 3, 4))]


def _successors(keys: np.ndarray, count: np.ndarray):
    """Of each context: all its counts, and successors with counts of 1, 2 and more."""
    context, _, sums = _merge(keys, count, count == 1, count == 2, count >= 3)
    return context, sums


def _store_ngrams(counted: DataFrame, folder: str, hot: Hot, shards: int) -> DataFrame:
    """Writes a file of n-grams of two words and more for each shard.

    Returns rows of files, and of what words and the contexts of hot words gain. A task
    has one shard.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _gather(batches):
            parts = [_thaw_ngrams(b) for b in blobs.pop(_NGRAMS)]
            *columns, n = (np.concatenate(x) for x in zip(*parts))
            del parts
            keys, lead, (count,) = _merge(_key(columns), n)
            columns = [c[lead] for c in columns]
            word, _, (raw,) = _merge(columns[-1], count)
            sections, figures = [], []
            for order in range(len(columns), 1, -1):
                sections.append(_section(keys, [count]))
                figures += _of_counts(count)
                freeze = _freeze_context
                if order == 2:
                    context, sums = _successors(columns[0], count)
                    yield from _by_shard(_shard(context, shards), order, freeze, context, *sums)
                else:
                    several = hot.parts_of(columns[-2]) > 1
                    context = _key(columns[:-1])
                    found, sums = _successors(context[~several], count[~several])
                    sections.append(_section(found, sums))
                    found, sums = _successors(context[several], count[several])
                    yield from _by_shard(_shard(found, shards), order, freeze, found, *sums)
                # In how many of these an n-gram without its first word is the end.
                columns = columns[1:]
                keys, lead, (count,) = _merge(_key(columns), np.ones(len(keys)))
                columns = [c[lead] for c in columns]
            yield from _by_shard(
                _shard(word, shards), _WORD, _freeze, word,
                count.astype(np.uint64), raw.astype(np.uint64),
            )
            yield _file_row(shard, _write(folder, "ngrams", sections), figures)

    return counted.repartitionById(shards, F.col("shard")).mapInArrow(work, _ROWS)


def _freeze_context(keys: np.ndarray, total: np.ndarray, *rest: np.ndarray) -> bytes:
    return _freeze(keys, total.astype(np.uint64), *(r.astype(np.uint32) for r in rest))


def _gather(batches: Iterator[pa.RecordBatch]):
    """The blobs of one shard after the other, by kind."""
    held: dict[int, dict[int, list[bytes]]] = {}
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "blob")))
        for shard, kind, blob in rows:
            held.setdefault(shard, {}).setdefault(kind, []).append(blob)
    for shard in sorted(held):
        yield shard, held.pop(shard)


def _store_words(gained: DataFrame, folder: str, shards: int, order: int) -> DataFrame:
    """Writes a file of words for each shard, with the longer contexts of hot words.

    A word has its figures as a context, its predecessors and its count.
    """

    def contexts(blobs: list[bytes]) -> list[np.ndarray]:
        parts = [_thaw(b, _CONTEXT_COLUMNS) for b in blobs]
        if not parts:
            return [np.zeros(0, k) for k in _CONTEXT_COLUMNS]
        return [np.concatenate(x) for x in zip(*parts)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _gather(batches):
            first = contexts(blobs.get(_CONTEXT, []))
            second = [_thaw(b, _WORD_COLUMNS) for b in blobs.get(_WORD, [])]
            second = [
                np.concatenate([np.zeros(0, np.uint64), *(p[i] for p in second)]) for i in range(3)
            ]
            none = np.zeros(len(second[0]), np.uint64), np.zeros(len(first[0]), np.uint64)
            columns = [np.concatenate([c, none[0]]) for c in first[1:]]
            columns += [np.concatenate([none[1], c]) for c in second[1:]]
            keys, _, sums = _merge(np.concatenate([first[0], second[0]]), *columns)
            sections = [_section(keys, sums, exact=True)]
            for n in range(3, order + 1):
                context, *figures = contexts(blobs.get(n, []))
                context, _, longer = _merge(context, *figures)
                sections.append(_section(context, longer))
            before, raw = sums[4:]
            figures = [*_of_counts(before[raw > 0]), int(raw.sum())]
            yield _file_row(shard, _write(folder, "words", sections), figures)

    return gained.repartitionById(shards, F.col("shard")).mapInArrow(work, _ROWS)


def _discounts(n: list[int]) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        # Too little text for the estimate.
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(x, 0.0), i + 1.0) for i, x in enumerate(d))])


_OPEN: dict[str, Lookup] = {}


@dataclass
class Model:
    """Where the files are, and the few figures that all lookups share."""

    folder: str
    order: int
    shards: int
    hot: Hot
    ngrams: dict[int, str]
    words: dict[int, str]
    discounts: dict[int, np.ndarray]  # of each order
    word_mass: float  # what discounts leave for unseen words
    types: int  # distinct bigrams
    train_tokens: int
    train_words: int  # distinct tokens

    def open(self) -> Lookup:
        """The lookup of this process, so that tasks go on with what earlier ones opened."""
        held = _OPEN.get(self.folder)
        if held is None:
            _OPEN.clear()
            held = _OPEN[self.folder] = Lookup(self)
        held.m = self
        return held


class Lookup:
    """The files of a model in one worker: the last used ones, a bounded number."""

    def __init__(self, model: Model) -> None:
        self.m = model
        self.maps: OrderedDict[str, tuple[list[Section], int]] = OrderedDict()
        self.held = 0

    def _sections(self, path: str) -> list[Section]:
        if path in self.maps:
            self.maps.move_to_end(path)
            return self.maps[path][0]
        sections, size = _mapped(self.m.folder, path)
        while self.maps and (len(self.maps) >= MAPPED or self.held + size > HELD):
            self.held -= self.maps.popitem(last=False)[1][1]
        self.maps[path] = sections, size
        self.held += size
        return sections

    def _find(
        self, files: dict[int, str], section: int, shard: np.ndarray, keys: np.ndarray, width: int
    ) -> np.ndarray:
        """Figures of the keys, 0 for those that are not there."""
        out = np.zeros((width, len(keys)))
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for i, j in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist()):
            at = order[i:j]
            path = files.get(int(shard[at[0]]))
            if path is not None:
                out[:, at] = self._sections(path)[section].find(keys[at])
        return out

    def _context(self, columns: list[np.ndarray]) -> np.ndarray:
        """Figures of contexts of two words and more."""
        m, keys = self.m, _key(columns)
        out = np.zeros((4, len(keys)))
        n = len(columns) + 1
        hot = m.hot.parts_of(columns[-1]) > 1
        for mine, files, section, shard in (
            # From the longest n-grams on, each with its contexts.
            (~hot, m.ngrams, 2 * (m.order - n) + 1, columns[-1]),
            (hot, m.words, n - 2, keys),
        ):
            at = np.flatnonzero(mine)
            out[:, at] = self._find(files, section, _shard(shard[at], m.shards), keys[at], 4)
        return out

    def score(self, row: np.ndarray, token: np.ndarray, place: np.ndarray, rows: int):
        """Each row's tokens, known tokens, base score and the model's, in log10."""
        m = self.m
        words, ids = np.unique(np.append(token, START), return_inverse=True)
        ids, start = ids[:-1], ids[-1]
        figures = self._find(m.words, 0, _shard(words, m.shards), words, 6)
        before, known = figures[4:]
        base = np.log10((known + 1) / (m.train_tokens + m.train_words + 1))
        # The lowest order: in how many bigrams a word is second, over all bigrams.
        low = np.full(len(words), m.word_mass / (m.train_words + 1))
        if m.types:
            low = low + (before - _discount(m.discounts[1], before)) / m.types

        columns, back = _distinct(ngrams(ids, place, m.order, start), len(words), return_inverse=True)
        p = low[columns[-1]]
        hashes = [words[c] for c in columns]
        shard = m.hot.shard(hashes[-2], hashes[-1], m.shards)
        for n in range(2, m.order + 1):
            own = hashes[-n:]
            (c,) = self._find(m.ngrams, 2 * (m.order - n), shard, _key(own), 1)
            total, *after = figures[:4, columns[-2]] if n == 2 else self._context(own[:-1])
            d = m.discounts[n]
            left = sum(d[i] * x for i, x in enumerate(after, 1))
            seen = total > 0
            total = np.where(seen, total, 1.0)
            p = np.where(seen, (c - _discount(d, c)) / total + left / total * p, p)
        logs = np.log10(p)[back]
        return (
            np.bincount(row, minlength=rows),
            np.bincount(row, known[ids] > 0, rows).astype(np.int64),
            np.bincount(row, base[ids], rows),
            np.bincount(row, logs, rows),
        )


def _discount(discounts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return discounts[np.minimum(counts, 3).astype(np.int64)]


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Counts the n-grams of all texts of ``docs`` and writes the model's files.

    ``order`` is the number of words of the longest, 2 or more; a row's first words come
    after order - 1 times START. A null text is an empty one. Three passes: hot words,
    n-grams, words. The driver gets a path and a few figures for each shard.
    """
    if order < 2:
        raise ValueError("a model has an order of 2 or more")
    spark = docs.sparkSession
    folder = scratch_folder(spark, "language-model")
    if "://" not in folder:
        folder = "file://" + os.path.abspath(folder.removeprefix("file:"))
    hot, size = hot_words(docs)
    shards = max(LEAST_SHARDS, -(-size // SHARD_TOKENS))
    stored = _store_ngrams(_count(docs, hot, shards, order), folder, hot, shards)
    kept = scratch_folder(spark, "ngram-rows")
    stored.write.parquet(kept)
    stored = spark.read.schema(stored.schema).parquet(kept)
    files = stored.filter(F.col("kind") == _FILE).select("shard", "path", "figures").collect()
    gained = stored.filter(F.col("kind") > _NGRAMS).select("shard", "kind", "blob")
    words = _store_words(gained, folder, shards, order).select("shard", "path", "figures").collect()

    def sums(rows: list, width: int) -> list[int]:
        return [sum(r["figures"][i] for r in rows) for i in range(width)]

    counted = sums(files, 5 * (order - 1))
    distinct, *of_words, total = sums(words, 6)
    discounts = {order - i // 5: _discounts(counted[i + 1 : i + 5]) for i in range(0, len(counted), 5)}
    d = discounts[1] = _discounts(of_words)
    types = counted[-5]
    several = distinct - of_words[0] - of_words[1]
    mass = (d[1] * of_words[0] + d[2] * of_words[1] + d[3] * several) / types if types else 1.0
    return Model(
        folder, order, shards, hot, {r["shard"]: r["path"] for r in files},
        {r["shard"]: r["path"] for r in words}, discounts, mass, types, total, distinct,
    )


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.

    Scores are log10 probabilities of the text's words and its end. Words are runs of
    bytes other than white space, A-Z in lower case. A null or empty text has its end
    alone. Equal texts have equal scores. Other columns of the input are not looked
    at. An empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = model.open()
        for part in T.slices(batches, limit=4 * T.SLICE):
            rows = part.rows.num_rows
            figures = look.score(*tokens(part.data, part.offsets), rows)
            n, known, base, score = figures
            yield pa.RecordBatch.from_arrays(
                [
                    part.rows.column("doc_id"), pa.array(n), pa.array(known),
                    pa.array(np.full(rows, model.train_tokens, np.int64)),
                    pa.array(base), pa.array(score),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mine.mapInArrow(
        work,
        "doc_id long, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def held_out(doc_id):
    """crc32 of the id as text, modulo 7, is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Scores of all rows by a model of those that are not held out."""
    model = train(docs.filter(~held_out(F.col("doc_id"))), order)
    out = with_scores(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *out.columns[1:])
