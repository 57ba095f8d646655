"""Spelling variants: words that differ by one letter, found by blocked Gram matrices.

One edit changes the counts of at most two letters. Letters are dealt to PARTS parts, so
some two of any four parts count the same in both words: words meet in the blocks of all
pairs of parts. In a block, a NumPy product of letter counts gives all squared distances
at once; pairs at most two apart whose lengths differ by one at most are then verified.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from sieveframe.sources.scratch import settle

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
DAMAGE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
PARTS = 4
KEPT = tuple(itertools.combinations(range(PARTS), PARTS - 2))
BLOCK = 4096  # words of one bucket that a task takes together
TILE = 1024  # rows and columns of one product
HELD = 1 << 19  # distinct words a task counts before it hands them on
PIECE = 1 << 20  # characters of a text that are looked at together
_SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_FIRST = 0xC0  # letters a to z, then U+00C0 to U+00FF
_LETTERS = 26 + 64
_PART = np.arange(_LETTERS) % PARTS


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text, cut where no run of letters is."""
    at = 0
    while len(text) - at > PIECE:
        stop = at + PIECE
        while stop < len(text) and RUN.match(text, stop):
            stop += 1
        yield text[at:stop]
        at = stop
    yield text[at:]


def _count_runs(doc_id: int | None, text: str, counts: Counter) -> None:
    mine: Counter = Counter()
    for piece in _pieces(text):
        mine.update(RUN.findall(piece.translate(_SMALL) if not piece.islower() else piece))
    head = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in mine.items():
        mark = zlib.crc32(run.encode(), head)
        if mark % DAMAGE == 0:
            at = mark % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            counts[run] += n


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): damaged words of at least LEAST_LENGTH, LEAST_COUNT times or more.

    Runs of letters in lower case. All runs of a document that are equal are damaged
    alike: where the checksum of ``<doc_id>:<run>`` is a multiple of DAMAGE, they lose one
    letter. A null doc_id is written as nothing.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for doc_id, text in zip(ids, texts):
                if text.is_valid:
                    _count_runs(doc_id.as_py(), text.as_py(), counts)
                if len(counts) >= HELD:
                    yield _counted(counts)
                    counts = Counter()
        if counts:
            yield _counted(counts)

    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (
        mine.mapInArrow(work, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
        names=["word", "n"],
    )


def letter_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often each letter is in each word, and the lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where(codes < _FIRST, codes - ord("a"), codes - _FIRST + 26)
    row = np.repeat(np.arange(len(words)), lengths)
    flat = np.bincount(row * _LETTERS + letter, minlength=len(words) * _LETTERS)
    return flat.reshape(len(words), _LETTERS), lengths


def _keys(words: list[str]) -> np.ndarray:
    """For each pair of parts a hash of the pair and of its letters' counts."""
    out = np.empty((len(words), len(KEPT)), np.uint64)
    seeds = T.mix(np.arange(1, _LETTERS + 1, dtype=np.uint64) * np.uint64(T.BASE))
    for at in range(0, len(words), TILE):
        counts, _ = letter_counts(words[at : at + TILE])
        counts = counts.astype(np.uint64)
        sums = [(counts[:, _PART == p] * seeds[_PART == p]).sum(axis=1) for p in range(PARTS)]
        for k, parts in enumerate(KEPT):
            total = sum((sums[p] for p in parts), np.zeros(len(counts), np.uint64))
            out[at : at + TILE, k] = T.mix(total + np.uint64(k + 1))
    return out


def with_keys(words: DataFrame) -> DataFrame:
    """(key, word, n): each word once for each pair of parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _keys(batch.column("word").to_pylist()).view(np.int64)
                again = np.repeat(np.arange(batch.num_rows), len(KEPT))
                more = batch.take(pa.array(again))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1)), more.column("word"), more.column("n")],
                    names=["key", "word", "n"],
                )

    return words.mapInArrow(work, "key long, word string, n long")


def blocks(keyed: DataFrame) -> DataFrame:
    """(key, i, j, of, word, n): words of a bucket that are compared together.

    A bucket of more than BLOCK words is split into parts by a hash of the word, and
    each two of its parts meet as one block, so no task has to hold a whole bucket.
    Buckets of one word are left out.
    """
    sizes = settle(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        .select(F.col("key").alias("_key"), F.ceil(F.col("size") / BLOCK).cast("int").alias("split")),
        "spelling-buckets",
    )
    mine = keyed.join(sizes, F.col("key") == F.col("_key")).drop("_key")
    of = F.pmod(F.xxhash64("word"), F.col("split")).cast("int")
    placed = mine.select("key", "word", "n", "split", of.alias("of"))
    other = F.explode(F.sequence(F.lit(0), F.col("split") - 1)).alias("other")
    return placed.select("key", "word", "n", "of", other).select(
        "key", F.least("of", "other").alias("i"), F.greatest("of", "other").alias("j"),
        "of", "word", "n",
    )


def _near(words: list[str], of: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block at most two apart, of equal lengths or of neighbouring ones."""
    counts, lengths = letter_counts(words)
    order = np.argsort(lengths, kind="stable")
    counts, lengths, of = counts[order], lengths[order], of[order]
    # Products of counts stay exact in the narrower type up to here.
    kind = np.float32 if lengths[-1] < 2000 else np.float64
    counts = counts.astype(kind)
    square = (counts * counts).sum(axis=1)
    left, right = [], []
    for a in range(0, len(words), TILE):
        b = min(a + TILE, len(words))
        stop = int(np.searchsorted(lengths, lengths[b - 1] + 1, "right"))
        for c in range(a, stop, TILE):
            d = min(c + TILE, stop)
            apart = square[a:b, None] + square[None, c:d] - 2 * (counts[a:b] @ counts[c:d].T)
            x, y = np.nonzero(apart <= 2)
            x, y = x + a, y + c
            # One edit within a length makes two, one between lengths makes one.
            fits = (x < y) & (apart[x - a, y - c] == 2 - (lengths[y] - lengths[x]))
            fits &= (lengths[y] - lengths[x] <= 1) & (lengths[y] >= lengths[x])
            if cross:
                fits &= of[x] != of[y]
            left.append(x[fits])
            right.append(y[fits])
    x, y = np.concatenate(left), np.concatenate(right)
    return order[x], order[y]


def one_edit(short: list[str], long: list[str]) -> np.ndarray:
    """Whether one inserted, deleted or replaced letter makes one word the other."""
    if not short:
        return np.zeros(0, bool)
    a = np.array(short, dtype=np.str_)
    b = np.array(long, dtype=np.str_)
    width = max(a.dtype.itemsize, b.dtype.itemsize) // 4
    n = np.char.str_len(a)
    step = np.char.str_len(b) - n
    a = a.astype(f"<U{width}").view(np.uint32).reshape(len(short), width)
    b = b.astype(f"<U{width}").view(np.uint32).reshape(len(long), width)
    ahead = np.minimum(np.cumprod(a == b, axis=1, dtype=np.int8).sum(axis=1), n)
    # From the end: both words without what they share in front, less one letter.
    back = np.arange(width)[None, :]
    tail_a = np.take_along_axis(a, np.maximum(n[:, None] - 1 - back, 0), axis=1)
    tail_b = np.take_along_axis(b, np.maximum((n + step)[:, None] - 1 - back, 0), axis=1)
    same = (tail_a == tail_b) & (back < n[:, None])
    behind = np.cumprod(same, axis=1, dtype=np.int8).sum(axis=1)
    rest = n - (1 - step)
    return (ahead + behind >= rest) & ~((step == 0) & (ahead >= n))


def _verified(words: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    if not len(x):
        return np.zeros(0, bool)
    most = max(map(len, words))
    few = max(1, (1 << 20) // most)
    held = [
        one_edit([words[k] for k in x[i : i + few]], [words[k] for k in y[i : i + few]])
        for i in range(0, len(x), few)
    ]
    return np.concatenate(held)


def _first_kept(words: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first pair of parts that count the same in both words."""
    counts, _ = letter_counts(words)
    parts = np.stack(
        [(counts[x][:, _PART == p] == counts[y][:, _PART == p]).all(axis=1) for p in range(PARTS)]
    )
    kept = np.stack([parts[list(pair)].all(axis=0) for pair in KEPT])
    return kept.argmax(axis=0)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of all pairs of words one edit apart.

    A pair that several blocks hold comes from the block of its first equal pair of
    parts alone.
    """
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = blocks(settle(with_keys(words), "spelling-keys"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # The last block of a batch may go on in the next one.
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            cut = _last_block(table)
            if cut:
                yield from _pairs(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from _pairs(pa.Table.from_batches(held).combine_chunks())

    return (
        placed.repartition(tasks, "key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(work, "word string, near string, near_n long")
    )


def _marks(table: pa.Table) -> np.ndarray:
    """Where a block begins."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in ("key", "i", "j"):
        column = np.asarray(table.column(name))
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _last_block(table: pa.Table) -> int:
    return int(_marks(table)[-1]) if table.num_rows else 0


def _pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    starts = _marks(table)
    stops = np.append(starts[1:], table.num_rows)
    words, n = table.column("word").to_pylist(), np.asarray(table.column("n"))
    of, i, j = (np.asarray(table.column(c)) for c in ("of", "i", "j"))
    keys = np.asarray(table.column("key")).view(np.uint64)
    left, right = [], []
    for a, b in zip(starts.tolist(), stops.tolist()):
        if b - a < 2:
            continue
        x, y = _near(words[a:b], of[a:b], cross=bool(i[a] != j[a]))
        left.append(x + a)
        right.append(y + a)
    if not left:
        return
    x, y = np.concatenate(left), np.concatenate(right)
    ok = _verified(words, x, y)
    x, y = x[ok], y[ok]
    if not len(x):
        return
    # The key tells which pair of parts a block is of.
    used, back = np.unique(np.concatenate([x, y]), return_inverse=True)
    own = [words[k] for k in used.tolist()]
    first = _first_kept(own, back[: len(x)], back[len(x) :])
    mine = _keys(own)[back[: len(x)], first] == keys[x]
    x, y = x[mine], y[mine]
    word = pa.array([words[k] for k in np.concatenate([x, y]).tolist()], pa.string())
    near = pa.array([words[k] for k in np.concatenate([y, x]).tolist()], pa.string())
    yield pa.RecordBatch.from_arrays(
        [word, near, pa.array(n[np.concatenate([y, x])])], names=["word", "near", "near_n"]
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends.

    Each round follows twice as many forms as the one before. A form is at least twice
    as frequent as its word, so there are few.
    """
    step = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        joined = step.join(ahead, F.col("root") == F.col("_at"), "left")
        moved = settle(
            joined.select(
                "word", F.coalesce("_to", "root").alias("root"),
                F.col("_to").isNotNull().alias("moved"),
            ),
            "roots",
        )
        step = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return step


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of (word, n).

    Two words are near if one letter inserted, deleted or replaced makes one the other.
    The form of a word is its most frequent near word, the smallest in code-point order
    among equals, if that is at least twice as frequent as the word; root is where forms
    lead, the word itself without one. Words must be distinct and not null, in the
    letters a to z and U+00C0 to U+00FF. An empty table gives no rows.
    """
    words = settle(words.select("word", "n"), "words")
    near = near_words(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = settle(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.near")).alias("form"),
            F.when(-F.col("best.less") >= 2 * F.col("n"), -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(judged.filter("form IS NOT NULL")).select(F.col("word").alias("_word"), "root")
    return judged.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """variants() of the words of all texts of ``docs``, damaged as word_counts() says.

    A null or empty text has no words. Equal rows count each. Other columns of the input
    are not looked at. An empty table gives no rows.
    """
    return variants(word_counts(docs))
