"""Substring dedup over bytes with a suffix array for each bucket of strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import superkmers as S
from llm import text as T
from llm.substring_dedup import counted

WIDTH = 400
MER = 16  # bytes hashed at each position
STEP = 48  # any so many positions hold the start of a phrase
# A run of MER bytes is hot if it is there once for so many rows, and more than FEW times.
HOT = 1000
FEW = 64
TASK_GRAMS = 1 << 15  # runs of bytes that a task counts on from slice to slice
BINS = 1 << 22  # about as many as positions that are counted together
OFTEN = 4  # times that a run must be there among these to be counted
LEVEL = 3  # of compression: more takes longer than finding the strings
HOT_GRAMS = 1 << 20
_CLASSES = 31


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffixes grouped by their longest Lyndon prefix, groups in order.

    ``text`` ends with its only 0, its smallest symbol. Returns the first slot of each
    suffix's group, the pointer to the nearest earlier suffix of a smaller group, and
    the first free slot of every group.

    Groups are taken from the largest down. When one is taken, its prefix is complete
    and ends the prefix that the pointed suffixes have so far. Those with more
    complete parts of this kind are larger, so they move behind the rest of their
    group: by ascending count, each count a group of its own.
    """
    n = len(text)
    symbols = np.array(text)
    by_symbol = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[by_symbol[1:]] != symbols[by_symbol[:-1]]
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    places = np.empty((2, n), np.int64)
    places[:, by_symbol] = np.arange(n), heads
    order, (slot, group) = by_symbol.tolist(), places.tolist()
    size, before = np.bincount(heads, minlength=n).tolist(), [-1] * n

    high = n
    while high > 0:
        low = group[order[high - 1]]
        if high - low == 1:
            # Most groups end up with one suffix, which moves one other.
            s = order[low]
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[s] = p
            high = low
            if p >= 0:
                g = group[p]
                size[g] -= 1
                last, at = g + size[g], slot[p]
                other = order[last]
                order[at], slot[other] = other, at
                order[last], slot[p] = p, last
                group[p] = last
                size[last] += 1
            continue
        members = sorted(order[low:high])
        counts: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[s] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        high = low
        most = max(counts.values(), default=0)
        for count in range(most, 0, -1):
            moved = [p for p, c in counts.items() if c == count] if most > 1 else list(counts)
            if not moved:
                continue
            for p in moved:
                g = group[p]
                size[g] -= 1
                last, at = g + size[g], slot[p]
                other = order[last]
                order[at], slot[other] = other, at
                order[last], slot[p] = p, last
            heads = [group[p] + size[group[p]] for p in moved]
            for p, g in zip(moved, heads):
                group[p] = g
            for g in heads:
                size[g] += 1
    return group, before, list(range(n))


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of all suffixes of ``symbols`` (1 or more each) in order; the end comes first."""
    text = [*symbols, 0]
    n = len(text)
    group, before, free = lyndon_groups(text)
    out, placed = [0] * n, [False] * n
    out[0] = n - 1
    for rank in range(n):
        # The next smaller suffix of each of these is the one at this rank.
        p = out[rank] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = True
            p = before[p]
    return out


def common_prefixes(symbols: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Symbols that each suffix in ``order`` shares with the one before it, at most its room.

    ``room`` is the number of symbols left until the string ends. Halves the room until
    the hashes of what is compared agree.
    """
    n = len(symbols)
    out = np.zeros(n + 1, np.int64)
    # The end of the text comes first, and shares nothing.
    mine, other = order[2:], order[1:-1]
    most = np.minimum(room[mine], room[other])
    rolling = T.Rolling(T.mix(symbols.astype(np.uint64)), T.WORD_BASES[0])
    low, high = np.zeros(len(mine), np.int64), most
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = rolling.of(mine, mine + middle) == rolling.of(other, other + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    out[2:] = low
    return out


def _positions(data: np.ndarray, offsets: np.ndarray):
    """Hash of the MER bytes at each position, all ones where a row has fewer left."""
    rolling = T.rolling_bytes(data)
    values = np.full(len(data), ~np.uint64(0))
    hashes = rolling.fixed(MER)
    values[: len(hashes)] = hashes >> np.uint64(1)
    # The last MER - 1 positions of a row reach into the next one.
    ends = offsets[1:, None] - np.arange(1, MER)[None, :]
    ends = ends[ends >= offsets[:-1, None]]
    values[ends] = ~np.uint64(0)
    return rolling, values


def _slide(x: np.ndarray, n: int, f: np.ufunc) -> np.ndarray:
    """f over every n neighbours, by doubling."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = f(x[: len(x) - step], x[step:])
        done += step
    return x


def phrases(values: np.ndarray) -> np.ndarray:
    """Positions whose value is the smallest of some STEP neighbours."""
    if len(values) < STEP:
        return np.zeros(0, np.int64)
    least = _slide(values, STEP, np.minimum)
    pad = np.zeros(STEP - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), STEP, np.maximum)
    return np.flatnonzero((most == values) & (values != ~np.uint64(0)))


def hot_grams(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of the frequent runs of MER bytes, a class of each, and bytes of text.

    All positions count, not only starts of phrases: without these, others would take
    their place. A class is 1 for the least frequent ones, and one more for each doubling.
    Positions are first thrown into BINS; only those in bins of OFTEN or more are told
    apart. A task keeps its TASK_GRAMS most frequent runs from slice to slice and reports
    those that are there once in 2 * HOT of its rows; at most HOT_GRAMS come back. Only
    speed depends on them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        held, size, seen = [], 0, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            values = np.concatenate(held)
            bins = (values & np.uint64(BINS - 1)).view(np.int64)
            values = values[np.bincount(bins, minlength=BINS)[bins] >= OFTEN]
            found, n = np.unique(values, return_counts=True)
            found, n = found[n >= OFTEN], n[n >= OFTEN]
            all_, back = np.unique(np.concatenate([grams, found]), return_inverse=True)
            sums = np.bincount(back, np.concatenate([counts, n]), len(all_)).astype(np.int64)
            if len(all_) > TASK_GRAMS:
                most = np.sort(np.argpartition(sums, -TASK_GRAMS)[-TASK_GRAMS:])
                all_, sums = all_[most], sums[most]
            return all_, sums

        # Hashing takes smaller pieces than counting.
        for part in T.slices(batches):
            _, values = _positions(part.data, part.offsets)
            held.append(values[values != ~np.uint64(0)])
            size += len(held[-1])
            rows += part.rows.num_rows
            seen += len(part.data)
            if size > BINS - T.SLICE:
                grams, counts = merged()
                held, size = [], 0
        if held:
            grams, counts = merged()
        often = counts * 2 * HOT > rows
        yield S.counted_rows(grams[often], counts[often], seen)

    least = max(docs.count() / (2 * HOT), FEW)
    summed = S.summed(docs.select("text").mapInArrow(work, S.COUNTED))
    grams, counts = S.most_frequent(summed, F.col("n") > F.lit(least), HOT_GRAMS)
    classes = 1 + np.log2(counts / least).astype(np.uint64)
    order = np.argsort(grams)
    classes = np.minimum(classes, np.uint64(_CLASSES))[order]
    return grams[order], classes, S.text_bytes(summed)


def _hot_last(values: np.ndarray, grams: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The values with the class of hot ones in their first bits, so these come last."""
    out = values >> np.uint64(5)
    if len(grams):
        low = np.uint64((1 << 20) - 1)
        maybe = np.zeros(1 << 20, bool)
        maybe[grams & low] = True
        at = np.flatnonzero(maybe[values & low])
        i = np.minimum(np.searchsorted(grams, values[at]), len(grams) - 1)
        hit = grams[i] == values[at]
        out[at[hit]] |= classes[i[hit]] << np.uint64(58)
    out[values == ~np.uint64(0)] = ~np.uint64(0)
    return out


def _finder(grams: np.ndarray, classes: np.ndarray):
    """Finds the super-k-mers of the windows of WIDTH bytes.

    The smallest value of a window is also the smallest of STEP of its positions, so
    only starts of phrases can be minimisers. A window takes a hot run of bytes only if
    all its runs are hot, and then one of the least frequent class. So a line that very
    many rows share makes no minimiser of windows that reach beyond it, and windows
    inside it are equal and travel once a batch.
    """

    def find(data: np.ndarray, offsets: np.ndarray) -> S.Found:
        rolling, values = _positions(data, offsets)
        values = _hot_last(values, grams, classes)
        places = phrases(values)
        row = np.searchsorted(offsets, places, "right") - 1
        r = S.runs(places, values[places], row, offsets, WIDTH - MER + 1, WIDTH)
        stop = r.last + WIDTH
        content = rolling.of(r.first, stop) ^ T.mix(r.hash)
        return S.Found(data, r, r.first, stop, content, r.first - offsets[r.row])

    return find


def recurring(p: S.Packed) -> tuple[np.ndarray, np.ndarray]:
    """String and place of every window of WIDTH bytes that is there twice or more.

    Only strings whose minimiser others have too can hold one. Equal strings are one, with
    their weights added. The phrases of the others become symbols, and a suffix array
    orders the phrase suffixes. Windows are equal if their whole phrases are, which is so
    if their first phrases stand in one run of the array that shares so many symbols, and
    if the bytes before and after them are.
    """
    none = np.zeros(0, np.int64)
    _, inverse = np.unique(p.minimiser, return_inverse=True)
    origin = np.flatnonzero(np.bincount(inverse, p.weight)[inverse] > 1)
    if not len(origin):
        return none, none
    offsets = np.zeros(len(p.lengths) + 1, np.int64)
    np.cumsum(p.lengths, out=offsets[1:])
    body = p.data.tobytes()
    texts = [body[i:j] for i, j in zip(offsets[origin].tolist(), offsets[origin + 1].tolist())]
    number: dict[bytes, int] = {}
    same = np.array([number.setdefault(t, len(number)) for t in texts])
    weight = np.bincount(same, p.weight[origin])
    start, length = p.start[origin], p.lengths[origin]
    string, place = [], []
    # A string that is there twice: all its windows recur.
    twice = np.flatnonzero((weight[same] > 1) & (start >= 0))
    if len(twice):
        each, of = _every_window(length[twice])
        string.append(twice[of])
        place.append(each)

    # The others, one of each.
    lead = np.zeros(len(number), np.int64)
    lead[same[::-1]] = np.arange(len(same))[::-1]
    at = np.zeros(len(number) + 1, np.int64)
    np.cumsum(length[lead], out=at[1:])
    data = np.frombuffer(b"".join(number), np.uint8)
    del texts, number, body
    hit, where = _windows(data, at, weight)
    if len(hit):
        # Only strings that are there once still need an answer.
        single = weight[hit] == 1
        own = lead[hit[single]]
        ask = start[own] >= 0
        string.append(own[ask])
        place.append(where[single][ask])
    if not string:
        return none, none
    s, w = np.concatenate(string), np.concatenate(place)
    order = np.lexsort((w, s))
    return origin[s[order]], w[order]


def _every_window(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows of strings of these lengths, and the string of each."""
    counts = np.maximum(lengths - WIDTH + 1, 0)
    string = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(string)) - before[string], string


def _phrases_of(data: np.ndarray, offsets: np.ndarray):
    """Rolling hashes, and the phrase starts of strings: places, first, last, hash.

    A start is in every window that holds one of the STEP-windows ``first`` to ``last``
    whole, whatever surrounds it. The hash is that of the bytes up to the next start of
    the string; a last start has none and gets 0.
    """
    rolling, values = _positions(data, offsets)
    starts = phrases(values)
    row = np.searchsorted(offsets, starts, "right") - 1
    r = S.runs(starts, values[starts], row, offsets, STEP, STEP + MER - 1)
    starts, row = starts[r.place], r.row
    inner = np.zeros(len(starts), bool)
    inner[:-1] = row[:-1] == row[1:]
    ends = np.append(starts[1:], 0)
    keys = np.zeros(len(starts), np.uint64)
    keys[inner] = rolling.of(starts[inner], ends[inner])
    return rolling, starts, r.first, r.last, keys, inner


def _ordered_runs(keys: np.ndarray, inner: np.ndarray):
    """Places in the order of phrase suffixes, and the runs there that share symbols.

    Gives the place of each phrase, -1 for none, and a function that numbers for q the
    runs of places whose suffixes share q symbols. A phrase that is there once can be in no window that recurs, so it ends what
    is before it like the end of a string does, and only one of such neighbours stays.
    """
    n = len(keys)
    _, symbol, count = np.unique(keys, return_inverse=True, return_counts=True)
    often = inner & (count[symbol] > 1)
    keep = often.copy()
    keep[1:] |= often[:-1]
    kept = np.flatnonzero(keep)
    place = np.full(n, -1)
    if not len(kept):
        return place, lambda q: None
    of = often[kept]
    symbols = np.ones(len(kept), np.int64)
    symbols[of] = np.unique(symbol[kept[of]], return_inverse=True)[1] + 2
    ends = np.flatnonzero(~of)
    room = ends[np.searchsorted(ends, np.arange(len(kept)), "left")] - np.arange(len(kept))
    order = np.array(suffix_array(symbols.tolist()))
    shared = common_prefixes(symbols, order, room)
    rank = np.empty(len(kept) + 1, np.int64)
    rank[order] = np.arange(len(kept) + 1)
    place[kept[of]] = rank[:-1][of]

    def runs(q: int) -> np.ndarray:
        cut = shared < q
        cut[0] = True
        return np.cumsum(cut) - 1

    return place, runs


def _windows(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray):
    """Distinct strings: number and place of the windows that recur."""
    none = np.zeros(0, np.int64)
    slices, parts, i = [], [], 0
    # Hashing takes smaller pieces than ordering.
    while i < len(offsets) - 1:
        j = int(np.searchsorted(offsets, offsets[i] + T.SLICE, "right")) - 1
        j = max(i + 1, min(j, len(offsets) - 1))
        lo, hi = offsets[i], offsets[j]
        rolling, *found = _phrases_of(data[lo:hi], offsets[i : j + 1] - lo)
        slices.append((rolling, i, j, lo))
        parts.append([x + lo for x in found[:3]] + found[3:])
        i = j
    starts, first, last, keys, inner = (np.concatenate(x) for x in zip(*parts))
    if not len(starts):
        return none, none
    place, runs_of = _ordered_runs(keys, inner)

    # Windows of all strings: first and last start inside each.
    at, string = _every_window(np.diff(offsets))
    at = at + offsets[string]
    head = np.searchsorted(last, at, "left")
    tail = np.searchsorted(first, at + WIDTH - STEP - MER + 1, "right") - 1
    depth = (tail - head).astype(np.int16)
    # Without a whole phrase the bytes alone decide.
    group = np.where(depth == 0, 0, -1)
    some = np.flatnonzero((depth > 0) & (place[head] >= 0))
    some = some[np.argsort(depth[some], kind="stable")]
    for pick in np.split(some, np.flatnonzero(np.diff(depth[some])) + 1):
        if not len(pick):
            continue
        run = runs_of(int(depth[pick[0]]))
        members = np.bincount(run)
        lead = run[place[head[pick]]]
        more = members[lead] > 1
        group[pick[more]] = lead[more]
    kept = np.flatnonzero(group >= 0)
    one, two = [], []
    for rolling, i, j, lo in slices:
        a, b = np.searchsorted(string[kept], [i, j])
        own = kept[a:b]
        left = rolling.of(at[own] - lo, starts[head[own]] - lo)
        right = rolling.of(starts[tail[own]] - lo, at[own] + WIDTH - lo)
        one.append(T.mix(left + T.mix(group[own].astype(np.uint64))))
        two.append(T.mix(right + T.mix(depth[own].astype(np.uint64))))
    at, string = at[kept], string[kept]
    again = counted(np.concatenate(one), np.concatenate(two), weight[string])
    return string[again], at[again] - offsets[string[again]]


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a key, and (owner, key, a, b) of bytes a to b that recur."""
    keyed = S.with_row_key(docs)
    *hot, size = hot_grams(keyed)
    buckets = S.buckets_for(size)
    packed = S.pack(keyed, _finder(*hot), WIDTH, buckets, with_minimiser=True, level=LEVEL)
    return keyed, S.spans(packed, recurring, WIDTH, buckets)


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_bytes of every row.

    Bytes of the UTF-8 text covered by WIDTH bytes that start anywhere else are
    removed. A null text counts as empty. A null doc_id is a row like others. Equal
    rows are copies of each other, so both lose such bytes. What is left may cut a
    character, so it is binary. Other columns of the input are not looked at. An empty
    table gives no rows.
    """
    keyed, found = repeated_spans(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            gone = S.removed(part.rows.column("spans"), part.offsets)
            starts = gone.copy()
            starts[1:] &= ~gone[:-1]
            inner = part.offsets[:-1][part.offsets[:-1] < len(gone)]
            starts[inner] = gone[inner]
            stay = ~gone
            body = part.data[stay].tobytes()
            left = T.per_row(stay, part.offsets)
            ends = np.cumsum(left)
            texts = [body[j - k : j] for j, k in zip(ends.tolist(), left.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.rows.column("doc_id"),
                    pa.array(np.diff(part.offsets)),
                    pa.array(T.per_row(gone, part.offsets)),
                    pa.array(T.per_row(starts, part.offsets)),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array(texts, pa.binary()),
                ],
                names=[
                    "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes",
                ],
            )

    return S.with_spans(keyed, found).mapInArrow(
        work,
        "doc_id long, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string, kept_bytes binary",
    )
