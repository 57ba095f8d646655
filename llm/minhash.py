"""Near-duplicate documents by MinHash sketches, banding and exact checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.components import components
from sieveframe.sources.scratch import settle

SIMILARITY = 80  # percent
BANDS = 64
BAND_ROWS = 6
BINS = BANDS * BAND_ROWS
RATIO = 1.05  # of the sizes in neighbouring classes
_NONE = ~np.uint64(0)
_SEEDS = T.mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(T.BASE))
_ROWS = T.mix(np.arange(1, BAND_ROWS + 1, dtype=np.uint64) * np.uint64(T.WORD_BASES[0]))


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles, by row and hash.

    A row of fewer than ``width`` words has its whole sequence as its one shingle.
    """
    rows = len(offsets) - 1
    w = T.words(T.lower(data), offsets)
    rolling = T.Rolling(w.hash, T.WORD_BASES[0])
    hashes = rolling.fixed(width)
    at = np.arange(len(hashes))
    at = at[w.row[at] == w.row[at + width - 1]]
    count = np.bincount(w.row, minlength=rows)
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < width))
    row = np.concatenate([w.row[at], short])
    value = np.concatenate([hashes[at], rolling.of(first[short], first[short] + count[short])])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def sketch(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """BINS numbers for each row; rows share one with the chance of their similarity.

    Round i throws every element into one of the bins with i ahead of its hash, so a
    bin keeps the smallest hash of the first round that reached it. Rounds go on until
    all bins of a row are full. After BINS rounds, round BINS + j throws everything
    into bin j alone, so that none stays empty. Rows without elements get nothing.
    """
    out = np.full(rows * BINS, _NONE)
    table = out.reshape(rows, BINS)
    row = row.astype(np.int64)
    low = np.uint64((1 << 48) - 1)
    for i in range(BINS):
        if not len(row):
            return table
        h = T.mix(value ^ _SEEDS[i])
        bins = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        ahead = np.uint64(i << 48)
        np.minimum.at(out, row * BINS + bins.astype(np.int64), (h & low) | ahead)
        here = np.flatnonzero(np.diff(row, prepend=-1))
        left = (table[row[here]] == _NONE).any(axis=1)
        if not left.all():
            keep = np.repeat(left, np.diff(np.append(here, len(row))))
            row, value = row[keep], value[keep]
    for r in np.unique(row).tolist():
        mine = value[row == r]
        for j in np.flatnonzero(table[r] == _NONE).tolist():
            h = T.mix(mine ^ _SEEDS[BINS + j])
            table[r, j] = (h.min() & low) | np.uint64((BINS + j) << 48)
    return table


def band_keys(table: np.ndarray) -> np.ndarray:
    """One hash for each band of each row; the band's number is part of it."""
    values = T.mix(table.reshape(len(table), BANDS, BAND_ROWS) + _ROWS)
    keys = values.sum(axis=2, dtype=np.uint64)
    return T.mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(T.BASE))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit mark of the shingle set, and its band keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            rows = part.rows.num_rows
            row, value = shingle_sets(part.data, part.offsets, width)
            n = np.bincount(row, minlength=rows)
            keys = band_keys(sketch(row, value, rows))
            sums = np.zeros((2, len(value) + 1), np.uint64)
            np.cumsum(T.mix(value ^ _SEEDS[0]), out=sums[0, 1:])
            np.cumsum(T.mix(value ^ _SEEDS[1]), out=sums[1, 1:])
            ends = np.cumsum(n)
            marks = (sums[:, ends] - sums[:, ends - n]).view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS),
                pa.array(keys.view(np.int64).reshape(-1)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.rows.column("doc_id"), pa.array(n),
                    pa.array(marks[0]), pa.array(marks[1]), lists,
                ],
                names=["doc_id", "n_shingles", "f", "g", "bands"],
            )

    return docs.mapInArrow(
        work, "doc_id long, n_shingles long, f long, g long, bands array<long>"
    )


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of the documents whose id is in ``ids``; hashes in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            rows = part.rows.num_rows
            row, value = shingle_sets(part.data, part.offsets, width)
            ends = np.searchsorted(row, np.arange(rows + 1), "left")
            lists = pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(value.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [part.rows.column("doc_id"), lists], names=["id", "shingles"]
            )

    mine = docs.join(ids, F.col("doc_id") == F.col("id"), "left_semi")
    return mine.mapInArrow(work, "id long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked): whether the sets behind each pair are similar."""
    of = lambda side: sets.select(
        F.col("id").alias(side), F.col("shingles").alias(f"{side}_set")
    )
    both = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - both
    return (
        pairs.join(of("a"), "a")
        .join(of("b"), "b")
        .select(
            "a", "b", (100 * both >= SIMILARITY * union).alias("linked"),
        )
    )


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked if the sets of their lower-cased ``width``-word shingles have
    a Jaccard similarity of SIMILARITY percent or more. component_id is the smallest
    doc_id that links reach, kept is true for that document. A text that is null or
    has no word has no shingles and no links. Rows of one doc_id are one document. A
    row with a null doc_id is linked with nothing: component_id is null, kept true.
    Other columns of the input are not looked at. An empty table gives no rows.

    Equal sets are one node. The pairs that are checked on full sets:

    1. each member of a bucket with its smallest and its largest member;
    2. for documents in buckets that still hold several components, those of different
       ones that across_components() finds.

    So a link is found if its two documents share any bucket. For a similarity of 0.8
    that fails with a chance of (1 - 0.8 ** 6) ** 64 < 4e-9, and less above.
    """
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = settle(sketches(mine, width), "sketches")
    usable = drawn.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = settle(
        usable.groupBy("f", "g").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")
        ),
        "nodes",
    )
    lead = usable.select("f", "g", "doc_id", "bands").join(
        nodes.select(F.col("f").alias("f2"), F.col("g").alias("g2"), "rep", "n"),
        (F.col("f") == F.col("f2")) & (F.col("g") == F.col("g2"))
        & (F.col("doc_id") == F.col("rep")),
    )
    placed = lead.select("rep", "n", F.explode("bands").alias("bucket"))
    ends = placed.groupBy(F.col("bucket").alias("own")).agg(
        F.min("rep").alias("low"), F.max("rep").alias("high")
    ).filter("low < high")
    # Only buckets of two members or more go on; for most documents that is none.
    shared = settle(
        placed.join(ends, F.col("bucket") == F.col("own")).select(
            "bucket", "rep", "n", "low", "high"
        ),
        "buckets",
    )
    sizes = shared.select(F.col("rep").alias("other"), F.col("n").alias("m")).distinct()
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * SIMILARITY

    ends = shared.select("rep", "n", F.explode(F.array("low", "high")).alias("end"))
    pairs = settle(
        ends.filter("rep <> end")
        .distinct()
        .join(sizes, F.col("end") == F.col("other"))
        .filter(fits)
        .select(F.col("rep").alias("a"), F.col("end").alias("b")),
        "pairs",
    )
    ids = shared.select(F.col("rep").alias("id")).distinct()
    sets = settle(sets_of(mine, ids, width), "sets")
    first = settle(verified(pairs, sets).filter("linked"), "checked")
    linked = first.select("a", "b").unionAll(_same_id(usable, nodes))
    found = settle(components(linked), "components")

    rest = across_components(_split(shared, found), sets)
    third = settle(verified(rest, sets).filter("linked"), "checked")
    if not third.isEmpty():
        found = settle(components(linked.unionAll(third.select("a", "b"))), "components")

    ranked = nodes.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("f").alias("f2"), F.col("g").alias("g2"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    return (
        drawn.select("doc_id", "n_shingles", "f", "g")
        .join(
            ranked,
            (F.col("f") == F.col("f2")) & (F.col("g") == F.col("g2"))
            & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
            "left",
        )
        .select(
            "doc_id", "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            (F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
        )
    )


def across_components(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): all pairs of different components that can be linked, once each.

    Put all shingles in one order. Sets of n and m shingles that are similar have at
    least SIMILARITY / (100 + SIMILARITY) * (n + m) in common, so they share one among
    the first n and m less that number, plus one, of each. The order begins with
    shingles that no two components share, which decide nothing, and goes on from rare
    to frequent: what very many documents have in common comes last and makes no pairs.

    Sizes fall into classes that grow by RATIO. A set looks for smaller ones, or of its
    own class, in each class that may hold them; how far it looks depends on that class.
    """
    mine = members.select("rep", "n", "component").distinct()
    each = mine.join(sets, F.col("rep") == F.col("id")).select(
        "rep", "n", "component", F.explode("shingles").alias("shingle")
    )
    common = (
        each.groupBy(F.col("shingle").alias("own"))
        .agg(
            F.count(F.lit(1)).alias("freq"),
            F.min("component").alias("x"), F.max("component").alias("y"),
        )
        .filter("x < y")
        .select("own", "freq")
    )
    listed = F.array_sort(F.collect_list(F.struct("freq", "shingle")))
    steps = range(int(1 + math.log(100 / SIMILARITY) / math.log(RATIO)) + 1)
    part = SIMILARITY / (100 + SIMILARITY)

    def front(down: bool) -> DataFrame:
        """The first shingles of each set, for each step between the classes."""
        size_class = F.floor(F.log("n") / math.log(RATIO)).cast("int")
        rows = []
        for d in steps:
            # The other set has at least so many times the shingles of this one.
            other = RATIO ** -(d + 1) if down else RATIO ** (d - 1)
            need = F.ceil(F.col("n") * (part * (1 + other)) - 1e-6)
            first = (F.col("n") - need + 1 - F.col("before")).cast("int")
            rows.append(
                F.transform(
                    F.slice("shared", 1, F.greatest(first, F.lit(0))),
                    _row_of(d, size_class - d if down else size_class),
                )
            )
        return numbered.select(
            "rep", "n", "component", F.inline(F.concat(*rows))
        ).withColumn("left", F.col("n") - F.col("place"))

    numbered = settle(
        each.join(common, F.col("shingle") == F.col("own"))
        .groupBy("rep", "n", "component")
        .agg(listed.alias("listed"))
        .select(
            "rep", "n", "component", (F.col("n") - F.size("listed")).alias("before"),
            F.transform(
                "listed", lambda x, i: F.struct(x["shingle"].alias("shingle"), i.alias("i"))
            ).alias("shared"),
        ),
        "front",
    )
    small = front(False)
    small = small.select(
        *(F.col(c).alias(f"{c}2") for c in ("shingle", "cls", "step", "component", "n", "left")),
        F.col("rep").alias("other"),
    )
    both = front(True).join(
        small,
        (F.col("shingle") == F.col("shingle2"))
        & (F.col("cls") == F.col("cls2"))
        & (F.col("step") == F.col("step2"))
        & (F.col("component") != F.col("component2"))
        & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * SIMILARITY)
        # What comes from here on must be enough.
        & (F.least("left", "left2") * (100 + SIMILARITY) >= (F.col("n") + F.col("n2")) * SIMILARITY),
    )
    return both.select(
        F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")
    ).distinct()


def _row_of(step: int, size_class: Column):
    return lambda x: F.struct(
        x["shingle"].alias("shingle"),
        (F.col("before") + x["i"]).alias("place"),
        size_class.alias("cls"),
        F.lit(step).alias("step"),
    )


def _same_id(usable: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the sets of one doc_id, if it has rows of several."""
    held = usable.select("doc_id", "f", "g").join(nodes, ["f", "g"]).select("doc_id", "rep")
    ends = held.groupBy(F.col("doc_id").alias("id")).agg(
        F.min("rep").alias("low"), F.max("rep").alias("high")
    )
    several = held.join(ends.filter("low < high"), F.col("doc_id") == F.col("id"))
    return several.filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))


def _split(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with theirs."""
    named = shared.join(found, F.col("rep") == F.col("node"), "left").select(
        "bucket", "rep", "n", "low", "high", F.coalesce("component", "rep").alias("component")
    )
    several = (
        named.groupBy(F.col("bucket").alias("own"))
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x < y")
        .select("own")
    )
    return named.join(several, F.col("bucket") == F.col("own"), "left_semi")
