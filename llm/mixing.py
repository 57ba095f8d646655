"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of equally many words. Sources get blocks by highest
quotients of their targets, then the shards of each source by highest quotients of what
they hold. Inside a shard the rows lie one after the other in a seeded order; its blocks
are cut from that line, and those that are taken once more are spread along it from a
seeded start. So what a row gives follows from where it begins and ends, without a row
for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm import text as T
from sieveframe.sources.scratch import settle

WEIGHTS = (1, 2, 3)  # of the sources in code-point order, repeating
MOST = 3  # times a source's words that its target reaches, and that a row is taken
SEED = "mix-1"
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1024
# The smallest target has so many blocks, unless blocks would be less than a word. Their
# number costs nothing.
LEAST_BLOCKS = 1024
_SLACK = 1e-9  # keeps the bracket of a divisor apart from rounding


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words of the text, 0 for null) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            solid = ~T.is_space(part.data)
            begins = solid.copy()
            begins[1:] &= ~solid[:-1]
            heads = part.offsets[:-1][part.offsets[:-1] < len(solid)]
            begins[heads] = solid[heads]
            yield pa.RecordBatch.from_arrays(
                [
                    part.rows.column("doc_id"), part.rows.column("source"),
                    pa.array(T.per_row(begins, part.offsets).astype(np.int64)),
                ],
                names=["doc_id", "source", "size"],
            )

    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    return mine.mapInArrow(work, "doc_id long, source string, size long")


def positions(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` in a written table with ``position``: 0, 1, ... in this order.

    Sorted by ranges of the order; the driver gets the number of rows of each range.
    """
    placed = settle(
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "positions"
    )
    part = F.shiftright("_id", 33)
    sizes = {
        r["part"]: r["n"]
        for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    before = np.zeros(max(sizes, default=0) + 1, np.int64)
    for p, n in sizes.items():
        before[p + 1 :] += n
    starts = F.array(*(F.lit(int(x)) for x in before)).cast("array<long>")
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("position", F.get(starts, part.cast("int")) + within).drop("_id")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with sid, their number in order, and target.

    All sizes together are shared by weight. A target stops at MOST times its source's
    size; the excess is shared again until no target is above. A round is one small
    aggregate, and each but the last stops at least one more source.
    """
    placed = positions(sources, F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    weight = F.get(weights, (F.col("position") % len(WEIGHTS)).cast("int")).cast("long")
    most = MOST * F.col("source_size")
    total, shares = placed.agg(F.sum("source_size"), F.sum(weight)).first()
    share = total / shares if total else 0.0
    while total:
        above = most < F.lit(share) * weight
        held, free = placed.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0)),
        ).first()
        again = (total - held) / free
        if again == share:
            break
        share = again
    target = F.least(most.cast("double"), F.lit(share) * weight)
    return placed.select(
        F.col("position").alias("sid"), "source", "source_size", target.alias("target")
    )


def apportion(items: DataFrame, seats: DataFrame) -> DataFrame:
    """``items`` (sid, item, weight, most) with the seats each gets: ``quota``.

    ``seats`` has the number of seats of each sid. The items of a sid get them by the
    highest quotients weight / (2 k - 1), none more than its ``most``; equal quotients
    go to the lower item. Seats that nothing can take stay empty.

    Quotients above one divisor are counted, not listed. The divisor that fills the
    seats lies between two that follow from the sums; only quotients between them, a
    few for each item, are listed and ranked.
    """
    groups = items.groupBy("sid").agg(
        F.sum("weight").alias("all"), F.count(F.lit(1)).alias("n"), F.sum("most").alias("room")
    )
    groups = settle(
        groups.join(seats, "sid").select(
            "sid", "all", "n", F.least("seats", "room").alias("seats")
        ),
        "apportion",
    )

    def rounded(divisor: Column) -> Column:
        count = F.floor(F.col("weight") / divisor + 0.5).cast("long")
        return F.least(F.coalesce(count, F.lit(0).cast("long")), F.col("most"))

    step = 1.0
    while True:
        wide = F.when(
            F.col("seats") * 2 > F.col("n"),
            F.col("all") / (F.col("seats") - F.col("n") / 2) * (1 + _SLACK),
        )
        narrow = F.col("all") / (F.col("seats") + F.col("n") * step) * (1 - _SLACK)
        ranged = items.join(groups, "sid").select(
            "sid", "item", "weight", "most", "seats",
            rounded(wide).alias("least"), rounded(narrow).alias("top"),
        )
        short = ranged.groupBy("sid").agg(
            F.first("seats").alias("seats"), F.sum("top").alias("top")
        )
        # An item that reached its most may leave others more than the sums say.
        if short.filter("top < seats").isEmpty():
            break
        step *= 2
    ranged = settle(ranged, "ranged")
    sure = ranged.groupBy("sid").agg(
        F.sum("least").alias("sure"), F.first("seats").alias("seats")
    )
    between = (
        ranged.filter("top > least")
        .select("sid", "item", "weight", F.explode(F.sequence(F.col("least") + 1, "top")).alias("k"))
        .select("sid", "item", (F.col("weight") / (2 * F.col("k") - 1)).alias("quotient"))
    )
    ranked = positions(between, F.col("sid"), F.desc("quotient"), F.col("item"))
    first = ranked.groupBy("sid").agg(F.min("position").alias("first"))
    more = (
        ranked.join(first, "sid")
        .join(sure, "sid")
        .filter("position - first < seats - sure")
        .groupBy("sid", "item")
        .agg(F.count(F.lit(1)).alias("more"))
    )
    quota = F.col("least") + F.coalesce("more", F.lit(0))
    return ranged.join(more, ["sid", "item"], "left").select(
        "sid", "item", quota.alias("quota")
    )


def _key(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))


def _number(key: Column) -> Column:
    """A number below 2 ** 32 from the first digits of a key."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, shard, block_words, quota and taken.

    One row for each row of ``docs``. size is the number of words; source_size and
    target are those of its source; quota is how many blocks its shard of the source
    gives; taken is how many words of the row are in the mix, repeats counted, at most
    MOST times size. The sum of taken over a source differs from its target by about
    a block.

    A null source is one of its own, the last. A text without words, or null, has
    nothing to give. Rows that are equal in doc_id, source and size are counted before
    they are dealt to shards, each copy on its own. A null doc_id is a value like
    others. Other columns are not looked at. An empty table gives no rows.
    """
    counted = settle(
        word_counts(docs).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")),
        "sizes",
    )
    sources = targets(
        counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    )
    least, words = sources.filter("target > 0").agg(F.min("target"), F.sum("source_size")).first()
    block = max(1, min(BLOCK_WORDS, int((least or 0) // LEAST_BLOCKS)))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)).cast("long")
    named = sources.select("sid", F.col("source").alias("name"), "source_size", "target", shards.alias("shards"))
    copy = _key(F.col("doc_id"), F.col("sid"), F.col("size"), F.col("copy"))
    rows = (
        counted.join(named, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
        .withColumn("key", copy)
        .withColumn("shard", _number(F.col("key")) % F.col("shards"))
    )
    rows = settle(rows.drop("name", "shards", "n"), "dealt")
    held = settle(
        rows.filter("size > 0").groupBy("sid", "shard")
        .agg(F.sum("size").alias("words"))
        .withColumn("blocks", F.ceil(F.col("words") / block).cast("long")),
        "shards",
    )
    of_source = (
        held.groupBy("sid").agg(F.sum("blocks").alias("blocks"))
        .join(sources, "sid")
        .select(
            F.lit(0).cast("long").alias("sid"), F.col("sid").alias("item"),
            F.col("target").alias("weight"), (MOST * F.col("blocks")).alias("most"),
        )
    )
    spark = docs.sparkSession
    seats = spark.range(1).select(
        F.col("id").alias("sid"), F.lit(int((words or 0) // block)).cast("long").alias("seats")
    )
    by_source = apportion(of_source, seats).select(F.col("item").alias("sid"), F.col("quota").alias("seats"))
    of_shard = held.select(
        "sid", F.col("shard").alias("item"), F.col("blocks").alias("weight"),
        (MOST * F.col("blocks")).alias("most"),
    )
    quotas = apportion(of_shard, by_source).select(
        F.col("sid").alias("_sid"), F.col("item").alias("_shard"), "quota"
    )
    start = _number(_key(F.col("sid"), F.col("shard"))) % F.col("blocks")
    plan = held.join(
        quotas, (F.col("sid") == F.col("_sid")) & (F.col("shard") == F.col("_shard"))
    ).select("_sid", "_shard", "blocks", "quota", start.alias("start"))

    in_line = Window.partitionBy("sid", "shard").orderBy("key")
    line = rows.filter("size > 0").withColumn("end", F.sum("size").over(in_line))
    line = line.join(plan, (F.col("sid") == F.col("_sid")) & (F.col("shard") == F.col("_shard")))
    given = line.select(
        "doc_id", "source", "size", "source_size", "target", "shard", "quota",
        (_taken_before(F.col("end"), block) - _taken_before(F.col("end") - F.col("size"), block)).alias("taken"),
    )
    zero = F.lit(0).cast("long")
    empty = rows.filter("size = 0").select(
        "doc_id", "source", "size", "source_size", "target", "shard",
        zero.alias("quota"), zero.alias("taken"),
    )
    return given.unionAll(empty).withColumn("block_words", F.lit(block))


def _taken_before(place: Column, block: int) -> Column:
    """Words taken from the first ``place`` words of a shard's line.

    Every block is taken quota div blocks times; of quota mod blocks more, block i is
    one if (i + start) * extra passes a multiple of the number of blocks.
    """
    i, rest = F.call_function("div", place, F.lit(block)), place % block
    blocks, quota, start = F.col("blocks"), F.col("quota"), F.col("start")
    extra = quota % blocks
    each = F.call_function("div", quota, blocks)

    def passed(x: Column) -> Column:
        return F.call_function("div", (x + start) * extra, blocks)

    here = each + passed(i + 1) - passed(i)
    return (each * i + passed(i) - passed(F.lit(0))) * block + rest * here
