"""Benchmark decontamination with spaced seeds, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.sources.scratch import settle

# A passage is WINDOW words long, or the whole item if that is shorter, and counts as
# found if MATCH percent of its words stand at the same places.
WINDOW = 13
MATCH = 80
SHORTEST = 5
# Word positions that a seed looks at, by the least length of a passage. Any passage of
# that length with as many other words as MATCH allows keeps one seed of its masks whole.
MASKS = {
    13: ((0, 1, 3, 6, 7),),
    10: ((0, 1, 2, 3), (0, 1, 2, 4)),
    5: ((0, 1, 2), (0, 1, 3)),
}
SPAN = 1 + max(p for masks in MASKS.values() for mask in masks for p in mask)
# Words of items that are broadcast at once: at most 2 seeds each, with the words around
# them, in less than 1 KB.
BLOCK = 200_000
SPACE = r"[\x20\x09-\x0D]+"


def word_hashes(text: Column) -> Column:
    """The hash of each lower-cased word, in order."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _used(masks: list) -> list[int]:
    return sorted({p for _, mask in masks for p in mask})


def _seeds(row: Column, masks: list) -> Column:
    """The seed of each mask (with its number) at one place; null past the end."""
    out = []
    for number, mask in masks:
        places = [row[f"h{p}"] for p in mask]
        out.append(F.when(places[-1].isNotNull(), F.xxhash64(F.lit(number), *places)))
    return F.array(*out)


def _places(hashes: Column, masks: list) -> Column:
    """At each place its hash and those after it that a mask looks at."""
    shifted = []
    for p in _used(masks):
        rest = F.slice(hashes, p + 1, F.greatest(F.size(hashes) - p, F.lit(0)))
        shifted.append((rest if p else hashes).alias(f"h{p}"))
    return F.arrays_zip(*shifted)


def _all_seeds(df: DataFrame, masks: list, *keep: str) -> DataFrame:
    """(keep..., hashes, place, seed) of every mask at every place."""
    zipped = _places(F.col("hashes"), masks)
    at = df.select(*keep, "hashes", F.posexplode(zipped).alias("place", "row"))
    seeds = F.explode(_seeds(F.col("row"), masks)).alias("seed")
    return at.select(*keep, "hashes", "place", seeds).filter(F.col("seed").isNotNull())


def _around(hashes: Column, place: Column) -> Column:
    """The words that a passage with the seed at this place can hold, and the seed's
    place among them; WINDOW bounds how many that are."""
    back = F.least(place, F.lit(WINDOW - 1))
    return F.struct(
        F.slice(hashes, place - back + 1, back + SPAN + WINDOW).alias("words"),
        back.alias("place"),
    )


def items_of(benchmark: DataFrame) -> DataFrame:
    """item, hashes, words of a passage, and words it must share; SHORTEST words or more."""
    n = F.least(F.size("hashes"), F.lit(WINDOW))
    return (
        benchmark.select(F.col("item_id").cast("long").alias("item"), word_hashes(F.col("text")).alias("hashes"))
        .filter(F.size("hashes") >= SHORTEST)
        .select("item", "hashes", n.alias("width"), F.ceil(n * MATCH / 100).cast("int").alias("need"))
    )


def _shared(own: Column, item: Column, width: Column) -> Column:
    """The most equal words in one passage of ``width`` words; both seeds side by side.

    Places outside the document or the item differ.
    """
    back = F.least(own["place"], item["place"])
    a = F.slice(own["words"], own["place"] - back + 1, SPAN + 2 * WINDOW)
    b = F.slice(item["words"], item["place"] - back + 1, SPAN + 2 * WINDOW)
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))
    sums = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(same) - width + 1, F.lit(1))),
        lambda i: F.aggregate(F.slice(same, i, width), F.lit(0), lambda s, x: s + x),
    )
    return F.array_max(sums)


def hits(docs: DataFrame, benchmark: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., item) of the documents that hold a passage of an item.

    Seeds of the items are broadcast, at most BLOCK words of items at a time; a larger
    benchmark is searched for in several passes. Places of documents whose seed no
    item has stop there. The others go on with the few words around them, dealt by
    place so that no document or common seed is one task's work, and are compared with
    each item that has the seed.
    """
    items = settle(items_of(benchmark), "items")
    size = items.agg(F.sum(F.size("hashes")).alias("n"), F.min("width").alias("low")).first()
    if not size["n"]:
        return docs.select(*keys, F.lit(None).cast("long").alias("item")).limit(0)
    lengths = [n for n in MASKS if n == WINDOW or size["low"] < _above(n)]
    masks = list(enumerate(m for n in MASKS for m in MASKS[n]))
    of = {n: [(i, m) for i, m in masks if m in MASKS[n]] for n in MASKS}
    used = [x for n in lengths for x in of[n]]
    blocks = -(-size["n"] // BLOCK)
    hashed = docs.select(*keys, word_hashes(F.col("text")).alias("hashes"))
    seeded = _all_seeds(hashed, used, *keys)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        their = None
        for n in lengths:
            mine = part.filter((F.col("width") >= n) & (F.col("width") < _above(n)))
            some = _all_seeds(mine, of[n], "item", "width", "need").select(
                "item", "width", "need", F.col("seed").alias("theirs"),
                _around(F.col("hashes"), F.col("place")).alias("passage"),
            )
            their = some if their is None else their.unionAll(some)
        their = settle(their, "seeds")
        known = F.broadcast(their.select("theirs").distinct())
        near = (
            seeded.join(known, F.col("seed") == F.col("theirs"), "left_semi")
            .select(*keys, "place", "seed", _around(F.col("hashes"), F.col("place")).alias("own"))
            .repartition(tasks, *keys, "place")
        )
        shared = _shared(F.col("own"), F.col("passage"), F.col("width"))
        hit = (
            near.join(F.broadcast(their), F.col("seed") == F.col("theirs"))
            .filter(shared >= F.col("need"))
            .select(*keys, "item")
        )
        found = hit if found is None else found.unionAll(hit)
    return found.distinct()


def _above(n: int) -> int:
    """The next longer class of passages begins here."""
    longer = [m for m in MASKS if m > n]
    return min(longer) if longer else 1 << 30


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, first_item and contaminated of every row.

    n_items is the number of benchmark items of which the text holds a passage: WINDOW
    consecutive words of the item (all of a shorter one) of which MATCH percent or
    more stand at the same distances in the text. Words are lower-cased. Items below
    SHORTEST words are not searched for. Null or empty texts hold none, null item ids
    count as one item, and equal items count each. Rows of one doc_id are told apart
    by their text; equal rows have equal results. Other columns are not looked at. An
    empty table gives no rows, an empty benchmark leaves all rows clean.
    """
    keyed = _keyed(docs).select("doc_id", "text", "row_key")
    found = hits(keyed, benchmark, ["doc_id", "row_key"])
    counts = found.groupBy(F.col("doc_id").alias("id"), F.col("row_key").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("item").alias("first_item")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key"))
    return (
        keyed.select("doc_id", "row_key")
        .join(counts, same, "left")
        .select(
            "doc_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_items"), "first_item",
            F.col("n").isNotNull().alias("contaminated"),
        )
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "row_key", F.xxhash64("text")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no passage."""
    names = docs.columns
    keyed = docs.select("*", F.xxhash64("text").alias("_row_key"))
    found = hits(keyed.select("doc_id", "text", "_row_key"), benchmark, ["doc_id", "_row_key"])
    ids = found.select(F.col("doc_id").alias("_id"), F.col("_row_key").alias("_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row_key") == F.col("_key"))
    return keyed.join(ids, same, "left_anti").select(*(f"`{n}`" for n in names))
