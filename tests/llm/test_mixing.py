"""Quotas and shares of a mix against a seat-by-seat version."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from llm import mixing as M


def seats_one_by_one(weights, most, seats):
    got = [0] * len(weights)
    for _ in range(seats):
        free = [i for i in range(len(got)) if got[i] < most[i]]
        if not free:
            break
        got[max(free, key=lambda i: (Fraction(weights[i]) / (2 * got[i] + 1), -i))] += 1
    return got


@pytest.mark.parametrize("seed", range(4))
def test_apportionment(spark, seed):
    r = random.Random(seed)
    groups = {}
    for sid in range(6):
        n = r.choice([1, 2, 5, 40])
        weights = [r.choice([1, 7, 7, r.randint(1, 3000)]) for _ in range(n)]
        most = [r.choice([0, 3, 5, 4000]) for _ in range(n)]
        groups[sid] = weights, most, r.choice([0, 1, n // 2, 90, 700])
    items = [(s, i, w, m) for s, (ws, ms, _) in groups.items() for i, (w, m) in enumerate(zip(ws, ms))]
    df = spark.createDataFrame(items, "sid long, item long, weight long, most long")
    seats = spark.createDataFrame([(s, g[2]) for s, g in groups.items()], "sid long, seats long")
    got = {(x.sid, x.item): x.quota for x in M.apportion(df, seats).collect()}
    for s, (weights, most, n) in groups.items():
        assert [got[s, i] for i in range(len(weights))] == seats_one_by_one(weights, most, n)


def test_targets_stop_and_reshare(spark):
    sizes = {"a": 10, "b": 1, "c": 400, "é": 5, "z": 1000, None: 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    stopped = set()
    while True:
        share = Fraction(sum(sizes.values()) - sum(3 * sizes[s] for s in stopped), sum(weight[s] for s in sizes if s not in stopped))
        above = {s for s in sizes if s not in stopped and share * weight[s] > 3 * sizes[s]}
        if not above:
            break
        stopped |= above
    want = {s: float(3 * sizes[s] if s in stopped else share * weight[s]) for s in sizes}
    assert got == pytest.approx(want) and 3 <= len(stopped) < 6
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


@pytest.fixture
def mixed(spark):
    def make(rows):
        schema = "doc_id long, source string, text string, size string, target string, taken int, key string"
        more = [(*row, "x", "y", 1, "z") for row in rows]
        return spark.createDataFrame(more, schema).repartition(3)

    return make


def corpus(seed, n=400):
    r = random.Random(seed)
    sources = ["a"] * 8 + ["b", "c", "d", "", None, "tiny"]
    rows = [(i, r.choice(sources), " ".join("w" * r.choice([0, 1, 5, 40, 200]))) for i in range(n)]
    rows = [x for x in rows if x[1] != "tiny"] + [(n, "tiny", "three words only"), (n + 1, "none", " \n")]
    rows += [(None, "b", None), (None, None, "a text without id"), (7, "d", "x\x0by\tz")] * 3
    return rows + [(900, "a", "w " * 30_000)]


def test_mix_comes_near_its_targets(mixed, monkeypatch):
    monkeypatch.setattr(M, "SHARD_WORDS", 2000)
    rows = corpus(1)
    got = M.mix(mixed(rows)).collect()
    size = lambda text: len((text or "").replace("\x0b", " ").split())
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, size(t)) for i, s, t in rows)
    of = defaultdict(int)
    for _, s, t in rows:
        of[s] += size(t)
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= M.MOST * r["size"] and r.source_size == of[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
    shards = {r.shard for r in got if r.source == "a"}
    assert len(shards) > 5
    for s, want in target.items():
        # Each shard of a source may end in a short block.
        assert abs(taken[s] - want) <= max(3 * got[0].block_words * (1 + of[s] // 2000), 0.01 * want)
    assert sum(taken.values()) == pytest.approx(sum(of.values()), rel=0.01)


def test_reruns_and_partitions_agree(mixed):
    rows = corpus(2)
    key = lambda r: tuple(str(x) for x in r)
    first = sorted(M.mix(mixed(rows)).collect(), key=key)
    again = sorted(M.mix(mixed(rows[::-1]).coalesce(1)).collect(), key=key)
    assert first == again


def test_words_taken_add_up_block_by_block(spark):
    """The closed form against a walk over all words."""
    for words, block, quota, start in ((10, 3, 5, 1), (7, 2, 0, 3), (100, 7, 45, 9), (5, 9, 2, 0)):
        blocks = -(-words // block)
        extra = quota % blocks
        times = [quota // blocks + (i + 1 + start) * extra // blocks - (i + start) * extra // blocks for i in range(blocks)]
        assert sum(times) == quota
        df = spark.range(words + 1).select(
            "id", F.lit(blocks).cast("long").alias("blocks"), F.lit(quota).cast("long").alias("quota"),
            F.lit(start).cast("long").alias("start"),
        )
        got = {r.id: r.n for r in df.select("id", M._taken_before(F.col("id"), block).alias("n")).collect()}
        assert [got[p] for p in range(words + 1)] == [sum(times[i // block] for i in range(p)) for p in range(words + 1)]


@pytest.mark.parametrize("rows", [[], [(1, "a", None), (2, None, "")]])
def test_nothing_to_take(mixed, rows):
    got = M.mix(mixed(rows)).collect()
    assert len(got) == len(rows) and all(r.taken == 0 and r.target == 0 for r in got)
