import collections
import hashlib

import pytest

from llm import sharding


def brute_table(names, slots):
    order = []
    for name in names:
        d = hashlib.md5(name.encode()).hexdigest()
        start, skip = int(d[:16], 16) % slots, int(d[16:], 16) % (slots - 1) + 1
        order.append([(start + i * skip) % slots for i in range(slots)])
    owner, turn = {}, 0
    while len(owner) < slots:
        shard = turn % len(names)
        owner[next(s for s in order[shard] if s not in owner)] = shard
        turn += 1
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("n, slots", [(1, 2), (3, 7), (7, 101), (101, 101), (5, 997)])
def test_table_equals_brute_force(n, slots):
    names = [f"s{i}" for i in range(n)]
    assert sharding.lookup_table(names, slots) == brute_table(names, slots)


def test_shares_are_even_and_few_slots_move():
    names = [f"shard-{i}" for i in range(64)]
    table = sharding.lookup_table(names)
    assert len(table) == sharding.SLOTS
    count = collections.Counter(table).values()
    assert max(count) - min(count) <= 1 and len(count) == 64
    fewer = sharding.lookup_table(names[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != 63)
    assert moved < 0.12 * len(table)


@pytest.mark.parametrize("names, slots", [([], 7), (["a", "a"], 7), (["a"], 9), (["a"] * 3, 2)])
def test_bad_tables_are_refused(names, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, slots)


def test_rows_equal_brute_force(docs, odd_texts):
    table = sharding.lookup_table([f"shard-{i}" for i in range(sharding.SHARDS)])
    out = sharding.place(docs(odd_texts).withColumnRenamed("lang", "shard"))
    assert out.columns == ["doc_id", "text", "n_words", "kept", "bands", "slot", "shard"]
    got = out.collect()
    assert len(got) == len(odd_texts)
    for r in got:
        key = f"null:{r.text or ''}" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:12], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, table[slot])


def test_written_shards(docs, tmp_path, spark):
    placed = sharding.place(docs([(i, "t") for i in range(500)]), shards=5)
    sharding.write_shards(placed, str(tmp_path / "out"), parts=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(500))
    assert all(len(list(d.glob("*.parquet"))) <= 2 for d in (tmp_path / "out").glob("shard=*"))


def test_empty_table(docs):
    assert sharding.place(docs([])).collect() == []
