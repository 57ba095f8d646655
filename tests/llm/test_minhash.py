import itertools
import random
import re

import numpy as np
import pytest

from llm import minhash
from llm import text as T
from llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall((text or "").encode().lower())
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in itertools.combinations(zip([i for i, _ in rows], sets), 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((root(i), root(j)))
            up[y] = x
    return {i: (len(s), root(i)) for (i, _), s in zip(rows, sets)}


def variants(seed):
    """Groups around the limit, chains, exact copies, tiny texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(500)]
    out = []
    for _ in range(12):
        base = r.choices(vocabulary, k=r.randint(4, 120))
        for _ in range(r.randint(1, 10)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 12))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            out.append(" ".join(copy))
            if r.random() < 0.3:
                base = copy
        out += [out[-1], out[-1].upper()]
    out += ["a", "A", "a b", "a b c", "b a", "", " "]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("width, seed", [(2, 0), (2, 1), (5, 2)])
def test_equals_brute_force(docs, width, seed):
    rows = variants(seed)
    got = minhash.near_duplicates(docs(rows), width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(docs, odd_texts):
    got = minhash.near_duplicates(docs(odd_texts), 2).collect()
    assert len(got) == len(odd_texts)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[1].n_shingles, by_id[1].component_id, by_id[1].kept) == (0, 1, True)
    # Rows of id 9 are one document, and one of them equals 5.
    assert {r.component_id for r in got if r.doc_id in (5, 9)} == {5}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_empty_table(docs):
    assert minhash.near_duplicates(docs([])).collect() == []


def test_sketch_is_full_and_estimates_similarity():
    r = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 3000):
        a = r.integers(0, 2**64, n, np.uint64)
        b = a.copy()
        b[: n // 5] = r.integers(0, 2**64, n // 5, np.uint64)
        value = np.concatenate([a, b])
        row = np.repeat([0, 1], n)
        table = minhash.sketch(row, value, 2)
        assert (table != ~np.uint64(0)).all()
        true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        assert abs((table[0] == table[1]).mean() - true) < 0.12


def test_rows_without_elements_have_no_sketch():
    table = minhash.sketch(np.zeros(0, np.int64), np.zeros(0, np.uint64), 2)
    assert (table == ~np.uint64(0)).all()


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)]
    links += [(1150, 2000), (5000, 5000)]
    random.Random(2).shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r.node: r.component for r in got}
    assert all(found[i] == 0 for i in range(301))
    assert all(found[i] == 1000 for i in [*range(1000, 1200), 2000])
    assert len(got) == len(found)


def test_a_slice_does_not_change_a_set():
    data = np.frombuffer("one two Three\n two three".encode(), np.uint8)
    row, value = minhash.shingle_sets(data, np.array([0, 13, len(data)]), 2)
    assert np.bincount(row).tolist() == [2, 1]
    assert value[2] in value[:2].tolist()
    assert T.words(data, np.array([0, 13, len(data)])).row.tolist() == [0, 0, 0, 1, 1]


def test_components_of_stars_and_chains(spark):
    """Centres of many links beside long chains."""
    r = random.Random(2)
    links = [(0, i) for i in range(100, 400)] + [(i, 999) for i in range(400, 600)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(399, 450), (1030, 2000)]
    links += [(r.randint(3000, 3400), r.randint(3000, 3400)) for _ in range(300)]
    r.shuffle(links)
    found = {x: x for pair in links for x in pair}

    def root(x):
        while found[x] != x:
            x = found[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        found[b] = a
    df = spark.createDataFrame(links, "a long, b long")
    got = {x.node: x.component for x in components(df).collect()}
    assert got == {x: root(x) for x in found if root(x) != x or any(root(y) == x for y in found if y != x)}


def test_steps_leave_no_shuffle_files(docs, shuffle_files):
    """The disk never holds the shuffles of more than one step."""
    rows = variants(3)
    before = shuffle_files()
    got = minhash.near_duplicates(docs(rows), 2)
    assert not shuffle_files(unlike=before)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 2)
